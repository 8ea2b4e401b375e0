"""Links between rows: grouped streaming tasks, local forests and distributed connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import written


def runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``by`` as one table each, across batch borders (rows come sorted)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(by)).to_numpy()
        borders = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for start, stop in zip(borders, borders[1:]):
            if held and keys[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = keys[start]
    if held:
        yield pa.Table.from_batches(held)


def per_task(frame: DataFrame, run: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Applies ``run`` to the rows of each value of ``task``; cheaper than grouped Pandas for many small groups."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "task"):
            found = run(table)
            if found is not None:
                yield found

    return frame.repartition("task").sortWithinPartitions("task").mapInArrow(apply, schema)


def block_tasks(frame: DataFrame, group: str, member: str, blocks: str) -> DataFrame:
    """Adds ``task`` (and ``own_block``, ``other_block``): a group of one block is one task, others are dealt to one task per pair of blocks.

    Every pair of members meets in a task, and no task holds more than two blocks.
    """
    own = F.pmod(F.xxhash64(F.col(member), F.lit(7)), F.col(blocks))
    other = F.filter(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1), lambda b: (F.col(blocks) == 1) | (b != own))
    frame = frame.withColumn("own_block", own).withColumn("other_block", F.explode(other))
    pair = [F.least("own_block", "other_block"), F.greatest("own_block", "other_block")]
    return frame.withColumn("task", F.xxhash64(group, *pair))


class Forest:
    """Union-find over the members of a task."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, members: np.ndarray) -> None:
        """Makes ``members`` one component (whole components move)."""
        roots = np.unique(self.root[members])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id on an edge (a, b); the component is its smallest id.

    Large-star and small-star rounds: every node moves its neighbours to the smallest it knows, until every
    component is a star; each round's table is written. Minima are combined before they are shuffled, and a hub's edges stay rows.
    """
    pairs = written(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    while not _stars(pairs):
        both = pairs.select(F.explode(F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")), F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*")
        pairs = written(small.where("hi <> lo").distinct(), "edges")
    return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
        pairs.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    )


def _stars(pairs: DataFrame) -> bool:
    """Whether every node that has a smaller neighbour has one only, and that one has none."""
    ends = pairs.select("hi", F.lit(1).alias("n")).unionByName(pairs.select(F.col("lo").alias("hi"), F.lit(0).alias("n")))
    # a node seen above and below another, or above two others, breaks a star
    seen = ends.groupBy("hi").agg(F.sum("n").alias("above"), F.min("n").alias("least"))
    return seen.where((F.col("above") > 1) | ((F.col("above") > 0) & (F.col("least") == 0))).isEmpty()
