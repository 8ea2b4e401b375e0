"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside the cells.

Centres are fitted on a bounded sample; every vector is then placed in its nearest cell (home), in its core or its shell.
Cores and shells fill blocks, tight ones first, and a vector is a guest in every earlier block where the geometry of the
cells leaves room for a partner. So every pair meets exactly once, in the earlier of its two home blocks. A task holds the
rows at home in one block and compares the guests as they come.

Exact copies are one class with a count, so a very common vector is one row in the cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import written
from screenlake.llm.links import Forest, components


def unit_rows(column: pa.Array, size: int) -> np.ndarray:
    """Double-precision rows of length 1."""
    values = column.values if isinstance(column, pa.ListArray) else column.combine_chunks().values
    rows = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """Spherical k-means: assign by largest cosine, move centres to the normalised mean."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        best = np.concatenate([(sample[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, best, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def usable(vector: str) -> F.Column:
    """Whether a vector is there, finite and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    frame: DataFrame, threshold: float = 0.9, vectors_per_cell: int = 500, max_cells: int = 4096, fit_rows: int = 20_000,
    block_rows: int = 2048, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; links are pairs with a cosine of at least ``threshold``.

    ``fit_rows`` bounds the sample for the centres (the rows with the smallest hashes), ``max_cells`` the centres;
    larger cells take more blocks. No pair is missed at any setting. Vectors without direction in common
    with few others have to visit most blocks, so a table of such vectors takes quadratic time. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing and are their own component; vectors of different lengths do
    not link. Rows with equal vectors link with each other. ``component_id`` passes over null keys. An empty table
    gives no rows; other columns, labels among them, are not read.
    """
    rows = frame.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))
    rows = rows.withColumn("valid", usable("vector"))
    rows = rows.withColumn("one", F.xxhash64("vector")).withColumn("two", F.xxhash64(F.lit(1), F.reverse("vector")))
    classes = rows.where("valid").groupBy("one", "two").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    classes = written(classes.withColumn("size", F.size("vector")).withColumn("cid", F.monotonically_increasing_id()), "classes")
    sizes = written(classes.groupBy("size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    # sizes of few vectors are one block each and share a pass; one of many has its own cells
    few = classes.join(sizes.where(F.col("n") <= block_rows), "size")
    found = compared(few.select(F.col("size").cast("long").alias("task"), F.lit(False).alias("guest"), "cid", "copies", "vector"), threshold)
    for size in [r["size"] for r in sizes.where(F.col("n") > block_rows).collect()]:
        found = found.unionByName(_linked(classes.where(F.col("size") == size), int(size), threshold, vectors_per_cell, max_cells, fit_rows, block_rows))
    found = written(found, "links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = components(found.where("cid <> parent").select(F.col("cid").alias("a"), F.col("parent").alias("b")))
    named = classes.select("cid", "one", "two", "first", "copies").join(counts, "cid", "left").join(parts.withColumnRenamed("id", "cid"), "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "component").select("one", "two", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    result = rows.select("key", "one", "two", "valid").join(written(named, "named").withColumn("valid", F.lit(True)), ["one", "two", "valid"], "left")
    result = result.withColumn("component_id", F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("key")))
    return result.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )


def fill_blocks(counts: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first block, number of blocks) of each part in order, and the parts that begin new blocks.

    Small parts share a block, a part that is larger than a block has several of its own.
    """
    first, parts, begins, last, room = [], [], [], -1, 0
    for i, count in enumerate(counts):
        if count > room:
            begins.append(i)
            parts.append(max(1, -(-int(count) // block_rows)))
            first.append(last + 1)
            last += parts[-1]
            room = block_rows if parts[-1] == 1 else 0
        else:
            parts.append(1)
            first.append(last)
        room -= min(room, int(count))
    return np.asarray(first), np.asarray(parts), np.asarray(begins)


class Block:
    """The rows at home in a block; counts their links with each other and with guests."""

    def __init__(self, cid: np.ndarray, copies: np.ndarray, rows: np.ndarray, threshold: float):
        self.cid, self.copies, self.rows, self.threshold = cid, copies, rows, threshold
        self.single = rows.astype(np.float32)
        self.links, self.forest = np.zeros(len(cid), np.int64), Forest(len(cid))
        for at in range(0, len(cid), 256):
            a, b = self.near(rows[at : at + 256])
            fine = a + at < b
            a, b = a[fine] + at, b[fine]
            self.count(a, b, copies)
            self.join(a, b, inside=True)

    def near(self, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (other, own) at the threshold or above: by single precision, close calls by double precision."""
        doubt = (others.shape[1] + 8) * 2.0**-22
        cosines = others.astype(np.float32) @ self.single.T
        a, b = np.nonzero(cosines >= self.threshold - doubt)
        sure = cosines[a, b] >= self.threshold + doubt
        unsure = np.flatnonzero(~sure)
        for at in range(0, len(unsure), 16_384):
            part = unsure[at : at + 16_384]
            sure[part] = np.einsum("ij,ij->i", others[a[part]], self.rows[b[part]]) >= self.threshold
        return a[sure], b[sure]

    def count(self, a: np.ndarray, b: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """Adds the copies of ``a`` to the links of ``b`` (own rows); inside the block also the other way round."""
        self.links += np.bincount(b, copies[a], len(self.cid)).astype(np.int64)
        links = np.bincount(a, self.copies[b], len(copies)).astype(np.int64)
        if copies is self.copies:
            self.links += links
        return links

    def join(self, a: np.ndarray, b: np.ndarray, inside: bool = False) -> np.ndarray:
        """Joins the own rows ``b`` that share a partner ``a`` (in order), and the partner if it is ``inside``; one of them for each partner."""
        if not len(a):
            return np.zeros(0, np.int64)
        begins = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        for i, members in zip(a[begins], np.split(b, begins[1:])):
            if inside:
                members = np.append(members, i)
            root = self.forest.root[members]
            if (root != root[0]).any():
                self.forest.join(members)
        return b[begins]

    def guests(self, cid: np.ndarray, copies: np.ndarray, rows: np.ndarray) -> pa.RecordBatch | None:
        found = []
        for at in range(0, len(cid), 512):
            a, b = self.near(rows[at : at + 512])
            links = self.count(a, b, copies[at : at + 512])
            partner = self.join(a, b)
            linked = np.unique(a)
            if len(linked):
                found.append((cid[at + linked], links[linked], self.cid[partner]))
        return link_rows(*map(np.concatenate, zip(*found))) if found else None

    def own(self) -> pa.RecordBatch | None:
        kept = np.flatnonzero(self.links)
        return link_rows(self.cid[kept], self.links[kept], self.cid[self.forest.root[kept]]) if len(kept) else None


def link_rows(cid: np.ndarray, links: np.ndarray, parent: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cid), pa.array(links), pa.array(parent)], ["cid", "links", "parent"])


def compared(tasks: DataFrame, threshold: float) -> DataFrame:
    """(cid, links, parent) of the rows of each task, (task, guest, cid, copies, vector) of one size."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, block = None, [], None

        def opened() -> Block:
            return Block(*map(np.concatenate, zip(*held)), threshold)

        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
            ids, guest = column("task").to_numpy(), column("guest").to_numpy(zero_copy_only=False)
            borders = np.flatnonzero((ids[1:] != ids[:-1]) | (guest[1:] != guest[:-1])) + 1
            for start, stop in zip([0, *borders], [*borders, len(ids)]):
                piece = batch.slice(start, stop - start)
                values = piece.column(piece.schema.get_field_index("vector")).flatten()
                size = len(values) // piece.num_rows
                lists = pa.ListArray.from_arrays(pa.array(np.arange(piece.num_rows + 1, dtype=np.int32) * size), values)
                rows = (column("cid").to_numpy()[start:stop], column("copies").to_numpy()[start:stop], unit_rows(lists, size))
                if ids[start] != task:
                    if held and (found := (block or opened()).own()) is not None:
                        yield found
                    task, held, block = ids[start], [], None
                if not guest[start]:
                    held.append(rows)
                    continue
                if not held:
                    continue
                block = block or opened()
                if (found := block.guests(*rows)) is not None:
                    yield found
        if held and (found := (block or opened()).own()) is not None:
            yield found

    return tasks.repartition("task").sortWithinPartitions("task", "guest").mapInArrow(compare, "cid long, links long, parent long")


def _linked(classes, size, threshold, vectors_per_cell, max_cells, fit_rows, block_rows) -> DataFrame:
    """(cid, links, parent) per task: copies that a class links to in the task, and a class of its component."""
    n = classes.count()
    sample = classes.orderBy("one", "two").limit(fit_rows).select("vector").toPandas()["vector"]
    centres = fit_centres(np.stack([np.asarray(v, np.float64) / np.linalg.norm(np.asarray(v, np.float64)) for v in sample]), min(max_cells, max(1, n // vectors_per_cell)))
    angle = np.arccos(np.clip(threshold, -1, 1))
    slack = 1e-6  # for rounding, in radians

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                column = part.column(part.schema.get_field_index("vector"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * size), column.flatten())
                close = np.clip(unit_rows(lists, size) @ centres.T, -1, 1)
                yield part, close, close.argmax(axis=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, close, home in parts_of(batches):
            away = np.arccos(close[np.arange(len(home)), home])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home * 2 + (away > angle)), pa.array(away)], [*part.schema.names, "part", "away"])

    kind = classes.schema["vector"].dataType.simpleString()
    placed = written(classes.select("cid", "copies", "vector").mapInArrow(place, f"cid long, copies long, vector {kind}, part long, away double"), "placed")
    shape = placed.groupBy("part").agg(F.min("away").alias("least"), F.max("away").alias("most"), F.count(F.lit(1)).alias("n"))
    shape = sorted((r["most"], r["part"], r["least"], r["n"]) for r in shape.collect())  # core and shell of every cell
    most, part_ids, least = (np.asarray([r[i] for r in shape]) for i in range(3))
    first, parts, begins = fill_blocks(np.asarray([r[3] for r in shape]), block_rows)
    rank = np.zeros(2 * len(centres), np.int64)
    rank[part_ids] = np.arange(len(shape))
    cells = part_ids // 2
    apart = np.sqrt(np.maximum(0, 2 - 2 * np.clip(centres @ centres.T, -1, 1)))
    reach = np.sin(angle) if angle < np.pi / 2 else 1.0

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, close, home in parts_of(batches):
            # a partner is within `angle`: its distance from the centre differs by that much at most, and it is on its own side of the border
            border = close[np.arange(len(home)), home][:, None] - close <= reach * apart[home] + slack
            away = np.arccos(close)[:, cells]
            may = border[:, cells] & (away <= most + angle + slack) & (away >= least - angle - slack)
            may = np.logical_or.reduceat(may, begins, axis=1)  # a vector visits a block once
            may = np.repeat(may, parts[begins], axis=1)
            at = rank[part.column(part.schema.get_field_index("part")).to_numpy()]
            spread = part.column(part.schema.get_field_index("spread")).to_numpy()
            own = first[at] + spread % parts[at]
            row, block = np.nonzero(may & (np.arange(may.shape[1]) < own[:, None]))
            stops = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(home)))]).astype(np.int32)
            visits = pa.ListArray.from_arrays(pa.array(stops), pa.array(block.astype(np.int64)))
            kept = [part.column(part.schema.get_field_index(name)) for name in ("cid", "copies", "vector")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(own.astype(np.int64)), visits], ["cid", "copies", "vector", "own", "visits"])

    spread = placed.withColumn("spread", F.pmod(F.xxhash64("cid", F.lit(7)), F.lit(1 << 40)))
    visits = spread.mapInArrow(visit, f"cid long, copies long, vector {kind}, own long, visits array<long>")
    tasks = visits.withColumn("task", F.explode(F.concat(F.array("own"), "visits")))
    return compared(tasks.select("task", (F.col("task") != F.col("own")).alias("guest"), "cid", "copies", "vector"), threshold)
