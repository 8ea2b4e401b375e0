"""Adjacency maps as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_adjacency(
    edges: DataFrame, path: str, nodes: DataFrame | None = None, chunk: int = 100_000, mode: str = "errorifexists"
) -> None:
    """One JSON object per line: ``{"node": ["neighbour", ..]}``.

    A line holds at most ``chunk`` neighbours; a hub spreads over as many lines
    as it needs, and the reader joins them again. Sorting by range splits a hub
    between tasks, because the neighbour is part of the sort key. ``nodes``
    adds an empty list for nodes without edges.
    """
    ranged = edges.select("src", "dst").repartitionByRange("src", "dst").sortWithinPartitions("src", "dst")
    tagged = ranged.withColumn("_tag", F.monotonically_increasing_id())
    # The tag grows by one per row of a partition, so each slice of tags is one bounded group.
    pieces = tagged.groupBy("src", F.expr(f"_tag div {int(chunk)}").alias("_slice"))
    lines = pieces.agg(F.sort_array(F.collect_list("dst")).alias("nbrs")).select("src", "nbrs")
    if nodes is not None:
        alone = nodes.select(F.col(nodes.columns[0]).alias("src")).join(edges, "src", "left_anti")
        lines = lines.unionByName(alone.select("src", F.array().cast("array<string>").alias("nbrs")))
    text = lines.select(F.to_json(F.create_map(F.col("src").cast("string"), F.col("nbrs").cast("array<string>"))))
    text.toDF("value").write.mode(mode).text(path)


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """``src, pos, dst``; ``pos`` and ``dst`` are null for a node without neighbours.

    Each line may hold any number of keys, so one object for the whole map
    reads as well.
    """
    maps = spark.read.text(path).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    lists = maps.select(F.explode("m").alias("src", "nbrs"))
    return lists.select("src", F.posexplode_outer("nbrs").alias("pos", "dst"))
