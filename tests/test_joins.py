"""The same results whichever way Spark joins, with a third of the rows under one key."""

import pytest
from pyspark.sql import functions as F

from screenlake.operators import encoding, features, graph, index


@pytest.fixture(params=["broadcast", "shuffle with skew splits"])
def joining(spark, request):
    changed = {}
    if request.param != "broadcast":
        changed = {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def hot(spark):
    third = F.col("id") % 3 == 0
    return spark.range(3000).repartition(6).select(
        F.col("id").alias("cell_id"),
        F.when(third, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 40).cast("string"))).alias("condition"),
        F.when(F.col("id") % 2 == 0, "cycling").otherwise("effector").alias("state"),
    )


def test_labels(joining, hot):
    labels = features.label_table(hot)
    got = features.expand_labels(hot, labels)
    assert got.count() == 3000
    sums = got.groupBy("condition").agg(F.sum("cycling").alias("s"), F.count_if(F.col("state") == "cycling").alias("n"))
    assert sums.filter("abs(s - n) > 1e-6").count() == 0


def test_group_numbers(joining, hot):
    keys = sorted({r.condition for r in hot.select("condition").distinct().collect()})
    got = index.group_number(hot, "condition").select("condition", "group_number").distinct().collect()
    assert {r.condition: r.group_number for r in got} == {k: str(i) for i, k in enumerate(keys)}


def test_encoding(joining, hot):
    vocab = encoding.vocabulary(hot, "condition")
    ids = {r.token: r.id for r in vocab.collect()}
    got = encoding.encode(hot, "cell_id", {"x": ("condition", 2)}, vocab).join(hot, "cell_id")
    assert got.count() == 3000
    wrong = [r for r in got.select("condition", "x_ids").distinct().collect() if r.x_ids != [ids[r.condition], 0]]
    assert not wrong


def test_subgraph(joining, hot):
    edges = hot.select(F.lit(0).cast("long").alias("src"), "cell_id").withColumnRenamed("cell_id", "dst")
    nodes = hot.select(F.col("cell_id").alias("node")).filter("node < 100")
    assert graph.induced_subgraph(edges, nodes).count() == 100
