import hashlib

import pytest
from pyspark.sql import functions as F

from screenlake.operators import index


def order_of(keys, seed=42):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_permutation_is_the_hash_order(spark, n):
    got = index.permute(spark.range(n), ["id"], 42, total="n").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == order_of(range(n))
    assert all(r.n == n for r in got) and sorted(r.position for r in got) == list(range(n))


def test_layout_does_not_matter(spark, rows):
    ids = spark.range(500)
    want = rows(index.permute(ids.coalesce(1), ["id"], 7))
    assert rows(index.permute(ids.repartition(9), ["id"], 7)) == want
    assert rows(index.permute(ids, ["id"], 8)) != want


def test_epochs_have_their_own_order(spark):
    got = index.permute_per_epoch(spark.range(50), ["id"], 42, 3).collect()
    orders = [[r.id for r in sorted((r for r in got if r.epoch == e), key=lambda r: r.position)] for e in range(3)]
    assert all(sorted(o) == list(range(50)) for o in orders) and orders[0] != orders[1] != orders[2]


@pytest.mark.parametrize("n,fraction,size", [(10, 0.25, 2), (10, 0.35, 4), (6, 0.25, 2), (10, 0.0, 0), (10, 1.0, 10), (0, 0.5, 0)])
def test_sample_rounds_half_to_even(spark, n, fraction, size):
    got = [r.id for r in index.sample_fraction(spark.range(n), ["id"], fraction).collect()]
    assert sorted(got) == sorted(order_of(range(n))[:size])


def test_split_masks(spark):
    got = index.split_masks(spark.range(5), ["id"], 0.5).collect()
    assert sum(r.test_mask for r in got) == 2 and sum(r.train_mask for r in got) == 3
    assert all(r.test_mask + r.train_mask == 1 for r in got)


def test_three_way(spark):
    got = [r.split for r in index.three_way(spark.range(7), ["id"]).collect()]
    assert {s: got.count(s) for s in set(got)} == {"train": 3, "test": 2, "validation": 2}


@pytest.mark.parametrize("n,size", [(7, 3), (6, 3), (2, 3), (100, 7), (1, 1)])
def test_batches(spark, n, size):
    df = spark.range(n).withColumn("key", F.format_string("%05d", F.col("id")))
    dropped = index.batches(df, ["key"], size).orderBy("id").collect()
    assert [r.batch for r in dropped] == [i // size for i in range(n // size * size)]
    chunks = index.batches(df, ["key"], size, drop_last=False).orderBy("id").collect()
    k = -(-n // size)
    sizes = [sum(r.batch == c for r in chunks) for c in range(k)]
    assert sum(sizes) == n and sizes == [n // k + (c < n % k) for c in range(k)]
    assert [r.batch for r in chunks] == sorted(r.batch for r in chunks)


def test_worked_batches(spark):
    got = index.batches(spark.range(7), ["id"], 3, drop_last=False).orderBy("id").collect()
    assert [r.batch for r in got] == [0, 0, 0, 1, 1, 2, 2]


def test_global_index_over_text_keys_and_many_partitions(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k")).repartition(11)
    got = index.global_index(df, ["k"], total="n").collect()
    keys = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(1000))
    assert [r.k for r in sorted(got, key=lambda r: r.idx)] == keys and {r.n for r in got} == {1000}


def test_global_index_over_mixed_directions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "g string, v int")
    got = index.global_index(df, ["g", F.desc("v")])
    assert [(r.g, r.v) for r in got.orderBy("idx").collect()] == [("a", 2), ("a", 1), ("b", 1)]


def test_group_number(spark, rows):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, None)], "i int, root string")
    assert rows(index.group_number(df, "root"), "i", "group_number") == [(0, "1"), (1, "0"), (2, "1"), (3, None)]


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_group_positions(spark, partitions):
    """A hot group with two thirds of the rows, over any number of partitions."""
    df = spark.range(300).select("id", F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7 + 1).alias("g"))
    got = index.group_position(df, "g", "id", total="n", partitions=partitions).collect()
    for g in {r.g for r in got}:
        members = sorted((r.id, r.position, r.n) for r in got if r.g == g)
        assert [m[1] for m in members] == list(range(len(members)))
        assert all(m[2] == len(members) for m in members)


def test_hot_group_with_far_keys_is_spread(spark):
    """A third of the rows in one group, keys 2,000,000 apart: no partition holds more than about its share of the rows."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), (F.col("id") * 2_000_000).alias("k"), F.lit(1).alias("v")
    ).repartition(4)
    stored = index._ranged(df, "g", "k", {}, 30).cache()
    sizes = [r["count"] for r in stored.groupBy("_part").count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 3_000
    hot = [r["count"] for r in stored.filter("g = 0").groupBy("_part").count().collect()]
    assert sum(hot) == 10_000 and len(hot) >= 8
    got = index.running_total(index.group_position(df, "g", "k", partitions=30), "g", "k", "v", "s", partitions=30)
    assert got.filter("g = 0 AND (position <> k / 6000000 OR s <> position + 1)").count() == 0
    assert got.filter("g <> 0 AND (position <> 0 OR s <> 1)").count() == 0


def test_rows_without_group_or_key_stay_where_they_are(spark):
    df = spark.createDataFrame([(0, 1), (None, 2), (0, None), (0, None)], "g int, id long")
    got = sorted(((r.g, r.id, r.position, r.n) for r in index.group_position(df, "g", "id", total="n").collect()), key=str)
    assert got == [(0, 1, 0, 1), (0, None, None, None), (0, None, None, None), (None, 2, None, None)]
    many = spark.range(0, 1000, 1, 8).select(F.lit(1).alias("g"), F.when(F.col("id") < 0, 1).alias("k"), F.lit(1).alias("v"))
    for found in (index.group_position(many, "g", "k"), index.running_total(many, "g", "k", "v", "s")):
        assert found.groupBy(F.spark_partition_id()).count().count() == 8
        assert found.drop("g", "k", "v").toDF("x").filter("x IS NOT NULL").count() == 0


def test_keys_of_any_kind_and_repeated_keys(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "y", 2), ("a", "z", 4), ("b", "x", 8)], "g string, k string, v int")
    got = index.group_position(df, "g", "k", partitions=4).collect()
    assert sorted((r.g, r.k, r.position) for r in got) == [("a", "x", 0), ("a", "y", 1), ("a", "y", 2), ("a", "z", 3), ("b", "x", 0)]
    sums = index.running_total(df, "g", "k", "v", "s", partitions=4).collect()
    assert sorted((r.g, r.k, r.s) for r in sums) == [("a", "x", 1), ("a", "y", 3), ("a", "y", 5), ("a", "z", 9), ("b", "x", 8)]
    assert index.running_total(df.limit(0), "g", "k", "v", "s").count() == 0


@pytest.mark.parametrize("partitions", [2, 30])
def test_running_total(spark, partitions):
    df = spark.range(-10, 40).select(F.col("id").alias("t"), (F.col("id") % 2).alias("g"), F.lit(2).alias("v"))
    got = index.running_total(df, "g", "t", "v", "s", partitions=partitions).collect()
    for g in {r.g for r in got}:
        sums = [r.s for r in sorted((r for r in got if r.g == g), key=lambda r: r.t)]
        assert sums == [2 * (i + 1) for i in range(len(sums))]


def test_running_total_over_missing_values(spark):
    df = spark.createDataFrame([(0, 0, None), (0, 1, 2), (0, 2, None), (0, 3, 5)], "g int, t int, v int")
    got = index.running_total(df, "g", "t", "v", "s", partitions=3).orderBy("t").collect()
    assert [r.s for r in got] == [0, 2, 2, 7]
