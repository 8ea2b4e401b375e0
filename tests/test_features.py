import math

import pytest
from pyspark.sql import functions as F

from screenlake.operators import features


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(
        [
            (1, "L2", "A", "progenitor"), (2, "L1", "A", "progenitor"), (3, "L2", "A", "effector"), (4, "L1", "A", "naive"),
            (5, "L1", "B", "terminal exhausted"), (6, "L1", "B", "other"), (7, "L1", "X", "cycling"),
        ],
        "cell_id long, lane string, condition string, state string",
    )


def test_proportions_with_catch_all(spark, cells, rows):
    genes = spark.createDataFrame([("A",), ("B",), ("Z",)], "condition string")
    got = rows(features.state_proportions(cells, genes))
    assert got == [("A", 0.5, 0.25, 0.0, 0.0, 0.25), ("B", 0.0, 0.0, 0.5, 0.0, 0.5)]  # no row for Z, none for X


def test_counts_add_up(cells):
    for r in features.state_counts(cells).collect():
        assert sum(r[c] for c in ("progenitor", "effector", "terminal_exhausted", "cycling", "other")) == r.total


def test_null_state_counts_as_other(spark, rows):
    cells = spark.createDataFrame([("A", None), ("A", "cycling")], "condition string, state string")
    assert rows(features.state_counts(cells)) == [("A", 0, 0, 0, 1, 1, 2)]


def test_exclusion_is_strict(cells, rows):
    assert rows(features.exclude_conditions(cells, ["A"]), "cell_id") == [(5,), (6,), (7,)]
    with pytest.raises(KeyError, match="nope"):
        features.exclude_conditions(cells, ["A", "nope"])
    assert features.exclude_conditions(cells, ["A", "nope"], strict=False).count() == 3


def test_exclusion_keeps_null_conditions(spark):
    cells = spark.createDataFrame([("A",), (None,)], "condition string")
    assert features.exclude_conditions(cells, ["A"]).collect()[0][0] is None


def test_expand_labels_needs_every_condition(spark, cells, rows):
    labels = spark.createDataFrame([("A", 0.1), ("B", 0.2)], "condition string, y double")
    with pytest.raises(KeyError, match="X"):
        features.expand_labels(cells, labels)
    kept = features.expand_labels(cells.filter("condition <> 'X'"), labels)
    assert rows(kept, "cell_id", "y") == [(1, 0.1), (2, 0.1), (3, 0.1), (4, 0.1), (5, 0.2), (6, 0.2)]


def test_one_hot_over_sorted_lanes(cells, rows):
    got = rows(features.one_hot(cells.filter("cell_id < 4"), "lane"), "cell_id", "onehot")
    assert got == [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])]


def test_one_hot_keeps_rows_without_a_lane(spark, rows):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "i int, lane string")
    assert rows(features.one_hot(df, "lane"), "i", "onehot") == [(1, [0.0, 1.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0])]


def test_positions_skip_absent_names_and_take_the_first(spark, rows):
    genes = spark.createDataFrame([(4, "b"), (0, "a"), (2, "b")], "gene_idx int, gene string")
    assert rows(features.positions_of(genes, ["b", "zz", "a"])) == [(0, "b", 2), (2, "a", 0)]


def test_densify_fills_gaps_edges_and_empty_cells(spark, rows):
    cells = spark.createDataFrame([(1,), (2,), (3,)], "cell_id long")
    matrix = spark.createDataFrame(
        [(1, 1, 2.0), (1, 1, 3.0), (1, 3, 7.0), (2, 0, 1.0), (2, 4, 2.0), (2, 5, 9.0), (2, -1, 9.0), (2, 2, None)], "cell_id long, gene_idx int, value double"
    )
    got = rows(features.densify(cells, matrix, 5), "cell_id", "features")
    assert got == [(1, [0, 5, 0, 7, 0]), (2, [1, 0, 0, 0, 2]), (3, [0, 0, 0, 0, 0])]


def test_drop_and_select_are_complements(spark, rows):
    matrix = spark.createDataFrame([(1, g, 1.0) for g in range(5)], "cell_id long, gene_idx int, value double")
    some = spark.createDataFrame([(1,), (3,), (9,)], "gene_idx int")
    assert [r[0] for r in rows(features.select_features(matrix, some), "gene_idx")] == [1, 3]
    assert [r[0] for r in rows(features.drop_features(matrix, some), "gene_idx")] == [0, 2, 4]


def test_zero_to_nan(spark):
    df = spark.createDataFrame([(0.0, 0), (float("nan"), 1), (2.0, 2)], "x double, i int")
    got = [r.x for r in features.zero_to_nan(df, ["x"]).orderBy("i").collect()]
    assert math.isnan(got[0]) and math.isnan(got[1]) and got[2] == 2.0


def test_cast_columns(spark):
    df = spark.createDataFrame([([1, 2], 3)], "a array<int>, b int")
    assert dict(features.cast_columns(df, ["a", "b"], "float").dtypes) == {"a": "array<float>", "b": "float"}


def test_training_table(spark, cells):
    matrix = spark.createDataFrame(
        [(i, g, float(i + g)) for i in range(1, 8) for g in range(3)] + [(1, 1, 10.0)],
        "cell_id long, gene_idx int, value double",
    )
    dropped = spark.createDataFrame([(0,)], "gene_idx int")
    got = features.training_table(cells, matrix, matrix, ["X"], dropped).orderBy("cell_id").collect()
    assert [r.cell_id for r in got] == [1, 2, 3, 4, 5, 6]
    assert got[0].features[:2] == [12.0, 3.0]  # gene 0 left out, repeated entry added up
    assert got[0].features[2:4] == [0.5, 0.25] and math.isnan(got[0].features[4])
    assert sorted(r.split for r in got) == ["test", "train", "train", "train", "validation", "validation"]


def test_skewed_condition_gives_the_same_table(spark, rows):
    """One condition holds most rows; layout must not matter."""
    hot = spark.range(3000).select(
        F.col("id").alias("cell_id"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("condition"),
        F.element_at(F.array(*map(F.lit, features.STATES)), (F.col("id") % 5 + 1).cast("int")).alias("state"),
    )
    one = rows(features.state_proportions(hot.coalesce(1)))
    assert one == rows(features.state_proportions(hot.repartition(13)))
    assert all(abs(sum(r[1:]) - 1) < 1e-12 for r in one)


def test_entries_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    cells = spark.range(300).select(F.col("id").alias("cell_id"))
    matrix = spark.range(1200).select((F.col("id") % 400).alias("cell_id"), (F.col("id") % 3).cast("int").alias("gene_idx"), F.lit(1.0).alias("value"))
    monkeypatch.setattr(features, "TASK_ENTRIES", 40)
    got = features.densify(cells, matrix, 3).select("cell_id", "features", F.spark_partition_id().alias("task")).collect()
    assert len(got) == 300 and all(sum(r.features) == 3.0 for r in got)
    assert len({r.task for r in got}) >= 25  # of 30; left to itself Spark makes one of so few rows
    monkeypatch.setattr(features, "TASK_ENTRIES", 500_000)
    assert features.entry_tasks(matrix) == 0
