"""Coordinate text files, and sparse rows."""

import math

import pytest
from pyspark.sql import functions as F

from screenlake.operators import features, models
from screenlake.sources.matrix import coordinate_header, read_coordinate_matrix, read_coordinates, write_coordinates

BANNER = "%%MatrixMarket matrix coordinate real general\n% made by hand\n%\n\n4 3 5\n"


def test_a_file_of_another_program(spark, tmp_path, rows):
    path = str(tmp_path / "m.mtx")
    (tmp_path / "m.mtx").write_text(BANNER + "1 1 2.5\n4 3 -1e-3\n2 1 7\n2 2 0\n4 1 5\n")
    known = coordinate_header(spark, path)
    assert (known.rows, known.columns, known.entries, known.symmetric) == (4, 3, 5, False)
    assert rows(read_coordinates(spark, path)) == [(0, 0, 2.5), (1, 0, 7.0), (1, 1, 0.0), (3, 0, 5.0), (3, 2, -0.001)]
    assert rows(read_coordinates(spark, path, rows=(1, 2))) == [(1, 0, 7.0), (1, 1, 0.0)]


def test_pattern_and_symmetric(spark, tmp_path, rows):
    (tmp_path / "p.mtx").write_text("%%MatrixMarket matrix coordinate pattern symmetric\n3 3 3\n1 1\n3 1\n3 2\n")
    path = str(tmp_path / "p.mtx")
    assert rows(read_coordinates(spark, path)) == [(0, 0, 1.0), (0, 2, 1.0), (1, 2, 1.0), (2, 0, 1.0), (2, 1, 1.0)]
    assert rows(read_coordinates(spark, path, rows=(0, 0))) == [(0, 0, 1.0), (0, 2, 1.0)]


@pytest.mark.parametrize("text", ["%%MatrixMarket matrix array real general\n3 3\n", "%%MatrixMarket matrix coordinate complex general\n1 1 0\n", "1 2\n", ""])
def test_other_files_are_refused(spark, tmp_path, text):
    (tmp_path / "x.mtx").write_text(text)
    with pytest.raises(ValueError):
        read_coordinates(spark, str(tmp_path / "x.mtx"))


def test_a_bad_entry_ends_the_job(spark, tmp_path):
    (tmp_path / "b.mtx").write_text(BANNER + "1 1 2.5\n4 x 1\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_coordinates(spark, str(tmp_path / "b.mtx")).collect()


def test_one_file_is_many_tasks_and_rows_reach_the_parser(spark, tmp_path):
    n = 60_000
    (tmp_path / "big.mtx").write_text(f"%%MatrixMarket matrix coordinate integer general\n{n} 5 {n}\n" + "".join(f"{i + 1} {i % 5 + 1} {i % 9}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        read = read_coordinates(spark, str(tmp_path / "big.mtx"))
        assert read.select(F.spark_partition_id()).distinct().count() >= 5
        assert tuple(read.agg(F.count("*"), F.sum("cell_idx"), F.sum("value")).first()) == (n, n * (n - 1) // 2, float(sum(i % 9 for i in range(n))))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    part = read_coordinates(spark, str(tmp_path / "big.mtx"), rows=(10, 19))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(row), GreaterThanOrEqual(row,11), LessThanOrEqual(row,20)]" in plan
    assert part.count() == 10


def test_round_trip_with_names(spark, tmp_path, rows):
    entries = spark.createDataFrame([(0, 1, 0.1), (2, 0, 1e300), (2, 2, -7.0)], "cell_idx long, gene_idx long, value double").repartition(3)
    path = str(tmp_path / "written")
    write_coordinates(entries, path, 3, 3)
    assert coordinate_header(spark, path).entries == 3
    assert rows(read_coordinates(spark, path)) == rows(entries)
    for name, lines in (("cells", "c0\nc1\nc2\n"), ("genes", "g0\ng1\ng2\n")):
        (tmp_path / name).write_text(lines)
    matrix = read_coordinate_matrix(spark, path, str(tmp_path / "cells"), str(tmp_path / "genes"))
    assert matrix.shape() == (3, 3)
    assert rows(matrix.scan(), "cell_id", "gene", "value") == [("c0", "g1", 0.1), ("c2", "g0", 1e300), ("c2", "g2", -7.0)]


# ------------------------------------------------------------------ sparse rows


def test_many_categories_without_dense_rows(spark):
    df = spark.range(200_000).select("id", F.when(F.col("id") % 1000 != 7, F.concat(F.lit("k"), F.lpad((F.col("id") % 100_000).cast("string"), 6, "0"))).alias("k"))
    hot = features.one_hot_sparse(df, "k")
    levels = df.select("k").distinct().count() - 1
    found = hot.select("id", "k", "onehot.*")
    assert found.agg(F.max(F.size("indices")), F.min("size"), F.max("size"), F.count("*")).first()[:] == (1, levels, levels, 200_000)
    assert found.filter("k IS NULL AND size(indices) <> 0").count() == 0
    assert found.select("k", "indices").distinct().count() == levels + 1
    low = found.filter("k = 'k000000' OR k = 'k000001'").select("indices").distinct().collect()
    assert sorted(r.indices[0] for r in low) == [0, 1]


def test_sparse_rows_equal_dense_ones(spark, rows):
    cells = spark.createDataFrame([(1, "a", 0.5, 0.0), (2, "b", None, 1.0), (3, None, 0.0, 0.0)], "cell_id long, lane string, y0 double, y1 double")
    matrix = spark.createDataFrame([(1, 0, 2.0), (1, 0, 3.0), (1, 3, 1.0), (2, 1, None), (2, 9, 4.0), (1, 2, 1.0), (1, 2, -1.0)], "cell_id long, gene_idx int, value double")
    dense = features.stack(features.append_array(features.one_hot(features.densify(cells, matrix, 4), "lane"), "features", "onehot"), "features", ["y0", "y1"])
    sparse = features.one_hot_sparse(features.sparsify(cells, matrix, 4), "lane")
    sparse = features.stack_sparse(features.append_sparse(sparse, "features", "onehot", "both"), "both", ["y0", "y1"], "both")
    assert rows(features.dense_rows(sparse, "both", 8), "cell_id", "features") == rows(dense, "cell_id", "features")
    held = {r.cell_id: r.both for r in sparse.collect()}
    assert held[3].indices == [] and held[1].indices == [0, 3, 4, 6] and held[2].values == [1.0, None, 1.0]
    assert features.one_hot_sparse(cells.limit(0), "lane").count() == 0


def test_models_take_narrow_sparse_rows(spark):
    df = spark.range(200).select("id", F.concat(F.lit("k"), (F.col("id") % 4).cast("string")).alias("k"), (F.col("id") % 4 * 10).cast("double").alias("y"))
    rows = features.dense_rows(features.one_hot_sparse(df, "k"), "onehot", 4)
    scored = models.fit_forest(rows, ["y"], trees=1, bootstrap=False).predict(rows)
    assert scored.filter("abs(y - y_predicted) > 1e-9").count() == 0
    assert math.isclose(scored.agg(F.avg("y_predicted")).first()[0], 15.0)
