import math

import pytest
from pyspark.sql import functions as F

from screenlake.sources import files
from screenlake.sources.matrix import SCHEMAS, read_matrix_tables


def test_path_rule():
    assert files.resolve_path("train.csv", "exp/") == "exp/train.csv"
    assert files.resolve_path("a/train.csv", "exp/") == "a/train.csv"
    assert files.resolve_path("http:train.csv", "exp/") == "http:train.csv"


def test_split_files_are_checked_before_any_read(spark):
    with pytest.raises(ValueError, match="csv or a json"):
        files.load_splits(spark, {"train": "a.csv", "test": "b.parquet"}, "x int")
    with pytest.raises(ValueError, match="need files"):
        files.load_splits(spark, {"train": None}, "x int")
    with pytest.raises(ValueError, match="dev"):
        files.load_splits(spark, {"dev": "a.csv"}, "x int")


HARD = ['plain', 'quote " and, comma', 'line\nbreak', ' spaces ', '', 'back\\slash "x\\"', None]


def test_splits_of_both_formats(spark, tmp_path, rows):
    df = spark.createDataFrame(list(enumerate(HARD)), "i int, t string")
    files.write_csv(df, str(tmp_path / "train.csv"))
    df.write.json(str(tmp_path / "test.json"))
    got = files.load_splits(spark, {"train": str(tmp_path / "train.csv"), "test": str(tmp_path / "test.json")}, "i int, t string")
    assert rows(got.filter("split = 'test'"), "i", "t") == list(enumerate(HARD))
    # In CSV an empty text and a missing one look alike.
    assert [t or "" for _, t in rows(got.filter("split = 'train'"), "i", "t")] == [t or "" for t in HARD]


def test_rejects_name_their_file_and_reason(spark, tmp_path, rows):
    lines = ["i,t,more", '1,"a ""q"", x",z', "x,b,z", "3,c", "4,d,z,w", "5,,", ",f,z", "9999999999,g,z", '7,"two', 'lines",z']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    name, schema = str(tmp_path / "a.csv"), "t string, i int"
    whole = files.read_csv(spark, name, schema, rejects="drop")
    assert whole.columns == ["t", "i", "more"]
    assert rows(whole, "i", "t") == [(1, 'a "q", x'), (5, None), (7, "two\nlines"), (None, "f")]
    bad = files.csv_rejects(spark, name, schema)
    assert rows(bad, "reason", "record") == [
        ("i is no int: 9999999999", '{"i":"9999999999","t":"g","more":"z"}'), ("i is no int: x", '{"i":"x","t":"b","more":"z"}'),
        ("malformed record", "3,c"), ("malformed record", "4,d,z,w"),
    ]
    assert all(r.file.endswith("a.csv") for r in bad.collect())
    # what a query reads does not change what is malformed
    assert whole.select("i").count() == 4 and bad.select("file").count() == 4 and whole.count() == 4
    by_line = files.read_csv(spark, name, schema, multi_line=False, rejects="drop")
    assert rows(by_line, "i", "t") == [(1, 'a "q", x'), (5, None), (None, "f")]
    assert files.csv_rejects(spark, name, schema, multi_line=False).count() == 6
    with pytest.raises(Exception, match=r"a\.csv: (malformed record|i is no int)"):
        files.read_csv(spark, name, schema).collect()
    with pytest.raises(ValueError, match="no column"):
        files.read_csv(spark, name, "absent int")
    with pytest.raises(ValueError, match="to fail or to drop"):
        files.read_csv(spark, name, schema, rejects="x")


def test_plain_csv_is_split_into_tasks(spark, tmp_path):
    (tmp_path / "big.csv").write_text("i,t\n" + "".join(f"{i},text {i}\n" for i in range(200_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        read = {m: files.read_csv(spark, str(tmp_path / "big.csv"), "i int, t string", multi_line=m) for m in (True, False)}
        tasks = {m: frame.select(F.spark_partition_id()).distinct().count() for m, frame in read.items()}
        assert tasks[True] == 1 and tasks[False] >= 8
        assert read[False].agg(F.sum("i")).first()[0] == read[True].agg(F.sum("i")).first()[0] == 199_999 * 100_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_rejects(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('{"i":1,"t":"a"}\n{"i":"x","t":"b"}\n{"i":3\n{"t":"d"}\n')
    path = {"test": str(tmp_path / "a.json")}
    assert rows(files.load_splits(spark, path, "i int, t string", rejects="drop"), "i", "t") == [(1, "a"), (None, "d")]
    assert [r[0] for r in rows(files.split_rejects(spark, path, "i int, t string"), "reason", "record")] == ["i is no int: x", "malformed record"]


def test_existing_target_is_refused(spark, tmp_path):
    df, path = spark.range(1), str(tmp_path / "out.csv")
    files.write_csv(df, path)
    with pytest.raises(Exception, match="(?i)already exists"):
        files.write_csv(df, path)
    files.write_csv(df, path, overwrite=True)


def test_delimited_text_in_file_order(spark, tmp_path):
    folder = tmp_path / "names"
    folder.mkdir()
    for part in range(3):
        lines = ["#string_protein_id\tpreferred_name\textra"] + [f"P{part}{i}\tN{i % 2}\tx" for i in range(4)]
        (folder / f"part-{part}.txt").write_text("\n".join(lines) + "\n")
    got = files.read_delimited(spark, str(folder), files.NAMES_SCHEMA, "\t", file_order="ord")
    assert [r[0] for r in got.orderBy("ord").collect()] == [f"P{p}{i}" for p in range(3) for i in range(4)]
    assert got.columns == ["#string_protein_id", "preferred_name", "ord"]


def test_log_lines_and_numbers(spark, tmp_path):
    text = "Epoch... (1/2 | Loss: 3.5, Learning Rate: 6e-05)\n Epoch... (9/9\nepoch\nEpoch... (2/2 | Eval Loss: nan | )\nTraining Epoch... (2/2"
    (tmp_path / "nb.log").write_text(text)
    lines = files.read_log(spark, str(tmp_path / "nb.log"))
    assert [r.value[:12] for r in files.lines_with_prefix(lines).collect()] == ["Epoch... (1/", "Epoch... (2/"]
    first, second = files.log_metrics(lines).collect()
    assert tuple(first) == (1, 2, 3.5, 6e-05)
    assert second.epoch == 2 and math.isnan(second.loss) and second.learning_rate is None


def test_matrix_text(spark, tmp_path):
    df = spark.createDataFrame([(1.5, float("nan")), (0.1, -2e-300)], "a double, b double")
    path = str(tmp_path / "m")
    files.write_matrix(df.coalesce(1), path, ["a", "b"])
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0] == "1.500000000000000000e+00,nan"
    back = files.read_matrix(spark, path, ["a", "b"]).collect()
    assert back[0].a == 1.5 and math.isnan(back[0].b) and tuple(back[1]) == (0.1, -2e-300)


def test_metrics_json(spark, tmp_path, rows):
    df = spark.createDataFrame([("test_b", 2.0), ("test_a", 1.5)], "metric string, value double")
    files.write_metrics(df, str(tmp_path / "m"))
    assert rows(files.read_metrics(spark, str(tmp_path / "m"))) == [("test_a", 1.5), ("test_b", 2.0)]


def test_metric_series_appends(spark, tmp_path):
    series = spark.createDataFrame([("train_loss", 1, 0.5), ("eval_loss", 1, 0.6)], "tag string, step long, value double")
    for _ in range(2):
        files.append_metrics(series, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).filter("tag = 'train_loss'").count() == 2


def test_names_of_results():
    assert files.results_name("in/test.csv", "out/", 2) == "out/test_results_epoch_2.csv"
    assert files.results_name("test.csv", "out", 2, 7) == "out/test_results_epoch_2_correct_7.csv"
    assert files.augmented_name("train.csv", "exp/") == "exp/additional_tasks_train.csv"


def test_matrix_tables(spark, tmp_path, rows):
    folder = str(tmp_path)
    spark.createDataFrame([(1, "A"), (2, "B")], "cell_id long, condition string").write.parquet(f"{folder}/cells")
    spark.createDataFrame([(0, "g0"), (1, "g1")], "gene_idx int, gene string").write.parquet(f"{folder}/genes")
    spark.createDataFrame([(1, 1, 5.0)], "cell_id long, gene_idx int, value double").write.parquet(f"{folder}/expression")
    matrix = read_matrix_tables(spark, folder)
    assert matrix.shape() == (2, 2)
    assert rows(matrix.scan(), "cell_id", "gene", "condition", "value") == [(1, "g1", "A", 5.0)]


def test_matrix_tables_as_csv(spark, tmp_path, rows):
    folder = str(tmp_path)
    spark.createDataFrame([("c1", "L1", "A", "other")], SCHEMAS["cells"]).write.csv(f"{folder}/cells", header=True)
    spark.createDataFrame([(0, "g0"), (1, "g1")], SCHEMAS["genes"]).write.csv(f"{folder}/genes", header=True)
    spark.createDataFrame([("c1", 1, 5.0)], SCHEMAS["expression"]).write.csv(f"{folder}/expression", header=True)
    got = rows(read_matrix_tables(spark, folder, "csv").scan(), "cell_id", "gene", "condition", "value")
    assert got == [("c1", "g1", "A", 5.0)]
    with pytest.raises(ValueError):
        read_matrix_tables(spark, folder, "h5")
