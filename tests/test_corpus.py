import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from screenlake.operators import corpus, index
from screenlake.sources import files

ROWS = [
    (0, "x/y/z", "ab_c.json", "P", "Y"),
    (1, "q/r", "aa.json", "two words", "X"),
    (2, "z", "ab_d.json", "three more words", None),
]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(ROWS, files.PAIR_SCHEMA)


def test_resolve_columns(spark):
    df = spark.createDataFrame([(1, "a", "b")], "document int, summary string, other string")
    assert tuple(corpus.resolve_columns(df).first()) == (1, "a")
    assert tuple(corpus.resolve_columns(df, "other", "summary").first()) == ("b", "a")
    assert tuple(corpus.resolve_columns(df, dataset="xsum").first()) == (1, "a")
    assert tuple(corpus.resolve_columns(df, summary_column="other", dataset="xsum").first()) == (1, "b")
    assert tuple(corpus.resolve_columns(df, dataset="unheard of").first()) == (1, "a")
    with pytest.raises(ValueError, match="document, summary, other"):
        corpus.resolve_columns(df, "missing")


def test_classification_copies(pairs):
    got = {(r.row_id, r.task): (r.prompt, r.correct_answer, r.id_int) for r in corpus.classification_task(pairs).collect()}
    assert got[0, "solve"] == ("solve: P", "Y", "1")
    assert got[0, "classify"] == ("classify: P", "y/ab_c.json 1", "1")
    assert got[1, "classify"] == ("classify: two words", "q/aa.json 0", "0")
    assert got[2, "classify"][1] is None  # no parent folder
    assert len(got) == 6


def test_correctness_and_fix_rows(spark):
    df = spark.createDataFrame([(0, "P", "Y", "X"), (1, "P", "Y", "Y"), (2, "P", None, None)],
                               "row_id int, prompt string, correct_answer string, predictions string")
    got = corpus.correctness_task(df).orderBy("row_id").collect()
    assert [(r.prompt, r.correct_answer, r.correct_answer_board) for r in got] == [
        ("correct?:P X", "no", "Y"), ("correct?:P Y", "yes", "Y"), (None, "no", None),
    ]
    assert {r.prompt_old for r in got} == {"P"}
    fixed = corpus.fix_task(df).orderBy("row_id").first()
    assert (fixed.prompt, fixed.correct_answer) == ("fix:P", "X")


def shout(prompt):
    return F.upper(prompt)


def test_all_tasks_together(pairs):
    grown = corpus.add_tasks(pairs, shout, correctness_ratio=0.7, fix_ratio=0.1, classification=True)
    got = grown.groupBy("task").count().collect()
    assert {r.task: r["count"] for r in got} == {"solve": 3, "classify": 3, "correctness": 2, "fix": 2}
    tasks = {(r.row_id, r.task): r for r in grown.collect()}
    sampled = {i for i, task in tasks if task == "fix"}
    assert sampled == {i for i, task in tasks if task == "correctness"}
    for i in sampled:  # the fix rows do not overwrite the correctness rows, nor see the "solve: " prompt
        assert tasks[i, "fix"].prompt == "fix:" + ROWS[i][3]
        assert tasks[i, "correctness"].prompt == f"correct?:{ROWS[i][3]} {ROWS[i][3].upper()}"


def test_marked_tables_are_left_alone(pairs):
    got = corpus.add_tasks(pairs, classification=True, name="additional_tasks_train.csv")
    assert got.count() == 3 and {r.task for r in got.collect()} == {"base"}


def test_tasks_need_a_predictor(pairs):
    with pytest.raises(ValueError):
        corpus.add_tasks(pairs, correctness_ratio=0.5)


def test_token_limits_are_inclusive(spark):
    df = spark.createDataFrame([("a b", "c"), ("a b c", "c"), ("a", "c d"), ("a", None)], "prompt string, correct_answer string")
    kept = corpus.limit_tokens(corpus.count_tokens(df), 2, 1).collect()
    assert [(r.token_count, r.token_count_correct) for r in kept] == [(2, 1), (1, None)]


def test_augment_filters_writes_and_orders(spark, pairs, tmp_path):
    target = str(tmp_path / "additional_tasks_train.csv")
    got = corpus.augment(pairs, 3, 5, classification=True, write_to=target).collect()
    assert sorted(r.position for r in got) == list(range(len(got)))
    assert all(r.token_count <= 3 and r.token_count_correct <= 5 for r in got)
    assert spark.read.options(**files.CSV_OPTIONS).csv(target).count() == 6  # written before the filter


def test_sample_is_predicted_once(spark, pairs):
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def counted(texts: pd.Series) -> pd.Series:
        calls.add(len(texts))
        return texts

    corpus.augment(pairs, 99, 99, counted, correctness_ratio=1.0, fix_ratio=1.0).collect()
    assert calls.value == 3


def test_batch_predictor_sees_whole_static_batches(spark):
    def load():
        def run(x: np.ndarray) -> np.ndarray:
            return np.array([f"{len(x)}:{t}" for t in x], dtype=object)

        return run

    df = spark.range(10).select("id", F.col("id").cast("string").alias("prompt")).coalesce(1)
    got = corpus.predict(df, corpus.batch_predictor(load, 4)).orderBy("id").collect()
    assert [r.predictions for r in got] == [f"{4 if i < 8 else 2}:{i}" for i in range(10)]


def test_map_batches(spark):
    def double(frames):
        for frame in frames:
            yield frame.assign(id=frame["id"] * 2)

    assert sorted(r.id for r in corpus.map_batches(spark.range(4), double, "id long").collect()) == [0, 2, 4, 6]


def report_of(frame):
    return {r.metric: r.value for r in frame.collect()}


def test_evaluation_from_frame_file_and_folder(spark, tmp_path):
    frame = pd.DataFrame({"row_id": [0, 1, 2], "id": "a/b", "path_data": "p", "prompt": ["Yes", "no", " x "], "correct_answer": [" yes", "maybe", "X"]})
    marked, report = corpus.evaluate_frame(spark, frame, lambda p: F.lower(p))
    got = report_of(report)
    assert (got["test_num_correct"], got["test_num_total"], got["test_accuracy"]) == (1.0, 3.0, 0.3333)
    assert got["test_rouge1"] == pytest.approx(66.6667) and got["test_gen_len"] == 1.0
    source = files.write_csv(spark.createDataFrame(frame), str(tmp_path / "test.csv"))
    _, again = corpus.evaluate_file(spark, source, lambda p: F.lower(p))
    assert report_of(again) == got
    target = corpus.write_evaluation(marked, report, source, str(tmp_path / "out"), epoch=3)
    assert target.endswith("out/test_results_epoch_3_correct_1.csv")
    rows = spark.read.options(**files.CSV_OPTIONS).csv(target)
    assert rows.count() == 3 and {"predictions", "correct"} <= set(rows.columns)
    text = "".join(p.read_text() for p in (tmp_path / "out" / "test_results.json").glob("part-*"))
    assert list(json.loads(text)) == sorted(got)


def test_evaluation_predicts_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def counted(texts: pd.Series) -> pd.Series:
        calls.add(len(texts))
        return texts

    df = spark.createDataFrame([(i, f"t {i}", "t 1") for i in range(5)], "row_id int, prompt string, correct_answer string")
    marked, report = corpus.evaluate(df, counted)
    corpus.write_evaluation(marked, report, "test.csv", str(tmp_path), epoch=0)
    assert calls.value == 5 and report_of(report)["test_num_correct"] == 1.0


def test_evaluation_adds_the_loss(spark):
    df = spark.createDataFrame([(0, "a", "a")], "row_id int, predictions string, correct_answer string")
    scores = spark.createDataFrame([(0, [0.0, 0.0], 1, 1), (1, [0.0, 0.0], 0, 1)], "batch int, logits array<double>, label int, mask int")
    _, report = corpus.evaluate(df, token_scores=scores)
    assert report_of(report)["test_loss"] == 0.6931


def test_permutation_of_grown_rows_has_no_ties(pairs):
    grown = corpus.add_tasks(pairs, classification=True)
    assert grown.select("row_id", "task").distinct().count() == grown.count()
    assert index.permute(grown, ["row_id", "task"], 1).select("position").distinct().count() == 6


def test_augment_keeps_rows_with_missing_or_repeated_keys_and_missing_text(spark):
    pairs = [(1, "a", "p", "one two", "x"), (1, "a", "p", "one two", "x"), (None, "b", "p", "three", None), (2, None, "p", None, "y")]
    df = spark.createDataFrame(pairs, files.PAIR_SCHEMA)
    grown = corpus.augment(df, 10, 10)
    assert grown.count() == 4
    assert sorted(r.position for r in grown.collect()) == [0, 1, 2, 3]


def test_augmented_file_reads_back_and_is_evaluated(spark, tmp_path):
    df = spark.createDataFrame([(i, "a", "p", f"word{i} b", f"word{i}") for i in range(6)], files.PAIR_SCHEMA)
    first = lambda texts: F.split(texts, " ")[0]
    path = f"{tmp_path}/pairs{corpus.AUGMENTED_MARK}.csv"
    corpus.augment(df, 10, 10, first, correctness_ratio=0.5, write_to=path)
    read = files.read_csv(spark, path, files.PAIR_SCHEMA)
    assert read.count() == 9 and "task" in read.columns
    again = corpus.augment(read, 10, 10, name=path)
    assert again.groupBy("task").count().orderBy("task").collect() == [("base", 6), ("correctness", 3)]
    marked, _ = corpus.evaluate_file(spark, path, first)
    assert marked.count() == 9
