"""The registered queries on the smallest tables, and the pipeline's stages on awkward rows."""

import os

import duckdb
import pytest

import corpus_pipeline
from check import TABLES, rows as comparable
from screenlake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, key):
    frame = QUERIES[key](spark, FOLDER)
    got = comparable(frame.columns, [tuple(r) for r in frame.collect()])
    assert got
    if key in ORACLES:
        db = duckdb.connect()
        for name in TABLES:
            db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
        twin = db.sql(ORACLES[key])
        assert got == comparable(twin.columns, twin.fetchall())


def test_pipeline_keeps_good_rows_and_drops_copies(spark, tmp_path):
    common = "the of and to in is that it was for".split()
    prose = lambda seed: " ".join(f"{common[(i + seed) % 10]} word{i * seed % 9973}x" for i in range(1, 120))
    good = prose(3)
    rows = [(100 + i, prose(7 + i), "en", "s", 1) for i in range(20)]
    rows += [(1, good, "en", "s", 1), (2, good, "en", None, None), (2, good, "en", None, None), (None, good + " x", "en", "s", 0), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, "THE!! " * 90, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS tie", "2 AS key")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0
        docs_after = stage(spark, docs, str(tmp_path))
        if name != "packed_sequences":
            assert docs_after.columns == corpus_pipeline.COLUMNS
        docs = docs_after
    assert {r.doc_id for r in docs.collect()} == {1, *range(100, 120)}


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
