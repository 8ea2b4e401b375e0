"""Every query on the smallest tables, against its SQL twin where it has one."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import TABLES, rows as comparable
from screenlake.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, db, key):
    frame = QUERIES[key](spark, FOLDER)
    got = comparable(frame.columns, [tuple(r) for r in frame.collect()])
    if key not in ORACLES:
        assert got
        return
    twin = db.sql(ORACLES[key])
    assert sorted(frame.columns) == sorted(twin.columns)
    assert got == comparable(twin.columns, twin.fetchall())


def test_entry_is_lazy_and_not_empty(spark):
    assert spark_entry.entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("left", ["nothing", "empty folder", "broken module"])
def test_entry_without_the_optional_part(tmp_path, left):
    """The driver deletes the folder; stale folders and modules that are missing must not take the rest down."""
    home = tmp_path / "repo"
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", "corpus_pipeline.py" if left == "nothing" else "x")
    shutil.copytree(os.path.dirname(os.path.abspath(spark_entry.__file__)), home, ignore=skip)
    if left != "nothing":
        (home / "screenlake" / "llm" / "__pycache__").mkdir(parents=True)
    if left == "broken module":
        (home / "screenlake" / "llm" / "__init__.py").write_text("import a_module_that_is_not_here")
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op1') or k == 'pipeline' for k in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=home, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert done.stdout.split() == [str(len(QUERIES)), "False"], done.stderr
