"""Scratch tables, prepared tables and the session's folder."""

import os
import subprocess
import sys

import pytest

from screenlake import session


def test_reuse_or_build(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    def run(**options):
        return session.reuse_or_build(spark, str(tmp_path), "t", {"a": 1}, build, **options).count()

    assert (run(), run(), len(built)) == (3, 3, 1)
    assert (run(overwrite=True), len(built)) == (3, 2)
    session.reuse_or_build(spark, str(tmp_path), "t", {"a": 2}, build)
    assert len(built) == 3


def test_scratch_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_path(spark, "x")
    assert path.startswith(configured.rstrip("/") if configured else spark.sparkContext.getCheckpointDir())
    assert session.scratch_path(spark, "x") != path


def test_a_changed_source_gives_a_new_table(spark, tmp_path):
    """Files that are added, resized, touched or removed are seen; nothing changed means nothing is built."""
    source, built = tmp_path / "source", []
    source.mkdir()
    (source / "a.csv").write_text("1\n2\n")

    def run(schema="x long"):
        def build():
            built.append(1)
            return spark.read.schema(schema).csv(str(source))

        kind = spark.createDataFrame([], schema).schema
        return session.reuse_or_build(spark, str(tmp_path / "kept"), "t", {"a": 1}, build, sources=[str(source)], schema=kind)

    assert (run().count(), run().count(), len(built)) == (2, 2, 1)
    (source / "b.csv").write_text("3\n")
    assert (run().count(), len(built)) == (3, 2)
    (source / "b.csv").write_text("3\n4\n")
    assert (run().count(), len(built)) == (4, 3)
    os.utime(source / "a.csv", (1, 1))
    assert (run().count(), len(built)) == (4, 4)
    assert (run("x double").count(), len(built)) == (4, 5)
    (source / "b.csv").unlink()
    latest = run()
    assert (latest.count(), len(built)) == (2, 6)
    assert len(session.drop_stale(spark, str(tmp_path / "kept"), "t", latest)) == 5
    assert (run().count(), len(built)) == (2, 6)


class Cluster:
    """A session that names no folder and does not run in local mode."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster)


def test_scope_removes_what_was_written_inside(spark):
    with session.scratch_scope(spark) as folder:
        kept = session.materialize(spark.range(5), "inner")
        assert kept.count() == 5 and kept.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(folder.split(":", 1)[-1].lstrip("/"))
        with session.scratch_scope(spark) as inner:
            session.materialize(spark.range(5), "innermost")
            assert inner.startswith(folder)
        assert session.is_written(spark, kept.inputFiles()[0].rsplit("/", 1)[0])
    assert not session.is_written(spark, kept.inputFiles()[0].rsplit("/", 1)[0])
    outside = session.materialize(spark.range(5), "outer")
    assert outside.count() == 5


def test_no_table_is_left_after_a_run(tmp_path):
    code = """
import sys
from screenlake import session
from screenlake.operators import index
spark = session.build_session(master="local[1]", **{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1]})
print(index.group_number(spark.range(5).selectExpr("string(id) AS k"), "k").count(), len(list(__import__("os").listdir(sys.argv[1] + "/screenlake"))))
"""
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, timeout=180, cwd=os.path.dirname(os.path.dirname(__file__)))
    assert done.stdout.split() == ["5", "1"], done.stderr[-2000:]
    assert os.listdir(tmp_path / "screenlake") == []
