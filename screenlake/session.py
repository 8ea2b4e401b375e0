"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "screenlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword settings win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is made only when
    the session itself runs in local mode and names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="screenlake-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) on the driver, for listing and removing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether Spark has committed a table there."""
    system, marker = _hadoop(spark, f"{path.rstrip('/')}/_SUCCESS")
    return system.exists(marker)


_SCOPE: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below the scratch folder; it goes when the application's JVM ends."""
    folder = f"{scratch_root(spark)}/screenlake/{spark.sparkContext.applicationId}"
    system, place = _hadoop(spark, folder)
    if not system.exists(place):
        system.mkdirs(place)
    system.deleteOnExit(place)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the run's folder, or in the open scope."""
    return f"{_SCOPE.get() or run_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Tables written inside go at the end: for work whose result does not read them, such as a fitted model."""
    folder = f"{_SCOPE.get() or run_folder(spark)}/scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _hadoop(spark, path)
    system.delete(place, True)


def remove_scratch(spark: SparkSession) -> None:
    """Removes all tables of this application now; frames that read them are of no use afterwards."""
    remove(spark, run_folder(spark))


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts lineage in a way that outlives executors, fixes the values of
    plan-dependent columns (partition numbers), and keeps column pruning for
    whatever reads the table next. A derived lookup table that is written this
    way also joins by its true size: Spark broadcasts it when it is under the
    session's threshold and leaves the large side unshuffled, and takes a
    shuffle join with skew splitting when it is not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def source_fingerprint(spark: SparkSession, sources: list[str]) -> str:
    """Changes when a file below one of the paths is added, removed, renamed, resized or written anew.

    Spark lists the files; no content is read, and one row comes back.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sources)
    marks = files.select(F.xxhash64("path", "length", "modificationTime").alias("mark"), "length")
    found = marks.agg(F.count("*"), F.sum("length"), F.bit_xor("mark"), F.sum(F.shiftright("mark", 20))).first()
    return ":".join(map(str, found))


def reuse_or_build(
    spark: SparkSession,
    folder: str,
    name: str,
    arguments: dict,
    build: Callable[[], DataFrame],
    overwrite: bool = False,
    sources: list[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Prepared table keyed by its arguments and its sources: read it when present, else build it.

    ``sources`` are the paths that ``build`` reads and ``schema`` is how it reads them; a file that changes there, or
    another schema, gives another key, so a stale table is never returned. A table counts as present once Spark has
    committed it (``_SUCCESS``).
    """
    parts = [sorted(arguments.items()), schema.json() if schema is not None else None]
    if sources:
        parts += [sorted(sources), source_fingerprint(spark, sources)]
    digest = hashlib.md5(repr(parts).encode()).hexdigest()[:16]
    path = f"{folder.rstrip('/')}/{name}-{digest}"
    if overwrite or not is_written(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_stale(spark: SparkSession, folder: str, name: str, keep: DataFrame) -> list[str]:
    """Removes the prepared tables of ``name`` other than the one that ``keep`` reads; the paths that went."""
    system, pattern = _hadoop(spark, f"{folder.rstrip('/')}/{name}-*")
    used = {unquote(urlparse(file).path).rsplit("/", 1)[0] for file in keep.inputFiles()}
    gone = []
    for status in system.globStatus(pattern) or []:
        path = status.getPath()
        if re.fullmatch(r".*-[0-9a-f]{16}", path.getName()) and path.toUri().getPath() not in used:
            system.delete(path, True)
            gone.append(path.toString())
    return gone
