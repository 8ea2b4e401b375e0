"""Files in and out: splits, delimited text, logs, matrices, metrics."""

from __future__ import annotations

import os
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType, StructField, StructType

PAIR_SCHEMA = "row_id BIGINT, id STRING, path_data STRING, prompt STRING, correct_answer STRING"
LINKS_SCHEMA = "protein1 STRING, protein2 STRING"
NAMES_SCHEMA = "`#string_protein_id` STRING, preferred_name STRING"

# Quoted text with line breaks survives a round trip with these.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "enforceSchema": False,
}

SPLITS = ("train", "validation", "test")

# -------------------------------------------------------------------- readers


def resolve_path(name: str, folder: str = "") -> str:
    """A name with ``http`` stays, a bare name goes below ``folder``, any other path stays."""
    if "http" in name or "/" in name:
        return name
    return f"{folder}{name}"


def read_csv(
    spark: SparkSession, name: str, schema: str, folder: str = "", multi_line: bool = True, rejects: str = "fail"
) -> DataFrame:
    """The columns of ``schema`` by the file's header, in their types; further columns follow as strings.

    ``rejects`` says what a malformed or uncastable record does: ``fail`` ends the job with its file and reason,
    ``drop`` leaves it out (``csv_rejects`` lists what was left out).
    """
    parsed = parse_csv(spark, resolve_path(name, folder), schema, multi_line)
    return _accepted(parsed, rejects)


def csv_rejects(spark: SparkSession, name: str, schema: str, folder: str = "", multi_line: bool = True) -> DataFrame:
    """``file, reason, record`` of the records that ``read_csv`` with ``drop`` leaves out."""
    return _rejected(parse_csv(spark, resolve_path(name, folder), schema, multi_line))


MARKS = ["_file", "_reason", "_record"]


def parse_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True, header: list[str] | None = None) -> DataFrame:
    """Typed columns and, per record, its file, what is wrong with it (null: nothing) and its text if something is.

    With ``multi_line`` quoted line breaks are read, and a file is one task; without, Spark splits files at line
    ends, and a record with a quoted break is malformed. ``header`` names the columns when the file has to have just
    these; by default they are read from it.
    """
    options = {**CSV_OPTIONS, "multiLine": multi_line}
    names = header or spark.read.options(**options).csv(path).columns
    texts = StructType([StructField(c, StringType()) for c in [*names, "_corrupt"]])
    # Without pruning every record is counted to its end, whatever columns a query reads.
    reader = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", columnPruning=False)
    return _typed(reader.schema(texts).csv(path), names, schema)


def parse_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same of JSON lines; a field that is absent is null."""
    names = [f.name for f in StructType.fromDDL(schema)]
    texts = StructType([StructField(c, StringType()) for c in [*names, "_corrupt"]])
    reader = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    return _typed(reader.schema(texts).json(path), names, schema)


def _typed(text: DataFrame, names: list[str], schema: str) -> DataFrame:
    wanted = {f.name: f.dataType for f in StructType.fromDDL(schema)}
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header {', '.join(names)}")
    quoted = {c: F.col(f"`{c}`") for c in names}
    typed = {c: quoted[c].try_cast(t) for c, t in wanted.items()}
    wrong = [
        F.when(quoted[c].isNotNull() & typed[c].isNull(), F.concat(F.lit(f"{c} is no {t.simpleString()}: "), quoted[c]))
        for c, t in wanted.items()
    ]
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit("malformed record")).otherwise(F.nullif(F.concat_ws("; ", *wrong), F.lit("")))
    record = F.when(reason.isNotNull(), F.coalesce("_corrupt", F.to_json(F.struct(*quoted.values()))))
    further = [quoted[c] for c in names if c not in wanted]
    columns = [typed[c].alias(c) for c in wanted] + further
    return text.select(*columns, F.col("_metadata.file_path").alias("_file"), reason.alias("_reason"), record.alias("_record"))


def _accepted(parsed: DataFrame, rejects: str) -> DataFrame:
    if rejects not in ("fail", "drop"):
        raise ValueError(f"rejects are to fail or to drop, not {rejects}")
    reason = F.col("_reason")
    if rejects == "fail":
        shown = F.concat(F.col("_file"), F.lit(": "), reason, F.lit(" in "), F.col("_record"))
        kept = F.when(reason.isNull(), True).otherwise(F.raise_error(shown).cast("boolean"))
    else:
        kept = reason.isNull()
    return parsed.filter(kept).drop(*MARKS)


def _rejected(parsed: DataFrame, *keep: str) -> DataFrame:
    return parsed.filter("_reason IS NOT NULL").select(*keep, *[F.col(c).alias(c.removeprefix("_")) for c in MARKS])


def file_format(path: str) -> str:
    """Format by extension; anything but csv and json is refused."""
    extension = os.path.splitext(path.rstrip("/"))[1].removeprefix(".")
    if extension not in ("csv", "json"):
        raise ValueError(f"{path} should be a csv or a json file")
    return extension


def _parsed_splits(spark: SparkSession, files: dict[str, str | None], schema: str, multi_line: bool) -> DataFrame:
    given = {split: path for split, path in files.items() if path}
    unknown = set(given) - set(SPLITS)
    if not given or unknown:
        raise ValueError(f"need files for some of {', '.join(SPLITS)}" + (f", not {sorted(unknown)}" if unknown else ""))
    formats = {split: file_format(path) for split, path in given.items()}
    names = [f.name for f in StructType.fromDDL(schema)]
    frames = []
    for split, path in given.items():
        csv = formats[split] == "csv"
        frame = parse_csv(spark, path, schema, multi_line, names) if csv else parse_json(spark, path, schema)
        frames.append(frame.withColumn("split", F.lit(split)))
    return reduce(DataFrame.unionByName, frames)


def load_splits(
    spark: SparkSession, files: dict[str, str | None], schema: str, multi_line: bool = True, rejects: str = "fail"
) -> DataFrame:
    """Named split files as one table with a ``split`` column; each file by its own format.

    JSON lines divide into tasks at any size, and so does CSV without quoted line breaks (``multi_line=False``). CSV
    with them is read one file per task, so large input should come as many files. A CSV header has to name the
    columns of ``schema``. ``rejects`` as in ``read_csv``; ``split_rejects`` lists them.
    """
    return _accepted(_parsed_splits(spark, files, schema, multi_line), rejects)


def split_rejects(spark: SparkSession, files: dict[str, str | None], schema: str, multi_line: bool = True) -> DataFrame:
    """``split, file, reason, record`` of all records that cannot be read."""
    return _rejected(_parsed_splits(spark, files, schema, multi_line), "split")


def read_delimited(
    spark: SparkSession, path: str, schema: str, separator: str = " ", file_order: str | None = None
) -> DataFrame:
    """Delimited text with a header line; the schema names the columns that are wanted, others are pruned.

    ``file_order`` adds a column that sorts rows as they stand in the files:
    file, start of the split in it, and row in the split.
    """
    table = spark.read.options(header=True, sep=separator, enforceSchema=True).schema(schema).csv(path)
    if file_order is None:
        return table
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return table.select("*", place.alias(file_order))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines as ``value``."""
    return spark.read.text(path)


def lines_with_prefix(lines: DataFrame, prefix: str = "Epoch") -> DataFrame:
    """Lines that start with ``prefix``, case-sensitive; text in front of it hides a line."""
    return lines.filter(F.col("value").startswith(prefix))


def log_metrics(lines: DataFrame) -> DataFrame:
    """``epoch, epochs, loss, learning_rate`` of training progress lines; null where a part is absent."""
    number = r"([-+0-9.eE]+|nan|inf)"

    def part(pattern: str, to: str) -> Column:
        return F.nullif(F.regexp_extract("value", pattern, 1), F.lit("")).try_cast(to)

    return lines_with_prefix(lines).select(
        part(r"^Epoch\.\.\. \((\d+)/", "int").alias("epoch"),
        part(r"^Epoch\.\.\. \(\d+/(\d+)", "int").alias("epochs"),
        part(rf"Loss: {number}", "double").alias("loss"),
        part(rf"Learning Rate: {number}", "double").alias("learning_rate"),
    )


# -------------------------------------------------------------------- writers


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> str:
    """CSV with header; an existing target is refused unless ``overwrite`` is set."""
    mode = "overwrite" if overwrite else "errorifexists"
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "enforceSchema")}
    df.write.mode(mode).options(**options, quoteAll=True, emptyValue="").csv(path)
    return path


def results_name(test_file: str, output_dir: str, epoch: int, num_correct: int | None = None) -> str:
    """Where the predictions of an epoch go, always below the output folder."""
    stem = os.path.splitext(os.path.basename(test_file.rstrip("/")))[0]
    counted = "" if num_correct is None else f"_correct_{num_correct}"
    return f"{output_dir.rstrip('/')}/{stem}_results_epoch_{epoch}{counted}.csv"


def augmented_name(name: str, folder: str = "") -> str:
    return f"{folder}additional_tasks_{name}"


def matrix_lines(columns: list[str]) -> Column:
    """Numbers of a row as comma-separated text with 18 digits after the point; missing values read ``nan``.

    The text reads back to the same numbers.
    """
    row = ",".join(["%.18e"] * len(columns))

    @arrow_udf("string")
    def shown(*values: pa.Array) -> pa.Array:
        cells = np.stack([v.to_numpy(zero_copy_only=False).astype(float) for v in values], axis=1)
        return pa.array([row % tuple(cell) for cell in cells.tolist()])

    return shown(*[F.col(c).cast("double") for c in columns])


def write_matrix(df: DataFrame, path: str, columns: list[str], overwrite: bool = False) -> None:
    """Numeric columns as comma-separated text without a header."""
    text = df.select(matrix_lines(columns).alias("value"))
    text.write.mode("overwrite" if overwrite else "errorifexists").text(path)


def read_matrix(spark: SparkSession, path: str, columns: list[str], header: bool = False) -> DataFrame:
    """The same text as ``DOUBLE`` columns."""
    schema = ", ".join(f"`{c}` DOUBLE" for c in columns)
    return spark.read.options(header=header, nanValue="nan").schema(schema).csv(path)


def write_metrics(metrics: DataFrame, path: str, overwrite: bool = False) -> None:
    """``metric, value`` rows as one JSON object with sorted keys.

    Metrics are one row per name, so a single object is small whatever was measured.
    """
    entries = F.array_sort(F.collect_list(F.struct("metric", "value")))
    line = metrics.agg(F.to_json(F.map_from_entries(entries), {"pretty": "true"}).alias("value"))
    line.write.mode("overwrite" if overwrite else "errorifexists").text(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``metric, value`` from such a file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,double>")).alias("metric", "value"))


def append_metrics(series: DataFrame, path: str) -> None:
    """Adds a metric series to a Parquet table partitioned by tag."""
    series.write.mode("append").partitionBy("tag").parquet(path)
