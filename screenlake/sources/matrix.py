"""Sparse matrix with row and column tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.operators import index


@dataclass(frozen=True)
class CellMatrix:
    """Cell rows, gene columns, and entries ``cell_id, gene_idx, value`` (zeros absent)."""

    cells: DataFrame
    genes: DataFrame
    values: DataFrame

    def shape(self) -> tuple[int, int]:
        return self.cells.count(), self.genes.count()

    def scan(self) -> DataFrame:
        """Entries with their gene name and cell columns."""
        return self.values.join(self.genes, "gene_idx").join(self.cells, "cell_id")


# The tables of a matrix folder and their columns.
SCHEMAS = {
    "cells": "cell_id STRING, lane STRING, condition STRING, state STRING",
    "genes": "gene_idx INT, gene STRING",
    "expression": "cell_id STRING, gene_idx INT, value DOUBLE",
}


def read_matrix_tables(spark: SparkSession, folder: str, file_format: str = "parquet") -> CellMatrix:
    """``cells``, ``genes`` and ``expression`` of one folder, as Parquet or as CSV with header."""
    if file_format == "parquet":
        return CellMatrix(*[spark.read.parquet(f"{folder}/{name}") for name in SCHEMAS])
    if file_format != "csv":
        raise ValueError(f"matrix tables are parquet or csv, not {file_format}")
    return CellMatrix(
        *[spark.read.option("header", True).schema(s).csv(f"{folder}/{name}") for name, s in SCHEMAS.items()]
    )


# ------------------------------------------------------------ coordinate text


@dataclass(frozen=True)
class Coordinates:
    """What the first lines of a coordinate file say."""

    rows: int
    columns: int
    entries: int
    pattern: bool = False
    symmetric: bool = False


def coordinate_header(spark: SparkSession, path: str) -> Coordinates:
    """Banner and size line; only the start of the file is read."""
    lines = spark.read.text(path).filter("_metadata.file_block_start = 0 AND trim(value) <> ''")
    banner = (lines.first() or [""])[0].lower().split()
    kinds = banner[1:] if banner and banner[0] == "%%matrixmarket" else []
    if kinds and (kinds[:2] != ["matrix", "coordinate"] or not {"complex", "hermitian", "skew-symmetric"}.isdisjoint(kinds)):
        raise ValueError(f"{path} is not a coordinate matrix of numbers: {' '.join(kinds)}")
    sizes = lines.filter("NOT startswith(value, '%')").first()
    if sizes is None or len(sizes[0].split()) != 3:
        raise ValueError(f"{path} has no line with rows, columns and entries")
    return Coordinates(*map(int, sizes[0].split()), "pattern" in kinds, "symmetric" in kinds)


def read_coordinates(
    spark: SparkSession,
    path: str,
    rows: tuple[int, int] | None = None,
    cell: str = "cell_idx",
    feature: str = "gene_idx",
    value: str = "value",
) -> DataFrame:
    """Entries of a coordinate text file (numbers from 1 there, from 0 here): ``cell, feature, value``.

    Spark cuts the file at line ends into tasks, so one file of any size is read by many. ``rows`` (first, last)
    reaches the parser as a pushed filter. The size line is what the reader takes for a header. Entries of a pattern
    are 1; the other half of a symmetric matrix is added. Fields stand one space apart; any other line ends the job.
    """
    known = coordinate_header(spark, path)
    schema = f"`row` BIGINT, `column` BIGINT{'' if known.pattern else ', `value` DOUBLE'}"
    options = {"sep": " ", "header": True, "comment": "%", "mode": "FAILFAST"}
    text = spark.read.options(**options).schema(schema).csv(path)
    amount = F.lit(1.0) if known.pattern else F.col("value")
    inside = lambda c: F.col(c).between(rows[0] + 1, rows[1] + 1) if rows else F.lit(True)
    entry = lambda i, j: [(F.col(i) - 1).alias(cell), (F.col(j) - 1).alias(feature), amount.alias(value)]
    found = text.filter(inside("row")).select(*entry("row", "column"))
    if known.symmetric:
        found = found.unionByName(text.filter(inside("column") & (F.col("row") != F.col("column"))).select(*entry("column", "row")))
    return found


def write_coordinates(
    entries: DataFrame, path: str, rows: int, columns: int, cell: str = "cell_idx", feature: str = "gene_idx", value: str = "value"
) -> None:
    """Entries numbered from 0 as coordinate text, in as many files as there are tasks, each with its size line."""
    stored = entries.select((F.col(cell) + 1).alias("i"), (F.col(feature) + 1).alias("j"), F.col(value).cast("double").cast("string").alias("v"))
    line = F.concat_ws(" ", "i", "j", "v").alias(f"{rows} {columns} {entries.count()}")
    # One column that is named like the size line, and separators that no line holds.
    stored.select(line).write.options(header=True, sep="\u0001", quote="\u0002").csv(path)


def read_coordinate_matrix(spark: SparkSession, path: str, cell_names: str, gene_names: str) -> CellMatrix:
    """A coordinate file with its two files of names, one name per line in the order of the numbers."""

    def named(file: str, number: str, name: str) -> DataFrame:
        lines = spark.read.text(file).select(
            F.col("value").alias(name),
            F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias("_place"),
        )
        return index.global_index(lines, ["_place"], number).select(number, name)

    cells, genes = named(cell_names, "cell_idx", "cell_id"), named(gene_names, "gene_idx", "gene")
    entries = read_coordinates(spark, path).join(cells, "cell_idx").select("cell_id", "gene_idx", "value")
    return CellMatrix(cells.select("cell_id"), genes, entries)
