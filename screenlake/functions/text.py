"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from screenlake.functions.arrays import col

# Every character that counts as whitespace when text is stripped.
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(text: str | Column) -> Column:
    """Whitespace removed at both ends, in time linear in the text."""
    return F.btrim(col(text), F.lit(WHITESPACE))


def file_root(path: str | Column) -> Column:
    """Text before the first dot, and of that the part before the first underscore."""
    return F.substring_index(F.substring_index(col(path), ".", 1), "_", 1)


def parent_dir(path: str | Column) -> Column:
    """Next-to-last part of a slash path; null when there is none."""
    return F.try_element_at(F.split(col(path), "/"), F.lit(-2))


def sentence_lines(text: str | Column) -> Column:
    """One sentence per line: a sentence ends at ``.``, ``!`` or ``?`` before whitespace."""
    return F.regexp_replace(col(text), r"([.!?])\s+", "$1\n")


def with_prefix(text: str | Column, prefix: str | None) -> Column:
    return F.concat(F.lit(prefix or ""), col(text))


def words(text: str | Column, first: int | None = None) -> Column:
    """Whitespace-separated tokens, or only the ``first`` so many.

    Splitting stops behind the last wanted token: leading whitespace costs one
    empty piece and the unsplit rest is one more.
    """
    limit = -1 if first is None else first + 2
    tokens = F.filter(F.split(col(text), r"\s+", limit), lambda x: x != "")
    return tokens if first is None else F.slice(tokens, 1, first)


def token_count(text: str | Column, end_marker: bool = False) -> Column:
    """Number of tokens, plus one when the encoder adds an end marker."""
    return F.regexp_count(col(text), F.lit(r"\S+")) + int(end_marker)


def as_text(value: str | Column) -> Column:
    """String form; a missing value becomes ``nan`` as in frame libraries."""
    return F.coalesce(col(value).cast("string"), F.lit("nan"))
