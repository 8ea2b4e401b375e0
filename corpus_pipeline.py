"""The corpus pipeline: documents in, packed training sequences out, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it as Parquet and the next one reads it.
All but the last return the columns of ``documents``. Repeated rows, nulls in any column, empty texts, empty tables
and further columns are allowed everywhere; further columns are not passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm import minhash, packing, pii, quality, substring
from screenlake.llm.common import bloom_filter, default_tokenizer, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that the rules reject; each row is judged by itself and travels with its verdict."""
    return quality.judge(docs.select(*COLUMNS), carry=("text", "lang", "source", "n_chars")).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, that with the smallest doc_id; at 0.8 similarity or more.

    Rows that are surely the only ones of their doc_id and text, and chosen, stay where they are. Only the others are
    shuffled, to drop what was not chosen and to keep one of rows that repeat both.
    """
    found = minhash.near_duplicates(docs.select(*COLUMNS), percent=80)
    marks = written(found.groupBy("doc_id", "tie").agg(F.max("chosen").alias("chosen"), F.count(F.lit(1)).alias("n")), "marks")
    doubtful = marks.where("NOT chosen OR n > 1")
    hashed = docs.select(*COLUMNS).withColumn("tie", F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))))
    asked = bloom_filter(doubtful, ["doc_id", "tie"])
    suspect = F.lit(True) if asked is None else asked(F.col("doc_id"), F.col("tie"))
    dropped = doubtful.where("NOT chosen")
    left = hashed.where(suspect).hint("merge")
    left = left.join(dropped, left["doc_id"].eqNullSafe(dropped["doc_id"]) & (left["tie"] == dropped["tie"]), "left_anti")
    return hashed.where(~suspect).select(*COLUMNS).unionByName(left.dropDuplicates(["doc_id", "tie"]).select(*COLUMNS))


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 20 words or more that start earlier in the corpus; words are then joined by one space."""
    kept = substring.remove_repeats(docs, carry=("lang", "source"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that give it away."""
    clean = pii.sanitise(docs, carry=("lang", "source"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = packing.pack(docs, default_tokenizer(), keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_removal", substring_removal),
    ("personal_data", personal_data),
    ("packed_sequences", packed_sequences),
]

#: The later stages cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
