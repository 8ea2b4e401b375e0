"""The driver's tables in the roles the operators expect.

The ``*_SQL`` strings say the same for the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Named states of the events table; `other` also takes the one type that is not listed.
STATES = ["view", "click", "purchase", "signup", "other"]

# Conditions left out of the training tables.
EXCLUDED_USERS = [3, 7, 11]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------- assay roles


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell table: one row per event, condition = user, state = event type."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS cell_id", "user_id AS condition", "event_type AS state"
    )


def proportions_sql(where: str = "") -> str:
    return f"""
    SELECT user_id AS condition,
           count(*) FILTER (event_type = 'view') / count(*) AS "view",
           count(*) FILTER (event_type = 'click') / count(*) AS click,
           count(*) FILTER (event_type = 'purchase') / count(*) AS purchase,
           count(*) FILTER (event_type = 'signup') / count(*) AS signup,
           count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase', 'signup')) / count(*) AS other
    FROM events {where} GROUP BY user_id"""


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell table behind the quantity matrix: lane = order priority."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS cell_id", "o_orderpriority AS lane", "o_orderpriority AS condition", "o_orderstatus AS state"
    )


def part_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse matrix: orders x parts, quantity as value; pairs may repeat."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS cell_id", "l_partkey AS gene_idx", "l_quantity AS value"
    )


# Line numbers run from 1 to 7, so they make a matrix that is narrow enough to be dense.
LINES = 7


def line_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse matrix: orders x line numbers, quantity as value; pairs may repeat."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS cell_id", "l_linenumber - 1 AS gene_idx", "l_quantity AS value"
    )


LINE_ROWS_SQL = "SELECT o_orderkey AS cell_id, o_orderpriority AS lane, o_orderstatus AS state, " + ", ".join(
    f"coalesce(sum(l_quantity) FILTER (l_linenumber = {i + 1}), 0.0) AS f{i}" for i in range(LINES)
) + " FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL"


# -------------------------------------------------------------- graph roles


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge file: the two keys of each line item as linked ids."""
    return table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS protein1", "l_partkey AS protein2")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name dictionary; names repeat, so the first row of a name counts."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS protein_id", "p_name AS preferred_name", "p_partkey AS file_ord"
    )


# The labelled names of the graph queries.
LABEL_PATTERN = "^(red|blue|green|small|large) "


def graph_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label set: the part names with one of a few leading words."""
    named = table(spark, sf_dir, "part").filter(F.col("p_name").rlike(LABEL_PATTERN))
    return named.select(F.col("p_name").alias("label")).distinct()


RELATION_SQL = f"""
    WITH labels AS (SELECT DISTINCT p_name AS label FROM part WHERE regexp_matches(p_name, '{LABEL_PATTERN}')),
    firsts AS (SELECT p_name AS label, min(p_partkey) AS id FROM part
               WHERE p_name IN (SELECT label FROM labels) GROUP BY p_name),
    both_ways AS (SELECT l_suppkey AS a, l_partkey AS b FROM lineitem
                  UNION SELECT l_partkey, l_suppkey FROM lineitem),
    relation AS (SELECT f.label AS src, e.b AS dst_id, p.p_name AS dst
                 FROM both_ways e JOIN firsts f ON e.a = f.id JOIN part p ON p.p_partkey = e.b
                 WHERE p.p_name IN (SELECT label FROM labels)),
    edges AS (SELECT DISTINCT src, dst FROM relation)"""


# --------------------------------------------------------------- text roles


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text pairs: whole document as prompt, its first line as the answer."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.concat_ws("/", "lang", "source", F.col("doc_id").cast("string")).alias("id"),
        F.concat("source", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".json")).alias("path_data"),
        F.col("text").alias("prompt"),
        F.substring_index("text", "\n", 1).alias("correct_answer"),
    )


PAIRS_SQL = """
    pairs AS (SELECT doc_id AS row_id, concat_ws('/', lang, source, doc_id::VARCHAR) AS id,
                     source || '_' || doc_id::VARCHAR || '.json' AS path_data,
                     "text" AS prompt, split_part("text", chr(10), 1) AS correct_answer
              FROM documents)"""


def first_sentence(prompt: Column) -> Column:
    """Stand-in predictor: the text up to its first sentence end, else the whole text."""
    return F.regexp_extract(prompt, r"(?s)^(.*?[.!?])(\s|$)", 1)


FIRST_SENTENCE_SQL = r"regexp_extract({0}, '(?s)^(.*?[.!?])(\s|$)', 1)"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text pairs: a user turn and the assistant turn right after it."""
    talk = table(spark, sf_dir, "conversations")
    asked = talk.filter("role = 'user'").selectExpr("conv_id", "turn", "text AS prompt")
    reply = talk.filter("role = 'assistant'").selectExpr("conv_id", "turn - 1 AS turn", "text AS correct_answer")
    return asked.join(reply, ["conv_id", "turn"])


TURNS_SQL = """
    turns AS (SELECT u.conv_id, u.turn, u."text" AS prompt, a."text" AS correct_answer
              FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
              WHERE u.role = 'user' AND a.role = 'assistant')"""
