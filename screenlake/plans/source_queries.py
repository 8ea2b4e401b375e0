"""Files written from the driver's tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.operators import features
from screenlake.plans import bindings as b
from screenlake.plans.registry import query
from screenlake.session import reuse_or_build, scratch_path
from screenlake.sources import files
from screenlake.sources.matrix import CellMatrix, coordinate_header, read_coordinates, write_coordinates

TALK_SCHEMA = "conv_id BIGINT, turn BIGINT, text STRING"


@query(
    "load_splits",
    """SELECT CASE role WHEN 'user' THEN 'train' WHEN 'assistant' THEN 'validation' ELSE 'test' END AS split,
              conv_id, turn, "text" FROM conversations""",
)
def load_splits(spark, sf_dir):
    talk = b.table(spark, sf_dir, "conversations")
    root = scratch_path(spark, "splits")
    paths = {"train": f"{root}/train.csv", "validation": f"{root}/validation.json", "test": f"{root}/test.csv"}
    columns = ["conv_id", "turn", "text"]
    files.write_csv(talk.filter("role = 'user'").select(columns), paths["train"])
    talk.filter("role = 'assistant'").select(columns).write.json(paths["validation"])
    files.write_csv(talk.filter("role = 'system'").select(columns), paths["test"])
    return files.load_splits(spark, paths, TALK_SCHEMA)


SPOILED_SQL = """
    WITH t AS (SELECT CASE role WHEN 'user' THEN 'train' ELSE 'test' END AS split, conv_id::VARCHAR AS c, turn::VARCHAR AS n, role,
                      CASE WHEN conv_id % 5 = 1 THEN 'n' ELSE '' END || conv_id::VARCHAR AS bad_c,
                      CASE WHEN turn % 3 = 1 THEN turn::VARCHAR || '.x' ELSE turn::VARCHAR END AS bad_n,
                      conv_id % 11 = 3 AS short, conv_id % 11 = 4 AS long FROM conversations)"""


def _spoiled(spark, sf_dir):
    """Conversations as CSV and JSON lines, some with text in number columns, too few or too many fields, or a broken object."""
    talk = b.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    conv = F.concat(F.when(F.col("conv_id") % 5 == 1, "n").otherwise(""), F.col("conv_id").cast("string"))
    turn = F.when(F.col("turn") % 3 == 1, F.concat(F.col("turn").cast("string"), F.lit(".x"))).otherwise(F.col("turn").cast("string"))
    few, many = F.col("conv_id") % 11 == 3, F.col("conv_id") % 11 == 4
    line = F.when(few, F.concat_ws(",", conv, turn)).when(many, F.concat_ws(",", conv, turn, "role", F.lit("more"))).otherwise(F.concat_ws(",", conv, turn, "role"))
    json = F.concat(F.lit('{"conv_id":"'), conv, F.lit('","turn":"'), turn, F.lit('","role":"'), F.col("role"), F.when(few, '"').otherwise('"}'))
    root = scratch_path(spark, "spoiled")
    # One column that is named like the header line, and separators that no line holds: lines are written as they are.
    lines = talk.filter("role = 'user'").select(line.alias("conv_id,turn,role"))
    lines.write.options(header=True, sep="\u0001", quote="\u0002").csv(f"{root}/train.csv")
    talk.filter("role <> 'user'").select(json.alias("value")).write.text(f"{root}/test.json")
    return {"train": f"{root}/train.csv", "test": f"{root}/test.json"}, "conv_id BIGINT, turn BIGINT, role STRING"


@query(
    "load_splits_rejects",
    SPOILED_SQL + """, r AS (
        SELECT split, bad_c, bad_n, role,
               CASE WHEN split = 'train' AND short THEN bad_c || ',' || bad_n WHEN split = 'train' AND long THEN bad_c || ',' || bad_n || ',' || role || ',more'
                    WHEN split = 'test' AND short THEN '{"conv_id":"' || bad_c || '","turn":"' || bad_n || '","role":"' || role || '"' END AS broken,
               concat_ws('; ', CASE WHEN bad_c <> c THEN 'conv_id is no bigint: ' || bad_c END, CASE WHEN bad_n <> n THEN 'turn is no bigint: ' || bad_n END) AS wrong
        FROM t)
    SELECT split, CASE WHEN broken IS NULL THEN wrong ELSE 'malformed record' END AS reason,
           coalesce(broken, '{"conv_id":"' || bad_c || '","turn":"' || bad_n || '","role":"' || role || '"}') AS record
    FROM r WHERE broken IS NOT NULL OR wrong <> ''""",
)
def load_splits_rejects(spark, sf_dir):
    paths, schema = _spoiled(spark, sf_dir)
    return files.split_rejects(spark, paths, schema, multi_line=False).select("split", "reason", "record")


@query(
    "load_splits_accepted",
    SPOILED_SQL + """ SELECT split, c::BIGINT AS conv_id, n::BIGINT AS turn, role FROM t
        WHERE bad_c = c AND bad_n = n AND NOT short AND NOT (split = 'train' AND long)""",
)
def load_splits_accepted(spark, sf_dir):
    paths, schema = _spoiled(spark, sf_dir)
    return files.load_splits(spark, paths, schema, multi_line=False, rejects="drop")


@query(
    "read_delimited",
    """SELECT l_suppkey::VARCHAR AS protein1, l_partkey::VARCHAR AS protein2, p_name AS preferred_name
       FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def read_delimited(spark, sf_dir):
    root = scratch_path(spark, "delimited")
    links = b.links(spark, sf_dir)
    links.write.options(header=True, sep=" ").csv(f"{root}/links")
    names = b.names(spark, sf_dir).selectExpr("protein_id AS `#string_protein_id`", "preferred_name")
    names.write.options(header=True, sep="\t").csv(f"{root}/names")
    edges = files.read_delimited(spark, f"{root}/links", files.LINKS_SCHEMA, " ")
    known = files.read_delimited(spark, f"{root}/names", files.NAMES_SCHEMA, "\t")
    return edges.join(known.withColumnRenamed("#string_protein_id", "protein2"), "protein2").select(
        "protein1", "protein2", "preferred_name"
    )


@query(
    "matrix_scan",
    """SELECT l_orderkey AS cell_id, l_partkey AS gene_idx, sum(l_quantity) AS value, p_name AS gene,
              o_orderpriority AS condition
       FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""",
)
def matrix_scan(spark, sf_dir):
    genes = b.table(spark, sf_dir, "part").selectExpr("p_partkey AS gene_idx", "p_name AS gene")
    cells = b.order_cells(spark, sf_dir).select("cell_id", "condition")
    return CellMatrix(cells, genes, features.sum_entries(b.part_matrix(spark, sf_dir))).scan()


@query(
    "matrix_shape",
    """SELECT (SELECT count(*) FROM orders) AS cells, (SELECT count(*) FROM part) AS genes""",
)
def matrix_shape(spark, sf_dir):
    genes = b.table(spark, sf_dir, "part").selectExpr("p_partkey AS gene_idx", "p_name AS gene")
    cells, genes = CellMatrix(b.order_cells(spark, sf_dir), genes, b.part_matrix(spark, sf_dir)).shape()
    return spark.createDataFrame([(cells, genes)], "cells long, genes long")


@query(
    "coordinate_scan",
    """WITH n AS (SELECT max(o_orderkey) // 2 AS half FROM orders), m AS (
           SELECT l_orderkey AS cell_idx, l_partkey AS gene_idx, sum(l_quantity) AS value FROM lineitem GROUP BY ALL)
       SELECT cell_idx, gene_idx, value, (SELECT count(*) FROM m) AS entries FROM m, n WHERE cell_idx BETWEEN 10 AND half""",
)
def coordinate_scan(spark, sf_dir):
    """The quantities of lines as one coordinate text, of which half the rows are read."""
    entries = features.sum_entries(b.part_matrix(spark, sf_dir), "cell_id", "gene_idx", "value").withColumnRenamed("cell_id", "cell_idx")
    highest = b.table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    path = scratch_path(spark, "coordinates")
    write_coordinates(entries, path, highest + 1, b.table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0] + 1)
    known = coordinate_header(spark, path)
    return read_coordinates(spark, path, rows=(10, highest // 2)).withColumn("entries", F.lit(known.entries).cast("long"))


@query(
    "result_files",
    """SELECT conv_id, turn, role, "text" FROM conversations""",
)
def result_files(spark, sf_dir):
    """Results written as CSV under the name that says epoch and hits, and read back by that name."""
    talk = b.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    right = talk.filter("role = 'assistant'").count()
    name = files.results_name("in/test.csv", scratch_path(spark, "results"), 3, right)
    files.write_csv(talk, name)
    found = files.read_csv(spark, name, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return found.withColumn("text", F.coalesce("text", F.lit("")))


@query(
    "prepared_table",
    """SELECT lang, count(*) AS n FROM documents GROUP BY lang""",
)
def prepared_table(spark, sf_dir):
    """A prepared table that follows its source: built once for these files and arguments, then read."""
    source, folder = f"{sf_dir}/documents.parquet", scratch_path(spark, "prepared")
    build = lambda: b.table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    for _ in range(2):
        kept = reuse_or_build(spark, folder, "languages", {"by": "lang"}, build, sources=[source])
    return kept


@query(
    "export_matrix",
    """SELECT l_quantity AS x0, l_extendedprice AS x1, CASE WHEN l_discount = 0 THEN 'nan'::DOUBLE ELSE l_discount END
              AS x2, l_tax AS x3 FROM lineitem""",
)
def export_matrix(spark, sf_dir):
    rows = b.table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity AS x0", "l_extendedprice AS x1", "l_discount AS x2", "l_tax AS x3"
    )
    path, columns = scratch_path(spark, "matrix"), ["x0", "x1", "x2", "x3"]
    files.write_matrix(features.zero_to_nan(rows, ["x2"]), path, columns)
    return files.read_matrix(spark, path, columns)


def _log(spark, sf_dir):
    """A log written from the events: progress lines, indented ones, and lower-case noise."""
    events = b.table(spark, sf_dir, "events")
    progress = F.concat(
        F.lit("Epoch... ("), (F.col("user_id") + 1).cast("string"), F.lit("/150 | Loss: "),
        F.col("value").cast("string"), F.lit(", Learning Rate: "),
        (F.col("event_id") / 1024).cast("decimal(18,4)").cast("string"), F.lit(")"),
    )
    line = (
        F.when(F.col("event_type").isin("view", "click"), progress)
        .when(F.col("event_type") == "signup", F.concat(F.lit(" "), progress))
        .when(F.col("event_type") == "purchase", F.lower(progress))
        .otherwise(F.lit("Epoch... (no numbers here)"))
    )
    path = scratch_path(spark, "log")
    events.select(line.alias("value")).write.text(path)
    return files.read_log(spark, path)


LOG_SQL = """
    WITH e AS (SELECT *, 'Epoch... (' || (user_id + 1)::VARCHAR || '/150 | Loss: ' || "value"::VARCHAR
                         || ', Learning Rate: ' || (event_id / 1024)::DECIMAL(18, 4)::VARCHAR || ')' AS line FROM events)"""


@query(
    "log_lines_prefix",
    f"""{LOG_SQL} SELECT line AS value FROM e WHERE event_type IN ('view', 'click')
        UNION ALL SELECT 'Epoch... (no numbers here)' FROM e WHERE event_type NOT IN ('view', 'click', 'signup', 'purchase')""",
)
def log_lines_prefix(spark, sf_dir):
    return files.lines_with_prefix(_log(spark, sf_dir))


@query(
    "log_metrics_extract",
    f"""{LOG_SQL} SELECT (user_id + 1)::INT AS epoch, 150 AS epochs, "value" AS loss,
                         (event_id / 1024)::DECIMAL(18, 4)::DOUBLE AS learning_rate
        FROM e WHERE event_type IN ('view', 'click')
        UNION ALL SELECT NULL, NULL, NULL, NULL FROM e WHERE event_type NOT IN ('view', 'click', 'signup', 'purchase')""",
)
def log_metrics_extract(spark, sf_dir):
    return files.log_metrics(_log(spark, sf_dir))
