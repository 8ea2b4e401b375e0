"""Label tables, feature matrices and one-hot columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.functions.arrays import redact_suffix
from screenlake.operators import features
from screenlake.plans import bindings as b
from screenlake.plans.registry import query

LINE_NAMES = [f"f{i}" for i in range(b.LINES)]
STATE_LIST = ", ".join(f'"{s}"' for s in b.STATES)


def _conditions(spark, sf_dir):
    return b.table(spark, sf_dir, "customer").filter("c_acctbal > 0").selectExpr("c_custkey AS condition")


@query(
    "state_counts",
    """SELECT user_id AS condition,
              count(*) FILTER (event_type = 'view') AS "view",
              count(*) FILTER (event_type = 'click') AS click,
              count(*) FILTER (event_type = 'purchase') AS purchase,
              count(*) FILTER (event_type = 'signup') AS signup,
              count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase', 'signup')) AS other,
              count(*) AS total
       FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY user_id""",
)
def state_counts(spark, sf_dir):
    return features.state_counts(b.cells(spark, sf_dir), _conditions(spark, sf_dir), b.STATES)


@query(
    "state_proportions",
    b.proportions_sql("WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"),
)
def state_proportions(spark, sf_dir):
    return features.state_proportions(b.cells(spark, sf_dir), _conditions(spark, sf_dir), b.STATES)


@query(
    "expand_labels",
    f"""WITH labels AS ({b.proportions_sql()})
        SELECT event_id AS cell_id, condition, event_type AS state, {STATE_LIST}
        FROM events JOIN labels ON condition = user_id WHERE user_id NOT IN (3, 7, 11)""",
)
def expand_labels(spark, sf_dir):
    cells = b.cells(spark, sf_dir)
    labels = features.label_table(cells, states=b.STATES)
    return features.expand_labels(features.exclude_conditions(cells, b.EXCLUDED_USERS), labels)


@query(
    "exclude_conditions",
    "SELECT doc_id, source, lang FROM documents WHERE source NOT IN ('src0', 'src3', 'src7')",
)
def exclude_conditions(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return features.exclude_conditions(docs, ["src0", "src3", "src7"], "source")


@query(
    "split_by_condition",
    """SELECT doc_id, source, CASE WHEN source IN ('src1', 'src2') THEN 'test'
              WHEN source IN ('src5') THEN 'validation' ELSE 'train' END AS split FROM documents""",
)
def split_by_condition(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "source")
    return features.split_by_condition(docs, ["src1", "src2"], ["src5"], "source")


@query(
    "ordered_membership",
    """WITH asked(ord, gene) AS (VALUES (0, 'small ring'), (1, 'no such part'), (2, 'blue bolt'),
                                        (3, 'red widget'), (4, 'absent'))
       SELECT ord, gene, min(p_partkey) AS gene_idx FROM asked JOIN part ON p_name = gene GROUP BY ord, gene""",
)
def ordered_membership(spark, sf_dir):
    genes = b.table(spark, sf_dir, "part").selectExpr("p_name AS gene", "p_partkey AS gene_idx")
    return features.positions_of(genes, ["small ring", "no such part", "blue bolt", "red widget", "absent"])


@query(
    "drop_features",
    """SELECT l_orderkey AS cell_id, l_partkey AS gene_idx, sum(l_quantity) AS value FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'SMALL') GROUP BY ALL""",
)
def drop_features(spark, sf_dir):
    small = b.table(spark, sf_dir, "part").filter("p_type = 'SMALL'").selectExpr("p_partkey AS gene_idx")
    return features.sum_entries(features.drop_features(b.part_matrix(spark, sf_dir), small))


@query(
    "select_features",
    """SELECT l_orderkey AS cell_id, l_partkey AS gene_idx, sum(l_quantity) AS value FROM lineitem
       WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'SMALL') GROUP BY ALL""",
)
def select_features(spark, sf_dir):
    small = b.table(spark, sf_dir, "part").filter("p_type = 'SMALL'").selectExpr("p_partkey AS gene_idx")
    return features.sum_entries(features.select_features(b.part_matrix(spark, sf_dir), small))


def _dense(spark, sf_dir):
    return features.densify(b.order_cells(spark, sf_dir), b.line_matrix(spark, sf_dir), b.LINES)


@query("densify_rows", f"SELECT * EXCLUDE (lane, state) FROM ({b.LINE_ROWS_SQL})")
def densify_rows(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    return dense.select("cell_id", *features.as_columns(dense, "features", LINE_NAMES))


STATUS_STATES = ["F", "O", "other"]
STATUS_SQL = """
    SELECT o_orderpriority AS lane, count(*) FILTER (o_orderstatus = 'F') / count(*) AS y0,
           count(*) FILTER (o_orderstatus = 'O') / count(*) AS y1,
           count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) / count(*) AS y2
    FROM orders GROUP BY o_orderpriority"""


@query(
    "stack_features_labels",
    f"SELECT r.* EXCLUDE (lane, state), y0, y1, y2 FROM ({b.LINE_ROWS_SQL}) r JOIN ({STATUS_SQL}) USING (lane)",
)
def stack_features_labels(spark, sf_dir):
    cells = b.order_cells(spark, sf_dir)
    labels = features.label_table(cells, states=STATUS_STATES)
    dense = features.expand_labels(_dense(spark, sf_dir), labels)
    stacked = features.stack(dense, "features", STATUS_STATES)
    return stacked.select("cell_id", *features.as_columns(stacked, "features", [*LINE_NAMES, "y0", "y1", "y2"]))


@query(
    "onehot_sparse",
    """WITH n AS (SELECT count(DISTINCT l_partkey)::INT AS size FROM lineitem)
       SELECT l_orderkey, l_linenumber, size + 2 AS size,
              list_filter([(dense_rank() OVER (ORDER BY l_partkey) - 1)::INT, CASE WHEN l_quantity <> 0 THEN size END, CASE WHEN l_tax <> 0 THEN size + 1 END],
                          lambda x: x IS NOT NULL) AS indices,
              list_filter([1.0::DOUBLE, nullif(l_quantity, 0), nullif(l_tax, 0)], lambda x: x IS NOT NULL) AS "values"
       FROM lineitem, n""",
)
def onehot_sparse(spark, sf_dir):
    """Every part a category, with two numbers of the line behind it: no row is as long as the part list."""
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    rows = features.stack_sparse(features.one_hot_sparse(lines, "l_partkey"), "onehot", ["l_quantity", "l_tax"], "row")
    return rows.select("l_orderkey", "l_linenumber", "row.*")


@query(
    "onehot_lookup",
    """WITH levels AS (SELECT DISTINCT lang AS level FROM documents)
       SELECT doc_id, lang, (SELECT string_agg(CASE WHEN level = lang THEN '1' ELSE '0' END, ' ' ORDER BY level)
                             FROM levels) AS onehot FROM documents""",
)
def onehot_lookup(spark, sf_dir):
    docs = features.one_hot(b.table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang")
    digits = F.transform("onehot", lambda x: x.cast("int").cast("string"))
    return docs.withColumn("onehot", F.array_join(digits, " "))


@query(
    "features_with_lane",
    f"""SELECT r.* EXCLUDE (lane, state), (lane = '1-URGENT')::DOUBLE AS lane0, (lane = '2-HIGH')::DOUBLE AS lane1,
               (lane = '3-MEDIUM')::DOUBLE AS lane2, (lane = '4-NOT SPECIFIED')::DOUBLE AS lane3,
               (lane = '5-LOW')::DOUBLE AS lane4 FROM ({b.LINE_ROWS_SQL}) r""",
)
def features_with_lane(spark, sf_dir):
    wide = features.append_array(features.one_hot(_dense(spark, sf_dir), "lane"), "features", "onehot")
    names = [*LINE_NAMES, *[f"lane{i}" for i in range(5)]]
    return wide.select("cell_id", *features.as_columns(wide, "features", names))


@query(
    "zero_to_nan",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_discount = 0 THEN 'nan'::DOUBLE ELSE l_discount END
              AS l_discount, CASE WHEN l_tax = 0 THEN 'nan'::DOUBLE ELSE l_tax END AS l_tax FROM lineitem""",
)
def zero_to_nan(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"
    )
    return features.zero_to_nan(lines, ["l_discount", "l_tax"])


@query(
    "cast_features",
    """SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS value
       FROM embeddings""",
)
def cast_features(spark, sf_dir):
    vectors = features.cast_columns(b.table(spark, sf_dir, "embeddings"), ["embedding"], "double")
    return vectors.select("vec_id", F.posexplode("embedding").alias("pos", "value"))


@query(
    "distinct_sorted",
    "SELECT source, row_number() OVER (ORDER BY source) - 1 AS position FROM (SELECT DISTINCT source FROM documents)",
)
def distinct_sorted(spark, sf_dir):
    return features.distinct_positions(b.table(spark, sf_dir, "documents"), "source")


@query(
    "redact_map",
    """SELECT event_id, unnest(['k', 'user_token']) AS key,
              unnest([json_extract_string(props, '$.k'), '<USER_TOKEN>']) AS value FROM events""",
)
def redact_map(spark, sf_dir):
    settings = F.map_concat(
        F.from_json("props", "map<string,string>"),
        F.create_map(F.lit("user_token"), F.col("user_id").cast("string")),
    )
    hidden = b.table(spark, sf_dir, "events").select("event_id", redact_suffix(settings).alias("settings"))
    return hidden.select("event_id", F.explode("settings").alias("key", "value"))


def _or_nan(names):
    return ", ".join(f"CASE WHEN {n} = 0 THEN 'nan'::DOUBLE ELSE {n} END AS {n}" for n in names)


@query(
    "prepare_training_table",
    f"""WITH kept AS (SELECT r.*, y0, y1, y2 FROM ({b.LINE_ROWS_SQL}) r JOIN ({STATUS_SQL}) USING (lane)
                      WHERE lane <> '4-NOT SPECIFIED'),
        placed AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || cell_id)) AS rn, count(*) OVER () AS n FROM kept)
        SELECT cell_id, CASE WHEN rn <= n // 2 THEN 'train' WHEN rn <= n // 2 + (n - n // 2) // 2 THEN 'test'
                             ELSE 'validation' END AS split, {_or_nan(LINE_NAMES[1:])}, {_or_nan(["y0", "y1", "y2"])}
        FROM placed""",
)
def prepare_training_table(spark, sf_dir):
    matrix = b.line_matrix(spark, sf_dir)
    ready = features.training_table(
        b.order_cells(spark, sf_dir),
        matrix,
        genes=matrix,
        excluded=["4-NOT SPECIFIED"],
        dropped_features=matrix.filter("gene_idx = 0"),
        states=STATUS_STATES,
    )
    return ready.select("cell_id", "split", *features.as_columns(ready, "features", [*LINE_NAMES[1:], "y0", "y1", "y2"]))
