"""Losses, accuracies, audits and activations."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.functions.arrays import log_softmax, total
from screenlake.functions.losses import sigmoid_class
from screenlake.operators import features, index, metrics, models
from screenlake.plans import bindings as b
from screenlake.plans.registry import query
from screenlake.session import scratch_path
from screenlake.sources import files

SMOOTHING = 0.1


def _answered(spark, sf_dir):
    rows = b.pairs(spark, sf_dir).select("row_id", "prompt", "correct_answer")
    return rows.withColumn("predictions", b.first_sentence(F.col("prompt")))


@query(
    "exact_match_accuracy",
    rf"""WITH {b.PAIRS_SQL}, a AS (SELECT trim({b.FIRST_SENTENCE_SQL.format("prompt")}, E' \t\n\x0B\f\r') AS p,
                                        trim(correct_answer, E' \t\n\x0B\f\r') AS y FROM pairs)
        SELECT count(*) FILTER (p = y) AS num_correct, count(*) AS num_total,
               count(*) FILTER (p = y) / count(*) AS accuracy FROM a""",
)
def exact_match_accuracy(spark, sf_dir):
    return metrics.exact_match(_answered(spark, sf_dir), "predictions", "correct_answer")


@query(
    "label_accuracy",
    """SELECT round(avg(CASE WHEN quality = (n_chars >= 500)::INT THEN 1.0::DOUBLE ELSE 0 END), 3) AS accuracy
       FROM labels JOIN documents USING (doc_id)""",
)
def label_accuracy(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") >= 500).cast("int").alias("guess"))
    return metrics.label_accuracy(b.table(spark, sf_dir, "labels").join(docs, "doc_id"), "guess", "quality")


@query(
    "mae_multioutput",
    f"""WITH labels AS ({b.proportions_sql()})
        SELECT round((avg(abs((event_type = 'view')::INT - "view")) + avg(abs((event_type = 'click')::INT - click))
                     + avg(abs((event_type = 'purchase')::INT - purchase))
                     + avg(abs((event_type = 'signup')::INT - signup))
                     + avg(abs((event_type NOT IN ('view', 'click', 'purchase', 'signup'))::INT - other))) / 5, 3) AS mae
        FROM events JOIN labels ON condition = user_id""",
)
def mae_multioutput(spark, sf_dir):
    cells = b.cells(spark, sf_dir)
    labelled = features.expand_labels(cells, features.state_proportions(cells, states=b.STATES), strict=False)
    truth = {f"true_{s}": (F.col("state") == s).cast("int") for s in b.STATES[:-1]}
    truth["true_other"] = (~F.col("state").isin(b.STATES[:-1])).cast("int")
    return metrics.mae_multioutput(labelled.withColumns(truth), {f"true_{s}": s for s in b.STATES})


@query("sse_loss", """SELECT round(sum(("value" - 12.5::DOUBLE) ** 2), 2) AS loss FROM events""")
def sse_loss(spark, sf_dir):
    rows = b.table(spark, sf_dir, "events").select(F.col("value").alias("y"), F.lit(12.5).alias("p"))
    return metrics.sse_loss(rows, "y", "p").select(F.round("loss", 2).alias("loss"))


@query(
    "bce_loss",
    """WITH r AS (SELECT quality AS y, least(greatest(n_chars / 4000, 1e-5::DOUBLE), 1 - 1e-5::DOUBLE) AS c
                  FROM labels JOIN documents USING (doc_id))
       SELECT round(sum(-y * ln(c) - (1 - y) * ln(1 - c)), 4) AS loss FROM r""",
)
def bce_loss(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") / 4000).alias("p"))
    scored = b.table(spark, sf_dir, "labels").join(docs, "doc_id")
    return metrics.bce_loss(scored, "quality", "p").select(F.round("loss", 4).alias("loss"))


def token_scores(spark, sf_dir):
    """Embeddings as token scores: the vector is the logits, class 0 is padding, 32 rows make a batch."""
    return b.table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id DIV 32 AS batch", "embedding AS logits", "label", "IF(label = 0, 0, 1) AS mask"
    )


TOKEN_SQL = """
    v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings),
    n AS (SELECT vec_id, ln(sum(exp(x))) AS norm FROM v GROUP BY vec_id),
    t AS (SELECT vec_id, vec_id // 32 AS batch, any_value(label) AS label, any_value(norm) AS norm,
                 -sum(CASE WHEN k = label THEN {conf} ELSE {low} END * (x - norm)) - {const} AS loss
          FROM v JOIN n USING (vec_id) GROUP BY vec_id)""".format(
    conf="0.9::DOUBLE",
    low="(0.1::DOUBLE / 63)",
    const="(-(0.9::DOUBLE * ln(0.9::DOUBLE) + 63 * (0.1::DOUBLE / 63) * ln(0.1::DOUBLE / 63 + 1e-20::DOUBLE)))",
)


@query(
    "masked_smoothed_ce",
    f"""WITH {TOKEN_SQL} SELECT round(sum(CASE WHEN label = 0 THEN 0 ELSE loss END) / count(*) FILTER (label <> 0), 6)
        AS loss, count(*) FILTER (label <> 0) AS num_labels FROM t""",
)
def masked_smoothed_ce(spark, sf_dir):
    scored = metrics.masked_cross_entropy(token_scores(spark, sf_dir), "logits", "label", "mask", SMOOTHING)
    return scored.select(F.round("loss", 6).alias("loss"), "num_labels")


@query(
    "mean_of_batch_ratios",
    f"""WITH {TOKEN_SQL}, r AS (SELECT sum(CASE WHEN label = 0 THEN 0 ELSE loss END) / count(*) FILTER (label <> 0) AS loss
                                FROM t GROUP BY batch)
        SELECT round(avg(loss), 6) AS loss FROM r""",
)
def mean_of_batch_ratios(spark, sf_dir):
    scored = metrics.mean_of_batch_ratios(
        token_scores(spark, sf_dir), "logits", "label", "mask", smoothing=SMOOTHING
    )
    return scored.select(F.round("loss", 6).alias("loss"))


@query(
    "label_mean",
    """SELECT round((avg(o_totalprice) + avg(o_custkey)) / 2, 4) AS mean FROM orders""",
)
def label_mean(spark, sf_dir):
    """Mean over all rows and outputs, where boosting over several outputs starts."""
    orders = b.table(spark, sf_dir, "orders").select("o_totalprice", "o_custkey")
    return spark.createDataFrame([(models.global_mean(orders, orders.columns),)], "mean double").select(F.round("mean", 4).alias("mean"))


@query(
    "skip_first",
    """SELECT event_id, user_id FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) WHERE i > 1""",
)
def skip_first(spark, sf_dir):
    return metrics.skip_first(b.table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", ["user_id"])


@query(
    "block_token_loss",
    f"""WITH {TOKEN_SQL} SELECT batch, round(sum(CASE WHEN label = 0 THEN 0 ELSE loss END) / count(*) FILTER (label <> 0), 6) AS loss,
                                count(*) FILTER (label <> 0) AS num_labels FROM t GROUP BY batch""",
)
def block_token_loss(spark, sf_dir):
    """The same losses from rows of 16 logits each."""
    whole = b.table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("logits"))
    blocks = whole.select("vec_id", "label", F.explode(F.sequence(F.lit(0), F.size("logits") - 1, F.lit(16))).alias("first"), "logits")
    blocks = blocks.select("vec_id", "label", "first", F.slice("logits", F.col("first") + 1, 16).alias("logits"))
    tokens = metrics.block_cross_entropy(blocks, ["vec_id", "label"], "logits", "first", "label", 64, SMOOTHING)
    marked = tokens.withColumns({"batch": F.expr("vec_id DIV 32"), "mask": F.when(F.col("label") == 0, 0).otherwise(1)})
    return metrics.masked_token_loss(marked, "loss", "mask", ["batch"]).select("batch", F.round("loss", 6).alias("loss"), "num_labels")


@query(
    "soft_target_ce",
    f"""WITH labels AS ({b.proportions_sql()}),
        e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, (generate_subscripts(embedding, 1) - 1) % 5 AS k FROM embeddings),
        x AS (SELECT vec_id, sum(v) FILTER (k = 0) AS a, sum(v) FILTER (k = 1) AS b, sum(v) FILTER (k = 2) AS c,
                     sum(v) FILTER (k = 3) AS d, sum(v) FILTER (k = 4) AS e FROM e GROUP BY vec_id),
        r AS (SELECT *, ln(exp(a) + exp(b) + exp(c) + exp(d) + exp(e)) AS norm,
                     row_number() OVER (ORDER BY md5('42:' || vec_id)) AS rn, count(*) OVER () AS n
              FROM x JOIN labels ON condition = vec_id)
        SELECT CASE WHEN rn <= n - round_even(n * 0.2::DOUBLE, 0) THEN 1 ELSE 0 END AS train_mask,
               round(avg("view" * (norm - a) + click * (norm - b) + purchase * (norm - c) + signup * (norm - d)
                         + other * (norm - e)), 6) AS loss FROM r GROUP BY 1""",
)
def soft_target_ce(spark, sf_dir):
    labels = features.state_proportions(b.cells(spark, sf_dir), states=b.STATES)
    # All places of a vector, folded onto one score per state.
    fold = lambda k: total(F.filter("embedding", lambda _, i: i % len(b.STATES) == k))
    outputs = b.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("condition"), F.array(*[fold(k) for k in range(len(b.STATES))]).alias("scores")
    )
    rows = outputs.join(labels, "condition").withColumn("targets", F.array(*b.STATES))
    masked = index.split_masks(rows, ["condition"], 0.2)
    scored = metrics.soft_target_cross_entropy(masked, "scores", "targets", ["train_mask"])
    return scored.select("train_mask", F.round("loss", 6).alias("loss"))


@query(
    "group_l2_norm",
    """SELECT label, round(sqrt(sum(x * x)), 6) AS norm
       FROM (SELECT label, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY label""",
)
def group_l2_norm(spark, sf_dir):
    norms = metrics.group_l2_norm(b.table(spark, sf_dir, "embeddings"), "label", "embedding")
    return norms.select("label", F.round("norm", 6).alias("norm"))


@query(
    "nan_audit",
    """SELECT count(*) AS n_rows, 'l_discount' AS "column", count(*) FILTER (l_discount = 0) AS n_missing FROM lineitem
       UNION ALL SELECT count(*), 'l_tax', count(*) FILTER (l_tax = 0) FROM lineitem""",
)
def nan_audit(spark, sf_dir):
    columns = ["l_discount", "l_tax"]
    lines = b.table(spark, sf_dir, "lineitem").select(*columns)
    return metrics.nan_audit(features.zero_to_nan(lines, columns), columns)


@query(
    "log_softmax",
    """WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
       n AS (SELECT vec_id, ln(sum(exp(x))) AS norm FROM v GROUP BY vec_id)
       SELECT vec_id, pos, round(x - norm, 6) AS value FROM v JOIN n USING (vec_id)""",
)
def log_softmax_rows(spark, sf_dir):
    vectors = b.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(log_softmax("embedding")))
    return vectors.select("vec_id", "pos", F.round("col", 6).alias("value"))


@query(
    "sigmoid_class",
    """SELECT event_id, CASE WHEN 1 / (1 + exp(-("value" - 12))) > 0.5 THEN 1 ELSE 0 END AS class FROM events""",
)
def sigmoid_class_rows(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", sigmoid_class(F.col("value") - 12).alias("class"))


@query(
    "metrics_prefixed",
    """SELECT 'test_max_value' AS metric, max("value") AS value FROM events
       UNION ALL SELECT 'test_num_total', count(*)::DOUBLE FROM events
       UNION ALL SELECT 'test_users', count(DISTINCT user_id)::DOUBLE FROM events""",
)
def metrics_prefixed(spark, sf_dir):
    wide = b.table(spark, sf_dir, "events").agg(
        F.countDistinct("user_id").alias("users"), F.max("value").alias("max_value"), F.count("*").alias("num_total")
    )
    path = scratch_path(spark, "metrics")
    files.write_metrics(metrics.prefixed(wide), path)
    return files.read_metrics(spark, path)
