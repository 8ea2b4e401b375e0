"""Numbering, permutations, samples, splits, batches and step series."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.operators import features, index, metrics
from screenlake.plans import bindings as b
from screenlake.plans.registry import query

BATCH = 32

RANKED_SQL = "row_number() OVER (ORDER BY md5('42:' || event_id))"


def _events(spark, sf_dir, *columns):
    return b.table(spark, sf_dir, "events").select("event_id", *columns)


@query(
    "group_number",
    """SELECT doc_id, (dense_rank() OVER (ORDER BY source) - 1)::VARCHAR AS group_number FROM documents""",
)
def group_number(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "source")
    return index.group_number(docs, "source").drop("source")


@query(
    "renumber_rows",
    """SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS "index" FROM documents WHERE lang = 'en'""",
)
def renumber_rows(spark, sf_dir):
    english = b.table(spark, sf_dir, "documents").filter("lang = 'en'").select("doc_id")
    return index.renumber(english, ["doc_id"])


@query(
    "batches_drop_last",
    f"""SELECT event_id, i // {BATCH} AS batch
        FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM events)
        WHERE i // {BATCH} < n // {BATCH}""",
)
def batches_drop_last(spark, sf_dir):
    return index.batches(_events(spark, sf_dir), ["event_id"], BATCH)


@query(
    "batches_array_split",
    f"""WITH placed AS (SELECT event_id, {RANKED_SQL} - 1 AS i, count(*) OVER () AS n,
                               (count(*) OVER () + {BATCH - 1}) // {BATCH} AS k FROM events)
        SELECT event_id, CASE WHEN i < (n % k) * (n // k + 1) THEN i // (n // k + 1)
                              ELSE (n % k) + (i - (n % k) * (n // k + 1)) // (n // k) END AS batch FROM placed""",
)
def batches_array_split(spark, sf_dir):
    return index.batches(_events(spark, sf_dir), ["event_id"], BATCH, drop_last=False, shuffle_seed=42)


@query("seeded_permutation", f"SELECT event_id, {RANKED_SQL} - 1 AS position FROM events")
def seeded_permutation(spark, sf_dir):
    return index.permute(_events(spark, sf_dir), ["event_id"], 42)


@query(
    "epoch_permutation",
    """SELECT event_id, epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || epoch || ':' || event_id)) - 1
              AS position FROM events, (VALUES (0), (1), (2)) e(epoch)""",
)
def epoch_permutation(spark, sf_dir):
    return index.permute_per_epoch(_events(spark, sf_dir), ["event_id"], 42, 3)


@query(
    "seeded_sample",
    f"""SELECT event_id, event_type FROM (SELECT *, {RANKED_SQL} AS rn, count(*) OVER () AS n FROM events)
        WHERE rn <= round_even(n * 0.15::DOUBLE, 0)""",
)
def seeded_sample(spark, sf_dir):
    return index.sample_fraction(_events(spark, sf_dir, "event_type"), ["event_id"], 0.15)


@query(
    "exact_split_masks",
    f"""SELECT event_id, (rn <= n - round_even(n * 0.2::DOUBLE, 0))::INT AS train_mask,
               (rn > n - round_even(n * 0.2::DOUBLE, 0))::INT AS test_mask
        FROM (SELECT event_id, {RANKED_SQL} AS rn, count(*) OVER () AS n FROM events)""",
)
def exact_split_masks(spark, sf_dir):
    return index.split_masks(_events(spark, sf_dir), ["event_id"], 0.2)


@query(
    "three_way_split",
    f"""SELECT event_id, CASE WHEN rn <= n // 2 THEN 'train' WHEN rn <= n // 2 + (n - n // 2) // 2 THEN 'test'
                              ELSE 'validation' END AS split
        FROM (SELECT event_id, {RANKED_SQL} AS rn, count(*) OVER () AS n FROM events)""",
)
def three_way_split(spark, sf_dir):
    return index.three_way(_events(spark, sf_dir), ["event_id"])


@query(
    "cumulative_time",
    """SELECT event_id, user_id, sum("value"::DECIMAL(18, 2)) OVER (PARTITION BY user_id ORDER BY event_id)::DOUBLE
              AS train_time FROM events""",
)
def cumulative_time(spark, sf_dir):
    seconds = F.col("value").cast("decimal(18,2)")
    timed = index.running_total(_events(spark, sf_dir, "user_id", "value"), "user_id", "event_id", seconds, "train_time")
    return timed.select("event_id", "user_id", F.col("train_time").cast("double").alias("train_time"))


# ---------------------------------------------------------------- step series


@query(
    "metric_series_long",
    """WITH placed AS (SELECT user_id AS epoch, "value" AS loss, "value" / 100 AS learning_rate,
                              row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i,
                              count(*) OVER (PARTITION BY user_id) AS n FROM events)
       SELECT epoch, 'train_loss' AS tag, epoch * n - n + i + 1 AS step, loss AS value FROM placed
       UNION ALL SELECT epoch, 'train_learning_rate', epoch * n - n + i + 1, learning_rate FROM placed
       UNION ALL SELECT epoch, 'eval_loss', epoch * n, max(loss) FROM placed GROUP BY epoch, n
       UNION ALL SELECT epoch, 'train_time', epoch * n, sum(loss::DECIMAL(18, 2))::DOUBLE FROM placed
                 GROUP BY epoch, n""",
)
def metric_series_long(spark, sf_dir):
    steps = _events(spark, sf_dir, "user_id", "value").selectExpr(
        "user_id AS epoch", "event_id AS step", "value AS loss", "value / 100 AS learning_rate"
    )
    per_epoch = steps.groupBy("epoch").agg(
        F.count("*").alias("steps"),
        F.max("loss").alias("loss"),
        F.sum(F.col("loss").cast("decimal(18,2)")).cast("double").alias("train_time"),
    )
    closing = per_epoch.withColumn("step", F.col("epoch") * F.col("steps")).drop("steps")
    return metrics.metric_series(steps, closing, ["loss", "learning_rate"], ["loss"])


@query("every_kth_step", "SELECT event_id, user_id, value FROM events WHERE event_id % 10 = 0")
def every_kth_step(spark, sf_dir):
    return metrics.every_kth(_events(spark, sf_dir, "user_id", "value"), "event_id", 10)


@query(
    "last_metric_per_epoch",
    "SELECT user_id AS epoch, arg_max(value, event_id) AS loss, max(event_id) AS step FROM events GROUP BY user_id",
)
def last_metric_per_epoch(spark, sf_dir):
    steps = _events(spark, sf_dir, "user_id", "value").selectExpr("user_id AS epoch", "event_id AS step", "value AS loss")
    return metrics.last_per_epoch(steps, ["loss"])


@query(
    "steps_per_epoch",
    """SELECT lang AS split, count(*) AS n, count(*) // 8 AS full_steps, (count(*) + 7) // 8 AS all_steps
       FROM documents GROUP BY lang""",
)
def steps_per_epoch(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").selectExpr("lang AS split")
    return metrics.steps_per_epoch(docs, 8, ["split"])


@query(
    "warmup_decay_schedule",
    """WITH n AS (SELECT count(*) AS n FROM orders), t AS (SELECT (n // 16) * 2 AS total FROM n),
       placed AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
       SELECT o_orderkey, e.epoch, e.epoch * (n // 16) + i // 16 AS step,
              CASE WHEN e.epoch * (n // 16) + i // 16 < 100 THEN 6e-5::DOUBLE * (e.epoch * (n // 16) + i // 16) / 100
                   ELSE 6e-5::DOUBLE * greatest(1 - (e.epoch * (n // 16) + i // 16 - 100) / (total - 100), 0) END
              AS learning_rate
       FROM placed, n, t, (VALUES (0), (1)) e(epoch) WHERE i // 16 < n // 16""",
)
def warmup_decay_schedule(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey")
    return metrics.scheduled_rows(orders, ["o_orderkey"], batch=16, epochs=2, warmup=100, rate=6e-5)


@query(
    "head_rows",
    """SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
                                 FROM documents) WHERE rn <= CASE lang WHEN 'en' THEN 50 WHEN 'fr' THEN 20
                                                                      ELSE rn END""",
)
def head_rows(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return metrics.head_rows(docs, {"en": 50, "fr": 20}, ["doc_id"], split="lang")


@query(
    "reindex_left",
    "SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
)
def reindex_left(spark, sf_dir):
    keys = b.table(spark, sf_dir, "documents").select("doc_id")
    return features.reindex(b.table(spark, sf_dir, "labels"), keys, "doc_id")
