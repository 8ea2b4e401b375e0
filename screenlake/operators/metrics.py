"""Losses, accuracies, step series and schedules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.functions import losses
from screenlake.functions.arrays import col, let, total
from screenlake.functions.text import strip
from screenlake.operators import index
from screenlake.session import materialize

# ------------------------------------------------------------------ accuracies


def mark_exact(df: DataFrame, predicted: str, answer: str, out: str = "correct") -> DataFrame:
    """Both sides stripped, then compared; a missing side never matches."""
    stripped = df.withColumns({predicted: strip(predicted), answer: strip(answer)})
    return stripped.withColumn(out, F.coalesce(F.col(predicted) == F.col(answer), F.lit(False)))


def exact_match(df: DataFrame, predicted: str, answer: str) -> DataFrame:
    """``num_correct, num_total, accuracy`` over the whole table."""
    hit = F.count_if("correct")
    return mark_exact(df, predicted, answer).agg(
        hit.alias("num_correct"),
        F.count("*").alias("num_total"),
        F.try_divide(hit, F.count("*")).alias("accuracy"),
    )


def label_accuracy(df: DataFrame, predicted: str, answer: str, digits: int = 3) -> DataFrame:
    """Share of equal labels, rounded."""
    same = F.coalesce(F.col(predicted) == F.col(answer), F.lit(False)).cast("double")
    return df.agg(F.round(F.avg(same), digits).alias("accuracy"))


def mae_multioutput(df: DataFrame, outputs: dict[str, str], digits: int = 3) -> DataFrame:
    """Mean absolute error: mean over rows per output, then the plain mean of the outputs.

    ``outputs`` maps each true column to its predicted column.
    """
    errors = [F.avg(F.abs(F.col(y) - F.col(p))) for y, p in outputs.items()]
    return df.agg(F.round(reduce(Column.__add__, errors) / len(errors), digits).alias("mae"))


# ---------------------------------------------------------------------- losses


def sse_loss(df: DataFrame, y: str, p: str) -> DataFrame:
    """Sum of squared errors (not their mean)."""
    return df.agg(F.sum(losses.squared_error(y, p)).alias("loss"))


def bce_loss(df: DataFrame, y: str, p: str) -> DataFrame:
    """Summed binary cross-entropy on clipped probabilities."""
    return df.agg(F.sum(losses.binary_cross_entropy(y, p)).alias("loss"))


def masked_cross_entropy(
    df: DataFrame, logits: str, label: str, mask: str, smoothing: float = 0.0, group: list[str] | None = None
) -> DataFrame:
    """Label-smoothed token loss over the unmasked tokens, in all or per group."""
    loss = losses.smoothed_cross_entropy(logits, label, smoothing)
    unmasked = F.sum(col(mask))
    scored = df.groupBy(*(group or [])).agg(
        F.try_divide(F.sum(loss * F.col(mask)), unmasked).alias("loss"), unmasked.alias("num_labels")
    )
    return scored


def mean_of_batch_ratios(
    df: DataFrame, logits: str, label: str, mask: str, batch: str = "batch", smoothing: float = 0.0
) -> DataFrame:
    """Plain mean of the per-batch losses, so a short batch weighs as much as a long one."""
    return masked_cross_entropy(df, logits, label, mask, smoothing, [batch]).agg(F.avg("loss").alias("loss"))


def block_cross_entropy(
    df: DataFrame, keys: list[str], logits: str, first: str, label: str, size: int, smoothing: float = 0.0
) -> DataFrame:
    """Per token (``keys``) its smoothed cross-entropy, from rows that hold a block of its vocabulary each.

    ``first`` is the vocabulary number of a block's first logit and ``size`` the size of the whole vocabulary. A block
    shrinks to its largest logit, its scaled sum of exponentials, its sum, and the logit of the label if it holds
    that; tokens are put together from these four numbers, so no row has a list as long as the vocabulary. The label
    stands in every row of a token. A token without the block of its label has no loss.
    """
    top = F.array_max(logits).cast("double")
    scaled = let(top, lambda t: F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - t)))
    own = F.get(F.col(logits), F.col(label) - F.col(first)).cast("double")
    held = F.when(F.col(label) >= F.col(first), own)
    blocks = df.select(*keys, top.alias("_top"), scaled.alias("_scaled"), total(logits).alias("_sum"), held.alias("_own"))
    # The window and the sums below share one shuffle of four numbers per block.
    raised = blocks.withColumn("_max", F.max("_top").over(Window.partitionBy(*keys)))
    merged = raised.groupBy(*keys).agg(
        (F.first("_max") + F.log(F.sum(F.col("_scaled") * F.exp(F.col("_top") - F.col("_max"))))).alias("_norm"),
        F.sum("_sum").alias("_sum"),
        F.max("_own").alias("_own"),
    )
    return merged.select(*keys, losses.smoothed_from_sums("_norm", "_sum", "_own", F.lit(size), smoothing).alias("loss"))


def masked_token_loss(tokens: DataFrame, loss: str, mask: str, group: list[str] | None = None) -> DataFrame:
    """Mean loss of the unmasked tokens and their number, in all or per group."""
    unmasked = F.sum(col(mask))
    return tokens.groupBy(*(group or [])).agg(F.try_divide(F.sum(F.col(loss) * F.col(mask)), unmasked).alias("loss"), unmasked.alias("num_labels"))


def soft_target_cross_entropy(
    df: DataFrame, scores: str, targets: str, group: list[str] | None = None
) -> DataFrame:
    """Mean cross-entropy of the rows against target shares, in all or per group."""
    return df.groupBy(*(group or [])).agg(F.avg(losses.soft_cross_entropy(scores, targets)).alias("loss"))


def mean_length(df: DataFrame, ids: str, pad: int, out: str = "gen_len") -> DataFrame:
    """Mean number of ids that are not padding."""
    return df.agg(F.avg(F.size(F.filter(ids, lambda x: x != pad))).alias(out))


def group_l2_norm(df: DataFrame, group: str, array: str) -> DataFrame:
    """Euclidean norm of all values of a group."""
    squares = F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return df.groupBy(group).agg(F.sqrt(F.sum(squares)).alias("norm"))


def nan_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, n_missing, n_rows`` from one pass over the table."""
    audited = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.isnan(c)).alias(c) for c in columns])
    return audited.unpivot("n_rows", columns, "column", "n_missing")


def nan_mask(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same columns as booleans that say where a value is missing."""
    return df.withColumns({c: F.isnan(c) for c in columns})


# ---------------------------------------------------------------- step series


def metric_series(
    steps: DataFrame,
    closing: DataFrame,
    train_metrics: list[str],
    eval_metrics: list[str],
    epoch: str = "epoch",
    step: str = "step",
    time: str = "train_time",
) -> DataFrame:
    """``epoch, tag, step, value``.

    ``steps`` has one row per training step and epoch, in the order of its
    whole-number ``step``; ``closing`` one row per epoch with the step its
    series ends at. Value ``i`` of ``L`` lands on step ``end - L + i + 1``;
    eval metrics and the time land on the end itself.
    """
    placed = index.group_position(steps, epoch, step, "_i", "_n")
    ends = closing.select(epoch, F.col(step).alias("_end"))
    placed = placed.join(ends, epoch, "left").withColumn("_at", F.col("_end") - F.col("_n") + F.col("_i") + 1)
    train = placed.select(epoch, F.col("_at").alias("step"), *[F.col(m).alias(f"train_{m}") for m in train_metrics])
    tails = closing.select(
        epoch, F.col(step).alias("step"), F.col(time), *[F.col(m).alias(f"eval_{m}") for m in eval_metrics]
    )
    long = [frame.unpivot([epoch, "step"], None, "tag", "value") for frame in (train, tails)]
    return long[0].unionByName(long[1]).select(epoch, "tag", "step", "value")


def every_kth(df: DataFrame, step: str, k: int) -> DataFrame:
    """Rows whose step is a multiple of ``k``."""
    return df.filter(F.col(step) % k == 0)


def skip_first(df: DataFrame, step: str, group: list[str] | None = None) -> DataFrame:
    """Every series without its first element."""
    starts = df.groupBy(*(group or [])).agg(F.min(step).alias("_start"))
    if group:
        return df.join(starts, group).filter(F.col(step) > F.col("_start")).select(*df.columns)
    return df.filter(F.col(step) > starts.scalar())


def last_per_epoch(df: DataFrame, values: list[str], epoch: str = "epoch", step: str = "step") -> DataFrame:
    """Values of the last step of every epoch."""
    return df.groupBy(epoch).agg(*[F.max_by(v, step).alias(v) for v in values], F.max(step).alias(step))


def steps_per_epoch(df: DataFrame, batch: int, group: list[str] | None = None) -> DataFrame:
    """Row count with the number of full batches and of all batches."""
    return df.groupBy(*(group or [])).agg(
        F.count("*").alias("n"),
        F.floor(F.count("*") / batch).alias("full_steps"),
        F.ceil(F.count("*") / batch).alias("all_steps"),
    )


def warmup_decay(step: str | Column, total: str | Column, warmup: int, rate: float) -> Column:
    """Linear rise over ``warmup`` steps, then a linear fall to 0 at ``total``.

    Without steps left to fall over, the rate stays where the rise ended.
    """
    s, t = col(step), col(total)
    rise = F.try_divide(F.lit(rate) * s, F.lit(warmup))
    left = F.when(t > warmup, F.greatest(1 - F.try_divide(s - warmup, t - warmup), F.lit(0.0))).otherwise(1.0)
    return F.when(s < warmup, rise).otherwise(F.lit(rate) * left)


def scheduled_rows(
    df: DataFrame, order: list[str], batch: int, epochs: int, warmup: int, rate: float
) -> DataFrame:
    """Every row once per epoch, with the step that consumes it and the rate of that step."""
    placed = index.global_index(df, order, "_i", "_n").withColumn("_steps", F.floor(F.col("_n") / batch))
    batched = placed.withColumn("_batch", F.floor(F.col("_i") / batch)).filter("_batch < _steps")
    repeated = batched.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    stepped = repeated.withColumn("step", F.col("epoch") * F.col("_steps") + F.col("_batch"))
    learning = warmup_decay("step", F.col("_steps") * epochs, warmup, rate)
    return stepped.select(*df.columns, "epoch", "step", learning.alias("learning_rate"))


def head_rows(df: DataFrame, limits: dict[str, int], order: list[str], split: str = "split") -> DataFrame:
    """First ``min(n, limit)`` rows of each split that has a limit; every other split stays whole.

    One narrow pass over split and order key numbers all limited splits at once and finds the key at which each is
    cut; the rows themselves are then filtered where they are, whatever the number of limits. Rows that repeat a key
    are told apart by a hash of the whole row, and rows that are the same all through are counted out at the cut.
    """
    limited = {name: limit for name, limit in limits.items() if limit > 0}
    key = F.struct(*order, F.xxhash64(*df.columns).alias("_tie"))
    keys = df.filter(F.col(split).isin(list(limited))).select(F.col(split).alias("_split"), key.alias("_key"))
    placed = index.group_position(keys, "_split", "_key", "_i")
    bound = reduce(lambda c, item: c.when(F.col("_split") == item[0], item[1]), limited.items(), F.when(F.lit(False), 0))
    cut = placed.filter(F.col("_i") == bound - 1).select("_split", F.col("_key").alias("_cut"))
    # Per split, where its cut is and how many of the rows just at the cut belong to the head: a row per limit.
    ties = placed.join(F.broadcast(materialize(cut, "cuts")), "_split").filter(F.col("_key") == F.col("_cut"))
    cuts = materialize(ties.groupBy("_split", "_cut").agg((F.first(bound) - F.min("_i")).alias("_need"), F.count("*").alias("_have")), "cuts")
    whole = df.filter(F.col(split).isNull() | ~F.col(split).isin(list(limits)))
    marked = df.withColumn("_key", key).join(F.broadcast(cuts), F.col(split) == F.col("_split"), "left")
    below = marked.filter(F.col(split).isin(list(limited)) & (F.col("_cut").isNull() | (F.col("_key") < F.col("_cut")) | ((F.col("_key") == F.col("_cut")) & (F.col("_need") == F.col("_have")))))
    some = marked.filter((F.col("_key") == F.col("_cut")) & (F.col("_need") < F.col("_have")))
    same = some.groupBy(*df.columns).agg(F.first("_need").alias("_need"))
    repeated = same.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_need")))
    return reduce(DataFrame.unionByName, [whole, below.select(*df.columns), repeated.select(*df.columns)])


# -------------------------------------------------------------------- reports


def prefixed(metrics: DataFrame, prefix: str = "test_", digits: int | None = None) -> DataFrame:
    """One-row metrics as ``metric, value`` with prefixed names, sorted by name."""
    values = {c: F.col(c).cast("double") for c in metrics.columns}
    if digits is not None:
        values = {c: F.round(v, digits) for c, v in values.items()}
    wide = metrics.select(*[values[c].alias(f"{prefix}{c}") for c in sorted(metrics.columns)])
    return wide.unpivot([], None, "metric", "value")
