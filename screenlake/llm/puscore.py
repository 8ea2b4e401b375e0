"""Quality scores by positive-unlabelled learning.

Trusted positives are labelled rows; the unlabelled set is the text of all rows. The class prior is estimated from
a first model that tells positives from unlabelled text: where the two densities agree best, their ratio is 1 over
the prior. A linear model then minimises the non-negative unbiased risk with logistic loss; its part for negatives,
risk(unlabelled) - prior * risk(positives), is kept at or above zero.

Both fits are Newton steps over sums of gradients and curvatures. The sums are made where the features are, so all
rows take part and what reaches the driver is as large as the square of the number of features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import text_slices, written

UPPER, LOWER, DIGIT = (np.arange(*r) for r in ((65, 91), (97, 123), (48, 58)))
SPACE = np.array([32, *range(9, 14)])
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8).astype(int)
MARKS = np.frombuffer(b"!?", np.uint8).astype(int)
STOPS = np.frombuffer(b".,;:", np.uint8).astype(int)


def features(text: str) -> list[float]:
    """Shape of a whole text: length, classes of characters, words, repetition, lines."""
    data = text.encode()
    histogram = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n, size = len(words), max(len(data), 1)
    share = lambda codes: float(histogram[codes].sum()) / size
    lines = [line for line in text.split("\n") if line.strip()]
    per_word = 1 / max(n, 1)
    shares = [share(c) for c in (UPPER, DIGIT, SPACE, SYMBOLS, MARKS, STOPS)]
    distinct = len(set(words)) * per_word
    again = sum(map(bytes.__eq__, words, words[1:])) * per_word
    pairs = len(set(zip(words, words[1:]))) / max(n - 1, 1)
    length = float(np.log1p(n))
    values = [
        length, length * length / 10, *shares, *(min(1.0, 10 * s) for s in shares), float(np.sqrt(shares[0])), float(np.sqrt(shares[3])), float(np.sqrt(shares[4])),
        float(histogram[124]) * per_word, float(histogram[128:].sum()) / size, np.log1p(sum(map(len, words)) * per_word), distinct, again, pairs,
        float(np.sqrt(again)), max(0.0, 0.7 - pairs), len(lines) * per_word, 1 - len(set(lines)) / max(len(lines), 1), float(n == 0),
    ]
    return values


N_FEATURES = len(features("a b"))


def feature_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, x): features of every row, written."""
    frame = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                rows = pa.array([features(t) for t in texts], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), rows], ["key", "x"])

    return written(frame.mapInArrow(run, f"key {frame.schema['key'].dataType.simpleString()}, x array<double>"), "features")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(rows: DataFrame, of) -> np.ndarray:
    """Sum over all rows of ``of(matrix)``, an array of fixed size; summed per task, then by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    parts = rows.select("x").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(max((r["place"] for r in parts), default=-1) + 1)
    for row in parts:
        out[row["place"]] = row["value"]
    return out


class Model:
    """Standardised features and a linear logit."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones(len(x))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.inputs(x) @ self.weights


def curvature(model: Model):
    """Count, sum of softplus(logit), its gradient and its second derivatives, flat."""

    def of(x: np.ndarray) -> np.ndarray:
        inputs = model.inputs(x)
        z = inputs @ model.weights
        p = 1 / (1 + np.exp(-z))
        second = inputs.T @ (inputs * (p * (1 - p))[:, None])
        return np.concatenate([[len(x), np.logaddexp(0, z).sum()], inputs.T @ p, second.ravel()])

    return of


def fit(positives: DataFrame, unlabelled: DataFrame, rounds: int = 8, ridge: float = 1e-3) -> tuple[Model, float]:
    """Model and class prior from (x) rows; without positives every score is the prior 0.5."""
    d = N_FEATURES
    sums = summed(unlabelled, lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]))
    if not len(sums):
        return Model(np.zeros(d), np.ones(d), np.zeros(d + 1)), 0.5
    mean = sums[1 : d + 1] / sums[0]
    spread = np.sqrt(np.maximum(sums[d + 1 :] / sums[0] - mean * mean, 0))
    scale = np.where(spread > 1e-9, spread, 1)
    empty = Model(mean, scale, np.zeros(d + 1))
    known = summed(positives, lambda x: np.concatenate([[len(x)], empty.inputs(x).sum(axis=0)]))
    if not len(known):
        return empty, 0.5
    centre = known[1:] / known[0]
    penalty = ridge * np.append(np.ones(d), 0)

    def newton(weight: float, rounds: int, correct: bool) -> Model:
        """Minimises mean softplus(z) over the unlabelled - weight * mean z over the positives.

        This is the unbiased risk for the logistic loss, in which loss(z) - loss(-z) = -z.
        """
        model = empty
        for _ in range(rounds):
            found = summed(unlabelled, curvature(model))
            n, risk, gradient, second = found[0], found[1], found[2 : d + 3], found[d + 3 :].reshape(d + 1, d + 1)
            slope, bend = gradient / n, second / n
            target = slope - weight * centre
            if correct:
                own = summed(positives, curvature(model))
                if risk / n - weight * own[1] / own[0] < 0:  # the risk of negatives fell below zero: lift it
                    target = -(slope - weight * own[2 : d + 3] / own[0])
            step = np.linalg.solve(bend + np.diag(penalty + 1e-6), target + penalty * model.weights)
            size = np.abs(step).max()
            model = Model(mean, scale, model.weights - step * min(1.0, 4 / max(size, 1e-9)))
            if size < 1e-4:
                break
        return model

    for share in (0.5, 0.05):  # for a prior of ``share`` the sigmoid is that share of the density ratio, so no lower prior can be seen
        first = newton(share, rounds, False)
        ratio = summed(positives, lambda x: np.array([len(x), _ratio(first, x, share).sum()]))  # noqa: B023
        prior = float(np.clip(ratio[0] / max(ratio[1], 1e-9), 0.05, 0.98))
        if prior > 1.1 * share:
            break
    return newton(prior, rounds, True), prior


def _ratio(model: Model, x: np.ndarray, share: float) -> np.ndarray:
    """Density of positives over that of unlabelled rows, by the model for a prior of ``share``."""
    return 1 / (share * (1 + np.exp(-model.logit(x))))


def quality_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 4, held_fold: int = 2,
    threshold: float = 0.7, rounds: int = 8,
) -> DataFrame:
    """(key, held_out, score, predicted) of every row of ``docs``.

    Labels are read only for keys whose crc32 modulo ``folds`` is not ``held_fold``, and only positive ones. A key
    that is labelled more than once counts once, by its largest label. Null labels and null keys are not used;
    a null key is not held out. Null and empty texts are scored like any other text. Without positives every score
    is 0.5. Repeated rows are scored each; an empty table gives no rows; other columns are not read.
    """
    fold = F.crc32(F.col("key").cast("string").cast("binary")) % folds
    table = feature_table(docs, key, text)
    trusted = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where((fold != held_fold) & F.col("label").isNotNull())
    trusted = trusted.groupBy("key").agg(F.max("label").alias("label")).where("label = 1").select("key")
    positives = written(table.join(trusted, "key", "left_semi").select("x"), "positives")
    model, _ = fit(positives, table, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logit = model.logit(matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-logit)))], ["key", "score"])

    scored = table.mapInArrow(run, f"key {table.schema['key'].dataType.simpleString()}, score double")
    held = F.coalesce(fold == held_fold, F.lit(False)).alias("held_out")
    return scored.select(F.col("key").alias(key), held, "score", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
