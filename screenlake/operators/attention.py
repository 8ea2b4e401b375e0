"""Attention-weighted neighbour aggregation with given weights (Brody et al. 2021)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.functions.arrays import elu, log_softmax
from screenlake.session import materialize


@dataclass(frozen=True)
class AttentionWeights:
    """One layer: two linear maps, the attention vector and the output bias."""

    left: list[list[float]]  # out x in, for the sending node
    right: list[list[float]]  # out x in, for the receiving node
    attention: list[float]
    left_bias: list[float] | None = None
    right_bias: list[float] | None = None
    bias: list[float] | None = None

    @property
    def width(self) -> int:
        return len(self.attention)


def _project(weights: AttentionWeights):
    left, right = np.asarray(weights.left, float), np.asarray(weights.right, float)
    left_bias = np.asarray(weights.left_bias or [0.0] * weights.width, float)
    right_bias = np.asarray(weights.right_bias or [0.0] * weights.width, float)

    @F.pandas_udf("l array<double>, r array<double>")
    def project(vectors: pd.Series) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"l": [], "r": []})
        x = np.stack(vectors.to_numpy()).astype(float)
        return pd.DataFrame({"l": list(x @ left.T + left_bias), "r": list(x @ right.T + right_bias)})

    return project


def _score(weights: AttentionWeights, slope: float) -> Column:
    parts = []
    for k, a in enumerate(weights.attention):
        x = F.col("l")[k] + F.col("r")[k]
        parts.append(F.lit(float(a)) * F.when(x > 0, x).otherwise(x * slope))
    return reduce(Column.__add__, parts)


def attention_layer(
    nodes: DataFrame, edges: DataFrame, weights: AttentionWeights, slope: float = 0.2
) -> DataFrame:
    """``id, x`` after one layer; ``nodes`` is ``id, x`` and ``edges`` integer ``src, dst`` with self-edges.

    The softmax of a node's incoming edges is two aggregates with map-side
    combine, so a hub is reduced in every task before it meets one. Projected
    nodes and scored edges are each read twice and therefore written once.
    """
    projected = materialize(nodes.select("id", _project(weights)("x").alias("p")).select("id", "p.l", "p.r"), "projected")
    senders = projected.select(F.col("id").alias("src"), "l")
    receivers = projected.select(F.col("id").alias("dst"), "r")
    scored = edges.join(senders, "src").join(receivers, "dst").select(
        "dst", "l", _score(weights, slope).alias("score")
    )
    scored = materialize(scored, "scored")
    top = scored.groupBy("dst").agg(F.max("score").alias("top"))
    weighed = scored.join(top, "dst").withColumn("w", F.exp(F.col("score") - F.col("top")))
    sums = [F.sum(F.col("w") * F.col("l")[k]).alias(f"_s{k}") for k in range(weights.width)]
    pooled = weighed.groupBy("dst").agg(F.sum("w").alias("_w"), *sums)
    bias = weights.bias or [0.0] * weights.width
    values = [F.col(f"_s{k}") / F.col("_w") + F.lit(float(bias[k])) for k in range(weights.width)]
    return pooled.select(F.col("dst").alias("id"), F.array(*values).alias("x"))


def attention_network(
    nodes: DataFrame, edges: DataFrame, first: AttentionWeights, second: AttentionWeights
) -> DataFrame:
    """``id, x, log_probability``: two layers with ELU between, log-softmax at the end."""
    hidden = attention_layer(nodes, edges, first).withColumn("x", elu("x"))
    scores = attention_layer(hidden, edges, second)
    return scores.withColumn("log_probability", log_softmax("x"))
