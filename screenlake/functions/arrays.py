"""Array expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` loops over an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(array: str | Column) -> Column:
    """Sum of a numeric array."""
    return F.aggregate(col(array), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dense_from_entries(entries: str | Column, width: int) -> Column:
    """Zero-filled array from entries ``(i, v)`` sorted by ``i``; null entries give all zeros.

    Each entry writes the gap before it and itself, so the work is linear in
    the row width.
    """
    e = col(entries)

    def piece(x: Column, at: Column) -> Column:
        last = F.when(at == 0, F.lit(-1)).otherwise(F.get(e, at - 1)["i"])
        return F.concat(F.array_repeat(F.lit(0.0), x["i"] - last - 1), F.array(x["v"]))

    tail = F.array_repeat(F.lit(0.0), F.lit(width - 1) - F.get(e, F.size(e) - 1)["i"])
    filled = F.concat(F.flatten(F.transform(e, piece)), tail)
    return F.when(F.size(e) > 0, filled).otherwise(F.array_repeat(F.lit(0.0), width))


def indicator(position: Column, width: Column) -> Column:
    """Vector of ``width`` zeros with a 1 at ``position``."""
    before = F.array_repeat(F.lit(0.0), position.cast("int"))
    after = F.array_repeat(F.lit(0.0), (width - position - 1).cast("int"))
    return F.concat(before, F.array(F.lit(1.0)), after)


def log_sum_exp(array: str | Column) -> Column:
    a = col(array)

    def shifted(top: Column) -> Column:
        return top + F.log(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - top)))

    return let(F.array_max(a).cast("double"), shifted)


def log_softmax(array: str | Column) -> Column:
    """``x - log(sum(exp(x)))`` per element, shifted by the maximum."""
    a = col(array)
    return let(log_sum_exp(a), lambda norm: F.transform(a, lambda x: x.cast("double") - norm))


def elu(array: str | Column) -> Column:
    """``x`` above 0, ``exp(x) - 1`` below."""
    return F.transform(col(array), lambda x: F.when(x > 0, x).otherwise(F.expm1(x)))


def clip(value: str | Column, low: float, high: float) -> Column:
    return F.least(F.greatest(col(value), F.lit(low)), F.lit(high))


def redact_suffix(mapping: str | Column, suffix: str = "_token") -> Column:
    """Map values whose key ends in ``suffix`` replaced by the bracketed upper-case key."""
    return F.transform_values(
        col(mapping),
        lambda k, v: F.when(F.endswith(k, F.lit(suffix)), F.concat(F.lit("<"), F.upper(k), F.lit(">"))).otherwise(v),
    )
