"""ROUGE F-scores (Lin 2004) of text pairs.

N-grams are counted by Spark: each row's are exploded once, with the side they stand on, counted per row before
anything is shuffled, and the smaller count of both sides is the overlap. Subsequences are found row by row by small
helpers, in Arrow batches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from screenlake.functions.arrays import col
from screenlake.functions.stemmer import stem as porter_stem

KINDS = ("rouge1", "rouge2", "rougeL", "rougeLsum")
SUBSEQUENCES = ("rougeL", "rougeLsum")


def clean(text: str | Column) -> Column:
    """Lower case; every run without letters or digits becomes a space, line breaks stay."""
    return F.regexp_replace(F.lower(col(text)), r"[^\p{L}\p{N}\n]+", " ")


def f_score(overlap: float, predicted: int, expected: int) -> float:
    if not overlap or not predicted or not expected:
        return 0.0
    precision, recall = overlap / predicted, overlap / expected
    return 2 * precision * recall / (precision + recall)


def _lcs_states(a: list[str], b: list[str]) -> Iterator[int]:
    """Bit-parallel subsequence table: one integer per prefix of ``a``, one bit per word of ``b``.

    A bit is 0 where the length grows by one at that word of ``b``.
    """
    where: dict[str, int] = {}
    for i, word in enumerate(b):
        where[word] = where.get(word, 0) | (1 << i)
    full = state = (1 << len(b)) - 1
    yield state
    for word in a:
        hits = state & where.get(word, 0)
        state = ((state + hits) | (state - hits)) & full
        yield state


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence."""
    last = 0
    for last in _lcs_states(a, b):
        pass
    return len(b) - last.bit_count()


def _lcs_hits(expected: list[str], predicted: list[str]) -> set[int]:
    """Positions in ``expected`` of one longest common subsequence."""
    states = list(_lcs_states(expected, predicted))

    def length(i: int, j: int) -> int:
        return j - (states[i] & ((1 << j) - 1)).bit_count()

    hits, i, j = set(), len(expected), len(predicted)
    while i and j:
        if expected[i - 1] == predicted[j - 1]:
            hits.add(i - 1)
            i, j = i - 1, j - 1
        elif length(i, j - 1) > length(i - 1, j):
            j -= 1
        else:
            i -= 1
    return hits


def summary_lcs(predicted: list[list[str]], expected: list[list[str]]) -> float:
    """Summary-level score: per expected sentence the union of its matches, each word counted as often as both have it."""
    left, right = Counter(w for s in predicted for w in s), Counter(w for s in expected for w in s)
    sizes = left.total(), right.total()
    matched = 0
    for sentence in expected:
        union = set().union(*[_lcs_hits(sentence, other) for other in predicted]) if predicted else set()
        for i in sorted(union):
            word = sentence[i]
            if left[word] > 0 and right[word] > 0:
                matched += 1
                left[word] -= 1
                right[word] -= 1
    return f_score(matched, *sizes)


@lru_cache(maxsize=200_000)
def _stem(word: str) -> str:
    return porter_stem(word)


def stems(words: Column) -> Column:
    """Porter stems of word lists; each distinct word of a batch is stemmed once."""

    @arrow_udf("array<string>")
    def stemmed(lists: pa.Array) -> pa.Array:
        filled = lists.fill_null([])
        coded = filled.flatten().dictionary_encode()
        known = pa.array([None if w is None else _stem(w) for w in coded.dictionary.to_pylist()], pa.string())
        ends = np.cumsum(np.append(0, np.array(filled.value_lengths(), np.int64)))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), known.take(coded.indices))

    return stemmed(words)


def gram_words(text: str | Column, stem: bool) -> Column:
    """Cleaned words of a text; none for a missing one."""
    words = F.filter(F.split(F.coalesce(clean(text), F.lit("")), r"\s+"), lambda w: w != "")
    return stems(words) if stem else words


def grams(words: Column, n: int) -> Column:
    """N-grams of a word list, joined by a space."""
    if n == 1:
        return words
    starts = F.sequence(F.lit(1), F.size(words) - n + 1)
    return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def ngram_scores(df: DataFrame, row: str, predicted: str, expected: str, sizes: tuple[int, ...] = (1, 2), stem: bool = True) -> DataFrame:
    """``row, rouge1, rouge2, ..``: F-scores over n-gram counts, each clipped to the smaller side, for every row.

    ``row`` names the rows; rows that share a name are scored as one.
    """
    sides = df.select(row, gram_words(predicted, stem).alias("_p"), gram_words(expected, stem).alias("_y"))
    entry = lambda n, side: lambda g: F.struct(F.lit(n).alias("n"), F.lit(side).alias("predicted"), g.alias("gram"))
    lists = [F.transform(grams(F.col(c), n), entry(n, c == "_p")) for n in sizes for c in ("_p", "_y")]
    each = sides.select(row, F.explode_outer(F.concat(*lists)).alias("_e")).select(row, "_e.*")
    counted = each.groupBy(row, "n", "gram").agg(F.count_if("predicted").alias("p"), F.count_if(~F.col("predicted")).alias("y"))
    sums = counted.groupBy(row).agg(
        *[F.sum(F.when(F.col("n") == n, value)).alias(f"_{name}{n}") for n in sizes for name, value in (("o", F.least("p", "y")), ("p", F.col("p")), ("y", F.col("y")))]
    )
    return sums.select(row, *[_f_score(*[F.col(f"_{name}{n}") for name in "opy"]).alias(f"rouge{n}") for n in sizes])


def _f_score(overlap: Column, predicted: Column, expected: Column) -> Column:
    precision, recall = overlap / predicted, overlap / expected
    return F.when(overlap > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)


def score_pair(predicted: str, expected: str, kinds: tuple[str, ...], stem: bool) -> list[float]:
    """Subsequence scores of two cleaned texts with one sentence per line."""
    sides = []
    for text in (predicted, expected):
        lines = [line.split() for line in text.split("\n")]
        if stem:
            lines = [[_stem(w) for w in line] for line in lines]
        sides.append([line for line in lines if line])
    a, b = ([w for line in side for w in line] for side in sides)
    return [f_score(lcs_length(a, b), len(a), len(b)) if kind == "rougeL" else summary_lcs(*sides) for kind in kinds]


def rouge_lcs(predicted: str | Column, expected: str | Column, kinds: tuple[str, ...] = SUBSEQUENCES, stem: bool = True) -> Column:
    """Struct of subsequence F-scores; a missing text scores 0."""

    @F.pandas_udf(", ".join(f"{k} double" for k in kinds))
    def score(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        rows = [score_pair(a or "", b or "", kinds, stem) for a, b in zip(left, right)]
        return pd.DataFrame(rows, columns=list(kinds))

    return score(clean(predicted), clean(expected))


def rouge(df: DataFrame, row: str, predicted: str, expected: str, kinds: tuple[str, ...] = KINDS, stem: bool = True) -> DataFrame:
    """``row`` and one F-score per kind; ``row`` has to name each row of a written table."""
    sizes = tuple(int(k.removeprefix("rouge")) for k in kinds if k not in SUBSEQUENCES)
    rest = tuple(k for k in kinds if k in SUBSEQUENCES)
    parts = [ngram_scores(df, row, predicted, expected, sizes, stem)] if sizes else []
    if rest:
        scored = df.select(row, rouge_lcs(predicted, expected, rest, stem).alias("_s"))
        parts.append(scored.select(row, *[F.col("_s")[k].alias(k) for k in rest]))
    return reduce(lambda a, b: a.join(b, row), parts).select(row, *kinds)


def rouge_means(kinds: tuple[str, ...] = KINDS) -> list[Column]:
    """Aggregates over score columns: mean over the rows, times 100, rounded to 4 digits."""
    return [F.round(F.avg(k) * 100, 4).alias(k) for k in kinds]
