"""Quality rules: base rules and divergence from language references, in DataFrame functions only.

Each text is described by histograms of character classes and of the common words of its language. The reference
of a language is the mean histogram of all its documents. A text fails if the Jensen-Shannon distance of either
histogram to the reference is above its limit; texts too short for a stable histogram are not judged by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import written

#: Frequent function words by language (fixed values).
COMMON = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein".split(),
    "en": "the of and to in a is that it was for on are with as be at this".split(),
    "es": "de la que el en y a los se del las un por con no una su para".split(),
    "fr": "de la le et les des en un du une que est pour qui dans au sur par".split(),
}
OTHER = "other"
BINS = max(map(len, COMMON.values())) + 1
SPACE = r"[\x20\x09-\x0D]+"
#: Character classes in the order in which they are taken out of a text; what is left is the last class.
CLASSES = (r"[a-z]+", SPACE, r"[A-Z]+", r"[^\x00-\x7F]+", r"[0-9]+", r"[#*$%&|<>]+")


def repeated_words(words: Column, n: int = 3) -> Column:
    """Number of words in ``n``-word windows that the text holds at least twice.

    Windows are sorted by a 64-bit hash, so that equal ones are neighbours.
    """
    keyed = F.transform(
        F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(n)]).alias("k"), i.alias("i")),
    )
    return F.sort_array(keyed)


def profile(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carry, lang, n_chars, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, chars, commons) per row."""
    known = F.col(lang).isin(*COMMON)
    frame = docs.select(
        F.col(key).alias("key"),
        F.struct(F.lit(0), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]).alias("carry"),
        F.when(known, F.col(lang)).otherwise(OTHER).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    frame = frame.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    frame = frame.select(
        "key", "carry", "lang", "words", F.col("text").alias("left0"), F.length("text").cast("long").alias("n_chars"),
        F.size("words").cast("long").alias("n_words"), lines.alias("lines"), repeated_words(F.col("words")).alias("windows"),
    )
    for i, rule in enumerate(CLASSES):
        frame = frame.withColumn(f"left{i + 1}", F.regexp_replace(f"left{i}", rule, ""))
    sizes = [F.length(f"left{i}") for i in range(len(CLASSES) + 1)]
    chars = F.array(*[(a - b).cast("long") for a, b in zip(sizes, sizes[1:])], sizes[-1].cast("long"))
    pick = lambda own: F.filter("words", lambda w: F.lower(w).isin(*own))
    found = {name: pick(own) for name, own in COMMON.items()}
    common = reduce(lambda rest, name: F.when(F.col("lang") == name, found[name]).otherwise(rest), found, F.array().cast("array<string>"))
    again = F.filter(
        "windows",
        lambda x, j: (F.get(F.col("windows"), j - 1)["k"] == x["k"]) | (F.get(F.col("windows"), j + 1)["k"] == x["k"]),
    )
    return frame.select(
        "key", "carry", "lang", "n_chars", "n_words", (sizes[0] - (sizes[1] - sizes[2])).cast("long").alias("word_chars"), chars.alias("chars"),
        (sizes[5] - sizes[6]).cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        common.alias("common"), again["i"].alias("again"),
    ).select(
        "key", "carry", "lang", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.size(F.array_distinct(F.flatten(F.transform("again", lambda i: F.array(i, i + 1, i + 2))))).cast("long").alias("n_repeat_words"),
        "chars", _histogram(F.transform("common", F.lower), F.col("lang"), F.col("n_words")).alias("commons"),
    )


def _histogram(common: Column, lang: Column, n_words: Column) -> Column:
    """Counts of the language's common words in list order, zero-filled, then of all other words."""
    word = lambda i: reduce(lambda rest, name: F.when(lang == name, F.lit(COMMON[name][i])).otherwise(rest), COMMON, F.lit("\n"))
    counts = [F.size(common) - F.size(F.array_remove(common, word(i))) for i in range(BINS - 1)]
    return F.array(*[c.cast("long") for c in counts], n_words - F.size(common))


def references(profiles: DataFrame) -> DataFrame:
    """Mean share per class and per common word of each language; at most one row per listed language and one more."""
    share = lambda name, total, i: F.coalesce(F.avg(F.when(F.col(total) > 0, F.col(name)[i] / F.col(total))), F.lit(0.0))
    return profiles.groupBy("lang").agg(
        F.array(*[share("chars", "n_chars", i) for i in range(len(CLASSES) + 1)]).alias("char_reference"),
        F.array(*[share("commons", "n_words", i) for i in range(BINS)]).alias("word_reference"),
    )


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram of counts to one of shares; 0 if either is empty."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    log2 = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def term(count: Column, q: Column) -> Column:
        p = count / total
        m = (p + q) / 2
        return (log2(p, m) + log2(q, m)) / 2

    divergence = F.aggregate(F.zip_with(counts, reference, term), F.lit(0.0), lambda a, x: a + x)
    empty = (total == 0) | ~F.exists(reference, lambda q: q > 0)
    return F.when(empty, 0.0).otherwise(F.sqrt(F.greatest(divergence, F.lit(0.0))))


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", min_words: int = 50, max_repeat: int = 50,
    char_limit: float = 0.3, word_limit: float = 0.3, min_chars: int = 300, min_common_words: int = 80,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Adds the verdict to every row: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    char_distance, word_distance, base_failed, kept, and the columns to ``carry``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat`` percent of them in repeated
    3-word windows. Otherwise a row is kept unless the character distance is above ``char_limit`` (texts of at
    least ``min_chars`` characters) or the word distance above ``word_limit`` (at least ``min_common_words``
    words). Null and empty texts have no words and fail; an unknown or null language is compared with the mean
    of all such texts, without words. Repeated rows are judged each; null keys stay null; an empty table gives
    no rows; other columns are not read.
    """
    profiles = written(profile(docs, key, text, lang, carry), "profiles")
    frame = profiles.join(F.broadcast(references(profiles)), "lang")
    frame = frame.withColumn("char_distance", js_distance(F.col("chars"), F.col("char_reference")))
    frame = frame.withColumn("word_distance", js_distance(F.col("commons"), F.col("word_reference")))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    odd_chars = (F.col("n_chars") >= min_chars) & (F.col("char_distance") > char_limit)
    odd_words = (F.col("n_words") >= min_common_words) & (F.col("word_distance") > word_limit)
    return frame.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance",
        failed.alias("base_failed"), (~failed & ~odd_chars & ~odd_words).alias("kept"),
        *[F.col(f"carry.c{i}").alias(c) for i, c in enumerate(carry)],
    )
