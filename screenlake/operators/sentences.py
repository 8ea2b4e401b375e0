"""Sentence ends that know the corpus's abbreviations.

A period after an abbreviation does not end a sentence. Which words are abbreviations is learned from the corpus by
the log-likelihood test of Kiss and Strunk (2006): a word that nearly always has a period behind it, is short, may
have periods inside, and seldom stands without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.functions import text as tx
from screenlake.session import materialize

#: The chance of a period behind an abbreviation, and the score from which a word counts as one.
CERTAIN, THRESHOLD = 0.99, 0.3
#: Up to so many abbreviations are looked up in the expression that cuts the text; more are joined.
LISTED = 5_000


def word_type(token: Column) -> Column:
    """Lower case, without marks in front and without a period at the end."""
    bare = F.regexp_replace(F.lower(token), r"^[^\p{L}\p{N}]+", "")
    return F.when(bare.endswith("."), F.substring(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare)


def abbreviation_scores(df: DataFrame, text: str = "text") -> DataFrame:
    """``word, with_period, without_period, score`` of every word that begins with a letter and has a period behind it somewhere.

    Counts are combined before they are shuffled; what is kept per word is two numbers. Missing texts have no words.
    """
    tokens = df.select(F.explode(tx.words(text)).alias("token"))
    typed = tokens.select(word_type(F.col("token")).alias("word"), F.col("token").endswith(".").alias("period"))
    counted = materialize(
        typed.groupBy("word").agg(F.count_if("period").alias("with_period"), F.count_if(~F.col("period")).alias("without_period")), "word_counts"
    )
    whole = counted.agg(F.struct(F.sum("with_period").alias("b"), F.sum(F.col("with_period") + F.col("without_period")).alias("n"))).scalar()
    share = whole["b"] / whole["n"]
    a, b = F.col("with_period").cast("double"), F.col("without_period").cast("double")
    # A corpus in which every word has a period says nothing: the test needs a chance below one.
    ratio = -2 * (a * F.log(share / CERTAIN) + b * F.log((1 - share) / (1 - CERTAIN)))
    inner = F.length(F.replace(F.col("word"), F.lit("."), F.lit("")))
    periods = F.length("word") - inner + 1
    score = ratio * F.exp(-inner) * periods * F.pow(inner.cast("double"), -b)
    found = counted.filter((F.col("with_period") > 0) & F.col("word").rlike(r"^\p{L}"))
    return found.select("word", "with_period", "without_period", F.when(share < 1, score).otherwise(0.0).alias("score"))


def learn_abbreviations(df: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``word`` of every word that scores ``threshold`` or more, written."""
    return materialize(abbreviation_scores(df, text).filter(F.col("score") >= threshold).select("word"), "abbreviations")


def pieces(text: Column) -> Column:
    """Text cut behind every ``.``, ``!`` or ``?`` that has white space after it; the white space stays with its piece."""
    return F.regexp_extract_all(text, F.lit(r"(?s)(.*?[.!?]\s+|.+$)"), F.lit(1))


def last_word(piece: Column) -> Column:
    """Type of the word that ends a piece with a period; null for other ends."""
    token = F.element_at(F.split(F.rtrim(F.regexp_replace(piece, r"\s", " ")), " "), -1)
    return F.when(token.endswith("."), word_type(token))


def _line(piece: Column, kept: Column) -> Column:
    """A piece whose white space stays, or becomes the line break that ends a sentence."""
    return F.when(kept | ~piece.rlike(r"[.!?]\s+$"), piece).otherwise(F.concat(F.regexp_replace(piece, r"([.!?])\s+$", "$1"), F.lit("\n")))


def sentence_lines(df: DataFrame, abbreviations: DataFrame, text: str = "text", out: str | None = None, listed: int = LISTED) -> DataFrame:
    """``text`` (as ``out``) with one sentence per line: a sentence ends at ``.``, ``!`` or ``?`` before white space, but not at the period of an abbreviation.

    ``abbreviations`` has a column ``word``. Up to ``listed`` of them go into the expression, and rows are cut where
    they are; beyond that the pieces are joined with the table by their last word and put together again by row.
    Missing texts stay missing.
    """
    out = out or text
    words = [r.word for r in abbreviations.select("word").distinct().limit(listed + 1).collect()]
    if len(words) <= listed:
        known = lambda piece: F.coalesce(last_word(piece).isin(words), F.lit(False)) if words else F.lit(False)
        lines = F.concat_ws("", F.transform(pieces(F.col(text)), lambda p: _line(p, known(p))))
        return df.withColumn(out, F.when(F.col(text).isNotNull(), lines))
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "sentences")
    cut = numbered.select("_row", F.posexplode(pieces(F.col(text))).alias("_at", "_piece")).withColumn("_word", last_word(F.col("_piece")))
    marked = cut.join(materialize(abbreviations.select(F.col("word").alias("_word"), F.lit(True).alias("_known")).distinct(), "lookup"), "_word", "left")
    line = F.struct("_at", _line(F.col("_piece"), F.coalesce("_known", F.lit(False))).alias("line"))
    joined = marked.groupBy("_row").agg(F.sort_array(F.collect_list(line)).alias("_lines"))
    whole = numbered.join(joined, "_row", "left")
    value = F.when(F.col(text).isNotNull(), F.concat_ws("", F.coalesce(F.col("_lines.line"), F.array().cast("array<string>"))))
    return whole.withColumn(out, value).select(*df.columns, *([out] if out not in df.columns else []))
