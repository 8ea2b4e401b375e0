import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from screenlake.operators import sentences

TEXTS = [
    "Dr. Smith met Mr. Jones. They spoke of e.g. rain! Did it? Yes.",
    "The doctor saw Dr. Brown. Mr. White left. It rained and rained.",
    "Rain fell. The rain fell on Dr. Green and Mr. Black e.g. often.\nThe end.",
    "We met Dr. Gray.  Then Mr. Blue came e.g. late.", None, "", "no mark at all", "... !", "(Dr. X) said.", "end.",
] + [f"The day was long and the road was far so day {i} came. The rain fell again" for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)


def plain_type(token):
    bare = re.sub(r"^[^\w]+|^_+", "", token.lower())
    return bare[:-1] if bare.endswith(".") else bare


def plain_scores():
    tokens = [t for text in TEXTS for t in (text or "").split()]
    a, b = Counter(), Counter()
    for token in tokens:
        (a if token.endswith(".") else b)[plain_type(token)] += 1
    p = sum(a.values()) / len(tokens)
    out = {}
    for word in a:
        if word[:1].isalpha():
            length = len(word.replace(".", ""))
            ratio = -2 * (a[word] * math.log(p / 0.99) + b[word] * math.log((1 - p) / 0.01))
            out[word] = (a[word], b[word], ratio * math.exp(-length) * (1 + word.count(".")) * length ** -b[word])
    return out


def test_scores_against_plain_counts(docs):
    got = {r.word: (r.with_period, r.without_period, r.score) for r in sentences.abbreviation_scores(docs).collect()}
    want = plain_scores()
    assert set(got) == set(want)
    for word, (with_period, without, score) in want.items():
        assert got[word][:2] == (with_period, without) and got[word][2] == pytest.approx(score)


def test_learned_words(docs):
    learned = {r.word for r in sentences.learn_abbreviations(docs).collect()}
    assert {"dr", "mr", "e.g"} <= learned and not learned & {"jones", "rain", "fell", "rained", "yes"}


@pytest.mark.parametrize("listed", [5000, 0])
def test_lines_keep_abbreviations_whole(docs, spark, listed):
    known = spark.createDataFrame([("dr",), ("mr",), ("e.g",), ("dr",)], "word string")
    got = {r.id: r.text for r in sentences.sentence_lines(docs, known, listed=listed).collect()}
    assert len(got) == len(TEXTS)
    assert got[0] == "Dr. Smith met Mr. Jones.\nThey spoke of e.g. rain!\nDid it?\nYes."
    assert got[2] == "Rain fell.\nThe rain fell on Dr. Green and Mr. Black e.g. often.\nThe end."
    assert got[3] == "We met Dr. Gray.\nThen Mr. Blue came e.g. late."
    assert got[4] is None and got[5] == "" and got[6] == "no mark at all" and got[8] == "(Dr. X) said." and got[9] == "end."
    other = sentences.sentence_lines(docs, known, out="lines", listed=listed)
    assert other.columns == ["id", "text", "lines"] and {r.id: r.lines for r in other.collect()} == got


def test_without_abbreviations_like_the_plain_rule(docs, spark):
    from screenlake.functions.text import sentence_lines

    none = spark.createDataFrame([], "word string")
    both = sentences.sentence_lines(docs, none, out="lines").withColumn("plain", sentence_lines("text"))
    assert both.filter("NOT lines <=> plain").count() == 0
    assert sentences.abbreviation_scores(docs.limit(0)).count() == 0
    only = spark.createDataFrame([("a. b.",)], "text string")
    assert sentences.abbreviation_scores(only).filter("score <> 0").count() == 0


def test_a_very_long_text(spark):
    long = spark.range(1).select(F.repeat(F.lit("Dr. X came here. "), 60_000).alias("text"))
    known = spark.createDataFrame([("dr",)], "word string")
    lines = sentences.sentence_lines(long, known).select(F.size(F.split("text", "\n")).alias("n")).first().n
    assert lines == 60_001
