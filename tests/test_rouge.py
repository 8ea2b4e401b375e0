import random
import re
from collections import Counter
from functools import lru_cache

import pytest

from screenlake.functions.rouge import f_score, lcs_length, rouge, rouge_means, score_pair, summary_lcs
from screenlake.functions.stemmer import stem


def slow_lcs(a, b):
    @lru_cache(None)
    def best(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + best(i + 1, j + 1) if a[i] == b[j] else max(best(i + 1, j), best(i, j + 1))

    return best(0, 0)


@pytest.mark.parametrize("seed", range(30))
def test_lcs_against_recursion(seed):
    pick = random.Random(seed)
    a, b = ([pick.choice("abcd") for _ in range(pick.randrange(25))] for _ in range(2))
    assert lcs_length(a, b) == slow_lcs(tuple(a), tuple(b))
    if a and b:
        expected = slow_lcs(tuple(a), tuple(b))
        want = 2 * expected / (len(a) + len(b))
        assert summary_lcs([a], [b]) == pytest.approx(want)  # one sentence each: the union is one match


def test_union_of_sentences():
    # Published example: sentence w1..w5 against "w1 w2 w6 w7 w8" and "w1 w3 w8 w9 w5" matches 4 of 5 words.
    expected = [["w1", "w2", "w3", "w4", "w5"]]
    predicted = [["w1", "w2", "w6", "w7", "w8"], ["w1", "w3", "w8", "w9", "w5"]]
    precision, recall = 4 / 10, 4 / 5
    assert summary_lcs(predicted, expected) == pytest.approx(2 * precision * recall / (precision + recall))


def plain_ngrams(a, b, n):
    left, right = (Counter(zip(*[side[i:] for i in range(n)])) for side in (a, b))
    return f_score(sum((left & right).values()), sum(left.values()), sum(right.values()))


@pytest.mark.parametrize("stemmed", [True, False])
def test_all_scores_against_plain_counts(spark, stemmed):
    pick = random.Random(4)
    words = "cats cat running runs the The größe 12 a-b plays".split()
    rows = [(i, *[" ".join(pick.choice(words) + pick.choice(["", ".", "\n", "!  "]) for _ in range(pick.randrange(14))) for _ in range(2)]) for i in range(60)]
    rows += [(60, None, "cat"), (61, "", ""), (62, None, None), (63, "one", "one two")]
    got = {r.id: r for r in rouge(spark.createDataFrame(rows, "id long, p string, y string").repartition(3), "id", "p", "y", stem=stemmed).collect()}
    assert len(got) == len(rows)
    for i, p, y in rows:
        cleaned = [re.sub(r"[^\w\n]+|_", " ", (t or "").lower()) for t in (p, y)]
        sides = [[stem(w) if stemmed else w for w in t.split()] for t in cleaned]
        want = [plain_ngrams(*sides, n) for n in (1, 2)] + score_pair(*cleaned, ("rougeL", "rougeLsum"), stemmed)
        assert list(got[i])[1:] == pytest.approx(want)


def test_identical_texts_score_one():
    assert score_pair("a b c\nd e", "a b c\nd e", ("rougeL", "rougeLsum"), True) == [1.0] * 2


# Word and stem pairs as printed in Porter (1980).
PUBLISHED = {
    "caresses": "caress", "ponies": "poni", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss",
    "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "relational": "relat",
    "conditional": "condit", "vietnamization": "vietnam", "hopefulness": "hope", "triplicate": "triplic",
    "formalize": "formal", "electrical": "electr", "revival": "reviv", "allowance": "allow", "adjustment": "adjust",
    "adoption": "adopt", "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "generalizations": "gener", "oscillators": "oscil",
}


@pytest.mark.parametrize("word", PUBLISHED)
def test_published_stems(word):
    assert stem(word) == PUBLISHED[word]


def test_short_words_stay():
    assert [stem(w) for w in ("as", "bus", "yes", "sky")] == ["as", "bus", "yes", "sky"]


def test_scores_in_spark(spark):
    rows = [(0, "The cats sat.", "the cat sat"), (1, "Größe ist 5", "grösse ist 5"), (2, None, "x"), (3, "", "")]
    df = spark.createDataFrame(rows, "id long, p string, y string")
    got = {r.id: r for r in rouge(df, "id", "p", "y").collect()}
    assert got[0].rouge1 == 1.0 and got[0].rougeL == 1.0
    assert got[1].rouge1 == pytest.approx(2 / 3)
    assert got[2].rouge1 == 0.0 and got[3].rougeLsum == 0.0
    unstemmed = rouge(df, "id", "p", "y", ("rouge1",), stem=False)
    assert unstemmed.agg(*rouge_means(("rouge1",))).first()[0] == pytest.approx(100 * (2 / 3 + 2 / 3) / 4, abs=1e-4)


def test_ngrams_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(0, "a b", "a")], "id long, p string, y string")
    plan = rouge(df, "id", "p", "y", ("rouge1", "rouge2"), stem=False)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
