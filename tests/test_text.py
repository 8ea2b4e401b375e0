import pytest
from pyspark.sql import functions as F

from screenlake.functions import text as tx
from screenlake.functions.arrays import elu, log_softmax, redact_suffix
from screenlake.operators import encoding


def one(spark, column, *values, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(column).collect()]


def test_strip_like_python(spark):
    values = [" a ", "\t\na b\x0b\x0c", " x ", "\x1fy\x85", "　", "", "a"]
    assert one(spark, tx.strip("x"), *values) == [v.strip() for v in values]
    every = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
    assert sorted(tx.WHITESPACE) == sorted(every)


def test_file_root(spark):
    assert one(spark, tx.file_root("x"), "ab_c.x.json", "ab.c_d", "plain", None) == ["ab", "ab", "plain", None]


def test_parent_dir(spark):
    assert one(spark, tx.parent_dir("x"), "x/y/z", "z", "a/b", None) == ["y", None, "a", None]


def test_sentence_lines(spark):
    assert one(spark, tx.sentence_lines("x"), "One. Two!  Three? four", "a.b", "") == ["One.\nTwo!\nThree?\nfour", "a.b", ""]


def test_token_count(spark):
    assert one(spark, tx.token_count("x"), "a b  c", "", "  ", None) == [3, 0, 0, None]
    assert one(spark, tx.token_count("x", end_marker=True), "a b") == [3]


def test_prefix_and_text_form(spark):
    assert one(spark, tx.with_prefix("x", "p: "), "a", None) == ["p: a", None]
    assert one(spark, tx.with_prefix("x", None), "a") == ["a"]
    assert one(spark, tx.as_text("x"), None, 3, schema="x int") == ["nan", "3"]


def test_redact_suffix(spark):
    df = spark.createDataFrame([({"hub_token": "secret", "name": "n", "token": "t"},)], "m map<string,string>")
    assert df.select(redact_suffix("m")).first()[0] == {"hub_token": "<HUB_TOKEN>", "name": "n", "token": "t"}


def test_activations(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, -1.0],)], "a array<double>")
    soft = df.select(log_softmax("a")).first()[0]
    assert soft[0] == pytest.approx(-0.6931471805599453) and soft[2] == pytest.approx(-1001.6931471805599)
    assert df.select(elu("a")).first()[0] == pytest.approx([1000, 1000, -0.6321205588285577])


def test_first_words(spark):
    texts = ["  a b  c d ", "a", "", " a b", "a b", "a b c"]
    assert one(spark, tx.words("x", 2), *texts) == [t.split()[:2] for t in texts]
    assert one(spark, tx.words("x"), *texts) == [t.split() for t in texts]


@pytest.fixture
def vocab(spark):
    return encoding.vocabulary(spark.createDataFrame([("c b a",), ("a d",)], "t string"), "t")


def test_vocabulary(vocab):
    got = {r.token: (r.id, r.special) for r in vocab.collect()}
    assert got == {"<pad>": (0, True), "</s>": (1, True), "<unk>": (2, True),
                   "a": (3, False), "b": (4, False), "c": (5, False), "d": (6, False)}


def coded(spark, vocab, texts, length, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    return encoding.encode(df, "k", {"x": ("t", length)}, vocab, **options).orderBy("k")


def test_encode_pads_cuts_and_marks(spark, vocab):
    got = coded(spark, vocab, ["c d", "c d a b b", "", None, " zz  a "], 4).collect()
    assert [r.x_ids for r in got] == [[5, 6, 0, 0], [5, 6, 3, 4], [0] * 4, [0] * 4, [2, 3, 0, 0]]
    assert [r.x_mask for r in got] == [[1, 1, 0, 0], [1] * 4, [0] * 4, [0] * 4, [1, 1, 0, 0]]


def test_end_marker_takes_the_last_place(spark, vocab):
    got = coded(spark, vocab, ["c", "a b c d"], 3, end_marker=True).collect()
    assert [r.x_ids for r in got] == [[5, 1, 0], [3, 4, 1]]
    assert [r.x_mask for r in got] == [[1, 1, 0], [1, 1, 1]]


def test_decode_gives_the_cut_text(spark, vocab):
    rows = coded(spark, vocab, ["c d", "c d a b b", "", "a zz b"], 4)
    got = [r.text for r in encoding.decode(rows, "k", "x_ids", vocab).orderBy("k").collect()]
    assert got == ["c d", "c d a b", "", "a b"]


def test_shift_right(spark):
    df = spark.createDataFrame([([5, 6, 1, 0],)], "a array<int>")
    assert df.select(encoding.shift_right("a", 0)).first()[0] == [0, 5, 6, 1]


def test_encode_pairs(spark, vocab):
    df = spark.createDataFrame([(1, "a", "b c")], "k int, text string, summary string")
    got = encoding.encode_pairs(df, "k", vocab, 3, 4, prefix="d ").first()
    assert got.asDict() == {
        "k": 1, "input_ids": [6, 3, 0], "attention_mask": [1, 1, 0], "labels": [4, 5, 0, 0],
        "decoder_input_ids": [0, 4, 5, 0], "decoder_attention_mask": [1, 1, 0, 0],
    }


def test_hot_word(spark, vocab):
    """A third of all tokens are the same word."""
    df = spark.range(300).select(F.col("id").alias("k"), F.lit("a a b d c a").alias("t"))
    got = encoding.encode(df.repartition(5), "k", {"x": ("t", 6)}, vocab)
    assert got.filter("x_ids <> array(3, 3, 4, 6, 5, 3)").count() == 0 and got.count() == 300


def test_encode_looks_each_distinct_token_of_a_chunk_up_once(spark, monkeypatch):
    rows = [(1, "a b a", "b"), (2, None, ""), (None, "c zz", "a"), (1, "b c d", "a a"), (3, "  a  a a a a a a", None), (4, "", "q")]
    df = spark.createDataFrame(rows, "k long, text string, other string")
    vocab = encoding.vocabulary(spark.createDataFrame([("d c b a",)], "text string"), "text")
    a, b, c, d, unk = 3, 4, 5, 6, 2
    # rows with one key are one, their tokens in the order of their places and ids
    want = {1: ([a, b, b, c, a, d], [a, b, a]), 2: ([], []), None: ([c, unk], [a]), 3: ([a] * 7, []), 4: ([], [unk])}
    for most in (2_000_000, 3):
        monkeypatch.setattr(encoding, "CHUNK_TOKENS", most)
        got = encoding.encode(df.coalesce(1), "k", {"x": ("text", None), "y": ("other", None)}, vocab)
        assert {r.k: (r.x_ids, r.y_ids) for r in got.collect()} == want
        cut = encoding.encode(df.coalesce(1), "k", {"x": ("text", 3)}, vocab, end_marker=True).filter("k = 3").first()
        assert cut.x_ids == [a, a, 1] and cut.x_mask == [1, 1, 1]
    many = spark.range(100).select("id", F.lit("a b b zz " * 20).alias("text")).coalesce(1)
    monkeypatch.setattr(encoding, "CHUNK_TOKENS", 2_000_000)
    coded = encoding._coded(many, "id", [F.split("text", " ")])
    assert coded.select(F.explode("_tokens")).count() == 4  # of 8,100 tokens
    assert encoding.encode(many.limit(0), "id", {"x": ("text", 5)}, vocab).count() == 0
