"""Operators on small cases: nulls, empty and repeated rows, ties, clashing names, against plain counts."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from screenlake.llm import bpe, minhash, packing, pii, puscore, quality, rans, substring, tokens, vectors, warc
from screenlake.llm.common import default_tokenizer, rolled
from screenlake.llm.links import components

LONG = " ".join(f"w{i % 7919}" for i in range(60_000))
BASE = [f"alpha{i} beta{i * 7 % 13} gamma" for i in range(40)]
TEXTS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, " ".join(BASE)), (5, " ".join(BASE)), (5, " ".join(BASE)), (6, " ".join(BASE[:39])),
    (7, LONG), (None, " ".join(BASE)), (None, "only here é"), (8, "a  b\n\n<|endoftext|> don't"), (9, "mail me.x@a-b.co or +1 (555) 123-4567"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, tie int, task string"


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", "de", None, "xx"]
    return spark.createDataFrame([(i, t, langs[n % 4], None, None, "k", 0, "x") for n, (i, t) in enumerate(TEXTS)], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def as_rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


ODD = ["x,y;z <|endoftext|>, a|>b", "é,è. ×,÷. à\u00a0b,c\u3000,d", "1,2.3-4 don't,'s we'll.'re", "a" * 9 + "\n,b\n \n.", "a  b\n\n c", "<|endoftext|> x<|endoftext|>y ", "  ", "\n", "", " a", "é  b\t c's 're\x1c d", "x\r\ny z\n", "don't  stop 123abc", "Öé, ÿ!? À:. a.b", "×÷ a×", "﻿q ­ ß", "日本語 text 😀"]


@pytest.mark.parametrize("make", [tokens.library_encoder, bpe.index_encoder])
def test_cached_encoders_agree_with_the_library(make, library):
    texts = ODD + [t for _, t in TEXTS if t]
    for text, ids in zip(texts, make(default_tokenizer()).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_small_store_keeps_whole_ids(library):
    """Units that are thrown out and met again, and one that is larger than the store."""
    plain = lambda units: tokens.flat_ids([library.encode(u.as_py().decode(), add_special_tokens=False).ids for u in units])
    encoder = tokens.UnitEncoder(plain, limit=600)
    for text in ["a b c d", "x" * 500 + " a", "c d e f g h i", "", "a b c d " * 3, " " + LONG[:300], "q\nr s"]:
        ids = np.frombuffer(encoder.encode([text, None, text])[2], "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.units) < 200


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB é\n\t.,'s1<|>"), max_size=30), max_size=5))
def test_encoders_on_any_text(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_tokenizer())
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for make in (tokens.library_encoder, bpe.index_encoder):
        assert [np.frombuffer(x, "<u4").tolist() for x in make(default_tokenizer()).encode(texts)] == want


def test_bpe_digests(docs, library):
    path = default_tokenizer()
    got = as_rows(bpe.id_digests(bpe.decode(bpe.encode(docs, path), path), 50_257))
    assert as_rows(bpe.round_trip_digests(docs, path)) == got
    assert bpe.round_trip_digests(docs.limit(0), path).count() == bpe.encode(docs.limit(0), path).count() == 0
    want = collections.Counter()
    for key, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        want[key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()] += 1
    assert got == want


def test_packing_covers_every_id_once(docs, library):
    rows = packing.pack(docs, default_tokenizer(), capacity=64, rows_per_salt=3).collect()
    windows, kept = collections.defaultdict(list), collections.Counter()
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        kept[r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32] += 1
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    want = collections.Counter()
    for key, text in TEXTS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 64):
            part = ids[at : at + 64]
            want[key, at, len(part), len(ids), zlib.crc32(np.asarray(part, "<u4").tobytes())] += 1
    assert kept == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_plan_is_best_fit_decreasing(sizes):
    lines, windows = packing.plan(collections.Counter(sizes), 30)
    left = []
    for size in sorted(sizes, reverse=True):
        fits = [i for i, room in enumerate(left) if room >= size]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= size
        else:
            left.append(30 - size)
    assert windows == len(left)
    used = collections.Counter()
    for line in lines:
        for nth in range(line.count):
            used[line.window + nth // line.each] += line.size
    assert sorted(used.values()) == sorted(30 - room for room in left)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 99), max_size=700), st.integers(1, 9))
def test_coder_round_trip(ids, lanes):
    ids = np.asarray(ids, np.uint32)
    freq = rans.scaled(np.bincount(ids, minlength=100))
    assert freq.sum() == 1 << rans.SCALE and freq.min() >= 1
    coder = rans.Coder(freq, steps_per_checkpoint=8)
    block = rans.frame_block(coder, lanes, 0, 5, [1, None], [ids[:3], ids[3:]])
    (head, payload), = rans.frames(block)
    keys, lengths, read = rans.read_block(coder, head, payload)
    assert keys == [1, None] and lengths.tolist() == [len(ids[:3]), len(ids[3:])] and read.tolist() == ids.tolist()
    if len(ids) > 20:
        broken = bytearray(block)
        broken[-20] ^= 1
        with pytest.raises(ValueError):
            list(rans.frames(bytes(broken)))


def test_id_files(docs, library):
    rows = rans.round_trip(docs, default_tokenizer(), 50_257).collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids) for r in rows) == collections.Counter(
        (k, len(i), np.asarray(i, "<u4").tobytes()) for k, t in TEXTS for i in [[*library.encode(t or "", add_special_tokens=False).ids, 2]]
    )
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substrings_against_plain_windows(docs):
    got = as_rows(substring.remove_repeats(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), width=20, words_per_block=50).drop("x"))
    seen, want = {}, collections.Counter()
    for key, text in sorted({k: t for k, t in TEXTS if k is not None}.items()):
        own = words(text)
        gone = set()
        for i in range(len(own) - 19):
            window = tuple(own[i : i + 20])
            if window in seen:
                gone |= set(range(i, i + 20))
            seen.setdefault(window, key)
        want[key, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)] += 1
    assert got == want
    whole = substring.remove_repeats(docs).collect()
    assert len(whole) == len(TEXTS) and {r.n_removed for r in whole if r.doc_id is None} == {0, 120}


@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 20))
def test_rolled_hash_tells_windows_apart(values, width):
    found = rolled(np.asarray(values, np.uint64), width, 1)
    windows = [tuple(values[i : i + width]) for i in range(len(values) - width + 1)]
    assert len(found) == len(windows) and len(set(found.tolist())) == len(set(windows))


def test_near_duplicates(spark, docs):
    rows = minhash.near_duplicates(docs, node_limit=2, shingles_per_block=50).collect()
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows}
    assert len(rows) == len(TEXTS)
    assert got[1, 0] == (1, True) and got[2, 0] == (2, True) and got[3, 0] == (3, True)
    assert got[5, 116] == (4, False) and got[6, 113] == (4, False) and got[None, 116] == (4, False)
    assert got[None, 1] == (None, True) and got[7, 7919] == (7, True)
    assert sum(r.chosen for r in rows) == len({(r.component_id, r.n_shingles > 1, r.tie if r.n_shingles <= 1 else 0) for r in rows})
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_find_all_links(spark):
    rng = np.random.default_rng(5)
    texts = []
    for group in range(12):
        base = [f"g{group}w{i}" for i in range(200)]
        for _ in range(8):
            own = list(base)
            for i in rng.choice(200, int(rng.integers(0, 6)), replace=False):
                own[i] = f"x{rng.integers(10**9)}"
            texts.append(" ".join(own))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for limits in ({}, {"node_limit": 3, "shingles_per_block": 300}):
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, **limits).collect()}
        assert [got[i] for i in range(len(texts))] == root


def test_near_duplicates_at_a_low_percentage(spark):
    texts = []
    for pair in range(100):
        base = [f"p{pair}w{i}" for i in range(204)]
        texts += [" ".join(base), " ".join(base[:155] + [f"y{pair}w{i}" for i in range(49)])]  # 151 of 249 shingles are shared
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, percent=60, node_limit=2, depth=4).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


@pytest.mark.parametrize("similarity", [0.85, 0.8, 0.6])
def test_tree_count_against_simulation(similarity):
    rng = np.random.default_rng(4)
    apart, runs = 0, 4000
    for _ in range(runs):
        agree, alive = rng.binomial(minhash.PLACES, similarity), 1
        for _ in range(11):
            alive = int(rng.hypergeometric(agree, minhash.PLACES - agree, 2, size=min(alive, 30)).sum())
        apart += alive == 0
    trees = minhash.tree_count(similarity, 1e-6, 10)
    assert (apart / runs) ** trees <= 5e-6 and minhash.tree_count(similarity, 1e-12, 10) > trees


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 130)}


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    rows = [(i, (base[i % 40] + (i >= 40) * rng.normal(size=8) * 0.15).tolist(), 0) for i in range(300)]
    rows += [(300, rows[0][1], 0), (300, rows[0][1], 0), (301, None, 0), (302, [0.0] * 8, 0), (303, [float("nan")] * 8, 0), (304, [None] * 8, 0), (305, [], 0), (306, [1.0, 2.0], 0), (None, rows[1][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, key int")
    good = [i for i, r in enumerate(rows) if r[1] and len(r[1]) == 8 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = np.stack([np.asarray(rows[i][1], np.float32).astype(float) for i in good])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    root = np.arange(len(good))
    while True:
        new = np.minimum(root, np.where(near, root[None, :], len(good)).min(axis=1))
        if (new == root).all():
            break
        root = new
    want = collections.Counter()
    for n, i in enumerate(good):
        least = min(rows[good[m]][0] for m in range(len(good)) if root[m] == root[n] and rows[good[m]][0] is not None)
        want[rows[i][0], int(near[n].sum()), least, rows[i][0] == least] += 1
    for i in set(range(len(rows))) - set(good):
        want[rows[i][0], 0, rows[i][0], True] += 1
    assert as_rows(vectors.near_vectors(frame, vectors_per_cell=100)) == want
    blocked = as_rows(vectors.near_vectors(frame, vectors_per_cell=1000, block_rows=50))
    assert blocked == want
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def skewed_vectors(n, size=64):
    """A third of the rows near one vector, a third in groups of ten near each other, the others alone."""
    rng = np.random.default_rng(3)
    noise = lambda m: rng.normal(size=(m, size)) / np.sqrt(size)
    hot = noise(1) + 0.3 * noise(n // 3)
    groups = np.repeat(noise(n // 30), 10, axis=0)
    groups = groups + 0.3 * noise(len(groups))
    rows = np.concatenate([hot, groups, noise(n - len(hot) - len(groups))]).astype(np.float32)
    return rows[rng.permutation(n)]


def test_vectors_in_many_cells(spark):
    rows = skewed_vectors(1500)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    frame = spark.createDataFrame(list(enumerate(rows.tolist())), "vec_id long, embedding array<float>")
    for limits in ({"vectors_per_cell": 20, "block_rows": 100}, {"vectors_per_cell": 20}, {"vectors_per_cell": 200, "block_rows": 64}):
        got = {r.vec_id: r.n_links for r in vectors.near_vectors(frame, **limits).collect()}
        assert [got[i] for i in range(len(rows))] == want.tolist()


def test_vectors_recall_with_default_cells(spark):
    """All rows as queries against all rows, in 40 cells."""
    rows = skewed_vectors(20_000)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    want = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.9).sum(axis=1) - 1 for i in range(0, len(unit), 1000)])
    frame = spark.createDataFrame(list(enumerate(rows.tolist())), "vec_id long, embedding array<float>").repartition(8)
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(frame).collect()}
    assert [got[i] for i in range(len(rows))] == want.tolist()


def test_vectors_of_many_sizes(spark):
    rows = [(2 * size + i, [1.0 + i] + [1.0] * size) for size in range(20, 1120) for i in range(2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame).collect()}
    assert got == {i: (1, i - i % 2) for i, _ in rows}
    mixed = spark.createDataFrame([r for r in rows if r[0] < 60] + [(10_000 + i, [1.0, float(i)]) for i in range(300)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(mixed, vectors_per_cell=50, block_rows=40).collect()}
    unit = np.asarray([[1.0, i] for i in range(300)])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    assert got == {i: 1 for i in range(40, 60)} | dict(enumerate(((unit @ unit.T >= 0.9).sum(axis=1) - 1).tolist(), 10_000))


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab1234567890.@_-+() é"))
def test_spans_against_plain_rules(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_disclosing_terms_go(spark):
    rows = [(i, f"note {i} zorgon{i % 7} quux writes to big.boss@corp.example now, item {i * 31}", "x") for i in range(12)]
    rows += [(100 + i, f"plain text number {i} with common words now", "x") for i in range(60)] + [(200, "quux was here", "x"), (None, None, "x"), (201, "4111 1111 1111 1111", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = {r.doc_id: r for r in pii.sanitise(frame).collect()}
    assert got[200].text == " was here" and got[200].base == "" and got[200].spans == "remove:0:4"
    assert "[EMAIL]" in got[3].text and "quux" not in got[3].text and got[3].n_email == 1 and " to [EMAIL]" in got[3].text
    assert got[105].text == rows[17][1] and got[105].spans == ""
    assert got[None].text == "" and got[201].text == "[CARD]"
    assert pii.sanitise(frame.limit(0)).count() == 0
    again = frame.unionByName(frame).selectExpr("doc_id", "text", "key", "1 AS term", "2 AS name", "3 AS carry")
    assert pii.sanitise(again, carry=("key",)).count() == 2 * len(rows)


def plain_disclosures(texts, prior, most_bits, least_gain, context):
    spans = [pii.base_spans(t or "") for t in texts]
    free = [[(t or "")[s:e].lower() for s, e in pii.free_terms(t or "", sp)] for t, sp in zip(texts, spans)]
    whole = [{w.lower() for w in pii.TERM.findall(t or "")} for t in texts]
    entities = collections.defaultdict(dict)
    for i, (text, own) in enumerate(zip(texts, spans)):
        for span in own:
            starts = [s for s, _ in pii.free_terms(text, own)]
            at = sum(s < span[1] for s in starts)
            entities[pii.entity(text, span)].setdefault(i, tuple(free[i][max(0, at - context) : at + context]))
    function_words = {w for words in quality.COMMON.values() for w in words}
    for name, where in entities.items():
        share = len(where) / len(texts)
        for term in {t for i in where for t in free[i]} - function_words:
            both = [i for i in where if term in free[i]]
            n = sum(term in words for words in whole)
            hidden = -np.log2((len(both) + prior * share) / (n + prior))
            gained = -np.log2(share) - hidden
            if len({where[i] for i in both}) > 1 and hidden <= most_bits and gained >= least_gain:
                yield name, term, len(both), len(where), n, round(hidden, 9), round(gained, 9)


@pytest.mark.parametrize("most_bits,least_gain", [(1.2, 2.0), (0.5, 0.0), (30.0, -30.0)])
def test_all_disclosures_against_plain_counts(spark, most_bits, least_gain):
    """Terms far from the mention count like near ones; an address of two documents is judged; copies are one witness."""
    rng = np.random.default_rng(5)
    far = " ".join(f"pad{i}" for i in range(30))
    texts = [f"n{i} mail lone.wolf@corp.example about wolfram {rng.integers(9)}" for i in range(2)]
    texts += [f"n{i} call +1 555 010 0199, case{i} then to {far} zorgfar" for i in range(6)]
    texts += ["same words beside copy@corp.example each time rarest"] * 9
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 60, 20)) + (" who@corp.example" if i % 9 == 0 else "") for i in range(70)] + [None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    found = pii.disclosures(frame.selectExpr("coalesce(text, '') AS text"), 2.0, most_bits, least_gain, 8).collect()
    got = {(*r[:5], round(r.hidden_bits, 9), round(r.gained_bits, 9)) for r in found}
    assert got == set(plain_disclosures(texts, 2.0, most_bits, least_gain, 8)) and len(found) == len(got)
    terms = {r.term for r in found}
    assert ("zorgfar" in terms) and "rarest" not in terms and ("wolfram" in terms) == (most_bits > 1)


def test_archives(spark, tmp_path):
    big = "é\r\n\r\nWARC/1.1\r\n" * 20_000
    rows = [(1, "u", big), (2, None, big), (1, "u", big), (3, "x", None), (4, "x", ""), (None, "x", big), (5, "a b\r\nX: y", "short"), (6, "z", "short")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("url", "uri").selectExpr("*", "uri AS digest")
    warc.write_archives(frame, f"{tmp_path}/w", uri="uri", segment_bytes=50_000, chunk_bytes=999)
    got = collections.Counter((r.key, r.record_type, r.refers_to, r.payload_bytes, r.payload and r.payload.decode()) for r in warc.read_archives(spark, f"{tmp_path}/w").collect())
    size = len(big.encode())
    assert got == collections.Counter(
        [(1, "response", None, size, big)] * 2
        + [(2, "revisit", 1, size, None), (None, "revisit", 1, size, None), (3, "response", None, 0, b""), (4, "response", None, 0, b"")]
        + [(5, "response", None, 5, "short"), (6, "response", None, 5, "short")]
    )


def test_chunked_framing():
    assert warc.unchunked(warc.chunked(b"abc" * 100, 7)) == b"abc" * 100 and warc.unchunked(b"0\r\n\r\n") == b""
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")


def test_quality_rules(docs):
    rows = quality.judge(docs).collect()
    assert len(rows) == len(TEXTS)
    for r, text in ((r, t) for r in rows for k, t in TEXTS if k == r.doc_id and k not in (5, None)):
        own = words(text)
        windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
        count = collections.Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        want = (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(own) < 50 or 100 * len(covered) > 50 * len(own)) and (not r.base_failed or not r.kept)


def test_js_distance_against_numpy(spark):
    rows = [([3, 0, 5], [0.2, 0.3, 0.5]), ([0, 0, 0], [0.2, 0.3, 0.5]), ([1, 1, 1], [1 / 3] * 3), ([9, 0, 0], [0.0, 0.0, 1.0])]
    frame = spark.createDataFrame(rows, "c array<long>, q array<double>")
    got = [r.d for r in frame.select(quality.js_distance(frame["c"], frame["q"]).alias("d")).collect()]

    def distance(c, q):
        p, q = np.asarray(c) / sum(c), np.asarray(q)
        m = (p + q) / 2
        part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
        return np.sqrt(max(0.0, (part(p) + part(q)) / 2))

    assert got == pytest.approx([distance(*rows[0]), 0.0, 0.0, 1.0], abs=1e-9)


def test_quality_scores_on_held_out_rows(spark):
    rng = np.random.default_rng(2)
    good = lambda: " ".join("".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 8)))) for _ in range(80)) + "."
    texts = [(i, good() if i % 5 else " ".join(w.upper() + "!!" for w in good().split())) for i in range(600)]
    frame = spark.createDataFrame([*texts, (None, None), (601, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(0, 600, 2)] + [(0, None), (None, 1)], "doc_id long, quality int")
    rows = puscore.quality_scores(frame, labels).collect()
    assert len(rows) == 602 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 600]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.predicted == (r.doc_id % 5 > 0) for r in held]) > 0.97
    none = puscore.quality_scores(frame, labels.where("quality = 7")).collect()
    assert {r.score for r in none} == {0.5}
