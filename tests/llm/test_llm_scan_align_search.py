"""Licence scans, tokenizer alignment and ranked search against plain counts, on awkward rows."""

import collections
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from screenlake.llm import align, licences, search
from screenlake.llm.common import default_pieces, default_tokenizer
from screenlake.llm.terms import coded_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = " ".join(f"w{i % 7919} of the" for i in range(30_000)) + " All rights reserved, CC-BY ."
MIT = licences.TEMPLATES[14][1]
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "Released under the MIT Licence. Released under the MIT License."), (4, "Released under the MIT License."),
    (4, "Released under the MIT License."), (5, LONG), (None, "CC BY; cc  by cc by-sa"), (None, "a\u0085 b　 c d  e\r\n f\n\ng <s> <|endoftext|> don't\x00 x"),
    (6, "x▁y"), (7, MIT.replace("free of", "totally free of").upper()), (8, "gnu general public license"), (9, "ünïcode-ÄÖ 日本語 😀 é"), (10, "  lead"), (11, "trail \n"), (12, "\nfeed"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n int, rank string, slice int, score string, labels string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, "s", 1, "k", 0, "r", 7, "x", "y") for i, t in TEXTS], SCHEMA)


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def as_counter(df):
    return collections.Counter(tuple(r) for r in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aB9é_@[\x7f \n日😀"), max_size=20)), max_size=6))
def test_coded_words(texts):
    codes, dictionary, offsets = coded_words(pa.array(texts, pa.string()))
    words = [dictionary[int(c)].as_py().decode() for c in codes]
    assert [words[a:b] for a, b in zip(offsets[:-1], offsets[1:])] == [WORD.findall(lowered(t)) for t in texts]


# --- licence scans ---


def plain_phrases(words):
    return sorted((i, label) for label, phrase in licences.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())


def test_licence_base_columns(docs):
    got = as_counter(licences.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
    want = collections.Counter()
    for key, text in TEXTS:
        words = WORD.findall(lowered(text))
        places = plain_phrases(words)
        want[key, len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({p[1] for p in places}))] += 1
    assert got == want
    assert licences.scan(docs.limit(0)).count() == 0


def test_licence_labels_and_spans(docs):
    rows = collections.defaultdict(list)
    for r in licences.scan(docs).collect():
        rows[r.doc_id].append(r)
    assert [r.labels for r in rows[4]] == ["mit"] * 3 and all(r.score == 1.0 for r in rows[4])
    # the first is spelled "licence": four words of five
    assert sorted([(s.first_word, s.last_word, s.coverage) for s in r.spans] for r in rows[4]) == [[(0, 3, 0.8), (5, 9, 1.0)], [(0, 4, 1.0)], [(0, 4, 1.0)]]
    (changed,) = rows[7]  # one word put in: both parts are chained
    assert changed.labels == "mit" and changed.score == 1.0 and changed.spans[0].last_word == len(MIT.split())
    assert rows[8][0].base_labels == "gpl" and rows[8][0].score == 1.0
    assert rows[9][0].labels == "" and rows[9][0].score == 0.0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=8), max_size=4), st.lists(st.integers(0, 4), max_size=25))
def test_matching_statistics(templates, text):
    automaton = licences.SuffixAutomaton(templates)
    for i, (state, length) in enumerate(automaton.read(text)):
        inside = lambda n: any(t[j : j + n] == text[i + 1 - n : i + 1] for t in templates for j in range(len(t) - n + 1))  # noqa: E731, B023
        longest = max((n for n in range(1, i + 2) if inside(n)), default=0)
        assert length == longest
        if length:
            ends = {(t, j + length - 1) for t, words in enumerate(templates) for j in range(len(words)) if words[j : j + length] == text[i + 1 - length : i + 1]}
            assert set(automaton.ends[state]) == ends


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=3, max_size=9), min_size=1, max_size=3), st.text(alphabet="abcx", max_size=30), st.integers(2, 4))
def test_long_matches(templates, text, least):
    scanner = licences.Scanner([(f"t{i}", " ".join(t)) for i, t in enumerate(templates)], [("p", "a b")], least, 3)
    codes, dictionary, offsets = coded_words(pa.array([" ".join(text)]))
    listed = [w.as_py() for w in scanner.vocabulary]
    ids = np.array([listed.index(w) + 1 if (w := dictionary[int(c)].as_py()) in listed else 0 for c in codes], np.int64)
    found, places = {}, []
    for _, start, stop in scanner.segments(ids, offsets):
        more, here = scanner.matches(ids[start:stop].tolist(), start)
        found.update(more)
        places += here
    want = {}
    kept = [t for t in templates if len(t) >= least]
    for t, template in enumerate(kept):  # common parts that cannot be made longer on either side
        for i in range(len(text)):
            for j in range(len(template)):
                if text[i] == template[j] and not (i and j and text[i - 1] == template[j - 1]):
                    n = 0
                    while i + n < len(text) and j + n < len(template) and text[i + n] == template[j + n]:
                        n += 1
                    if n >= least:
                        want[t, i - j, i] = i + n - 1
    assert found == want
    assert sorted(p for p, _ in places) == [i for i in range(len(text) - 1) if text[i : i + 2] == "ab"]
    for template, begin, last, share in scanner.chains(found):
        assert 0 < share <= 1 and 0 <= begin <= last < len(text)


def test_template_bound():
    with pytest.raises(ValueError):
        licences.Scanner([("x", "a " * (licences.MOST_WORDS + 1))], [], 3, 3)


# --- tokenizer alignment ---


@pytest.fixture(scope="module")
def coders():
    return align.Tokenizers(default_tokenizer(), default_pieces())


def plain_alignment(text, coders):
    """(ids of A, ids of B, groups, links as (place in A, place in B)) by comparing all tokens, on the whole text."""
    if not text:
        return [], [], [], []
    a = coders.a.encode(" " + text, add_special_tokens=False).ids
    b = coders.b.encode(text)
    sides = []
    for ids, spell in ((a, coders.spell_a), (b, coders.spell_b)):
        parts = [spell(np.array([i])) for i in ids]
        if b"".join(parts) != (" " + text).encode():
            return [], [], [], []
        ends = np.cumsum([len(p) for p in parts]).tolist()
        sides.append(list(zip([0, *ends[:-1]], ends)))
    links = [(i, j) for i, (s, e) in enumerate(sides[0]) for j, (x, y) in enumerate(sides[1]) if s < y and x < e]
    groups = []
    for cut in sorted({e for _, e in sides[0]} & {e for _, e in sides[1]}):
        done = [sum(len(g[k]) for g in groups) for k in (0, 1)]
        groups.append(tuple([ids[n : sum(e <= cut for _, e in side)] for ids, side, n in zip((a, b), sides, done)]))
    return a, b, groups, links


def plain_table(texts, coders):
    found = [plain_alignment(t, coders) for t in texts]
    counts = collections.Counter()
    for a, b, _, links in found:
        counts.update({(a[i], b[j]) for i, j in links})
    highest = collections.defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    for a, b, groups, links in found:
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        pairs = [(a[i], b[j]) for i, j in links]
        best = sum(counts[p] == highest[p[0]] for p in pairs)
        yield len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in pairs), hashlib.sha256(shown.encode()).hexdigest() if shown else ""


def test_alignment(docs, coders):
    short = [(k, t) for k, t in TEXTS if t is not LONG]
    frame = docs.where("doc_id IS NULL OR doc_id <> 5")
    want = collections.Counter((k, *row) for (k, _), row in zip(short, plain_table([t for _, t in short], coders)))
    for size in (40, 3_000_000):
        got = align.align(frame, default_tokenizer(), default_pieces(), size=size)
        assert as_counter(got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) == want
    assert align.align(docs.limit(0), default_tokenizer(), default_pieces()).count() == 0


def test_alignment_of_a_long_text(docs, coders):
    row = align.align(docs.where("doc_id = 5"), default_tokenizer(), default_pieces()).first()
    assert row.n_a == len(coders.a.encode(" " + LONG, add_special_tokens=False).ids) and row.n_b == len(coders.b.encode(LONG))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB é\n\t.,'s1<|>\r　 ▁日😀"), max_size=30), min_size=1, max_size=5))
def test_units_align_like_whole_texts(texts):
    known = align.store(default_tokenizer(), default_pieces())
    rows, pairs, _ = align.align_slice(pa.array(range(len(texts))), pa.array(texts), known)
    got = rows.to_pylist()
    for row, (n_a, n_b, n_groups, n_links, _, _, digest) in zip(got, plain_table(texts, known.coders)):
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups_sha256"]) == (n_a, n_b, n_groups, n_links, digest)
        assert sum(row["times"]) == n_links and len(set(row["places"])) == len(row["places"])


def test_store_keeps_what_the_last_slice_used(coders):
    known = align.Store(coders, limit=8)
    for words in (["a", "b", "c", "d"], ["c", "e", "f"], ["a", "c", "x", "y", "z"], ["q"], ["c", "new", "é"]):
        units = pa.array([f" {w}".encode() for w in words], pa.binary())
        at = known.places(units)
        assert [known.held.units[int(i)].as_py() for i in at] == units.to_pylist()
        fresh = align.Aligned(units, coders)
        for name in align.Store.PER_UNIT:
            assert getattr(known.held, name)[at].tolist() == getattr(fresh, name).tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=20), st.lists(st.integers(1, 4), min_size=1, max_size=20))
def test_pointer_jumping_labels(a, b):
    short, long = sorted((a, b), key=sum)
    short.append(max(1, sum(long) - sum(short)))
    if sum(short) > sum(long):
        long.append(sum(short) - sum(long))
    ends = [np.cumsum(a), np.cumsum(b)]
    common = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    want = [next(i for i, e in enumerate(ends[1]) if e == next(c for c in common if c >= end)) for side in ends for end in side]
    assert align.labels(*ends).tolist() == want


# --- ranked search ---


def plain_search(texts, items, k):
    terms = [(key, collections.Counter(WORD.findall(lowered(t)))) for key, t in texts]
    filled = [(key, c) for key, c in terms if c]
    n_docs, total = len(filled), sum(sum(c.values()) for _, c in filled)
    df = collections.Counter(t for _, c in filled for t in c)
    out = collections.Counter()
    for item, text in dict.fromkeys(items):
        rows = []
        for key, c in filled:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(WORD.findall(lowered(text))) if c[t])
            if score > 0:
                rows.append((-score, key is None, key or 0))
        for rank, (score, missing, key) in enumerate(sorted(rows)[:k], 1):
            out[item, rank, None if missing else key, -score] += 1
    return out


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"t{x}" for x in rng.zipf(1.4, rng.integers(0, 40)) % 300) for _ in range(n)]
    texts[5 : n // 3] = [texts[5]] * (n // 3 - 5)  # a third are copies
    return [(int(i), t) for i, t in enumerate(texts)] + TEXTS


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 64, "block_entries": 300, "group_terms": 20, "seeds": 40}])
def test_search(spark, blocks):
    rows = corpus(3, 400)
    items = [(i, t) for i, t in corpus(4, 12)[:12]] + [(3, None), (4, ""), (None, "t1 t2 T2 t299"), (7, "of the MIT"), (7, "of the MIT"), (7, "t5 licence"), (8, "nowhere at all zzz")]
    frame = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, score int").repartition(5)
    asked = spark.createDataFrame([(i, t, "r", 1) for i, t in items], "item_id long, text string, rank string, item int")
    got = search.search(frame, asked, k=7, **blocks)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert as_counter(got) == plain_search(rows, items, 7)


def test_search_of_nothing(spark):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "mit")], "item_id long, text string")
    for docs, items in ((frame.limit(0), asked), (frame, asked.limit(0)), (frame.where("text = ''"), asked)):
        found = search.search(docs, items)
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 120), st.sampled_from([1, 3, 64]))
def test_bounds_hold(seed, rows, subspaces):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 12, rows)
    terms = np.concatenate([np.sort(rng.choice(40, n, replace=False)) for n in sizes])
    values = rng.integers(1, 10**6, len(terms))
    tree = search.BallTree(terms, values, sizes, subspaces, leaf=4)
    starts = np.cumsum(sizes) - sizes
    for _ in range(5):
        asked = np.sort(rng.choice(40, rng.integers(1, 10), replace=False))
        weights = rng.integers(0, 20_000, len(asked))
        dense = np.zeros(40, np.int64)
        dense[asked] = weights
        exact = np.array([int((dense[terms[s : s + n]] * values[s : s + n]).sum()) for s, n in zip(starts, sizes)])[tree.order]
        local, kept = tree.local(asked, weights)
        if not len(local):
            assert not exact.any()
            continue
        for (first, last, _), bound in zip(tree.nodes, tree.bounds(local, kept)):
            assert exact[first:last].max() <= bound
        best = search.Best(3, 1)
        search.search_tree(tree, list(range(rows)), asked, weights, best)
        assert best.rows == sorted(((int(s), i) for i, s in enumerate(exact) if s > 0), key=lambda r: (-r[0], r[1]))[:3]
