"""The filter of keys, a pipeline stage against pairs, and parts of operators against plain numpy."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from screenlake.llm import puscore, rans, warc
from screenlake.llm.common import bloom_filter


def test_bloom_filter_loses_no_key(spark):
    keys = spark.range(0, 30_000, 3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit(7).alias("c"))
    asked = bloom_filter(keys, ["k", "c"])
    rows = spark.range(30_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit(7).alias("c"), (F.col("id") % 3 == 0).alias("there"))
    marked = rows.withColumn("hit", asked(F.col("k"), F.col("c"))).groupBy("there", "hit").count().collect()
    counts = {(r.there, r.hit): r["count"] for r in marked}
    assert counts[True, True] == 10_000 and (True, False) not in counts
    assert counts[False, True] < 400  # under two in a hundred by chance
    assert bloom_filter(keys.limit(0), ["k"])(F.lit(1)) is not None
    assert rows.where(bloom_filter(keys.limit(0), ["k", "c"])(F.col("k"), F.col("c"))).count() == 0
    assert bloom_filter(keys, ["k"], most_bytes=1000) is None


@pytest.mark.parametrize("filtered", [True, False])
def test_near_duplicate_stage_against_pairs(spark, tmp_path, monkeypatch, filtered):
    """One row of each group of similar texts stays, and one of rows that are the same, with and without the key filter."""
    if not filtered:
        monkeypatch.setattr(corpus_pipeline, "bloom_filter", lambda *given, **named: None)
    base = [" ".join(f"w{(i * 7 + k * k) % 997}x{k}" for i in range(60)) for k in range(12)]
    texts = [(k, t) for k, t in enumerate(base)] + [(100 + k, t + " more") for k, t in enumerate(base[:5])] + [(200, base[0]), (200, base[0]), (7, base[7]), (None, base[8]), (None, None), (300, ""), (300, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} if t and t.split() else set()
    kept, classes = set(), []
    for i, t in sorted(set(texts), key=lambda row: (row[0] is None, row[0] or 0)):
        own = shingles(t)
        if not own or not any(own == c or 100 * len(own & c) >= 80 * len(own | c) for c in classes):
            kept.add((i, t))
            classes.append(own) if own else None
    assert got == collections.Counter(kept)


# --- parts of earlier operators ---


@pytest.mark.parametrize("lanes", [1, 3, 64])
def test_a_block_is_read_from_any_checkpoint_alone(lanes):
    """The states of a checkpoint are all that a reader needs: neither earlier words nor earlier ids."""
    rng = np.random.default_rng(lanes)
    ids = rng.zipf(1.3, 3000) % 50
    coder = rans.Coder(rans.scaled(np.bincount(ids, minlength=50)), steps_per_checkpoint=8)
    stream, marks = coder.encode(ids, lanes)
    size = 8 * lanes
    assert len(marks) == -(-len(ids) // size) > 4
    for i in (0, len(marks) // 2, len(marks) - 1):
        place, crc, states = marks[i]
        alone = np.concatenate([np.zeros(place, np.uint64), stream[place:].astype(np.uint64)])  # what was before is gone
        n = min(size, len(ids) - i * size)
        assert coder.decode(alone, (place, crc, states), n).tolist() == ids[i * size : i * size + n].tolist()
        with pytest.raises(ValueError):
            coder.decode(alone, (place, crc ^ 1, states), n)


def softplus(z):
    return np.logaddexp(0, z)


def drawn(rng, n, positive, shift):
    x = rng.normal(size=(n, puscore.N_FEATURES))
    x[:, :3] += shift if positive else -shift
    return x


def test_sums_of_the_risk_against_finite_differences():
    rng = np.random.default_rng(3)
    x, weights = rng.normal(size=(50, puscore.N_FEATURES)), rng.normal(size=puscore.N_FEATURES + 1) / 5
    model = lambda w: puscore.Model(x.mean(axis=0), x.std(axis=0), w)
    inputs = np.column_stack([np.clip((x - x.mean(axis=0)) / x.std(axis=0), -8, 8), np.ones(50)])
    d = len(weights)
    found = puscore.curvature(model(weights))(x)
    loss = lambda w: softplus(inputs @ w).sum()
    slope = lambda w: np.array([(loss(w + h) - loss(w - h)) / 2e-5 for h in 1e-5 * np.eye(d)])
    bend = np.array([(slope(weights + h) - slope(weights - h)) / 2e-3 for h in 1e-3 * np.eye(d)])
    assert found[0] == 50 and np.isclose(found[1], loss(weights))
    assert np.allclose(found[2 : d + 2], slope(weights), atol=1e-4) and np.allclose(found[d + 2 :].reshape(d, d), bend, atol=1e-2)


@pytest.mark.parametrize("prior,shift", [(0.3, 1.5), (0.7, 1.5)])
def test_positive_unlabelled_risk_against_numpy(spark, prior, shift):
    """Classes that part: the prior is near the true one, and the risk of negatives is held at zero."""
    rng = np.random.default_rng(8)
    positives, n = drawn(rng, 400, True, shift), 2500
    unlabelled = np.concatenate([drawn(rng, int(n * prior), True, shift), drawn(rng, n - int(n * prior), False, shift)])
    frames = [spark.createDataFrame([(x.tolist(),) for x in part], "x array<double>").repartition(3) for part in (positives, unlabelled)]
    model, estimate = puscore.fit(*frames, rounds=40)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)
    inputs = lambda x: np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    u, p = inputs(unlabelled), inputs(positives)
    negatives = lambda w: softplus(u @ w).mean() - estimate * softplus(p @ w).mean()
    assert abs(estimate - prior) < 0.1 and negatives(model.weights) > -0.02
    high, low = (model.logit(drawn(rng, 300, side, shift)) for side in (True, False))
    assert (high[:, None] > low[None, :]).mean() > 0.9  # area under the curve on rows that were not fitted


def test_revisits_are_resolved(spark, tmp_path):
    """What a revisit says of itself is not believed: its response has to be there, with its payload."""
    rows = [(1, "a" * 500), (2, "a" * 500), (1, "a" * 500), (3, "b" * 400), (4, "b" * 400)]
    pages = spark.createDataFrame([(i, "u", t) for i, t in rows], "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/w", segment_bytes=128, records_per_file=100)
    got = collections.Counter((r.key, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(spark, f"{tmp_path}/w").collect())
    assert got == collections.Counter({(1, "response", None, 500): 2, (2, "revisit", 1, 500): 1, (3, "response", None, 400): 1, (4, "revisit", 3, 400): 1})
    records = [r for f in (tmp_path / "w").glob("*.gz") for r in warc.records(f.read_bytes())]
    name = next(f["WARC-Refers-To"] for f, _ in records if f["WARC-Type"] == "revisit")
    for case, change in {
        "lost": lambda f, b: None if f.get("WARC-Record-ID") == name or f.get("WARC-Segment-Origin-ID") == name else (f, b),
        "other": lambda f, b: ({**f, "WARC-Payload-Digest": "sha256:00"}, b) if f["WARC-Type"] == "revisit" else (f, b),
        "gap": lambda f, b: None if f.get("WARC-Segment-Number") == "2" else (f, b),
        "short": lambda f, b: (f, b[:-1]) if "WARC-Segment-Total-Length" in f else (f, b),
    }.items():
        kept = [r for r in (change(f, b) for f, b in records) if r]
        folder = tmp_path / case
        folder.mkdir()
        content = b"".join(warc.record([(k, v) for k, v in f.items() if k != "Content-Length"], b) + warc.END for f, b in kept)
        (folder / "part.warc").write_bytes(content)
        with pytest.raises(Exception, match="refers to no response|segments are missing|total length differs"):
            warc.read_archives(spark, str(folder)).collect()
    warc.write_archives(pages.limit(0), f"{tmp_path}/empty")
    assert warc.read_archives(spark, f"{tmp_path}/empty").count() == 0
