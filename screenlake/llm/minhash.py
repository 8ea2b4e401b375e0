"""Near-duplicate texts by a chosen-path set similarity join.

Texts are sets of word shingles; equal sets are one class. Every class follows paths in a few independent trees: a
node sends its members on by the minwise tokens at the places that it selects, so similar sets keep meeting while
others part. A node that is small enough, or as deep as allowed, compares all its members by their signatures; those
that may be similar form groups. Links are confirmed on the full sets inside each group, with an inverted index.

Every tree reads signature places of its own. Their number, and how many places must agree, follow from the least
similarity and from the probability with which a pair at that similarity may be missed (``tree_count``, ``least_agreeing``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.chunks import hashed_words, split_words
from screenlake.llm.common import bloom_filter, mix64, rolled, written
from screenlake.llm.links import Forest, block_tasks, components, per_task

PLACES = 32  # of a tree


def seeds(places: int) -> np.ndarray:
    return mix64(np.arange(1, places + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def agreeing(places: int, similarity: float) -> list[float]:
    """Probability of each number of agreeing places."""
    return [math.comb(places, k) * similarity**k * (1 - similarity) ** (places - k) for k in range(places + 1)]


def tree_count(similarity: float, missed: float, depth: int) -> int:
    """Trees in all of which a pair parts with probability ``missed`` at most.

    In a tree the pair goes on by each of two places that agrees, so it parts as a branching process dies out; the
    number of agreeing places of the tree is binomial.
    """
    parted = 0.0
    for k, weight in enumerate(agreeing(PLACES, similarity)):
        dead = 0.0
        for _ in range(depth + 1):
            dead = (1 - k / PLACES + k / PLACES * dead) ** 2
        parted += weight * dead
    return max(1, math.ceil(math.log(missed) / math.log(min(max(parted, 1e-12), 1 - 1e-9))))


def least_agreeing(places: int, similarity: float, missed: float) -> int:
    """Number of places below which a pair agrees with probability ``missed`` at most."""
    below = np.cumsum(agreeing(places, similarity))
    return int(np.searchsorted(below, missed, "right"))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in one array, and where each text's part starts (n + 1 places).

    Words are lower-cased (A-Z); a text with fewer than ``width`` words is one shingle, one without words has none.
    """
    words = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = words.offsets.to_numpy().astype(np.int64)
    hashes = hashed_words(words.values)
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.flatnonzero(np.arange(len(hashes)) + width <= np.repeat(offsets[1:], counts))
    shingles, owner = rolled(hashes, width, 5)[starts] if len(starts) else np.zeros(0, np.uint64), row[starts]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        single = [rolled(hashes[offsets[i] : offsets[i + 1]], int(counts[i]), 50 + int(counts[i]))[0] for i in short]
        shingles, owner = np.concatenate([shingles, np.asarray(single, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    shingles, owner = shingles[new], owner[new]
    return shingles, np.searchsorted(owner, np.arange(len(counts) + 1))


def set_hashes(shingles: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of each set, as two sums; 0 for empty ones."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(shingles + np.uint64(seed)))]) for seed in (11, 12)]
    one, two = ((s[starts[1:]] - s[starts[:-1]]).view(np.int64) for s in sums)
    return one, two


def slices(batch: pa.RecordBatch, column: int, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy() + 1)
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + chars, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def signatures(frame: DataFrame, width: int, places: int) -> DataFrame:
    """(key, tie, n_shingles, one, two, signature, roots) of (key, text, tie) rows.

    A place keeps 16 bits of its least value: different values agree by chance once in 65,536, which can only bring
    more pairs together. The two places of each tree where all sets start from keep 32 bits (``roots``).
    """
    first = [t * PLACES + p for t in range(places // PLACES) for p in range(2)]
    each = seeds(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                shingles, starts = shingle_sets(part.column(1), width)
                sizes = np.diff(starts)
                one, two = set_hashes(shingles, starts)
                least = np.zeros((part.num_rows, places), np.uint32)
                full = np.flatnonzero(sizes)
                if len(full):
                    for place, seed in enumerate(each):
                        values = ((shingles ^ seed) * (seed | np.uint64(1))) >> np.uint64(32)
                        least[full, place] = np.minimum.reduceat(values, starts[full])
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * values.shape[1]), pa.array(np.ascontiguousarray(values).ravel()))
                    for values in (least.astype(np.uint16).view(np.int16), least[:, first].view(np.int32))
                ]
                columns = [part.column(0), part.column(2), pa.array(sizes.astype(np.int64)), pa.array(one), pa.array(two), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["key", "tie", "n_shingles", "one", "two", "signature", "roots"])

    return frame.mapInArrow(run, "key long, tie long, n_shingles long, one long, two long, signature array<smallint>, roots array<int>")


def candidate_edges(sets: DataFrame, trees: int, node_limit: int, depth: int, similarity: float, missed: float, pivots: int = 4) -> DataFrame:
    """(a, b) between classes that meet in some node and agree on enough of their signatures; a forest per node.

    In a large node every member is first compared with a few pivots. Members that agree with one closely are
    settled: whatever is similar to them agrees with that pivot on half of the places, too. The others branch. So a
    dense group takes as many comparisons as it has members.
    """
    places = PLACES * trees
    least = least_agreeing(PLACES, similarity, missed)
    half = places // 2
    close = places + half - least_agreeing(places, similarity, missed)  # a partner differs from a settled one at the other places at most
    child = lambda place: F.xxhash64(F.col("node"), place, F.get(F.col("signature"), place))
    starts = F.array(*[F.struct(F.lit(i // 2).alias("tree"), F.xxhash64(F.lit(i), F.get(F.col("roots"), F.lit(i))).alias("node")) for i in range(2 * trees)])
    level = sets.select("cid", F.explode(starts).alias("at")).select("cid", "at.tree", "at.node")
    leaves, found = [], []
    for step in range(depth + 1):
        level = written(level, "nodes")
        counts = written(level.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "counts")
        met = level.join(counts, "node")
        leaves.append(met if step == depth else met.where(F.col("n") <= node_limit))
        if step == depth or counts.where(F.col("n") > node_limit).isEmpty():
            break
        huge = written(met.where(F.col("n") > node_limit), "huge")
        asked = bloom_filter(huge.select("cid"), ["cid"])  # signatures that are surely not asked for are not shuffled
        signed = sets.select("cid", "signature")
        large = written(huge.join(signed if asked is None else signed.where(asked(F.col("cid"))), "cid"), "large")
        part = F.pmod(F.xxhash64("cid", "node"), F.lit(pivots))
        chosen = large.groupBy("node").agg(
            *[F.min(F.when(part == j, F.struct(F.xxhash64("cid").alias("h"), "cid", "signature"))).alias(f"pivot{j}") for j in range(pivots)]
        )
        near = large.join(chosen, "node")
        agreed = [F.size(F.filter(F.zip_with("signature", f"pivot{j}.signature", lambda x, y: x == y), lambda same: same)) for j in range(pivots)]
        linked = F.array(*[F.when(a >= half, F.col(f"pivot{j}.cid")) for j, a in enumerate(agreed)])
        settled = F.coalesce(F.greatest(*[F.coalesce(a, F.lit(0)) for a in agreed]) >= close, F.lit(False))
        near = written(near.select("cid", "tree", "node", "signature", linked.alias("linked"), settled.alias("settled")), "near")
        found.append(near.select(F.col("cid").alias("a"), F.explode(F.array_compact("linked")).alias("b")).where("a <> b"))
        first = F.pmod(F.xxhash64("node", F.lit(0)), F.lit(PLACES)).cast("int")
        second = F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit(1)), F.lit(PLACES - 1)).cast("int"), F.lit(PLACES))  # never the first
        level = near.where("NOT settled").select("cid", "tree", F.explode(F.array(*[child(F.col("tree") * PLACES + p) for p in (first, second)])).alias("node"))
    met = leaves[0]
    for leaf in leaves[1:]:
        met = met.unionByName(leaf)
    tasks = block_tasks(met.withColumn("blocks", F.ceil(F.col("n") / node_limit)), "node", "cid", "blocks").select("task", "cid")
    tasks = tasks.join(sets.select("cid", F.slice("signature", 1, PLACES).alias("signature")), "cid")

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        cids = table.column("cid").to_numpy()
        values = table.column("signature").combine_chunks().values.to_numpy().reshape(len(cids), PLACES)
        cids, own = np.unique(cids, return_index=True)  # a class may have reached a node by two places
        values = values[own]
        forest = Forest(len(cids))
        for i in range(len(cids) - 1):
            near = np.flatnonzero((values[i + 1 :] == values[i]).sum(axis=1) >= least) + i + 1
            if len(near):
                forest.join(np.append(near, i))
        moved = np.flatnonzero(forest.root != np.arange(len(cids)))
        if not len(moved):
            return None
        return pa.RecordBatch.from_arrays([pa.array(cids[moved]), pa.array(cids[forest.root[moved]])], ["a", "b"])

    edges = per_task(tasks, compare, "a long, b long")
    for more in found:
        edges = edges.unionByName(more)
    return edges.distinct()


def confirmed(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component of each set by links with Jaccard similarity of at least ``percent`` / 100.

    Sets outside the largest component are compared with all others through an inverted index, so that every pair
    that could still join two components is compared.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(tokens, kind="stable")
    owners = np.repeat(np.arange(n), sizes)[order]
    edges = np.searchsorted(tokens[order], np.arange(tokens.max() + 2)) if len(tokens) else np.zeros(1, np.int64)
    lengths = np.diff(edges)
    weight = np.add.reduceat(lengths[tokens], begins) / sizes  # a set that shares much comes first
    forest, waiting = Forest(n), np.ones(n, bool)
    while True:
        largest = np.bincount(forest.root, minlength=n).argmax()
        left = np.flatnonzero(waiting & (forest.root != largest))
        if waiting.all():
            left = np.arange(n)
        if not len(left):
            return forest.root
        pivot = left[weight[left].argmax()]
        waiting[pivot] = False
        own = tokens[begins[pivot] : begins[pivot] + sizes[pivot]]
        counts = lengths[own]
        ends = np.cumsum(counts)
        places = np.arange(ends[-1]) + np.repeat(edges[own] - (ends - counts), counts)
        shared = np.bincount(owners[places], minlength=n)
        near = np.flatnonzero(100 * shared >= percent * (sizes + sizes[pivot] - shared))
        forest.join(near)


def near_duplicates(
    docs: DataFrame, percent: int = 85, width: int = 5, missed: float = 1e-6, node_limit: int = 2000, depth: int = 10,
    shingles_per_block: int = 2_000_000, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, n_shingles, component_id, kept, tie, chosen): components of links with Jaccard similarity of ``percent`` or more.

    ``tie`` is a hash of the text and ``chosen`` marks one (key, tie) of each component, the smallest. Rows with equal sets are linked. ``component_id`` is the smallest key reachable, null if all are null. Rows without words link with nothing
    and are their own component. Rows that repeat a key share what any of them is linked to only through their
    texts. An empty table gives no rows; other columns are not read.
    A link of similarity ``percent`` is missed with probability ``missed`` at most: half of it for parting in all trees,
    half for signatures that agree on too few places.
    """
    similarity = percent / 100
    trees = tree_count(similarity, missed / 2, depth)
    frame = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    frame = frame.withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    signed = written(signatures(frame, width, PLACES * trees), "signatures")
    classes = signed.where("n_shingles > 0").groupBy("one", "two").agg(F.min(_place()).alias("place"), F.min("signature").alias("signature"), F.min("roots").alias("roots"), F.first("n_shingles").alias("n"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    groups = written(components(candidate_edges(classes.select("cid", "signature", "roots"), trees, node_limit, depth, similarity, missed / 4)), "groups")
    members = classes.join(groups.withColumnRenamed("id", "cid"), "cid").select("cid", "one", "two", F.col("place.key").alias("key"), "n", "component")
    members = written(members, "members")
    sizes = members.groupBy("component").agg(F.ceil(F.sum("n") / shingles_per_block).alias("blocks"))
    wanted = members.join(sizes, "component").select("cid", "one", "two", "key", "component", "blocks")

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.schema.get_field_index("text")):
                shingles, starts = shingle_sets(part.column(part.schema.get_field_index("text")), width)
                one, two = set_hashes(shingles, starts)
                column = lambda name: part.column(part.schema.get_field_index(name))  # noqa: B023, E731
                same = np.flatnonzero((column("one").to_numpy() == one) & (column("two").to_numpy() == two))
                data = [shingles[starts[i] : starts[i + 1]].tobytes() for i in same]
                picked = [column(name).take(pa.array(same)) for name in ("cid", "component", "blocks")]
                yield pa.RecordBatch.from_arrays([*picked, pa.array(data, pa.binary())], ["cid", "component", "blocks", "tokens"])

    # texts that are surely not wanted stay where they are; the others are shuffled, whatever their number
    wanted = written(wanted, "wanted")
    asked = bloom_filter(wanted.select("key"), ["key"])
    texts = frame if asked is None else frame.where(asked(F.col("key")))
    rows = texts.hint("merge").join(wanted, texts["key"].eqNullSafe(wanted["key"])).select("text", "cid", "one", "two", "component", "blocks")
    sets = rows.mapInArrow(full_sets, "cid long, component long, blocks long, tokens binary")
    tasks = block_tasks(sets, "component", "cid", "blocks").select("task", "cid", "tokens")

    def confirm(table: pa.Table) -> pa.RecordBatch | None:
        cids, own = np.unique(table.column("cid").to_numpy(), return_index=True)
        tokens = table.column("tokens")
        root = confirmed([np.frombuffer(tokens[int(i)].as_py(), np.uint64) for i in own], percent)
        moved = np.flatnonzero(root != np.arange(len(root)))
        if not len(moved):
            return None
        return pa.RecordBatch.from_arrays([pa.array(cids[moved]), pa.array(cids[root[moved]])], ["a", "b"])

    linked = components(per_task(tasks, confirm, "a long, b long"))
    linked = classes.select("cid", "one", "two", "place").join(linked.withColumnRenamed("id", "cid"), "cid", "left")
    linked = linked.withColumn("component", F.coalesce("component", "cid"))
    smallest = linked.groupBy("component").agg(F.min("place").alias("least"))
    named = written(linked.join(smallest, "component").select("one", "two", "least"), "named")
    result = signed.select("key", "tie", "n_shingles", "one", "two").join(named, ["one", "two"], "left")
    result = result.withColumn("least", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(_place()))
    return result.select(
        F.col("key").alias(key), "n_shingles", F.col("least.key").alias("component_id"), F.col("key").eqNullSafe(F.col("least.key")).alias("kept"),
        "tie", (F.col("least") == _place()).alias("chosen"),
    )


def _place() -> F.Column:
    """Order of rows: by key, null keys last, then by the hash of the text."""
    return F.struct(F.col("key").isNull().alias("unknown"), "key", "tie")
