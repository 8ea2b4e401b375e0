"""Ranked lexical search: exact inner products of sparse vectors by ball trees.

A document is the vector of its terms' impacts, an item the vector of its terms' weights; a score is their inner
product, in 64-bit integers. Only the items' terms can add to a score, so vectors hold those alone. Documents with
the same strongest terms are dealt to the same blocks; a block of bounded size becomes a ball tree: every node has the
centroid of its documents and, for each of a fixed number of subspaces of the terms, the largest distance of a
document from it. No document of a node can score more than

    sum over subspaces s of  <weights, centroid>_s + |weights|_s * radius_s

(with one subspace, the usual bound of a ball). Centroids are rounded before radii are measured, radii and bounds
are rounded up, so a bound never falls below a true score. A search takes nodes best bound first and leaves out those
that cannot reach the score of the k-th best document known; leaves are scored exactly.

Two passes read the index: the first scores the most promising leaves of every block, which gives each item a score
that its k-th best document reaches at least; the second searches all blocks with that score to start from. A task
returns at most k rows an item. Items are taken in groups of a bounded number of terms (``group_terms``), each group
reading the documents once; what a group sends to all tasks and gets back to the driver (its terms, their counts, one
score an item) has that bound.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.common import written
from screenlake.llm.terms import coded_words, entries, row_slices

LEAF = 32
SUBSPACES = 4096
#: Relative room for the rounding of sums in doubles: well above their number of terms times 2 ** -53.
SLACK = 1e-9


def term_counts(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """(key, n, terms, counts) of rows (key, text): all terms, and places in ``vocabulary`` with their occurrences, ascending."""
    size = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "text"):
            codes, dictionary, offsets = coded_words(part.column(1))
            places = pc.fill_null(pc.index_in(dictionary, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
            terms = places[codes] if len(codes) else np.zeros(0, np.int32)
            rows = np.repeat(np.arange(part.num_rows), np.diff(offsets))
            known = terms >= 0
            pairs, counts = np.unique(rows[known] * size + terms[known], return_counts=True)
            ends = pa.array(np.searchsorted(pairs, np.arange(part.num_rows + 1) * size), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(values, pa.int32())) for values in (pairs % size, counts)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets), pa.int64()), *lists], ["key", "n", "terms", "counts"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n long, terms array<int>, counts array<int>")


def impacts(n: np.ndarray, counts: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Impact of ``counts`` occurrences in documents of ``n`` terms (one n for each count)."""
    length = 100 - 50 + (50 * n * documents) // total
    return (1_000_000_000 * counts) // (1000 * counts + 20 * length)


def weight(documents: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * with_term + 1)))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a list array."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


class BallTree:
    """Ball tree over sparse rows: rows in tree order, and nodes as (first row, last row + 1, left child or -1)."""

    def __init__(self, terms: np.ndarray, values: np.ndarray, sizes: np.ndarray, subspaces: int = SUBSPACES, leaf: int = LEAF):
        self.vocabulary, local = np.unique(terms, return_inverse=True)
        width, rows = len(self.vocabulary), len(sizes)
        starts = np.cumsum(sizes) - sizes
        squares = np.add.reduceat((values * values).astype(np.float64), starts)
        order = np.arange(rows)
        self.nodes: list[tuple[int, int, int]] = []
        spread: list[tuple[int, int, int]] = [(0, rows, -1)]
        while spread:  # a node's children follow each other; parents come before them
            first, last, parent = spread.pop()
            if parent >= 0 and self.nodes[parent][2] < 0:
                self.nodes[parent] = (*self.nodes[parent][:2], len(self.nodes))
            self.nodes.append((first, last, -1))
            here = len(self.nodes) - 1
            if last - first <= leaf:
                continue
            members = order[first:last]
            cells, owners = entries(starts[members], sizes[members])
            held, values_here = local[cells], values[cells].astype(np.float64)
            dots = lambda dense: np.bincount(owners, dense[held] * values_here, last - first)
            dense = lambda row: np.bincount(local[starts[row] : starts[row] + sizes[row]], values[starts[row] : starts[row] + sizes[row]], width)
            centre = np.bincount(held, values_here, width) / (last - first)
            far = dense(members[np.argmax(squares[members] - 2 * dots(centre))])
            other = dense(members[np.argmax(squares[members] - 2 * dots(far))])
            order[first:last] = members[np.argsort(dots(other) - dots(far), kind="stable")]
            middle = (first + last) // 2
            spread += [(middle, last, -2), (first, middle, here)]
        self._link()
        cells, _ = entries(starts[order], sizes[order])
        self.order, self.sizes = order, sizes[order]
        self.terms, self.values = local[cells], values[cells]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self._balls(subspaces)

    def _link(self) -> None:
        """Right children by where the left one's rows end."""
        at = {(first, last): i for i, (first, last, _) in enumerate(self.nodes)}
        self.children = [() if left < 0 else (left, at[self.nodes[left][1], last]) for _, last, left in self.nodes]

    def _balls(self, subspaces: int) -> None:
        width = len(self.vocabulary)
        space = self.vocabulary % subspaces
        centre_nodes, centre_terms, centre_values, radii = [], [], [], []
        for i, (first, last, _) in enumerate(self.nodes):
            cells = slice(self.starts[first], self.starts[last])
            held, values = self.terms[cells], self.values[cells].astype(np.float64)
            owners = np.repeat(np.arange(last - first), self.sizes[first:last])
            centre = (np.bincount(held, values, width) / (last - first)).astype(np.float32).astype(np.float64)
            inside = np.flatnonzero(centre)
            whole = np.bincount(space[inside], centre[inside] ** 2, subspaces)
            # squared distance in a subspace: what the row holds there against the centre, and the centre elsewhere
            change = (values - centre[held]) ** 2 - centre[held] ** 2
            used, back = np.unique(owners * subspaces + space[held], return_inverse=True)
            near = np.bincount(back, change)
            mass = np.bincount(back, values * values)
            at = used % subspaces
            widest = np.where(np.bincount(at, minlength=subspaces) < last - first, whole, 0.0)  # a row without terms there
            np.maximum.at(widest, at, near + whole[at] + SLACK * (mass + whole[at]))
            radius = np.sqrt(np.maximum(widest + SLACK * whole, 0.0)) * (1 + SLACK)
            radii.append(np.nextafter(radius.astype(np.float32), np.float32(np.inf)))
            centre_nodes.append(np.full(len(inside), i))
            centre_terms.append(inside)
            centre_values.append(centre[inside])
        nodes, terms, values = map(np.concatenate, (centre_nodes, centre_terms, centre_values))
        by_term = np.argsort(terms, kind="stable")
        self.centre_nodes, self.centre_values = nodes[by_term], values[by_term]
        self.centre_starts = np.searchsorted(terms[by_term], np.arange(width + 1))
        self.radii = np.array(radii)
        self.space = space

    def bounds(self, local: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Of every node, a number that no inner product with one of its rows exceeds."""
        begin, size = self.centre_starts[local], np.diff(self.centre_starts)[local]
        cells, owners = entries(begin, size)
        sums = np.bincount(self.centre_nodes[cells], self.centre_values[cells] * weights[owners], len(self.nodes))
        spaces, back = np.unique(self.space[local], return_inverse=True)
        lengths = np.sqrt(np.bincount(back, weights.astype(np.float64) ** 2)) * (1 + SLACK)
        return (sums + self.radii[:, spaces].astype(np.float64) @ lengths) * (1 + SLACK) + 1

    def scores(self, node: int, dense: np.ndarray) -> np.ndarray:
        """Exact inner products of a node's rows with the weights of the block's terms."""
        first, last, _ = self.nodes[node]
        cells = slice(self.starts[first], self.starts[last])
        return np.add.reduceat(dense[self.terms[cells]] * self.values[cells], self.starts[first:last] - self.starts[first])

    def local(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the terms in the block's vocabulary, and their weights; others are left out."""
        places = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
        kept = (self.vocabulary[places] == terms) & (weights > 0)
        return places[kept], weights[kept]


class Best:
    """The k best (score, key) so far; equal scores by ascending key, null keys last."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.rows = k, floor, []

    @property
    def least(self) -> int:
        """A score below this cannot be among the k best."""
        return max(self.floor, self.rows[-1][0] if len(self.rows) == self.k else 1)

    def add(self, scores: np.ndarray, keys: list) -> None:
        wanted = np.flatnonzero(scores >= self.least)
        if len(wanted):
            self.rows += [(int(scores[i]), keys[i]) for i in wanted]
            self.rows.sort(key=lambda row: (-row[0], row[1] is None, row[1] if row[1] is not None else 0))
            del self.rows[self.k :]


def search_tree(tree: BallTree, keys: list, terms: np.ndarray, weights: np.ndarray, best: Best, leaves: int | None = None) -> int:
    """Adds the best rows of a tree (``keys`` in tree order), nodes with the best bound first; the number of leaves scored.

    With ``leaves``, stops after so many leaves.
    """
    local, weights = tree.local(terms, weights)
    if not len(local):
        return 0
    bounds = tree.bounds(local, weights)
    dense = np.zeros(len(tree.vocabulary), np.int64)
    dense[local] = weights
    heap, scored = [(-bounds[0], 0)], 0
    while heap and -heap[0][0] >= best.least and (leaves is None or scored < leaves):
        _, node = heapq.heappop(heap)
        if tree.children[node]:
            for child in tree.children[node]:
                heapq.heappush(heap, (-bounds[child], child))
            continue
        first, last, _ = tree.nodes[node]
        best.add(tree.scores(node, dense), keys[first:last])
        scored += 1
    return scored


def index_blocks(vectors: DataFrame, documents: int, total: int, rows: int, entries: int) -> DataFrame:
    """(keys, tree): ball trees of blocks of at most ``rows`` documents and about ``entries`` terms; documents without an item's term are in none."""

    def built(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(held).combine_chunks()
        (terms, sizes), (counts, _) = (flat(block.column(name).combine_chunks()) for name in ("terms", "counts"))
        n = np.repeat(block.column("n").to_numpy(), sizes)
        tree = BallTree(terms, impacts(n, counts, documents, total), sizes)
        keys = block.column("key").combine_chunks().take(pa.array(tree.order))
        del tree.order
        data = zstandard.compress(pickle.dumps(tree, 5), 1)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), pa.array([data], pa.binary())], ["keys", "tree"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        room, space = rows, entries
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = min(start + room, max(start + 1, int(np.searchsorted(ends, before + space, "right"))))
                held.append(batch.slice(start, stop - start))
                room, space, start = room - (stop - start), space - int(ends[stop - 1] - before), stop
                if room <= 0 or space <= 0 or stop < batch.num_rows:
                    yield built(held)
                    held, room, space = [], rows, entries
        if held:
            yield built(held)

    return vectors.mapInArrow(run, f"keys array<{vectors.schema['key'].dataType.simpleString()}>, tree binary")


def search_blocks(index: DataFrame, items: list[np.ndarray], weights: np.ndarray, floors: list[int], k: int, leaves: int | None = None) -> DataFrame:
    """(item, key, score): of every task, the k best documents of each item that reach its floor."""
    element = index.schema["keys"].dataType.elementType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(element)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, floor) for floor in floors]
        for batch in batches:
            for keys, data in zip(batch.column(0), batch.column(1)):
                tree = pickle.loads(zstandard.decompress(data.as_py()))
                named = keys.as_py()
                for own, terms in zip(best, items):
                    search_tree(tree, named, terms, weights[terms], own, leaves)
        rows = [(i, key, score) for i, own in enumerate(best) for score, key in own.rows]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], arrow), pa.array(columns[2], pa.int64())], ["item", "key", "score"])

    return index.mapInArrow(run, f"item int, key {element.simpleString()}, score long")


def top(found: DataFrame, k: int, salts: int = 32) -> DataFrame:
    """The k best rows of each item with their ``rank``: first inside salted parts, then over what is left."""
    order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    parts = found.withColumn("salt", F.pmod(F.xxhash64("key", "score"), F.lit(salts)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k).drop("salt", "rank")
    return parts.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text hash, terms): distinct items with their distinct terms, written."""
    frame = items.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).dropDuplicates()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "text"):
            codes, dictionary, offsets = coded_words(part.column(1))
            lists = [np.unique(codes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            words = dictionary.take(pa.array(np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words)], ["key", "hash", "terms"])

    frame = frame.withColumn("hash", F.xxhash64("key", "text"))
    return written(frame.mapInArrow(run, f"key {frame.schema['key'].dataType.simpleString()}, hash long, terms array<binary>"), "items")


def _group(docs: DataFrame, items: list, item_type: str, k: int, seeds: int, block_rows: int, block_entries: int) -> DataFrame | None:
    """(item key, rank, key, score) of one group of items, written; None if no document has a term."""
    spark = docs.sparkSession
    vocabulary = sorted({bytes(term) for row in items for term in row.terms})
    places = {term: i for i, term in enumerate(vocabulary)}
    wanted = [np.array(sorted(places[bytes(term)] for term in row.terms), np.int64) for row in items]
    vectors = written(term_counts(docs, pa.array(vocabulary, pa.binary())), "vectors")
    documents, total = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    with_term = {term: n for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    weights = np.array([weight(documents, with_term.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    index = written(index_blocks(vectors, documents, total, block_rows, block_entries), "index")
    probe = search_blocks(index, wanted, weights, [1] * len(items), seeds, leaves=-(-2 * seeds // LEAF))
    least = top(probe, k).groupBy("item").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    known = {row.item: row.score for row in least.collect()}
    found = top(search_blocks(index, wanted, weights, [known.get(i, 1) for i in range(len(items))], k), k)
    named = spark.createDataFrame([(i, row.key) for i, row in enumerate(items)], f"item int, item_key {item_type}")
    return written(found.join(F.broadcast(named), "item").select("item_key", "rank", "key", "score"), "ranked")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    seeds: int = 16,
    block_rows: int = 2048,
    block_entries: int = 1_000_000,
    group_terms: int = 100_000,
) -> DataFrame:
    """(item_key, rank, key, score): the ``k`` best documents of every item, of those with a score above 0.

    Terms are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased. With N documents that
    have a term, L terms in all and df documents with a term, the term weighs floor(1000 ln((2N + 2) / (2df + 1))); a
    document of n terms has the length m = 50 + 50nN div L; tf occurrences add weight * (10^9 tf div (1000 tf + 20 m)).
    Equal scores rank by ascending key, null keys last.

    Null and empty texts have no terms: such documents are not counted and such items find nothing. Rows that repeat
    a document's key are documents each. Equal items (key and text) are one; items that share a key only are ranked
    one by one, and null keys stay null. An empty table on either side gives no rows. A text is read whole, however long;
    an item with more terms than ``group_terms`` is a group of its own.
    """
    if docs.columns.count(key) != 1 or items.columns.count(item_key) != 1:
        raise ValueError("a key column is missing or stands twice")
    frame = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    listed = item_terms(items, item_key, item_text)
    item_type = listed.schema["key"].dataType.simpleString()
    terms = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = -(-terms // group_terms)
    parts = []
    for group in range(groups):
        rows = listed.where((F.pmod("hash", F.lit(groups)) == group) & (F.size("terms") > 0)).collect()
        found = _group(frame, rows, item_type, k, seeds, block_rows, block_entries) if rows else None
        if found is not None:
            parts.append(found)
    if not parts:
        return docs.sparkSession.createDataFrame([], f"item_key {item_type}, rank int, key {frame.schema['key'].dataType.simpleString()}, score long").withColumnsRenamed({"item_key": item_key, "key": key})
    return reduce(DataFrame.unionByName, parts).withColumnsRenamed({"item_key": item_key, "key": key})
