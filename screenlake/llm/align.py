"""Alignment of two tokenizers by pointer jumping.

A text with a space before it is cut into tokens by a byte-level tokenizer (A) and by a sentence-piece model (B). Every
token points to the farthest-right token of the other side that overlaps it; a token whose end is an end on the other
side too leads to the B token that ends there, which points to itself. Doubling (each token takes its successor's
successor) brings every token to the last token of its component in a number of steps that is the logarithm of the
longest chain, for all texts of a slice at once; that token labels the group.

Both tokenizers cut a text wherever a space follows a character that is not white space, and around a line feed
between two such characters. Pieces between these borders (units) are aligned alone; a slice of whole rows encodes and
aligns each distinct unit once and gathers its rows from them.

How many documents hold an id pair linked is counted over the corpus: a slice sends each of its distinct pairs once,
with its number of documents; sums are joined back to the slices as rows, and each slice is then finished by itself.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.bpe import Gather, byte_letters
from screenlake.llm.chunks import from_bytes, to_bytes
from screenlake.llm.common import written
from screenlake.llm.terms import binary_array, entries, row_slices, text_bytes
from screenlake.llm.tokens import SPACE, flat_ids, unit_starts

class Tokenizers:
    """Both tokenizers: ids of units, and the bytes of ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as file:
            content = json.load(file)
        back = {letter: byte for byte, letter in enumerate(byte_letters())}
        names = {**{t["id"]: t["content"].encode() for t in content["added_tokens"]}, **{i: bytes(back[c] for c in t) for t, i in content["model"]["vocab"].items() if all(c in back for c in t)}}
        bytes_a = [names.get(i, b"") for i in range(max(names) + 1)]
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        normal = [p for i, p in pieces if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in normal):
            raise ValueError(f"{path_b} has pieces that reach over the start of a word: its units cannot be cut")
        self.size_b = len(pieces)
        self.spell_a, self.spell_b = Gather(bytes_a), Gather(bytes_b)
        #: decimal ids, A then B, each with the mark for "more follow" and the mark for the last of its group
        self.decimal = Gather([b"%d%s" % (i, mark) for n, last in ((len(bytes_a), b"|"), (len(pieces), b";")) for i in range(n) for mark in (b",", last)])
        self.shift_b = 2 * len(bytes_a)

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of units by A and by B. B puts a space before every text; a line feed keeps it from joining the unit."""
        ids_a: list[list[int]] = []
        for start in range(0, len(units), 5000):
            ids_a += [coded.ids for coded in self.a.encode_batch_fast(units[start : start + 5000], add_special_tokens=False)]
        ids_b = self.b.encode(["\n" + unit for unit in units], num_threads=1)
        lead = len(self.b.encode("\n"))
        return ids_a, [ids[lead:] for ids in ids_b]


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def labels(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For all A tokens, then all B tokens: the B token that ends the token's component. Both lists of ends close at the same place."""
    size = len(ends_a)
    over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    alone = np.arange(size, size + len(ends_b))
    follow = np.concatenate([size + over_a, np.where(ends_a[over_b] > ends_b, over_b, alone)]) if size else alone
    while True:
        doubled = follow[follow]
        if np.array_equal(doubled, follow):
            return follow - size
        follow = doubled


class Aligned:
    """Units with their tokens, groups and links.

    ``good`` marks units whose tokens spell them on both sides; others have none. Per unit: counts of tokens, groups
    and links, the id pairs of its links (A id * size of B + B id) and its groups as text, each group closed by ``;``.
    """

    COUNTS = ("n_a", "n_b", "n_groups", "n_links")

    def __init__(self, units: pa.Array, coders: Tokenizers):
        self.units = units
        data, borders = text_bytes(units.cast(pa.string(), safe=False))
        ids_a, ids_b = coders.encode(units.cast(pa.string()).to_pylist())
        (flat_a, n_a), (flat_b, n_b) = flat_ids(ids_a), flat_ids(ids_b)
        sizes = np.diff(borders)
        self.good = spelled(flat_a, n_a, coders.spell_a, data, sizes) & spelled(flat_b, n_b, coders.spell_b, data, sizes)
        flat_a, flat_b = flat_a[np.repeat(self.good, n_a)], flat_b[np.repeat(self.good, n_b)]
        self.n_a, self.n_b = np.where(self.good, n_a, 0), np.where(self.good, n_b, 0)
        ends_a, ends_b = np.cumsum(coders.spell_a.lengths[flat_a]), np.cumsum(coders.spell_b.lengths[flat_b])
        owner_a, owner_b = np.repeat(np.arange(len(units)), self.n_a), np.repeat(np.arange(len(units)), self.n_b)
        label = labels(ends_a, ends_b)
        of_a, of_b = label[: len(flat_a)], label[len(flat_a) :]
        ending = of_b == np.arange(len(flat_b))
        self.n_groups = np.bincount(owner_b[ending], minlength=len(units))
        # an overlap of two tokens is one stretch between neighbouring ends of either side
        cuts = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # merges two sorted runs
        cuts = cuts[np.append(cuts[1:] != cuts[:-1], True)] if len(cuts) else cuts
        at_a, at_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        self.pairs = flat_a[at_a] * coders.size_b + flat_b[at_b]
        self.n_links = np.bincount(owner_a[at_a], minlength=len(units))
        last_a = np.append(of_a[1:] != of_a[:-1], True) if len(of_a) else np.zeros(0, bool)
        token = np.concatenate([flat_a * 2 + last_a, coders.shift_b + flat_b * 2 + ending])
        order = np.lexsort((np.concatenate([np.zeros(len(of_a), int), np.ones(len(of_b), int)]), label))
        self.text = np.frombuffer(coders.decimal(token[order]), np.uint8)
        sizes = coders.decimal.lengths[token]
        self.text_sizes = np.bincount(np.concatenate([owner_a, owner_b]), sizes, len(units)).astype(np.int64)


class Store:
    """Aligned units that a worker has met, at most about ``limit`` of them; beyond that only those of the last slice stay."""

    PER_UNIT = (*Aligned.COUNTS, "good", "text_sizes")

    def __init__(self, coders: Tokenizers, limit: int = 400_000):
        self.coders, self.limit = coders, limit
        self.held = Aligned(pa.array([], pa.binary()), coders)

    def places(self, units: pa.Array) -> np.ndarray:
        """Places of distinct units in ``held``; new ones are aligned together."""
        found = pc.index_in(units, value_set=self.held.units)
        fresh = units.filter(pc.is_null(found))
        at = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        if len(fresh):
            if len(self.held.units) + len(fresh) > self.limit:
                at[at >= 0] = self._keep(at[at >= 0])
            at[at < 0] = len(self.held.units) + np.arange(len(fresh))
            more, held = Aligned(fresh, self.coders), self.held
            held.units = pa.concat_arrays([held.units, fresh])
            for name in (*self.PER_UNIT, "pairs", "text"):
                setattr(held, name, np.concatenate([getattr(held, name), getattr(more, name)]))
        return at

    def _keep(self, at: np.ndarray) -> np.ndarray:
        """Keeps the units at these (distinct) places, in this order."""
        held = self.held
        for name, sizes in (("pairs", held.n_links), ("text", held.text_sizes)):
            cells, _ = entries((np.cumsum(sizes) - sizes)[at], sizes[at])
            setattr(held, name, getattr(held, name)[cells])
        for name in self.PER_UNIT:
            setattr(held, name, getattr(held, name)[at])
        held.units = held.units.take(pa.array(at))
        return np.arange(len(at))


@lru_cache(maxsize=1)
def store(path_a: str, path_b: str) -> Store:
    return Store(tokenizers(path_a, path_b))


def spelled(ids: np.ndarray, counts: np.ndarray, spell: Gather, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which units are spelled by their tokens' bytes; unit i has counts[i] of the ids and sizes[i] bytes of data."""
    owners = np.repeat(np.arange(len(counts)), counts)
    fit = np.bincount(owners, spell.lengths[ids], len(counts)).astype(np.int64) == sizes
    got = np.frombuffer(spell(ids[fit[owners]]), np.uint8)
    bytes_of = np.repeat(np.arange(len(sizes)), sizes)
    kept = fit[bytes_of]
    fit[bytes_of[kept][got != data[kept]]] = False
    return fit


def align_slice(keys: pa.Array, texts: pa.Array, known: Store) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """(rows, distinct pairs, documents with each): a row has its counts, its digest and its pairs as (place, occurrences)."""
    data, borders = text_bytes(texts)
    filled = np.flatnonzero(np.diff(borders))
    sizes = np.diff(borders)[filled]
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    spaced = np.full(len(data) + len(filled), SPACE, np.uint8)
    inside = np.ones(len(spaced), bool)
    inside[starts] = False
    spaced[inside] = data
    cuts = unit_starts(spaced, starts)
    coded = binary_array(spaced, np.append(cuts, len(spaced))).dictionary_encode()
    at, codes = known.places(coded.dictionary), coded.indices.to_numpy()
    held = known.held
    owner = filled[np.searchsorted(starts, cuts, "right") - 1]  # row of each unit
    rows = len(texts)
    bad = np.zeros(rows, bool)
    bad[owner[~held.good[at][codes]]] = True
    kept = ~bad[owner]
    codes, owner = codes[kept], owner[kept]
    summed = {name: np.bincount(owner, getattr(held, name)[at][codes], rows).astype(np.int64) for name in held.COUNTS}
    n_links = held.n_links[at]
    cells, _ = entries((np.cumsum(held.n_links) - held.n_links)[at], n_links)
    distinct, place = np.unique(held.pairs[cells], return_inverse=True)
    both, times = np.unique(owner * len(at) + codes, return_counts=True)  # the distinct units of each row
    row, unit = np.divmod(both, max(1, len(at)))
    cells, which = entries((np.cumsum(n_links) - n_links)[unit], n_links[unit])
    linked = row[which] * len(distinct) + place[cells]
    order = np.argsort(linked, kind="stable")
    linked, many = linked[order], times[which][order]
    heads = np.flatnonzero(np.append(True, linked[1:] != linked[:-1])) if len(linked) else np.zeros(0, np.int64)
    many = np.add.reduceat(many, heads) if len(heads) else many
    row, place = np.divmod(linked[heads], max(1, len(distinct)))
    n_docs = np.bincount(place, minlength=len(distinct))
    offsets = pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32())
    text_sizes = held.text_sizes[at]
    text_at = (np.cumsum(held.text_sizes) - held.text_sizes)[at]
    digests, borders = [], np.searchsorted(owner, np.arange(rows + 1))
    for i in range(rows):
        own = codes[borders[i] : borders[i + 1]]
        if len(own):
            cells, _ = entries(text_at[own], text_sizes[own])
            digests.append(hashlib.sha256(held.text[cells[:-1]]).hexdigest())
        else:
            digests.append("")
    columns = {
        "key": keys,
        **{name: pa.array(values, pa.int64()) for name, values in summed.items()},
        "groups_sha256": pa.array(digests, pa.string()),
        "places": pa.ListArray.from_arrays(offsets, pa.array(place, pa.int32())),
        "times": pa.ListArray.from_arrays(offsets, pa.array(many, pa.int32())),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns)), distinct, n_docs


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", size: int = 3_000_000) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    ``n_a`` and ``n_b`` count the tokens of space + text by the tokenizers file ``path_a`` and the sentence-piece model
    ``path_b``; groups end where tokens of both end; links are the overlapping pairs of tokens. The count of an id pair
    is the number of rows that hold it linked; ``count_sum`` adds it over the links, ``n_best`` counts the links whose
    count no other partner of their A id exceeds. ``groups_sha256`` hashes the ids of all groups.

    Texts that are null or empty, or that a tokenizer does not spell byte by byte, have no tokens: zeros and ''.
    Rows that repeat a key are documents each; null keys stay null; an empty table gives no rows. ``size`` is the
    number of text bytes in a slice; a longer text is a slice of its own.
    """
    frame = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = frame.schema["key"].dataType.simpleString()

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = store(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for part in row_slices(batches, "text", size):
            rows, pairs, n_docs = align_slice(part.column(0), part.column(1), known)
            ends = pa.array([0, len(pairs)], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(values, kind)) for values, kind in ((pairs, pa.int64()), (n_docs, pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, pa.array([to_bytes(rows)], pa.binary())], ["slice", "pairs", "n_docs", "rows"])
            number += 1

    held = written(frame.mapInArrow(slices, "slice long, pairs array<long>, n_docs array<int>, rows binary"), "slices")
    sent = held.select("slice", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("place", "pair")).select("slice", "place", "pair.pairs", "pair.n_docs")
    counts = sent.groupBy("pairs").agg(F.sum("n_docs").alias("count"))
    size_b = _pieces(path_b)
    counts = written(counts.withColumn("a", F.floor(F.col("pairs") / size_b)), "counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    counts = counts.join(highest, "a").select("pairs", "count", (F.col("count") == F.col("highest")).alias("best"))
    back = sent.select("slice", "place", "pairs").join(counts, "pairs").groupBy("slice").agg(F.collect_list(F.struct("place", "count", "best")).alias("counts"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, known in zip(batch.column(0), batch.column(1)):
                rows = from_bytes(data.as_py())
                found = known.values if known.is_valid else None
                count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if found is not None:
                    place = found.field("place").to_numpy()
                    count, best = np.zeros((2, len(place)), np.int64)
                    count[place] = found.field("count").to_numpy()
                    best[place] = found.field("best").to_numpy(zero_copy_only=False)
                lists = rows.column(rows.schema.get_field_index("places"))
                place, many = lists.flatten().to_numpy(), rows.column(rows.schema.get_field_index("times")).flatten().to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(rows.num_rows), pc.list_value_length(lists).to_numpy())
                n_best, total = np.zeros((2, rows.num_rows), np.int64)
                np.add.at(n_best, owner, many * best[place])
                np.add.at(total, owner, many * count[place])
                columns = {**dict(zip(rows.schema.names, rows.columns)), "n_best": pa.array(n_best), "count_sum": pa.array(total)}
                yield pa.RecordBatch.from_arrays([columns[name] for name in OUTPUT], OUTPUT)

    joined = held.select("slice", "rows").join(back, "slice", "left").select("rows", "counts")
    schema = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return joined.mapInArrow(finish, schema).withColumnRenamed("key", key)


OUTPUT = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _pieces(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
