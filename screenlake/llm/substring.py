"""Removal of passages that occur earlier in the corpus, with a count-min prefilter.

A window is ``width`` consecutive words of one row. Each window is counted in the sketch by its anchor, the run of
``width // 2`` words in it with the smallest hash: equal windows have equal anchors, so the count of an anchor is
never below that of its windows, and neighbouring windows share anchors, which keeps the sketch small. Sketches of
the parts are merged by adding their counters (up to 2); the smallest of an anchor's counters overestimates its
count. Only windows whose anchor is estimated to repeat enter the second pass, which groups them exactly, by 128-bit
hashes of their words. No window that repeats is lost.

Sketches are kept and sent sparsely and their width follows the number of words, so the share of false repeats is
the same at every size; no task holds a whole sketch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.chunks import chunk_table, exchange, from_bytes, hashed_words, packed, split_words, unpacked
from screenlake.llm.common import mix64, rolled

LAST = np.iinfo(np.int64).max


class Windows:
    """Words, windows and anchors of a chunk."""

    def __init__(self, data: bytes, width: int):
        self.rows = from_bytes(data)
        self.words = split_words(self.rows.column(1))
        offsets = self.words.offsets.to_numpy().astype(np.int64)
        counts = np.diff(offsets)
        hashes = hashed_words(self.words.values)
        self.row_of = np.repeat(np.arange(len(counts)), counts)
        ends = np.repeat(offsets[1:], counts)
        self.starts = np.flatnonzero(np.arange(len(hashes)) + width <= ends)
        self.hashes, self.width = hashes, width
        gram = max(1, width // 2)
        if len(self.starts):
            grams = rolled(hashes, gram, 3)
            view = np.lib.stride_tricks.sliding_window_view(grams, width - gram + 1)
            anchor = self.starts + view.argmin(axis=1)[self.starts]
            places, self.anchor = np.unique(anchor, return_inverse=True)
            self.anchor_hash = grams[places]
        else:
            self.anchor, self.anchor_hash = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        keys = self.rows.column(0)
        self.keys = pc.fill_null(keys, LAST).to_numpy()

    def counters(self, row: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct counters of the anchors in a sketch row, the counter of each anchor, and the counts."""
        return np.unique(mix64(self.anchor_hash + np.uint64((row + 1) * 0xA0761D6478BD642F % 2**64)) >> np.uint64(64 - bits), return_inverse=True, return_counts=True)

    def candidates(self, repeated: np.ndarray) -> dict[str, np.ndarray]:
        """Windows with a repeated anchor, sorted by hash, then key and place: hashes, starts, first of each hash."""
        chosen = self.starts[repeated[self.anchor]] if len(self.starts) else self.starts
        if not len(chosen):
            none = np.zeros(0, np.uint64)
            return {"one": none, "two": none, "starts": chosen, "first": np.zeros(0, bool), "group": chosen}
        one, two = rolled(self.hashes, self.width, 1)[chosen], rolled(self.hashes, self.width, 2)[chosen]
        order = np.lexsort((chosen, self.keys[self.row_of[chosen]], two, one))
        one, two, chosen = one[order], two[order], chosen[order]
        first = np.ones(len(one), bool)
        first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        return {"one": one, "two": two, "starts": chosen, "first": first, "group": np.cumsum(first) - 1}


def bits_of(answers: list[dict], lengths: list[tuple[int, int]]) -> np.ndarray:
    """Answers of the blocks (block, entries sent) in order, as one array of flags."""
    by_block = {a["block"]: a["mask"] for a in answers or []}
    parts = [np.unpackbits(np.frombuffer(by_block[block], np.uint8), count=n).astype(bool) for block, n in lengths if n]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def cuts(values: np.ndarray, bits: int, blocks: int) -> np.ndarray:
    """Where sorted ``bits``-bit values pass from one block to the next."""
    borders = np.array([(b << bits) // blocks for b in range(1, blocks)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(values, borders), [len(values)]]).astype(np.int64)


def flag_repeats(
    frame: DataFrame, width: int = 20, depth: int = 2, counters_per_anchor: int = 8, words_per_block: int = 2_000_000,
) -> tuple[DataFrame, int]:
    """Chunks of ``frame`` (key, text, others) with the answers of both passes, and the block count."""
    chunks = chunk_table(frame, "text")
    total = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    anchors = 2 * total // max(1, width - max(1, width // 2) + 2) + 1  # expected density of window minima
    bits = max(16, int(anchors * counters_per_anchor - 1).bit_length())
    blocks = max(1, -(-total // words_per_block))

    def send_sketch(row: dict) -> Iterator[tuple[int, bytes]]:
        windows = Windows(row["data"], width)
        for level in range(depth):
            counters, _, counts = windows.counters(level, bits)
            at = cuts(counters, bits, blocks)
            for block in range(blocks):
                own, n = counters[at[block] : at[block + 1]], counts[at[block] : at[block + 1]]
                if len(own):
                    own = np.repeat(own, np.minimum(n, 2))
                    yield level * blocks + block, packed(np.diff(own, prepend=np.uint64(0)).astype("<u8" if bits > 32 else "<u4"))

    def merge_sketch(_, messages: list[bytes]) -> Iterator[bytes]:
        own = [np.cumsum(unpacked(m, "<u8" if bits > 32 else "<u4").astype(np.uint64)) for m in messages]
        counters, counts = np.unique(np.concatenate(own), return_counts=True)
        repeated = counters[counts > 1]
        for each in own:
            each = np.unique(each)
            at = np.minimum(np.searchsorted(repeated, each), max(len(repeated) - 1, 0))
            yield np.packbits(repeated[at] == each if len(repeated) else np.zeros(len(each), bool)).tobytes()

    sketched = chunks.join(exchange(chunks, send_sketch, merge_sketch, "sketch"), "chunk", "left")

    def send_windows(row: dict) -> Iterator[tuple[int, bytes]]:
        windows = Windows(row["data"], width)
        found = windows.candidates(estimated(windows, row["sketch"], depth, bits, blocks))
        head = np.flatnonzero(found["first"])
        keys = windows.keys[windows.row_of[found["starts"][head]]] if len(head) else head
        at = cuts(found["one"][head], 64, blocks)
        for block in range(blocks):
            part = slice(at[block], at[block + 1])
            if at[block] < at[block + 1]:
                hashes = np.concatenate([found["one"][head][part], found["two"][head][part]]).astype("<u8").tobytes()
                yield block, len(hashes).to_bytes(8, "little") + hashes + packed(keys[part].astype("<i8"))

    def merge_windows(numbers: list[int], messages: list[bytes]) -> Iterator[bytes]:
        sizes = [int.from_bytes(m[:8], "little") for m in messages]
        hashes = [np.frombuffer(m, "<u8", n // 8, 8) for m, n in zip(messages, sizes)]
        one = np.concatenate([h[: len(h) // 2] for h in hashes])
        two = np.concatenate([h[len(h) // 2 :] for h in hashes])
        keys = np.concatenate([unpacked(m[8 + n :], "<i8") for m, n in zip(messages, sizes)])
        source = np.repeat(np.arange(len(messages)), [len(h) // 2 for h in hashes])
        order = np.lexsort((source, keys, two, one))
        one, two = one[order], two[order]
        first = np.ones(len(one), bool)
        first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        flags = np.empty(len(one), bool)
        flags[order] = first
        for part in np.split(flags, np.cumsum([len(h) // 2 for h in hashes])[:-1]):
            yield np.packbits(part).tobytes()

    answered = exchange(sketched, send_windows, merge_windows, "windows")
    return sketched.join(answered, "chunk", "left"), (depth, bits, blocks)


def estimated(windows: Windows, answers: list[dict] | None, depth: int, bits: int, blocks: int) -> np.ndarray:
    """Whether the smallest counter of each anchor is above 1."""
    repeated = np.ones(len(windows.anchor_hash), bool)
    for level in range(depth):
        counters, counter, _ = windows.counters(level, bits)
        at = cuts(counters, bits, blocks)
        lengths = [(level * blocks + b, int(at[b + 1] - at[b])) for b in range(blocks)]
        flags = bits_of(answers, lengths)
        if len(flags):
            repeated &= flags[counter]
    return repeated


def remove_repeats(docs: DataFrame, width: int = 20, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), **limits) -> DataFrame:
    """(key, n_words, n_removed, text[, carried columns]): words outside repeated windows, joined by one space.

    A word goes if it lies in a window whose words also start earlier: in a row with a smaller key, or earlier
    in the same row. Windows are judged on the input. A null text has no words and becomes empty; rows shorter
    than a window stay whole. Null keys come after all others. Rows that repeat a key count as earlier or later
    by their place in the input files. An empty table gives no rows; columns that are not named are not read.
    """
    frame = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"), *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    flagged, (depth, bits, blocks) = flag_repeats(frame, width, **limits)
    others = [f for f in frame.schema if f.name.startswith("carry_")]
    schema = ", ".join(["key long, n_words long, n_removed long, text string", *(f"{f.name} {f.dataType.simpleString()}" for f in others)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(batch.schema.get_field_index(n))[i].as_py() for n in ("data", "sketch", "windows")}
                windows = Windows(row["data"], width)
                found = windows.candidates(estimated(windows, row["sketch"], depth, bits, blocks))
                head = np.flatnonzero(found["first"])
                at = cuts(found["one"][head], 64, blocks)
                earliest = bits_of(row["windows"], [(b, int(at[b + 1] - at[b])) for b in range(blocks)])
                later = found["starts"][~found["first"] | ~earliest[found["group"]]] if len(head) else head
                change = np.zeros(len(windows.hashes) + 1, np.int64)
                np.add.at(change, later, 1)
                np.add.at(change, later + width, -1)
                kept = np.cumsum(change[:-1]) == 0
                offsets = windows.words.offsets.to_numpy()
                left = np.concatenate([[0], np.cumsum(kept)])[offsets]
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), windows.words.values.filter(pa.array(kept))), " ")
                n_words, n_left = np.diff(offsets).astype(np.int64), np.diff(left).astype(np.int64)
                columns = [windows.rows.column(0), pa.array(n_words), pa.array(n_words - n_left), texts, *windows.rows.columns[2:]]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_removed", "text", *(f.name for f in others)])

    result = flagged.mapInArrow(run, schema)
    return result.select(F.col("key").alias(key), "n_words", "n_removed", F.col("text").alias(text), *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)])
