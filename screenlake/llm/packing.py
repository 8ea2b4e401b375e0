"""Best-fit-decreasing packing of token pieces into windows of a fixed size.

An overlong document is first cut into full windows and one rest. Best fit decreasing looks at sizes only, so it
runs on the number of pieces of each size: open windows are kept as runs by remaining capacity, and a segment tree
over the capacities finds the tightest one that still holds a piece. Every run of equal pieces that goes into a run
of equal windows is one line of the plan, so the plan is bounded by the window size, whatever the number of
documents. A piece then finds its window by its rank among the pieces of its size.

Ranks come from counts per (size, salt); a size that holds a third of all pieces is spread over the salts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.common import written
from screenlake.llm.tokens import encoded, library_encoder


class Line(NamedTuple):
    """``count`` pieces of ``size``, by rank from ``first``; ``each`` per window from ``window`` on, at ``offset``."""

    size: int
    first: int
    count: int
    each: int
    window: int
    offset: int


class CapacityTree:
    """Segment tree over remaining capacities; a leaf is set while some open window has that capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.set = [False] * (2 * self.leaves)

    def mark(self, capacity: int, present: bool) -> None:
        node = capacity + self.leaves
        self.set[node] = present
        while node > 1:
            node //= 2
            self.set[node] = self.set[2 * node] or self.set[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        """Smallest marked capacity of at least ``size``."""
        node = size + self.leaves
        if self.set[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.set[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.set[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Line], int]:
    """Lines of the best-fit-decreasing plan for ``counts`` pieces of each size, and the number of windows."""
    tree = CapacityTree(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> (first window, windows)
    lines: list[Line] = []
    windows = 0

    def keep(left: int, first: int, n: int) -> None:
        if left and n:
            runs.setdefault(left, []).append((first, n))
            tree.mark(left, True)

    for size in sorted(counts, reverse=True):
        rank, rest = 0, counts[size]
        while rest:
            room = tree.tightest(size)
            if room is None:
                room, each = capacity, capacity // size
                first, n = windows, -(-rest // each)
                windows += n
            else:
                each = room // size
                first, n = runs[room].pop()
                used = min(n, -(-rest // each))
                if used < n:
                    runs[room].append((first + used, n - used))
                if not runs[room]:
                    tree.mark(room, False)
                n = used
            take = min(rest, n * each)
            lines.append(Line(size, rank, take, each, first, capacity - room))
            full, over = divmod(take, each)
            keep(room - each * size, first, full)
            if over:
                keep(room - over * size, first + full, 1)
            rank, rest = rank + take, rest - take
    return lines, windows


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text", keep_ids: bool = True) -> DataFrame:
    """(key, start, length, doc_tokens, ids_crc32[, ids]): full windows and one rest per row, ``end_id`` appended."""
    frame = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = frame.schema["key"].dataType.simpleString()
    ending = np.asarray([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        for part, ids in encoded(batches, "text", encoder):
            rows, start, length, total, crc, kept = [], [], [], [], [], []
            for row, found in enumerate(ids):
                found += ending
                for at in range(0, len(found), step):
                    piece = found[at : at + step]
                    rows.append(row)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    total.append(len(found) // 4)
                    crc.append(zlib.crc32(piece))
                    kept.append(piece)
            columns = [part.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, total, crc))]
            names = ["key", "start", "length", "doc_tokens", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"key {kind}, start long, length long, doc_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    return frame.mapInArrow(run, schema).withColumnRenamed("key", key)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, key: str = "doc_id", text: str = "text",
    keep_ids: bool = True, rows_per_salt: int = 200_000,
) -> DataFrame:
    """Packs every row's ids, with ``end_id`` after them, into windows of ``capacity`` ids.

    Returns one row per piece: key, start (ids of the row before the piece), length, doc_tokens, ids_crc32,
    sequence_id and offset (place in the window), and ``ids`` as little-endian uint32 bytes unless ``keep_ids``
    is off. A null or empty text is one piece that holds only ``end_id``. Rows that repeat a key, or the whole
    row, are packed each on its own; null keys stay null. An empty table gives no rows. Pieces of equal size
    are interchangeable; which of them goes where follows (salt, key, start). Other columns are not read.
    """
    cut = written(pieces(docs, tokenizer, capacity, end_id, key, text, keep_ids), "pieces")
    salts = max(1, -(-cut.count() // rows_per_salt))
    narrow = [c for c in cut.columns if c != "ids"]
    cut = cut.withColumn("salt", F.pmod(F.xxhash64(*[cut[c] for c in narrow]), F.lit(salts)))
    sizes = cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
    sizes = written(sizes, "sizes")
    counts = {int(r["length"]): int(r["n"]) for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    lines, _ = plan(counts, capacity)
    order = Window.partitionBy("length", "salt").orderBy(*[F.col(c) for c in narrow if c != "length"])
    ranked = cut.withColumn("rank", F.row_number().over(order) - F.lit(1))
    ranked = ranked.join(sizes.select("length", "salt", "before"), ["length", "salt"]).withColumn("rank", (F.col("rank") + F.col("before")).cast("long"))
    ranked = ranked.select(*cut.columns[:-1], "rank")
    return _place(ranked, lines)


def _place(ranked: DataFrame, lines: list[Line]) -> DataFrame:
    """Adds window and offset by binary search in the plan; the plan is bounded by the window size."""
    by_size: dict[int, np.ndarray] = {}
    for line in lines:
        by_size.setdefault(line.size, []).append(line[1:])
    by_size = {size: np.asarray(rows, np.int64).T for size, rows in by_size.items()}
    names = ranked.columns
    length_at, rank_at = names.index("length"), names.index("rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(length_at).to_numpy()
            rank = batch.column(rank_at).to_numpy()
            window, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                first, _, each, start, base = by_size[int(size)]
                own = np.flatnonzero(length == size)
                line = np.searchsorted(first, rank[own], "right") - 1
                nth = rank[own] - first[line]
                window[own] = start[line] + nth // each[line]
                offset[own] = base[line] + nth % each[line] * size
            kept = [c for i, c in enumerate(batch.columns) if i != rank_at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(window), pa.array(offset)], [*(n for n in names if n != "rank"), "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")
