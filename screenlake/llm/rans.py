"""Token ids in files coded by a static range asymmetric numeral system.

One frequency table, counted over all ids and scaled to 2^20, is shared by all blocks. A block holds whole rows;
its ids are dealt over interleaved lanes that share one stream of 32-bit words. Every few steps a block keeps the
states of all lanes and the place in the stream (a checkpoint) with a checksum of the ids up to the next, so that a
reader can start anywhere and check what it has read. Blocks do not depend on each other.

Files are written by Spark's text sink, one framed block per line (frames carry their length, so the bytes are
free), and therefore commit atomically on any file system that Spark writes to.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm.common import written
from screenlake.llm.tokens import encoded, library_encoder
from screenlake.session import scratch_path

SCALE = 20
LOW = np.uint64(1 << 31)
MAGIC = b"RANS"
HEAD = struct.Struct("<4sIIIQII")  # magic, payload bytes, range, rows, start in the range, ids, lanes


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^SCALE, at least 1 each."""
    total = 1 << SCALE
    counts = np.asarray(counts, np.float64)
    freq = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * (total - len(counts)))).astype(np.int64)
    over = int(freq.sum()) - total
    order = np.argsort(-freq, kind="stable")
    if over < 0:
        freq[order[0]] -= over
    for i in order:
        if over <= 0:
            break
        cut = min(over, int(freq[i]) - 1)
        freq[i] -= cut
        over -= cut
    return freq


class Coder:
    """Vectorised coder: numpy steps over all lanes at once."""

    def __init__(self, freq: np.ndarray, steps_per_checkpoint: int = 128):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.gap = steps_per_checkpoint

    def encode(self, ids: np.ndarray, lanes: int) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]:
        """Stream of words and checkpoints (word place, crc32 of the ids up to the next, lane states)."""
        steps = -(-len(ids) // lanes)
        state = np.full(lanes, LOW, np.uint64)
        words: list[np.ndarray] = []
        marks = []
        emitted = 0
        for step in range(steps - 1, -1, -1):
            row = ids[step * lanes : (step + 1) * lanes]
            f, x = self.freq[row], state[: len(row)]
            full = x >= (f << np.uint64(63 - SCALE))
            if full.any():
                out = x[full].astype(np.uint32)
                words.append(out)
                emitted += len(out)
                x[full] >>= np.uint64(32)
            q, r = np.divmod(x, f)
            state[: len(row)] = (q << np.uint64(SCALE)) + r + self.start[row]
            if step % self.gap == 0:
                part = ids[step * lanes : (step + self.gap) * lanes]
                marks.append((emitted, zlib.crc32(part.astype("<u4").tobytes()), state.copy()))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        return stream, [(emitted - at, crc, states) for at, crc, states in reversed(marks)]

    def decode(self, stream: np.ndarray, mark: tuple[int, int, np.ndarray], n: int) -> np.ndarray:
        """``n`` ids from one checkpoint on; raises if their checksum differs."""
        place, crc, state = mark
        lanes, state = len(state), state.copy()
        out = np.empty(n, np.uint32)
        mask = np.uint64((1 << SCALE) - 1)
        for at in range(0, n, lanes):
            width = min(lanes, n - at)
            x = state[:width]
            slot = x & mask
            ids = self.symbol[slot]
            out[at : at + width] = ids
            x = self.freq[ids] * (x >> np.uint64(SCALE)) + slot - self.start[ids]
            low = np.flatnonzero(x < LOW)
            if len(low):
                x[low] = (x[low] << np.uint64(32)) | stream[place : place + len(low)]
                place += len(low)
            state[:width] = x
        if zlib.crc32(out.astype("<u4").tobytes()) != crc:
            raise ValueError("checksum of a block segment differs")
        return out


def frame_block(coder: Coder, lanes: int, part: int, start: int, keys: list, rows: list[np.ndarray]) -> bytes:
    """One block: header, keys and lengths, checkpoints, stream, crc32, line feed."""
    ids = np.concatenate(rows)
    lanes = max(1, min(lanes, len(ids) // 64 or 1))
    stream, marks = coder.encode(ids, lanes)
    index = zlib.compress(json.dumps([keys, [len(r) for r in rows]]).encode(), 1)
    checkpoints = b"".join(struct.pack("<QI", at, crc) + states.astype("<u8").tobytes() for at, crc, states in marks)
    payload = struct.pack("<III", len(index), len(marks), len(stream)) + index + checkpoints + stream.astype("<u4").tobytes()
    return HEAD.pack(MAGIC, len(payload), part, len(rows), start, len(ids), lanes) + payload + struct.pack("<I", zlib.crc32(payload)) + b"\n"


def frames(content: bytes) -> Iterator[tuple[tuple, memoryview]]:
    """(header, payload) of each block of a file; checks magic and checksum."""
    view, at = memoryview(content), 0
    while at < len(view):
        head = HEAD.unpack_from(view, at)
        if head[0] != MAGIC:
            raise ValueError("not a block")
        payload = view[at + HEAD.size : at + HEAD.size + head[1]]
        at += HEAD.size + head[1] + 5
        if zlib.crc32(payload) != struct.unpack_from("<I", view, at - 5)[0]:
            raise ValueError("checksum of a block differs")
        yield head, payload


def read_block(coder: Coder, head: tuple, payload: memoryview) -> tuple[list, np.ndarray, np.ndarray]:
    """(keys, lengths, ids) of a block."""
    _, _, _, _, _, n, lanes = head
    n_index, n_marks, n_words = struct.unpack_from("<III", payload)
    keys, lengths = json.loads(zlib.decompress(payload[12 : 12 + n_index]))
    at = 12 + n_index
    marks = []
    for _ in range(n_marks):
        place, crc = struct.unpack_from("<QI", payload, at)
        marks.append((place, crc, np.frombuffer(payload, "<u8", lanes, at + 12)))
        at += 12 + 8 * lanes
    stream = np.frombuffer(payload, "<u4", n_words, at).astype(np.uint64)
    size = coder.gap * lanes
    parts = [coder.decode(stream, mark, min(size, n - i * size)) for i, mark in enumerate(marks)]
    return keys, np.asarray(lengths, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint32)


@lru_cache(maxsize=1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One pair of contexts per worker: they cost more than what most rows hold."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeezed(ids: bytes) -> bytes:
    """uint32 ids as zstd-compressed bytes: all low halves, then all high halves."""
    return _zstd()[0].compress(np.ascontiguousarray(np.frombuffer(ids, "<u2").reshape(-1, 2).T).tobytes())


def spread(data: bytes) -> np.ndarray:
    """Inverse of ``squeezed``, as an array."""
    halves = np.frombuffer(_zstd()[1].decompress(data), "<u2").reshape(2, -1).astype(np.uint32)
    return halves[0] | halves[1] << np.uint32(16)


def token_table(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of whole texts by the tokenizers library, ``end_id`` appended; ids are packed by ``squeezed``."""
    frame = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    ending = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        for part, ids in encoded(batches, "text", encoder, size=4_000_000):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([squeezed(x + ending) for x in ids], pa.binary())], ["key", "ids"])

    return frame.mapInArrow(run, "key long, ids binary")


def id_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """Count of every id: summed per task first, then over the tasks; one row per id reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = [spread(ids.as_py()) for ids in batch.column(0).slice(start, 256)]
                found = np.bincount(np.concatenate(rows), minlength=vocabulary)
                if len(found) > vocabulary:
                    raise ValueError("an id is outside the vocabulary")
                counts += found
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int = 2, key: str = "doc_id", text: str = "text",
    ids_per_block: int = 1 << 19, lanes: int = 2048, blocks_per_file: int = 64,
) -> None:
    """Writes ``docs`` as coded ids in ascending key order: ``<folder>/blocks`` and the table in ``<folder>/table``.

    A null or empty text is the end id alone. Null keys come first; rows that repeat a key follow each other in
    the order of their ids. A row longer than a block makes a block of its own. An empty table writes a table and
    no block. Other columns are not read. A hot key range is no problem: ranges are cut by sampling, on (key, ids hash).
    """
    spark = docs.sparkSession
    tokens = written(token_table(docs, tokenizer, end_id, key, text), "tokens")
    freq = scaled(id_counts(tokens, vocabulary))
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq)], "id long, freq long").coalesce(1).write.parquet(f"{folder}/table")
    ordered = tokens.withColumn("tie", F.xxhash64("ids")).repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = Coder(freq), TaskContext.get().partitionId()
        keys, rows, size, start = [], [], 0, 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([frame_block(coder, lanes, part, start, keys, rows)[:-1]], pa.binary())], ["block"])

        for batch in batches:
            for key_, ids in zip(batch.column(0), batch.column(1)):
                data = spread(ids.as_py())
                if rows and size + len(data) > ids_per_block:
                    yield block()
                    start += size
                    keys, rows, size = [], [], 0
                keys.append(key_.as_py())
                rows.append(data)
                size += len(data)
        if rows:
            yield block()

    blocks = ordered.mapInArrow(run, "block binary").select(F.col("block").cast("string"))
    blocks.write.option("maxRecordsPerFile", blocks_per_file).option("lineSep", "\n").text(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids): rows of all files; ``start`` counts the ids of all rows before."""
    table = spark.read.parquet(f"{folder}/table").collect()  # one row per id of the vocabulary
    freq = np.zeros(len(table), np.int64)
    for row in table:
        freq[row["id"]] = row["freq"]
    files = spark.read.format("binaryFile").load(f"{folder}/blocks").select("content")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [head for content in batch.column(0) for head, _ in frames(content.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([h[2] for h in heads], pa.int64()), pa.array([h[5] for h in heads], pa.int64())], ["part", "n"])

    sums = files.mapInArrow(totals, "part long, n long").groupBy("part").agg(F.sum("n").alias("n")).collect()  # one row per range
    before, total = {}, 0
    for row in sorted(sums):
        before[row["part"]] = total
        total += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for content in batch.column(0):
                for head, payload in frames(content.as_py()):
                    keys, lengths, ids = read_block(coder, head, payload)
                    ends = np.cumsum(lengths)
                    data = ids.astype("<u4").tobytes()
                    texts = [data[4 * (e - n) : 4 * e] for e, n in zip(ends, lengths)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(ends - lengths + head[4] + before[head[2]]), pa.array(lengths), pa.array(texts, pa.binary())],
                        ["key", "start", "n_tokens", "ids"],
                    )

    return files.mapInArrow(run, "key long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes ``docs`` to a fresh shared folder and returns what the files hold (see ``read_ids``)."""
    folder = scratch_path(docs.sparkSession, "ids")
    write_ids(docs, folder, tokenizer, vocabulary, end_id, key, text)
    return read_ids(docs.sparkSession, folder).withColumnRenamed("key", key)
