"""Chunks: bounded batches of whole rows that travel as one binary value and talk to each other through blocks.

A chunk sends every block (a range of a hash space) one packed message; the task that merges a block answers each
chunk with one bit per entry it sent. Messages hold one entry per distinct key of the chunk, so a hot key costs one
entry per chunk, and the number of blocks grows with the corpus, so that a block stays bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import word_hashes, written

COLUMNS = "chunk long, n_words long, data binary"


def to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.RecordBatch:
    batches = list(pa.ipc.open_stream(data))
    return batches[0]


def split_words(texts: pa.Array) -> pa.ListArray:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; null texts have none."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values, offsets = cut.values, cut.offsets.to_numpy()
    full = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(full)])[offsets]
    return pa.ListArray.from_arrays(pa.array(kept, pa.int32()), values.filter(pa.array(full)))


def hashed_words(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word of a flat array; each distinct word is hashed once."""
    coded = words.dictionary_encode()
    distinct = word_hashes([w.encode() for w in coded.dictionary.to_pylist()])
    return distinct[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def chunk_table(frame: DataFrame, text: str, chars: int = 4_000_000) -> DataFrame:
    """Rows of ``frame`` in chunks of about ``chars`` characters: (chunk, n_words, data), written.

    A row longer than that is a chunk of its own. ``data`` holds the rows with all their columns.
    """
    names = frame.columns
    text_at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy() + 1)
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + chars, "right")))
                part = batch.slice(start, stop - start)
                n_words = len(split_words(part.column(text_at)).values)
                row = [pa.array([number], pa.int64()), pa.array([n_words], pa.int64()), pa.array([to_bytes(part)], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, ["chunk", "n_words", "data"])
                number += 1
                start = stop

    return written(frame.mapInArrow(run, COLUMNS), "chunks")


def packed(array: np.ndarray) -> bytes:
    return zstandard.compress(array.tobytes(), 1)


def unpacked(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def exchange(
    chunks: DataFrame,
    send: Callable[[dict], Iterator[tuple[int, bytes]]],
    merge: Callable[[list[int], list[bytes]], Iterator[bytes]],
    name: str,
) -> DataFrame:
    """(chunk, ``name``): answers of all blocks to each chunk, as an array of (block, mask), written.

    ``send`` gets a row of ``chunks`` as a dict and yields (block, message); ``merge`` gets all messages of a
    block, by ascending chunk, and yields an answer for each.
    """
    names = chunks.columns

    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in zip(names, batch.columns)}
                found = list(send(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found], pa.int64()), pa.array([row["chunk"]] * len(found), pa.int64()), pa.array([m for _, m in found], pa.binary())],
                    ["block", "chunk", "message"],
                )

    def answers(rows):
        import pandas as pd

        rows = rows.sort_values("chunk")
        return pd.DataFrame({"block": rows["block"], "chunk": rows["chunk"], "mask": list(merge(list(rows["chunk"]), list(rows["message"])))})

    sent = chunks.mapInArrow(messages, "block long, chunk long, message binary")
    back = sent.groupBy("block").applyInPandas(answers, "block long, chunk long, mask binary")
    return written(back.groupBy("chunk").agg(F.collect_list(F.struct("block", "mask")).alias(name)), name)
