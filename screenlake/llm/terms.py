"""Words of letters and digits of whole texts as coded arrays, found on bytes without a Python string per word.

A word is a maximal run of ASCII letters, ASCII digits and anything beyond ASCII; only A-Z are lower-cased. Null
texts have no words, and no word reaches over the end of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = ((LOWER >= 97) & (LOWER <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57)) | (_BYTES >= 128)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; text i is bytes[offsets[i]:offsets[i + 1]], empty for null."""
    full = pc.fill_null(texts, "")
    width = np.int64 if pa.types.is_large_string(full.type) or pa.types.is_large_binary(full.type) else np.int32
    offsets = np.frombuffer(full.buffers()[1], width)[full.offset : full.offset + len(full) + 1].astype(np.int64)
    data = full.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values data[offsets[i]:offsets[i + 1]]."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes, dictionary, offsets): text i has the words dictionary[codes[offsets[i]:offsets[i + 1]]], in order."""
    data, ends = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.int32), pa.array([], pa.binary()), np.zeros(len(texts) + 1, np.int64)
    inside = IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = ends[:-1][np.diff(ends) > 0]
    first[borders] = inside[borders]
    letters = LOWER[data][inside]
    starts = np.flatnonzero(first[inside])
    coded = binary_array(letters, np.append(starts, len(letters))).dictionary_encode()
    offsets = np.searchsorted(np.flatnonzero(first), ends)
    return coded.indices.to_numpy(), coded.dictionary, offsets


def entries(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of several runs, in order, and the number of the run of each."""
    owners = np.repeat(np.arange(len(sizes)), sizes)
    shift = starts - (np.cumsum(sizes) - sizes)
    return np.arange(len(owners)) + shift[owners], owners


def row_slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with whole rows and about ``size`` bytes of text each; a longer text is a part of its own."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
