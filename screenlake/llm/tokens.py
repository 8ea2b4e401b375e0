"""Token ids of whole texts by a byte-level tokenizer: each distinct unit of a slice is encoded once.

A unit is a piece of text between places where every byte-level rule set in use starts a new pre-token: before a space
that follows a character that is not white space, on both sides of a line feed between two such characters, and
between a Latin letter or digit and a mark other than an apostrophe. Units are cut on bytes, coded by Arrow, and
looked up in a store that a worker keeps between slices; only new ones reach the tokenizer. Rows are then gathered
from the ids of their units.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from screenlake.llm.terms import binary_array, entries, row_slices, text_bytes

#: Bytes that byte-level vocabularies write as letters from U+0100 on, in order.
UNPRINTABLE = [*range(33), *range(127, 161), 173]

SPACE, FEED = 0x20, 0x0A
_BYTES = np.arange(256)
VISIBLE = (_BYTES > 0x20) & (_BYTES < 0x7F)
#: First bytes of the characters beyond ASCII that can be white space (U+0085, U+00A0, U+1680, U+2000 on, U+3000).
LEADS_2 = _BYTES == 0xC2
LEADS_3 = (_BYTES >= 0xE1) & (_BYTES <= 0xE3)


ALNUM = ((_BYTES | 32 >= 97) & (_BYTES | 32 <= 122) & (_BYTES < 128)) | ((_BYTES >= 48) & (_BYTES <= 57))
MARK = VISIBLE & ~ALNUM & (_BYTES != ord("'"))
#: Second bytes of the letters U+00C0 to U+00FF: all but the signs for times and divided by.
LATIN = (_BYTES >= 0x80) & (_BYTES < 0xC0) & (_BYTES != 0x97) & (_BYTES != 0xB7)


def mark_starts(data: np.ndarray) -> np.ndarray:
    """True where a mark follows a Latin letter or a digit."""
    out = np.zeros(len(data), bool)
    letter = ALNUM[data[:-1]]
    letter[1:] |= LATIN[data[1:-1]] & (data[:-2] == 0xC3)
    out[1:] = MARK[data[1:]] & letter
    return out


def unit_starts(data: np.ndarray, starts: np.ndarray, marks: bool = False) -> np.ndarray:
    """Places where units start, in ascending order; ``starts`` are the (distinct) places where texts start.

    ``marks`` also cuts in front of marks, which only byte-level rules do.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    before = np.zeros(len(data), bool)  # the character before is surely no white space
    before[1:] = VISIBLE[data[:-1]] | (data[:-1] >= 0x80)
    before[2:] &= ~((data[1:-1] >= 0x80) & LEADS_2[data[:-2]])
    before[3:] &= ~((data[2:-1] >= 0x80) & LEADS_3[data[:-3]])
    after = np.zeros(len(data), bool)  # so is the character that follows
    after[:-1] = VISIBLE[data[1:]] | ((data[1:] >= 0x80) & ~LEADS_2[data[1:]] & ~LEADS_3[data[1:]])
    cut = before & (data == SPACE)
    feeds = before & after & (data == FEED)
    feeds[starts[1:] - 1] = False  # the last byte of a text
    cut |= feeds
    cut[1:] |= feeds[:-1]
    if marks:
        cut |= mark_starts(data)
    cut[starts] = True
    return np.flatnonzero(cut)


def flat_ids(lists: list[list[int]], dtype=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and the length of each list."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype, int(counts.sum())), counts


class UnitEncoder:
    """Ids of texts from those of their units.

    ``encode_units`` maps an array of distinct units to their ids and how many each has. ``special`` are strings that
    become one id wherever they stand: slices that hold one are not cut at marks. Units and ids are kept up to about
    ``limit`` bytes; beyond that, only those of the last slice stay.
    """

    def __init__(self, encode_units: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], special: tuple[str, ...] = (), limit: int = 32_000_000):
        self.encode_units, self.limit = encode_units, limit
        if any(any(c.isspace() for c in token) for token in special):
            raise ValueError("special tokens with white space inside would be cut")
        self.special = [token.encode() for token in special]
        self.units = pa.array([], pa.binary())
        self.ids, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _places(self, units: pa.Array) -> np.ndarray:
        """Places of distinct units in the store; new ones are encoded together."""
        found = pc.index_in(units, value_set=self.units)
        fresh = units.filter(pc.is_null(found))
        at = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        if len(fresh):
            if self.units.nbytes + self.ids.nbytes + self.counts.nbytes + 4 * fresh.nbytes > self.limit:
                kept = at[at >= 0]
                cells, _ = entries((np.cumsum(self.counts) - self.counts)[kept], self.counts[kept])
                self.units, self.ids, self.counts = self.units.take(pa.array(kept)), self.ids[cells], self.counts[kept]
                at[at >= 0] = np.arange(len(kept))
            at[at < 0] = len(self.units) + np.arange(len(fresh))
            ids, counts = self.encode_units(fresh)
            self.units = pa.concat_arrays([self.units, fresh])
            self.ids, self.counts = np.concatenate([self.ids, ids.astype(np.uint32)]), np.concatenate([self.counts, counts])
        return at

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has the ids offsets[i]:offsets[i + 1]; a null text has none."""
        data, borders = text_bytes(texts)
        filled = np.flatnonzero(np.diff(borders))
        held = data.tobytes() if self.special else b""
        cuts = unit_starts(data, borders[filled], marks=not any(token in held for token in self.special))
        coded = binary_array(data, np.append(cuts, len(data))).dictionary_encode()
        at = self._places(coded.dictionary)[coded.indices.to_numpy()]
        sizes = self.counts[at]
        cells, _ = entries((np.cumsum(self.counts) - self.counts)[at], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[cells], ends[np.searchsorted(cuts, borders)]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        ids, offsets = self.flat(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        data = ids.astype("<u4").tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


@lru_cache(maxsize=1)
def library_encoder(path: str) -> UnitEncoder:
    """Encoder by the tokenizers library: no special tokens added, no truncation, no padding. One serves all tasks of a worker.

    New units travel in lines: a line feed between two characters that are not white space is a pre-token of its own,
    so a line of text holds many units, and each unit's ids are found by the bytes that ids stand for. Units that
    begin or end with white space, other than one space in front, go one by one.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    # The number of bytes of an id: byte-level vocabularies write each byte as one letter.
    widths = np.zeros(1 + max(tokenizer.get_vocab().values()), np.int64)
    for token, i in tokenizer.get_vocab().items():
        widths[i] = len(token.encode()) if token in special else len(token)
    feed = tokenizer.encode("\n", add_special_tokens=False).ids

    def one_by_one(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat_ids([coded.ids for coded in tokenizer.encode_batch_fast(units, add_special_tokens=False)], np.uint32)

    def together(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units that begin and end with characters that are no white space, but for one space in front."""
        lines = ["\n".join(units[i : i + 500]) for i in range(0, len(units), 500)]
        ids, of_lines = one_by_one(lines)
        sizes = np.fromiter((len(unit.encode()) + 1 for unit in units), np.int64, len(units))
        sizes[499::500] -= 1
        if len(units) % 500:
            sizes[-1] -= 1
        ends = np.searchsorted(np.cumsum(widths[ids]), np.cumsum(sizes)) + 1
        counts = np.diff(ends, prepend=0)
        if int(counts.sum()) != len(ids):
            raise ValueError("ids do not end where units end")
        split = np.ones(len(units), bool)  # followed by a line feed
        split[499::500] = False
        split[-1] = False
        kept = np.ones(len(ids), bool)
        kept[ends[split] - 1] = False
        if (ids[~kept] != feed[0]).any():
            raise ValueError("a unit reaches over its end")
        return ids[kept], counts - split

    def encode_units(units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, borders = text_bytes(units)
        first, last = borders[:-1], borders[1:] - 1
        head = data[np.where(data[first] == SPACE, np.minimum(first + 1, last), first)]
        end, before, third = (data[np.maximum(last - k, first)] for k in range(3))
        opened = VISIBLE[head] | ((head >= 0x80) & ~LEADS_2[head] & ~LEADS_3[head])
        closed = VISIBLE[end] | ((end >= 0x80) & ~LEADS_2[before] & ~LEADS_3[third])
        plain = opened & closed & (len(feed) == 1)
        words = units.cast(pa.string())
        groups = [(together, np.flatnonzero(plain)), (one_by_one, np.flatnonzero(~plain))]
        parts = [(at, *run(words.take(pa.array(at)).to_pylist())) for run, at in groups if len(at)]
        order, ids, counts = (np.concatenate([part[i] for part in parts]) for i in range(3))
        starts, sizes = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        starts[order], sizes[order] = np.cumsum(counts) - counts, counts
        return ids[entries(starts, sizes)[0]], sizes

    return UnitEncoder(encode_units, tuple(special))


def encoded(batches: Iterator[pa.RecordBatch], text: str, encoder: UnitEncoder, size: int = 8_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of whole rows with about ``size`` bytes of text, and the ids of their texts (null text: empty)."""
    for part in row_slices(batches, text, size):
        yield part, encoder.encode(part.column(part.schema.get_field_index(text)))
    pa.default_memory_pool().release_unused()  # a worker lives on when its task is done
