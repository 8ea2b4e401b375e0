"""Byte-pair encoding by a pair occurrence index, and decoding by gathering token bytes.

Encoding: the distinct words of a slice of a partition are laid out as one row of symbols. An index maps each
adjacent pair that has a merge rank to all its positions. Active ranks are applied in ascending order; a merge
rewrites all positions of its pair from left to right and enters the pairs it creates with their neighbours.
A merge can only create pairs of higher rank (the merged symbol has to exist first), so one pass is enough.

Null texts count as empty and have no ids. Special tokens that the tokenizer file lists are cut out of the text
first, as the library does. Repeated rows and very long texts need no care: rows are independent of each other,
and words are cut before they are indexed.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from screenlake.llm.terms import row_slices, text_bytes
from screenlake.llm.tokens import UNPRINTABLE, UnitEncoder, encoded, flat_ids

#: Pre-token rule of byte-level tokenizers (fixed values).
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    return [chr(256 + UNPRINTABLE.index(b)) if b in UNPRINTABLE else chr(b) for b in range(256)]


class Vocabulary:
    """Merges, byte symbols and token bytes of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, letters = content["model"], byte_letters()
        ids = model["vocab"]
        self.byte_ids = [ids[letter] for letter in letters]
        #: (left id, right id) -> (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        back = {letter: byte for byte, letter in enumerate(letters)}
        size = 1 + max([*ids.values(), *(t["id"] for t in content["added_tokens"])])
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.special_rule = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None


def encode_index(words: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Ids of each word: all words share one pair occurrence index."""
    merges, byte_ids = vocabulary.merges, vocabulary.byte_ids
    symbols: list[int] = []
    starts = []
    for word in words:
        starts.append(len(symbols))
        symbols.extend([byte_ids[b] for b in word])
        symbols.append(-1)  # a border: no pair reaches over it
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    places: dict[int, list[int]] = {}
    known: dict[int, tuple[int, int, int]] = {}
    for place, pair in enumerate(zip(symbols, symbols[1:])):
        if pair in merges:
            rank, merged = merges[pair]
            if rank not in places:
                places[rank] = []
                known[rank] = (*pair, merged)
            places[rank].append(place)
    active = list(places)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        left, right, merged = known[rank]
        for place in sorted(places.pop(rank)):
            follower = after[place]
            if symbols[place] != left or symbols[follower] != right:
                continue  # an earlier merge took one of the two
            symbols[place], symbols[follower] = merged, -2
            beyond = after[follower]
            after[place], before[beyond] = beyond, place
            ahead = before[place]
            for at, pair in ((ahead, (symbols[ahead], merged)), (place, (merged, symbols[beyond]))):
                if at >= 0 and pair in merges:
                    new, result = merges[pair]
                    if new not in places:
                        places[new] = []
                        known[new] = (*pair, result)
                        heapq.heappush(active, new)
                    places[new].append(at)
    out = []
    for start, word in zip(starts, words):
        ids, place = [], start
        while symbols[place] != -1:
            ids.append(symbols[place])
            place = after[place]
        out.append(ids)
    return out


@lru_cache(maxsize=1)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def index_encoder(path: str) -> UnitEncoder:
    """Encoder whose new units are cut into pre-tokens, of which the distinct ones share one pair occurrence index."""
    vocabulary = vocabulary_of(path)
    special = vocabulary.special

    def cut(unit: str) -> list[str]:
        if not any(token in unit for token in special):
            return PRETOKEN.findall(unit)
        parts = vocabulary.special_rule.split(unit)
        return [token for part in parts for token in ([part] if part in special else PRETOKEN.findall(part))]

    def encode_units(units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        tokens = [cut(unit) for unit in units.cast(pa.string()).to_pylist()]
        fresh = list(dict.fromkeys(chain.from_iterable(tokens)))
        found = encode_index([b"" if t in special else t.encode() for t in fresh], vocabulary)
        known = {t: [special[t]] if t in special else ids for t, ids in zip(fresh, found)}
        return flat_ids([known[each[0]] if len(each) == 1 else list(chain.from_iterable(map(known.__getitem__, each))) for each in tokens], np.uint32)

    return UnitEncoder(encode_units, tuple(special))


class Gather:
    """Concatenates table entries by id: decoded bytes, or any text per id."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends) or not ends[-1]:
            return b""
        places = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[places].tobytes()


@lru_cache(maxsize=1)
def speller(path: str) -> Gather:
    """Bytes of ids."""
    return Gather(vocabulary_of(path).token_bytes)


@lru_cache(maxsize=1)
def decimals(size: int) -> Gather:
    """Decimal ids with a comma behind each."""
    return Gather([b"%d," % i for i in range(size)])


def spelled_texts(ids: np.ndarray, offsets: np.ndarray, spell: Gather) -> list[str]:
    """Text of each run of ids; bytes that are no UTF-8 become U+FFFD."""
    data = spell(ids)
    ends = np.concatenate([[0], np.cumsum(spell.lengths[ids])])[offsets].tolist()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def digests(ids: np.ndarray, offsets: np.ndarray, texts: list[str], decimal: Gather) -> tuple[list[str], list[str]]:
    """SHA-256 of the decimal ids of each run, joined by commas, and of each text."""
    data = decimal(ids)
    ends = np.concatenate([[0], np.cumsum(decimal.lengths[ids])])[offsets].tolist()
    of_ids = [hashlib.sha256(data[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends, ends[1:])]
    return of_ids, [hashlib.sha256(text.encode()).hexdigest() for text in texts]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): ``ids`` are little-endian uint32 bytes of the whole text; one row per row of ``docs``.

    A null text has no ids; rows that repeat are encoded each; an empty table gives no rows.
    """
    frame = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids in encoded(batches, "text", index_encoder(path)):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["key", "ids"])

    return frame.mapInArrow(run, f"key {frame.schema['key'].dataType.simpleString()}, ids binary").withColumnRenamed("key", key)


def flat_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of little-endian uint32 bytes; null has none."""
    data, borders = text_bytes(column.fill_null(b""))
    return np.frombuffer(data.tobytes(), "<u4"), borders // 4


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, text): bytes of the tokens joined; bytes that are no UTF-8 become U+FFFD.

    Null ids count as none; rows that repeat are decoded each; an empty table gives no rows.
    """
    frame = encoded.select(encoded[key].alias("key"), encoded["ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "ids"):
            texts = spelled_texts(*flat_binary(part.column(1)), speller(path))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["key", "ids", "text"])

    kind = frame.schema["key"].dataType.simpleString()
    return frame.mapInArrow(run, f"key {kind}, ids binary, text string").withColumnRenamed("key", key)


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def id_digests(decoded: DataFrame, vocabulary_size: int, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of decoded rows; ids are hashed as decimals joined by commas."""
    frame = decoded.select(decoded[key].alias("key"), "ids", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "ids"):
            ids, offsets = flat_binary(part.column(1))
            columns = digests(ids, offsets, part.column(2).to_pylist(), decimals(vocabulary_size))
            yield _digest_batch(part.column(0), offsets, columns)

    return frame.mapInArrow(run, f"key {frame.schema['key'].dataType.simpleString()}, {DIGESTS}").withColumnRenamed("key", key)


def _digest_batch(keys: pa.Array, offsets: np.ndarray, columns: tuple[list[str], list[str]]) -> pa.RecordBatch:
    arrays = [keys, pa.array(np.diff(offsets), pa.int64()), *(pa.array(c, pa.string()) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, ["key", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_digests`` of ``decode`` of ``encode`` in one pass: a slice is encoded, decoded and hashed by the same worker.

    Null and empty texts have no ids; rows that repeat have a row each; null keys stay null; an empty table gives no rows.
    """
    frame = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spell = index_encoder(path), speller(path)
        decimal = decimals(len(spell.lengths))
        for part in row_slices(batches, "text", 6_000_000):
            ids, offsets = encoder.flat(part.column(1))
            texts = spelled_texts(ids, offsets, spell)
            yield _digest_batch(part.column(0), offsets, digests(ids, offsets, texts, decimal))

    return frame.mapInArrow(run, f"key {frame.schema['key'].dataType.simpleString()}, {DIGESTS}").withColumnRenamed("key", key)
