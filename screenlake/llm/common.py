"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared scratch folder (zstd) and reads it back.

    Cuts lineage so that it survives executors, fixes values that a repeated
    task might compute anew, and tells Spark the true size before a join.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def text_slices(batch: pa.RecordBatch, column: str, chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first row, whole texts) in slices of about ``chars`` characters, so that word lists stay small."""
    texts = batch.column(batch.schema.get_field_index(column))
    start, held, size = 0, [], 0
    for row in range(batch.num_rows):
        text = texts[row].as_py() or ""
        held.append(text)
        size += len(text)
        if size >= chars:
            yield start, held
            start, held, size = row + 1, [], 0
    if held:
        yield start, held


def bloom_filter(keys: DataFrame, columns: list[str], most_bytes: int = 16_000_000, bits: int = 12, probes: int = 6) -> Callable[..., F.Column] | None:
    """``test(*columns)``: false only for rows that are not in ``keys``; None if the filter would be above ``most_bytes``.

    The filter is built where the keys are, as 64-bit words that are combined before they are shuffled, and has
    ``bits`` bits per key, so its size is known before it is built. Null is a key like any other.
    """
    spark, count = keys.sparkSession, keys.count()
    words = -(-max(count, 1) * bits // 64)
    if 8 * words > most_bytes:
        return None

    def places(*given: F.Column) -> list[F.Column]:
        one, two = (F.xxhash64(*given, F.lit(seed)) for seed in (1, 2))
        return [F.pmod(F.shiftright(one, 1) + F.lit(i) * F.shiftright(two, 4), F.lit(64 * words)) for i in range(probes)]

    spots = keys.select(F.explode(F.array(*places(*[F.col(c) for c in columns]))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    found = spots.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    held = np.zeros(words, np.int64)
    held[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    table = spark.createDataFrame(pa.table({"words": pa.ListArray.from_arrays(pa.array([0, words], pa.int32()), pa.array(held))}))

    def test(*given: F.Column) -> F.Column:
        array = table.select("words").scalar()
        hits = [F.bit_get(F.get(array, (at / 64).cast("int")), (at % 64).cast("int")) == 1 for at in places(*given)]
        return reduce(lambda a, b: a & b, hits)

    return test


def sha256_hex(column) -> F.Column:
    return F.sha2(column, 256)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit of 64-bit words (splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word, each distinct word hashed once."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    coded = pa.array(words, pa.binary()).dictionary_encode()
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return distinct[coded.indices.to_numpy()]


def rolled(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of each ``width`` consecutive word hashes; position matters, entry i covers words i..i+width-1.

    Hashes of lengths that double are combined, so that a window costs log2(width) steps.
    """
    if len(words) < width:
        return np.zeros(0, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    block, length = mix64(words + np.uint64(seed * 2654435761 + 1)), 1
    done, covered = None, 0
    rest = width
    while True:
        if rest & 1:
            if done is None:
                done, covered = block, length
            else:
                n = len(block) - covered
                done = mix64(done[:n] * factor + block[covered : covered + n])
                covered += length
        rest >>= 1
        if not rest:
            return done[: len(words) - width + 1]
        n = len(block) - length
        block, length = mix64(block[:n] * factor + block[length : length + n]), length * 2
