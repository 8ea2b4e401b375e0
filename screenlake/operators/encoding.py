"""Word tokens to fixed-length id rows and back, with a vocabulary table."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.functions.arrays import col
from screenlake.functions.text import with_prefix, words
from screenlake.operators.index import global_index
from screenlake.session import materialize

PAD, END, UNKNOWN = 0, 1, 2
SPECIALS = ["<pad>", "</s>", "<unk>"]


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """``token, id, special``: the special tokens, then the sorted distinct words of ``text``."""
    tokens = df.select(F.explode(words(text)).alias("token")).distinct()
    numbered = global_index(tokens, ["token"], "id")
    plain = numbered.select("token", (F.col("id") + len(SPECIALS)).cast("int").alias("id"), F.lit(False).alias("special"))
    rows = [(token, i, True) for i, token in enumerate(SPECIALS)]
    special = df.sparkSession.createDataFrame(rows, "token string, id int, special boolean")
    return materialize(special.unionByName(plain), "vocabulary")


def pad_to(ids: Column, length: int, pad: int = PAD) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), F.lit(length) - F.size(ids)))


#: Tokens of a chunk: rows whose distinct tokens are looked up together. A longer row is a chunk of its own.
CHUNK_TOKENS = 2_000_000


def _coded(df: DataFrame, key: str, tokens: list[Column]) -> DataFrame:
    """``key, chunk, tokens`` and a list of codes per field, written: a code is a place among the chunk's distinct tokens.

    The first row of a chunk holds these.
    """
    names = [f"_{i}" for i in range(len(tokens))]
    source = df.select(key, *[column.alias(name) for name, column in zip(names, tokens)])
    schema = ", ".join([f"`{key}` {dict(df.dtypes)[key]}", "_chunk long", "_tokens array<string>", *[f"{name} array<int>" for name in names]])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = np.sum([lists.value_lengths().to_numpy(zero_copy_only=False) for lists in batch.columns[1:]], axis=0)
            before = np.cumsum(sizes) - sizes
            start = 0
            while start < len(sizes):
                stop = max(start + 1, int(np.searchsorted(before + sizes, before[start] + CHUNK_TOKENS, "right")))
                part = batch.slice(start, stop - start)
                fields = part.columns[1:]
                found = pa.concat_arrays([lists.flatten() for lists in fields]).dictionary_encode()
                codes, at, out = found.indices.to_numpy(), 0, []
                for lists in fields:
                    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(codes[at : at + ends[-1]])))
                    at += ends[-1]
                listed = pa.array([found.dictionary.to_pylist()] + [None] * (len(part) - 1), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(part), chunk)), listed, *out], [key, "_chunk", "_tokens", *names])
                start, chunk = stop, chunk + 1

    return materialize(source.mapInArrow(code, schema), "coded")


def encode(
    df: DataFrame,
    key: str,
    fields: Mapping[str, tuple[str | Column, int | None]],
    vocab: DataFrame,
    end_marker: bool = False,
) -> DataFrame:
    """``key`` plus ``<field>_ids`` and ``<field>_mask``, all ``ARRAY<INT>`` of fixed length.

    ``fields`` maps an output name to its text and length; with no length a
    field is neither cut nor padded. A missing text has no tokens. All fields
    share one pass. Rows are cut to length first. Each distinct token of a chunk of rows is looked up once. A written
    vocabulary is broadcast when it is small; when it is not, the join splits hot words. Rows with the same key are
    one, their tokens in the order of their places.
    """
    keep = {name: None if length is None else length - int(end_marker) for name, (_, length) in fields.items()}
    none = F.array().cast("array<string>")
    coded = _coded(df, key, [F.coalesce(words(text, keep[name]), none) for name, (text, _) in fields.items()])
    known = vocab.filter(~F.col("special")).select("token", F.col("id").cast("int").alias("id"))
    listed = coded.filter(F.col("_tokens").isNotNull()).select(F.col("_chunk").alias("chunk"), F.posexplode("_tokens").alias("at", "token"))
    found = listed.join(known, "token").groupBy("chunk", "at").agg(F.min("id").alias("id"))
    rows = coded.drop("_tokens")
    names = rows.columns

    def look_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        columns = dict(zip(names, rows.columns))
        lists = {name: pa.concat_arrays(columns[name].chunks) for name in names[2:] if rows.num_rows}
        most = max((int(x.flatten().to_numpy().max(initial=-1)) for x in lists.values()), default=-1)
        ids = np.full(most + 1, UNKNOWN, np.int32)
        ids[found.column("at").to_numpy()] = found.column("id").to_numpy()
        for name, x in lists.items():
            ends = np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy())]).astype(np.int32)
            columns[name] = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[x.flatten().to_numpy()]))
        return pa.table(columns)

    each = rows.groupBy("_chunk").cogroup(found.groupBy(F.col("chunk"))).applyInArrow(look_up, rows.schema)
    gathered = each.groupBy(key).agg(*[F.collect_list(f"_{i}").alias(f"_{i}") for i in range(len(fields))])

    def one(lists: str) -> Column:
        placed = F.transform(lists, lambda x: F.transform(x, lambda v, i: F.struct(i.alias("pos"), v.alias("id"))))
        return F.when(F.size(lists) == 1, F.col(lists)[0]).otherwise(F.sort_array(F.flatten(placed))["id"])

    gathered = gathered.select(key, *[one(f"_{i}").alias(name) for i, name in enumerate(fields)])
    columns = []
    for name, (_, length) in fields.items():
        ids = F.col(name)
        if end_marker:
            ids = F.concat(ids, F.array(F.lit(END)))
        mask = F.array_repeat(F.lit(1), F.size(ids))
        columns.append((ids if length is None else pad_to(ids, length)).alias(f"{name}_ids"))
        columns.append((mask if length is None else pad_to(mask, length, 0)).alias(f"{name}_mask"))
    return gathered.select(key, *columns)


def shift_right(ids: str | Column, start: int = PAD) -> Column:
    """Start id first, last id dropped."""
    return F.concat(F.array(F.lit(start)), F.slice(col(ids), 1, F.size(col(ids)) - 1))


def encode_pairs(
    df: DataFrame,
    key: str,
    vocab: DataFrame,
    source_length: int,
    target_length: int,
    text: str = "text",
    summary: str = "summary",
    prefix: str | None = None,
    start: int = PAD,
    end_marker: bool = False,
) -> DataFrame:
    """Model rows of a text pair: source, labels and shifted decoder input, derived columns only."""
    fields = {"source": (with_prefix(text, prefix), source_length), "target": (summary, target_length)}
    coded = encode(df, key, fields, vocab, end_marker)
    return coded.select(
        key,
        F.col("source_ids").alias("input_ids"),
        F.col("source_mask").alias("attention_mask"),
        F.col("target_ids").alias("labels"),
        shift_right("target_ids", start).alias("decoder_input_ids"),
        F.col("target_mask").alias("decoder_attention_mask"),
    )


def decode(df: DataFrame, key: str, ids: str, vocab: DataFrame, out: str = "text") -> DataFrame:
    """``key`` and the words of its ids, special ids left out."""
    flat = df.select(key, F.posexplode_outer(ids).alias("pos", "id"))
    plain = vocab.filter(~F.col("special")).select("token", "id")
    found = flat.join(plain, "id", "left").withColumn("w", F.when(F.col("token").isNotNull(), F.struct("pos", "token")))
    gathered = found.groupBy(key).agg(F.sort_array(F.collect_list("w")).alias("w"))
    return gathered.select(key, F.array_join(F.transform("w", lambda x: x["token"]), " ").alias(out))
