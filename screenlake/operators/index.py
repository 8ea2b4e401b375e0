"""Row numbers, permutations, samples and batches without a one-task window.

Three ways to number rows, picked by what the order is:

* by a seeded hash: hash prefixes are buckets of even size, so each bucket is
  ranked on its own and shifted by a table of at most 65,536 bucket offsets;
* by any key: range partitioning, then Spark's own per-partition numbering
  shifted by one offset per partition;
* inside groups, by any key: a segmented scan. Rows are range partitioned on
  (group, key) with borders drawn from the data, each partition is numbered or
  summed on its own, and one offset per group and partition is joined back, so
  a hot group is as many tasks as it has partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.session import materialize

Rank = Callable[[Column], Column]  # row count -> rank

PREFIX_DIGITS = 4  # hex digits, so 16**4 = 65,536 buckets at most


def seeded_hash(seed: str | int | Column, *keys: str | Column) -> Column:
    """``md5("seed:key")``, the same text in any engine.

    Of several keys each is written as ``length_key``, and a missing one as
    ``-``, so that different keys never give the same text.
    """
    lead = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    texts = [p.cast("string") for p in parts]
    if len(texts) > 1:
        texts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit("_"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws(":", lead, *texts))


def _prefix(hashed: str) -> Column:
    return F.substring(hashed, 1, PREFIX_DIGITS)


def _before(size: str, order: list[str], group: list[str] | None = None) -> Column:
    """Sum of ``size`` over the rows ahead of this one."""
    window = Window.partitionBy(*(group or [])).orderBy(*order)
    return F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size)


# --------------------------------------------------------------- permutations


def permute(
    df: DataFrame,
    keys: list[str],
    seed: str | int,
    out: str = "position",
    total: str | None = None,
    group: str | None = None,
) -> DataFrame:
    """Position (from 0) of each row in the seeded order of its unique key.

    ``group`` names a column that is folded into the seed and numbered on its
    own (one order per epoch); ``total`` adds the row count of the order.
    """
    lead = F.concat_ws(":", F.lit(str(seed)), F.col(group)) if group else seed
    groups = [group] if group else []
    hashed = df.withColumn("_hash", seeded_hash(lead, *keys)).withColumn("_bucket", _prefix("_hash"))
    sizes = hashed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        *groups,
        "_bucket",
        _before("_size", ["_bucket"], groups).alias("_before"),
        F.sum("_size").over(Window.partitionBy(*groups)).alias("_total"),
    )
    rank = F.row_number().over(Window.partitionBy(*groups, "_bucket").orderBy("_hash", *keys))
    # At most 65,536 offset rows, whatever the table holds. With groups there are so many
    # per group, so that join is left to Spark; it reuses the partitioning of the ranks.
    lookup = offsets if group else F.broadcast(offsets)
    placed = hashed.withColumn("_rank", rank).join(lookup, [*groups, "_bucket"])
    columns = [F.col(c) for c in df.columns]
    columns.append((F.col("_before") + F.col("_rank") - 1).alias(out))
    if total:
        columns.append(F.col("_total").alias(total))
    return placed.select(*columns)


def permute_per_epoch(df: DataFrame, keys: list[str], seed: str | int, epochs: int) -> DataFrame:
    """One independent order per epoch: the epoch number is part of the seed."""
    repeated = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    return permute(repeated, keys, seed, group="epoch")


def hash_cuts(df: DataFrame, keys: list[str], seed: str | int, ranks: dict[str, Rank]) -> DataFrame:
    """One row: per name, the hash of rank ``ranks[name](n)`` in the seeded order (null for rank 0).

    A radix select. The first pass only counts rows per hash prefix; the second
    ranks the few buckets that hold a wanted row. The table itself is never
    shuffled, and callers compare hashes against the returned values.
    """
    hashed = df.select(seeded_hash(seed, *keys).alias("_hash")).withColumn("_bucket", _prefix("_hash"))
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    spans = sizes.select(
        "_bucket",
        "_size",
        _before("_size", ["_bucket"]).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    wants = [F.struct(F.lit(k).alias("k"), r(F.col("_total")).cast("long").alias("rank")) for k, r in ranks.items()]
    hits = spans.withColumn("_want", F.explode(F.array(*wants))).filter(
        "_before < _want.rank AND _want.rank <= _before + _size"
    )
    hits = hits.selectExpr("_bucket", "_want.k AS _name", "_want.rank - _before AS _need")
    rank = F.row_number().over(Window.partitionBy("_name", "_bucket").orderBy("_hash"))
    found = (
        hashed.join(F.broadcast(hits), "_bucket")  # one row per wanted rank
        .withColumn("_rank", rank)
        .filter("_rank = _need")
    )
    return found.agg(*[F.max(F.when(F.col("_name") == k, F.col("_hash"))).alias(k) for k in ranks])


def _firsts(df: DataFrame, keys: list[str], seed: str | int, ranks: dict[str, Rank]) -> dict[str, Column]:
    """Per name, true for the first ``ranks[name](n)`` rows of the seeded order."""
    cuts = hash_cuts(df, keys, seed, ranks).select(F.struct(*ranks)).scalar()
    own = seeded_hash(seed, *keys)
    return {name: F.coalesce(own <= cuts[name], F.lit(False)) for name in ranks}


def sample_fraction(df: DataFrame, keys: list[str], fraction: float, seed: str | int = 42) -> DataFrame:
    """Exactly ``round-half-even(fraction * n)`` rows, chosen by the seeded order."""
    drawn = _firsts(df, keys, seed, {"sample": lambda n: F.bround(n * F.lit(float(fraction)))})
    return df.filter(drawn["sample"])


def split_masks(df: DataFrame, keys: list[str], ratio: float, seed: str | int = 42) -> DataFrame:
    """Adds ``train_mask`` / ``test_mask`` (0/1); test = round-half-even(n * ratio)."""
    first = _firsts(df, keys, seed, {"train": lambda n: n - F.bround(n * F.lit(float(ratio)))})
    marked = df.withColumn("train_mask", first["train"].cast("int"))
    return marked.withColumn("test_mask", 1 - F.col("train_mask"))


def three_way(df: DataFrame, keys: list[str], seed: str | int = 42, out: str = "split") -> DataFrame:
    """Half to train (rounded down), the rest halved into test (down) and validation (up)."""
    first = _firsts(
        df,
        keys,
        seed,
        {"train": lambda n: F.floor(n / 2), "test": lambda n: F.floor(n / 2) + F.floor(F.ceil(n / 2) / 2)},
    )
    return df.withColumn(out, F.when(first["train"], "train").when(first["test"], "test").otherwise("validation"))


# ------------------------------------------------------------ numbers by key


def global_index(
    df: DataFrame, order: list[str | Column], out: str = "idx", total: str | None = None
) -> DataFrame:
    """Row number from 0 in the order of ``order``, which must be unique per row.

    The ranged table is written once, because range bounds come from a sample
    and a second evaluation could draw others.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = materialize(ranged.withColumn("_tag", F.monotonically_increasing_id()), "indexed")
    # The tag holds the partition number in its upper 31 bits and the row in the lower 33.
    stored = stored.withColumn("_part", F.shiftright("_tag", 33))
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        "_part",
        _before("_size", ["_part"]).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    row = F.col("_tag").bitwiseAND(F.lit((1 << 33) - 1))
    columns = [F.col(c) for c in df.columns] + [(F.col("_before") + row).alias(out)]
    if total:
        columns.append(F.col("_total").alias(total))
    # One offset row per partition.
    return stored.join(F.broadcast(offsets), "_part").select(*columns)


def group_number(df: DataFrame, key: str, out: str = "group_number") -> DataFrame:
    """Number of each distinct key in sorted order, from 0, as a string; null for a missing key."""
    numbered = global_index(df.filter(F.col(key).isNotNull()).select(key).distinct(), [key], "_number")
    lookup = materialize(numbered.select(key, F.col("_number").cast("string").alias(out)), "numbers")
    return df.join(lookup, key, "left").select(*df.columns, out)


def renumber(df: DataFrame, order: list[str], out: str = "index") -> DataFrame:
    """Fresh row numbers after rows were dropped or added."""
    return global_index(df, order, out)


# -------------------------------------------------------------------- batches


def batch_of_position(position: str, total: str, size: int, drop_last: bool) -> Column:
    """Batch number of a position; null marks a row of the dropped last batch.

    Without dropping, ceil(n/size) chunks of near-equal length are made and
    the first ``n mod chunks`` of them are one row longer.
    """
    i, n = F.col(position), F.col(total)
    if drop_last:
        batch = F.floor(i / size)
        return F.when(batch < F.floor(n / size), batch)
    chunks = F.ceil(n / size)
    short = F.floor(n / chunks)
    longer = n - short * chunks
    edge = longer * (short + 1)
    return F.when(i < edge, F.floor(i / (short + 1))).otherwise(longer + F.floor((i - edge) / short))


def batches(
    df: DataFrame,
    order: list[str],
    size: int,
    drop_last: bool = True,
    shuffle_seed: str | int | None = None,
) -> DataFrame:
    """Adds ``batch``; rows are taken in key order, or permuted when a seed is given."""
    if shuffle_seed is None:
        placed = global_index(df, order, "_position", "_n")
    else:
        placed = permute(df, order, shuffle_seed, "_position", "_n")
    numbered = placed.withColumn("batch", batch_of_position("_position", "_n", size, drop_last))
    if drop_last:
        numbered = numbered.filter(F.col("batch").isNotNull())
    return numbered.drop("_position", "_n")


# ------------------------------------------------------- orders inside groups


def _ranged(df: DataFrame, group: str, order: str, extra: dict[str, Column], partitions: int | None) -> DataFrame:
    """Rows that have group and key, written in their order; ``_part`` and ``_row`` number partitions and rows in them.

    The place in the input is the last sort key: rows that repeat a key can part as well. The table is written once,
    since borders come from a sample.
    """
    keys = [group, order, "_seq"]
    placed = df.withColumns({"_seq": F.monotonically_increasing_id(), **extra})
    placed = placed.filter(F.col(group).isNotNull() & F.col(order).isNotNull())
    ranged = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    tagged = ranged.sortWithinPartitions(*keys).drop("_seq").withColumn("_tag", F.monotonically_increasing_id())
    stored = materialize(tagged, "scanned")
    return stored.withColumns({"_part": F.shiftright("_tag", 33), "_row": F.col("_tag").bitwiseAND(F.lit((1 << 33) - 1))})


def _offsets(stored: DataFrame, group: str, amount: Column) -> DataFrame:
    """Per group and partition: its ``_first`` row, the ``_before`` of the group in earlier partitions, the group's ``_all``.

    A window here holds one row per partition of a group. The table is written, so that Spark knows its size.
    """
    parts = stored.groupBy(group, "_part").agg(F.min("_row").alias("_first"), amount.alias("_sum"))
    sums = {"_before": _before("_sum", ["_part"], [group]), "_all": F.sum("_sum").over(Window.partitionBy(group))}
    return materialize(parts.withColumns(sums).drop("_sum"), "offsets")


def _without_place(df: DataFrame, group: str, order: str) -> DataFrame:
    return df.filter(F.col(group).isNull() | F.col(order).isNull())


def group_position(
    df: DataFrame,
    group: str,
    order: str,
    out: str = "position",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Position (from 0) inside ``group`` by the key ``order``, which may have any type that can be sorted.

    Equal keys keep some order. A row without group or key stays where it is, with no position. ``partitions``
    overrides the session's number of shuffle partitions.
    """
    stored = _ranged(df, group, order, {}, partitions)
    placed = stored.join(_offsets(stored, group, F.count("*")), [group, "_part"])
    columns = {out: F.col("_before") + F.col("_row") - F.col("_first")} | ({total: F.col("_all")} if total else {})
    found = placed.select(*df.columns, *[value.alias(name) for name, value in columns.items()])
    return found.unionByName(_without_place(df, group, order), allowMissingColumns=True)


def running_total(
    df: DataFrame, group: str, order: str, value: str | Column, out: str, partitions: int | None = None
) -> DataFrame:
    """Running sum of ``value`` inside ``group`` by the key ``order``; missing values add nothing.

    A row without group or key stays, with no sum.
    """
    amount = F.col(value) if isinstance(value, str) else value
    stored = _ranged(df, group, order, {"_amount": F.coalesce(amount, F.lit(0))}, partitions)
    within = Window.partitionBy(group, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    summed = stored.withColumn("_local", F.sum("_amount").over(within))
    placed = summed.join(_offsets(stored, group, F.sum("_amount")), [group, "_part"])
    found = placed.select(*df.columns, (F.col("_before") + F.col("_local")).alias(out))
    return found.unionByName(_without_place(df, group, order), allowMissingColumns=True)
