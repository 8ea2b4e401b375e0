"""Cell tables, label proportions and feature matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.functions.arrays import dense_from_entries, indicator
from screenlake.operators import index
from screenlake.session import materialize

# The named cell states, in output order; the last also takes every unknown state.
STATES = ["progenitor", "effector", "terminal exhausted", "cycling", "other"]


def _named(name: str) -> str:
    return name.replace(" ", "_")


def exclude_conditions(
    df: DataFrame, excluded: list, condition: str = "condition", strict: bool = True
) -> DataFrame:
    """Drops rows whose condition is excluded; in strict mode a label without rows is an error."""
    if strict:
        present = {r[0] for r in df.filter(F.col(condition).isin(excluded)).select(condition).distinct().collect()}
        absent = [label for label in excluded if label not in present]
        if absent:
            raise KeyError(f"conditions not found: {absent}")
    # A null condition is on no list, so it stays. In this form the filter reaches the scan.
    return df.filter(F.col(condition).isNull() | ~F.col(condition).isin(excluded))


def state_counts(
    cells: DataFrame,
    conditions: DataFrame | None = None,
    states: list[str] = STATES,
    condition: str = "condition",
    state: str = "state",
) -> DataFrame:
    """Rows per condition and state; the last state also counts every unknown one.

    Counting runs before the look-up of wanted conditions, so a hot condition
    is folded on the map side and the join sees one row per condition.
    """
    named, rest = states[:-1], states[-1]
    counts = [F.count_if(F.col(state) == s).alias(_named(s)) for s in named]
    totals = cells.groupBy(condition).agg(*counts, F.count("*").alias("total"))
    other = F.col("total") - sum((F.col(_named(s)) for s in named), F.lit(0))
    totals = totals.select(condition, *[_named(s) for s in named], other.alias(_named(rest)), "total")
    return totals if conditions is None else totals.join(conditions, condition, "left_semi")


def state_proportions(
    cells: DataFrame,
    conditions: DataFrame | None = None,
    states: list[str] = STATES,
    condition: str = "condition",
    state: str = "state",
) -> DataFrame:
    """Share of each state per condition; every row adds up to 1."""
    counts = state_counts(cells, conditions, states, condition, state)
    return counts.select(condition, *[(F.col(_named(s)) / F.col("total")).alias(_named(s)) for s in states])


def label_table(
    cells: DataFrame,
    conditions: DataFrame | None = None,
    states: list[str] = STATES,
    condition: str = "condition",
    state: str = "state",
) -> DataFrame:
    """State proportions as a written table, one row per condition."""
    return materialize(state_proportions(cells, conditions, states, condition, state), "labels")


def expand_labels(
    cells: DataFrame, labels: DataFrame, condition: str = "condition", strict: bool = True
) -> DataFrame:
    """Gives every cell the label row of its condition; strict mode refuses unlabelled conditions.

    Pass ``labels`` as a written table (``label_table``), so the cells stay
    where they are when the labels are few.
    """
    if strict:
        missing = cells.select(condition).distinct().join(labels, condition, "left_anti").limit(5).collect()
        if missing:
            raise KeyError(f"conditions without labels: {[r[0] for r in missing]}")
    return cells.join(labels, condition)


def split_by_condition(
    df: DataFrame, test: list, validation: list, condition: str = "condition", out: str = "split"
) -> DataFrame:
    """Test and validation rows by condition; everything else is train."""
    c = F.col(condition)
    return df.withColumn(
        out, F.when(c.isin(test), "test").when(c.isin(validation), "validation").otherwise("train")
    )


# ------------------------------------------------------------------- features


def positions_of(genes: DataFrame, wanted: list[str], gene: str = "gene", gene_idx: str = "gene_idx") -> DataFrame:
    """``(ord, gene, gene_idx)`` of the wanted names that exist; absent ones are skipped.

    The first position counts when a name repeats.
    """
    found = genes.filter(F.col(gene).isin(wanted)).groupBy(gene).agg(F.min(gene_idx).alias(gene_idx))
    asked = genes.sparkSession.createDataFrame(list(enumerate(wanted)), f"ord int, {gene} string")
    return asked.join(found, gene).select("ord", gene, gene_idx)


def drop_features(matrix: DataFrame, features: DataFrame, key: str = "gene_idx") -> DataFrame:
    """Matrix entries outside a feature set.

    The set is written first, so Spark knows its size and leaves the matrix
    unshuffled while it can be broadcast.
    """
    return matrix.join(materialize(features.select(key).distinct(), "features"), key, "left_anti")


def select_features(matrix: DataFrame, features: DataFrame, key: str = "gene_idx") -> DataFrame:
    """Matrix entries inside a feature set (written first, as above)."""
    return matrix.join(materialize(features.select(key).distinct(), "features"), key, "left_semi")


def sum_entries(matrix: DataFrame, cell: str = "cell_id", feature: str = "gene_idx", value: str = "value") -> DataFrame:
    """One entry per (cell, feature)."""
    return matrix.groupBy(cell, feature).agg(F.sum(value).alias(value))


#: Matrix entries that one task adds up and gathers.
TASK_ENTRIES = 500_000


def entry_tasks(matrix: DataFrame) -> int:
    """Tasks that the entries are dealt to: in proportion to their number, so that what a task holds does not grow.

    What one task may hold is left to Spark (0).
    """
    tasks = -(-matrix.count() // TASK_ENTRIES)
    return max(matrix.sparkSession.sparkContext.defaultParallelism, tasks) if tasks > 1 else 0


def densify(
    cells: DataFrame,
    matrix: DataFrame,
    width: int,
    cell: str = "cell_id",
    feature: str = "gene_idx",
    value: str = "value",
    out: str = "features",
    tasks: int | None = None,
) -> DataFrame:
    """One dense ``ARRAY<DOUBLE>`` per cell; repeated entries add up, cells without entries are all zeros.

    Repeats are added up first, so the list that is gathered per cell is never
    longer than the row. Entries outside ``0..width-1`` are dropped, and a null
    value counts as 0. Entries and cells are dealt to ``tasks`` by cell; by default
    the matrix is counted for that (``entry_tasks``).
    """
    tasks = entry_tasks(matrix) if tasks is None else tasks
    dealt = lambda df: df.repartition(tasks, cell) if tasks else df
    inside = dealt(matrix).filter(F.col(feature).between(0, width - 1))
    entry = F.struct(F.col(feature).cast("int").alias("i"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v"))
    unique = sum_entries(inside, cell, feature, value)
    rows = unique.groupBy(cell).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    joined = dealt(cells).join(rows, cell, "left")
    return joined.withColumn(out, dense_from_entries("_entries", width)).drop("_entries")


def stack(df: DataFrame, features: str, labels: list[str], out: str = "features") -> DataFrame:
    """Label columns appended to the feature row."""
    return df.withColumn(out, F.concat(F.col(features), F.array(*[F.col(c).cast("double") for c in labels])))


def zero_to_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zeros become NaN and NaN stays NaN, in the given columns (labels too when listed)."""
    nan = F.lit(float("nan"))
    return df.withColumns({c: F.when(F.col(c) == 0, nan).otherwise(F.col(c).cast("double")) for c in columns})


def zero_to_nan_array(df: DataFrame, column: str) -> DataFrame:
    """The same for an array column."""
    nan = F.lit(float("nan"))
    return df.withColumn(column, F.transform(column, lambda x: F.when(x == 0, nan).otherwise(x)))


def cast_columns(df: DataFrame, columns: list[str], to: str = "double") -> DataFrame:
    """All listed numeric (array) columns in one float type."""
    types = dict(df.dtypes)
    target = {c: f"array<{to}>" if types[c].startswith("array") else to for c in columns}
    return df.withColumns({c: F.col(c).cast(t) for c, t in target.items()})


# -------------------------------------------------------------------- one-hot


def distinct_positions(df: DataFrame, column: str, out: str = "position") -> DataFrame:
    """Sorted distinct values with their position from 0."""
    return index.global_index(df.select(column).distinct(), [column], out)


def one_hot(df: DataFrame, column: str, out: str = "onehot") -> DataFrame:
    """One-hot ``ARRAY<DOUBLE>`` over the sorted distinct values of ``column``; all zeros for a missing value.

    The category list is as long as each produced vector, so ordering it in
    one window is in proportion to a single output row.
    """
    levels = df.filter(F.col(column).isNotNull()).select(column).distinct()
    spot = F.row_number().over(Window.orderBy(column)) - 1
    width = F.count("*").over(Window.partitionBy())
    placed = materialize(levels.select(column, indicator(spot, width).alias(out)), "levels")
    zeros = F.array_repeat(F.lit(0.0), F.lit(placed.count()))
    return df.join(placed, column, "left").select(*df.columns, F.coalesce(out, zeros).alias(out))


# --------------------------------------------------------------------- sparse
# A sparse row is a struct (size, indices, values): as long as what it holds, whatever its width.


def sparse_row(size: Column, indices: Column, values: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))


def one_hot_sparse(df: DataFrame, column: str, out: str = "onehot") -> DataFrame:
    """One-hot over the sorted distinct values of ``column`` as a sparse row; empty for a missing value.

    Values are numbered by range, so neither a row nor a task holds the list of categories.
    """
    placed = materialize(distinct_positions(df.filter(F.col(column).isNotNull()), column, "_at"), "levels")
    hit = F.col("_at").isNotNull()
    none = F.array().cast("array<int>")
    row = sparse_row(F.lit(placed.count()), F.when(hit, F.array("_at")).otherwise(none), F.when(hit, F.array(F.lit(1.0))).otherwise(none))
    return df.join(placed, column, "left").select(*df.columns, row.alias(out))


def sparsify(
    cells: DataFrame, matrix: DataFrame, width: int, cell: str = "cell_id", feature: str = "gene_idx", value: str = "value", out: str = "features"
) -> DataFrame:
    """One sparse row per cell; repeated entries add up, null values are 0, entries outside the width are dropped, zeros are not held."""
    inside = matrix.filter(F.col(feature).between(0, width - 1))
    unique = sum_entries(inside, cell, feature, value).filter(F.col(value) != 0)
    entry = F.struct(F.col(feature).cast("int").alias("i"), F.col(value).cast("double").alias("v"))
    rows = unique.groupBy(cell).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    joined = cells.join(rows, cell, "left")
    held = F.coalesce("_e", F.array().cast("array<struct<i: int, v: double>>"))
    return joined.withColumn("_e", held).withColumn(out, sparse_row(F.lit(width), F.col("_e.i"), F.col("_e.v"))).drop("_e")


def append_sparse(df: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """Two sparse rows side by side."""
    a, b = F.col(left), F.col(right)
    moved = F.transform(b["indices"], lambda i: i + a["size"])
    return df.withColumn(out, sparse_row(a["size"] + b["size"], F.concat(a["indices"], moved), F.concat(a["values"], b["values"])))


def stack_sparse(df: DataFrame, features: str, labels: list[str], out: str = "features") -> DataFrame:
    """Label columns behind the sparse feature row; zero labels are not held."""
    at = F.array(*[F.struct(F.lit(k).alias("i"), F.col(c).cast("double").alias("v")) for k, c in enumerate(labels)])
    held = F.filter(at, lambda e: ~e["v"].eqNullSafe(F.lit(0.0)))
    row = F.col(features)
    moved = F.transform(held, lambda e: e["i"] + row["size"])
    return df.withColumn(
        out, sparse_row(row["size"] + len(labels), F.concat(row["indices"], moved), F.concat(row["values"], F.transform(held, lambda e: e["v"])))
    )


def dense_rows(df: DataFrame, sparse: str, width: int, out: str = "features") -> DataFrame:
    """A narrow sparse row as the array that dense operators and models take."""
    row = F.col(sparse)
    entries = F.sort_array(F.zip_with(row["indices"], row["values"], lambda i, v: F.struct(i.alias("i"), v.alias("v"))))
    return df.withColumn(out, dense_from_entries(entries, width))


def append_array(df: DataFrame, features: str, extra: str) -> DataFrame:
    """One array column appended to another (lane one-hot behind the features)."""
    return df.withColumn(features, F.concat(features, extra))


def as_columns(df: DataFrame, array: str, names: list[str]) -> list[Column]:
    """Array elements as named columns."""
    return [F.col(array)[i].alias(n) for i, n in enumerate(names)]


# ------------------------------------------------------------------ composite


def compact_features(
    matrix: DataFrame, genes: DataFrame, dropped: DataFrame | None = None, key: str = "gene_idx"
) -> tuple[DataFrame, int]:
    """Matrix over the kept features, renumbered from 0 in key order, and its width.

    The feature list is as long as one dense row, so a single window orders it.
    """
    kept = genes.select(key).distinct()
    if dropped is not None:
        kept = kept.join(dropped.select(key).distinct(), key, "left_anti")
    spots = materialize(kept.withColumn("_spot", F.row_number().over(Window.orderBy(key)) - 1), "spots")
    entries = matrix.join(spots, key)
    columns = [F.col("_spot").alias(key) if c == key else F.col(c) for c in matrix.columns]
    return entries.select(*columns), spots.count()


def training_table(
    cells: DataFrame,
    matrix: DataFrame,
    genes: DataFrame,
    excluded: list,
    dropped_features: DataFrame | None = None,
    states: list[str] = STATES,
    seed: str | int = 42,
    conditions: DataFrame | None = None,
) -> DataFrame:
    """``cell_id, split, features``: dense features then label shares, zeros as NaN.

    Excluded conditions go first. The split is drawn on the cells alone, before
    any join, since no later step drops a cell.
    """
    labels = label_table(cells, conditions, states)
    kept = index.three_way(exclude_conditions(cells, excluded), ["cell_id"], seed)
    # Entries of excluded cells find no cell in the join of ``densify``, so entries are shuffled once, by cell.
    entries, width = compact_features(matrix, genes, dropped_features)
    dense = densify(expand_labels(kept, labels), entries, width, tasks=entry_tasks(matrix))
    stacked = stack(dense, "features", [_named(s) for s in states])
    return zero_to_nan_array(stacked, "features").select("cell_id", "split", "features")


def reindex(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``df`` laid out on another key list; keys it lacks get nulls."""
    return keys.select(key).join(df, key, "left")
