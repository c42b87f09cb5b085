"""Data quality reports: duplicates, missing values, distinct values.

Each report is one pass over the table (or one shuffle of an already reduced table),
whatever the number of columns: no per-column loop of jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of a group of copies in ``duplicate_rows``.
SALTS = 32


def _kept(df: DataFrame, ignore) -> list[str]:
    return [c for c in df.columns if c not in set(ignore or ())]


def dedup(df: DataFrame, ignore: list[str] | tuple = (), keep_first_by: str | None = None) -> DataFrame:
    """Drop full-row duplicates judged on every column except ``ignore``.

    Without ``keep_first_by`` the ignored columns (e.g. a row index) are dropped. With
    it, the row with the smallest value of that column is kept — like pandas keeping
    the first occurrence — and the column is returned too. Both are one aggregate
    with map-side combine, so a group of copies holding a third of all rows is
    reduced inside every task before the shuffle.
    """
    cols = _kept(df, list(ignore) + ([keep_first_by] if keep_first_by else []))
    if keep_first_by is None:
        return df.select(*cols).dropDuplicates()
    return df.groupBy(*cols).agg(F.min(keep_first_by).alias(keep_first_by))


def duplicate_count(df: DataFrame, ignore: list[str] | tuple = ()) -> DataFrame:
    """One row: ``n_rows``, ``n_distinct`` and ``n_duplicates`` (all copies but the first)."""
    cols = _kept(df, ignore)
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.sum("__n").cast("bigint").alias("n_rows"),
                      F.count(F.lit(1)).cast("bigint").alias("n_distinct"),
                      F.sum(F.col("__n") - 1).cast("bigint").alias("n_duplicates"))


def duplicate_rows(df: DataFrame, order_by: str, ignore: list[str] | tuple = ()) -> DataFrame:
    """Rows that repeat an earlier row (smallest ``order_by`` is the original).

    Two windows over the compared columns. The first has a salt from ``order_by``, so that a group of copies of any
    size is shared by ``SALTS`` partitions, and finds the smallest value of each part; the second sees one
    row or a tie of rows of each part and finds the smallest of all. Rows above either are repeats. Where the
    source is already partitioned by some of the compared columns (a join's key), as in a join's output, Spark keeps
    its partitions and moves no row again.
    """
    cols = _kept(df, list(ignore) + [order_by])
    value = F.col(f"`{order_by}`")
    same = [F.col(f"`{c}`") for c in cols]
    rows = df.withColumn("__salt", F.pmod(F.xxhash64(value), F.lit(SALTS)))
    rows = rows.withColumn("__least", F.min(value).over(Window.partitionBy(*same, "__salt")))
    # A part's least value goes on to the second window; the others are repeats and stay out of its groups.
    rest = F.when(value != F.col("__least"), F.col("__salt") + 1).otherwise(F.lit(0))
    rows = rows.withColumn("__rest", rest)
    rows = rows.withColumn("__first", F.min(value).over(Window.partitionBy(*same, "__rest")))
    repeat = (F.col("__rest") > 0) | (value != F.col("__first"))
    return rows.where(repeat & value.isNotNull()).drop("__salt", "__least", "__rest", "__first")


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column, n_missing)``: nulls, and NaN for floating columns; one pass."""
    columns = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for c in columns:
        miss = F.col(c).isNull()
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(c)
        exprs.append(F.sum(F.when(miss, 1).otherwise(0)).cast("bigint").alias(c))
    wide = df.agg(*exprs)
    return wide.unpivot([], columns, "column", "n_missing")


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def unique_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct ``(column, value)`` pairs, null kept as a value; distributed, uncapped."""
    columns = columns or df.columns
    long = _as_text(df, columns).unpivot([], columns, "column", "value")
    return long.distinct()


def unique_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column, n_unique)`` exact, null counted as one value (pandas ``unique``)."""
    return unique_values(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_unique"))


def unique_counts_approx(df: DataFrame, columns: list[str] | None = None,
                         rsd: float = 0.05) -> DataFrame:
    """HyperLogLog++ estimate per column (bounded memory) plus one for null if present."""
    columns = columns or df.columns
    exprs = []
    for c in columns:
        exprs.append((F.approx_count_distinct(c, rsd) +
                      F.max(F.col(c).isNull().cast("int"))).cast("bigint").alias(c))
    return df.agg(*exprs).unpivot([], columns, "column", "n_unique_approx")


def distinct_sketches(df: DataFrame, columns: list[str] | None = None, by: list[str] | tuple = (),
                      lg_k: int = 12) -> DataFrame:
    """``(by..., column, sketch)``: a HyperLogLog sketch of each column's values, per group of ``by``.

    One pass with map-side combine; a sketch has about ``2 ** lg_k`` bytes whatever its rows, so the table can be
    stored per day or per file and merged later without the rows (``distinct_estimates``). Values are compared as
    text; null is one more value. An empty table has one empty sketch a column without ``by``, no rows with it.
    """
    by = list(by)
    columns = columns or [c for c in df.columns if c not in by]
    marked = {c: F.coalesce(F.concat(F.lit("v"), F.col(f"`{c}`").cast("string")), F.lit("n")) for c in columns}
    wide = df.groupBy(*by).agg(*[F.hll_sketch_agg(x, F.lit(lg_k)).alias(f"__s_{c}") for c, x in marked.items()])
    long = wide.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`__s_{c}`").alias("sketch")) for c in columns])).alias("__e"))
    return long.select(*by, "__e.column", "__e.sketch")


def merge_sketches(sketches: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """``(by..., column, sketch)``: the sketches of a column merged, to coarser groups or to one."""
    return sketches.groupBy(*by, "column").agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """``(by..., column, n_unique_approx)`` of merged sketches; relative standard error ``1.04 / sqrt(2 ** lg_k)``.

    A sketch that has seen its rows in one go estimates with their order, a merged one cannot. Each is united with
    itself first, which leaves its registers as they are and makes the estimate a function of them alone: the
    same values give the same number however they were grouped and merged.
    """
    merged = merge_sketches(sketches, by)
    return merged.select(*by, "column", F.hll_sketch_estimate(F.hll_union("sketch", "sketch")).cast("bigint").alias("n_unique_approx"))
