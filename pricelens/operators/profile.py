"""Column profiles: means, group statistics, value counts, describe, correlation, melt."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.columns import finite
from pricelens.functions.joins import bounded_count, lookup_join
from pricelens.functions.quantiles import (approx_quantiles, bracket_aggregates, exact_from_brackets, exact_quantiles,
                                            finite_values)
from pricelens.functions.ranking import sorted_rank

# Value-count tables above this many categories are ranked by a distributed sort
# instead of a per-feature window.
WINDOW_RANK_LIMIT = 1_000_000


def global_mean(df: DataFrame, value: str, name: str = "global_mean") -> DataFrame:
    return df.agg(F.avg(value).alias(name))


def group_stats(df: DataFrame, by: str | list[str], value: str) -> DataFrame:
    """Mean and non-null count of ``value`` per group (partial + final hash aggregate)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.avg(value).alias("cat_mean"),
                               F.count(value).cast("bigint").alias("cat_count"))


def value_counts(df: DataFrame, columns: list[str], min_count: int = 1) -> DataFrame:
    """``(feature, category, count)`` for many columns in ONE job; nulls excluded.

    The columns are unpivoted to (feature, category) and counted with map-side
    combine, so the shuffle carries at most one row per category per task.
    """
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in columns])
              .unpivot([], list(columns), "feature", "category")
              .where(F.col("category").isNotNull()))
    out = long.groupBy("feature", "category").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    if min_count > 1:
        out = out.where(F.col("count") >= min_count)
    return out


def value_counts_one(df: DataFrame, column: str, min_count: int = 1, min_ratio: int = 0,
                     ordered: bool = False) -> DataFrame:
    """``(column, count)`` for one column, nulls excluded.

    ``min_count`` is a HAVING; ``min_ratio = K`` keeps values with at least 1/K of the
    non-null rows (integer test, whatever the table's size); ``ordered`` sorts by
    descending count, ties by value, as a value count is usually read.
    """
    out = (df.where(F.col(column).isNotNull()).groupBy(column)
             .agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    if min_count > 1:
        out = out.where(F.col("count") >= min_count)
    if min_ratio > 0:
        from pricelens.session import materialize
        out = materialize(out, "value-counts")
        total = out.agg(F.sum("count")).first()[0] or 0
        out = out.where(F.col("count") * F.lit(int(min_ratio)) >= F.lit(int(total)))
    return out.orderBy(F.desc("count"), F.asc(column)) if ordered else out


def freq_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts with rank (count desc, then category) and share of the feature.

    The data behind a sorted bar chart. The count table is written once (one pass over
    the source); totals per feature are a bounded table (one row per feature); ranks
    use a window per feature while the table is small and a distributed sort beyond
    ``WINDOW_RANK_LIMIT`` categories.
    """
    from pricelens.session import materialize
    vc = materialize(value_counts(df, columns), "value-counts")
    totals = vc.groupBy("feature").agg(F.sum("count").alias("__total"))
    vc = lookup_join(vc, totals, ["feature"], "left", small=True)
    vc = vc.withColumn("share", F.col("count") / F.col("__total")).drop("__total")
    order = [F.col("count").desc(), F.col("category").asc()]
    if bounded_count(vc, WINDOW_RANK_LIMIT) is not None:
        from pyspark.sql import Window
        w = Window.partitionBy("feature").orderBy(*order)
        return vc.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return sorted_rank(vc, order, by=["feature"], name="rank")


def _tracked(ratio: int, tracked: int | None) -> int:
    """Values that a sketch follows: enough that its error is below half the threshold, at most Spark's million."""
    return min(max(int(tracked or 35 * ratio), 6 * ratio), 1_000_000)


def frequent_sketches(df: DataFrame, columns: list[str], ratio: int, by: list[str] | tuple = (),
                      tracked: int | None = None) -> DataFrame:
    """``(by..., feature, rows, sketch)``: a frequent-items sketch of each column, enough to find every value that holds
    at least ``1 / ratio`` of the rows. One pass in memory bounded by ``tracked`` values (default: 35 x ``ratio``)
    however many there are; sketches can be stored and merged (``frequent_items``). Null is one more value."""
    by = list(by)
    marked = [F.coalesce(F.concat(F.lit("v"), F.col(f"`{c}`").cast("string")), F.lit("n")).alias(c) for c in columns]
    long = df.select(*by, *marked).unpivot(by, list(columns), "feature", "__v")
    size = _tracked(ratio, tracked)
    return long.groupBy(*by, "feature").agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(__v, {size})").alias("sketch"))


def frequent_items(sketches: DataFrame, ratio: int, tracked: int | None = None) -> DataFrame:
    """``(feature, category, lower, upper, rows)`` of merged ``frequent_sketches``: bounds of the count of every value
    that may hold at least ``1 / ratio`` of the rows. None that does is missing; with the default size at most
    ``1.2 * ratio`` values a feature are listed.

    The sketch's map has at least ``tracked / 0.75`` slots m, a power of two, and its count is too high by at most
    3.5 / m of the rows: a tenth of the threshold by default, below half of it for any ``tracked`` (which must be what the
    sketches were made with) up to a ``ratio`` of 160,000.
    """
    size = _tracked(ratio, tracked)
    slots = 1 << math.ceil(math.log2(size / 0.75))
    merged = sketches.groupBy("feature").agg(
        F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(sketch, {size})").alias("__s"))
    # As many as the sketch can hold: the threshold decides, not a number of values.
    items = merged.select("feature", "rows", F.explode(F.expr(f"approx_top_k_estimate(__s, {size})")).alias("__e"))
    upper, value = F.col("__e.count"), F.col("__e.item")
    low = F.greatest(F.lit(0), upper - F.floor(F.col("rows") * F.lit(3.5 / slots)))
    return items.where(upper * F.lit(int(ratio)) >= F.col("rows")).select(
        "feature", F.when(value.startswith("v"), F.substr(value, F.lit(2))).alias("category"),
        low.cast("bigint").alias("lower"), upper.cast("bigint").alias("upper"), F.col("rows").cast("bigint").alias("rows"))


def frequent_counts(df: DataFrame, columns: list[str], ratio: int, tracked: int | None = None) -> DataFrame:
    """``(feature, category, count, lower, upper)``: exactly the values that hold at least ``1 / ratio`` of the rows, with
    their exact counts. The sketch names the candidates; a second pass counts those alone, so rare values, however
    many, are neither shuffled nor kept. Null is a value."""
    from pricelens.session import materialize
    found = materialize(frequent_items(frequent_sketches(df, columns, ratio, tracked=tracked), ratio, tracked), "frequent-items")
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], list(columns), "feature", "category")
    # A few rows per ``ratio`` and feature: small by construction.
    near = lookup_join(long, found.select("feature", "category"), ["feature", "category"], "left_semi", null_safe=True, small=True)
    counts = near.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("count"))
    both = lookup_join(found, counts, ["feature", "category"], "inner", null_safe=True, small=True)
    return both.where(F.col("count") * F.lit(int(ratio)) >= F.col("rows")).select("feature", "category", "count", "lower", "upper")


def melt_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long ``(variable, value)`` table of numeric columns, values as double."""
    return (df.select(*[F.col(c).cast("double").alias(c) for c in columns])
              .unpivot([], list(columns), "variable", "value"))


def describe_numeric(df: DataFrame, columns: list[str], approx: bool = False,
                     digits: int | None = 2) -> DataFrame:
    """pandas ``describe()``: count, mean, sample std, min, quartiles, max per column.

    Exact mode writes the melted finite values once (narrow); moments, extremes and the
    quantile brackets are one aggregate over them, the quartiles one more pass that moves
    only the rows inside the brackets. ``approx`` uses one pass of ``percentile_approx``.
    """
    from pricelens.session import materialize
    long = melt_numeric(df, columns)
    moments = [F.count("__x").cast("bigint").alias("count"), F.avg("__x").alias("mean"), F.stddev_samp("__x").alias("std"),
               F.min("__x").alias("min"), F.max("__x").alias("max")]
    probs, names = [0.25, 0.5, 0.75], ["q25", "q50", "q75"]
    if approx:
        data = finite_values(long, "value", ["variable"])
        base = data.groupBy("variable").agg(*moments)
        quant = approx_quantiles(data, "__x", probs, by=["variable"], names=names)
    else:
        data = materialize(finite_values(long, "value", ["variable"]), "describe-values")
        base = materialize(data.groupBy("variable").agg(*moments, *bracket_aggregates()), "describe")
        quant = exact_from_brackets(data, base, probs, ["variable"], names)
    out = lookup_join(base.select("variable", "count", "mean", "std", "min", "max"), quant.drop("n"), ["variable"], "left",
                      small=True)
    cols = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    r = (lambda c: F.round(F.col(c), digits)) if digits is not None else F.col
    return out.select("variable", "count", *[r(c).alias(c) for c in cols])


def pearson(df: DataFrame, columns: list[str], pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Pearson r for every pair of columns in ONE aggregate: ``(x, y, r)``."""
    pairs = pairs or list(combinations(columns, 2))
    # A pair counts where both values are finite; ``corr`` itself skips nulls only.
    exprs = [F.corr(finite(F.col(f"`{a}`")), finite(F.col(f"`{b}`"))).alias(f"__r{i}")
             for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*exprs)
    rows = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"__r{i}").alias("r"))
                     for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(rows))
