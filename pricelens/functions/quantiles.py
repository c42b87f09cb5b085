"""Exact and approximate quantiles that never gather a whole column into one task.

``exact_quantiles`` returns the same numbers as linear-interpolation percentiles
(``percentile`` in Spark, ``quantile_cont`` in SQL engines, numpy's default):
position ``h = (n - 1) * q``, value ``x[floor h] + (h - floor h) * (x[ceil h] - x[floor h])``.

Plan (what leaves the tasks is bounded by the sketch, not by the rows):

1. one aggregate per group: row count, extremes and a KLL sketch (bounded memory, mergeable), which
   gives for each quantile a bracket of two values that the exact quantile lies between;
2. the rows below each bracket as conditional sums, one row a group, and the distinct values inside it
   with map-side combine: only bracket rows (some ten-thousandths of the column) are shuffled;
3. running sums inside each bracket give the values at ``floor h`` and ``ceil h``. A bracket
   of more than ``task_rows`` distinct values is first narrowed: counts in 4,096 equal bins
   of its range tell which bins hold the two ranks, and the others are dropped.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.columns import finite
from pricelens.functions.joins import lookup_join

BINS = 4096
#: Size of the KLL sketches, and their normalised rank error at 99 % (2.296 / k^0.9021).
SKETCH_K = 8192


def rank_error(k: int = SKETCH_K) -> float:
    return 2.296 / k ** 0.9021


def _qname(q: float) -> str:
    return "q" + (f"{q:.6f}".rstrip("0").rstrip(".").replace("0.", "", 1) if q < 1 else "100")


def finite_values(df: DataFrame, value: str, by: list[str] | tuple = ()) -> DataFrame:
    """``(by..., __x)``: the finite values of a column."""
    return df.select(*by, finite(value).alias("__x")).where(F.col("__x").isNotNull())


def bracket_aggregates(k: int = SKETCH_K) -> list:
    """Aggregates over ``__x`` that ``exact_from_brackets`` needs, to go with a caller's own."""
    return [F.count("__x").cast("bigint").alias("__n"), F.min("__x").alias("__min"), F.max("__x").alias("__max"),
            F.kll_sketch_agg_double("__x", F.lit(k)).alias("__sketch")]


def quantile_sketches(df: DataFrame, value: str, by: list[str] | tuple = (), k: int = SKETCH_K) -> DataFrame:
    """``by..., n, sketch``: a KLL sketch per group as a binary column, to be stored and merged later."""
    data = finite_values(df, value, list(by))
    return data.groupBy(*by).agg(F.count("__x").cast("bigint").alias("n"), F.kll_sketch_agg_double("__x", F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] | tuple = (), k: int = SKETCH_K) -> DataFrame:
    """Stored sketches of parts (days, files, finer groups) as one per group."""
    return sketches.groupBy(*by).agg(F.sum("n").cast("bigint").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: list[float], names: list[str] | None = None) -> DataFrame:
    """The sketches with their quantiles in place of the binary: right to ``rank_error`` of the rows."""
    names = names or [_qname(q) for q in probs]
    return sketches.select("*", *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(c)
                                  for q, c in zip(probs, names)]).drop("sketch")


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | tuple = (),
                    names: list[str] | None = None, task_rows: int = 1_000_000, k: int = SKETCH_K) -> DataFrame:
    """One row per group: ``by...``, ``n`` (count of finite values) and one column per prob.

    The source is read twice; pass a written table if it is costly to compute.
    """
    from pricelens.session import materialize
    by = list(by)
    data = finite_values(df, value, by)
    g = data.groupBy(*by) if by else data.groupBy()
    stats = materialize(g.agg(*bracket_aggregates(k)), "quantile-brackets")
    return exact_from_brackets(data, stats, probs, by, names, task_rows, k=k)


def exact_from_brackets(data: DataFrame, stats: DataFrame, probs: list[float], by: list[str],
                        names: list[str] | None = None, task_rows: int = 1_000_000, width: float = 3.0, k: int = SKETCH_K) -> DataFrame:
    """The exact quantiles of ``data`` (``by..., __x``), given its ``bracket_aggregates`` as a
    written table ``stats``. A bracket reaches ``width`` rank errors to both sides; if one does not hold its
    quantile all are widened, in the end to the whole column."""
    from pricelens.session import materialize
    n_probs = len(probs)
    names = names or [_qname(q) for q in probs]
    # Groups of few rows are their own bracket: near the ends ranks are too coarse for the sketch.
    e = width * rank_error(k)
    few = F.col("__n") < 8 * k

    def edge(i: int, q: float, end: str, name: str):
        whole = not 0 < q < 1
        inner = F.col(end) if whole else F.kll_sketch_get_quantile_double("__sketch", F.lit(q))
        return F.when(few, F.col(end)).otherwise(inner).alias(f"{name}{i}")

    lo = [edge(i, q - e, "__min", "__lo") for i, q in enumerate(probs)]
    hi = [edge(i, q + e, "__max", "__hi") for i, q in enumerate(probs)]
    brackets = stats.where("__n > 0").select(*by, "__n", *lo, *hi)
    if by:
        near = lookup_join(data, brackets, by, "inner", null_safe=True, materialize=False)
    else:
        row = brackets.first()  # one row
        if row is None:
            return data.sparkSession.createDataFrame([], ", ".join(["n bigint", *[f"{n} double" for n in names]]))
        near = data.select("*", *[F.lit(row[c]).alias(c) for c in brackets.columns])
    x = F.col("__x")
    within = [x.between(F.col(f"__lo{i}"), F.col(f"__hi{i}")) for i in range(n_probs)]
    # Rows below a bracket are counted where they lie; only rows inside one become entries.
    below = near.groupBy(*by, "__n").agg(*[F.sum(F.when(x < F.col(f"__lo{i}"), 1).otherwise(0)).alias(f"__b{i}") for i in range(n_probs)])
    below = below.select(*by, "__n", F.inline(F.array(*[
        F.struct(F.lit(i).alias("__i"), F.lit(None).cast("double").alias("__key"), F.col(f"__b{i}").alias("__c"))
        for i in range(n_probs)]))).where("__c > 0")
    entries = F.filter(F.array(*[F.when(w, F.lit(i)) for i, w in enumerate(within)]), lambda i: i.isNotNull())
    inside = near.where(functools.reduce(operator.or_, within)).select(
        *by, "__n", F.explode(entries).alias("__i"), x.alias("__key"))
    inside = inside.groupBy(*by, "__n", "__i", "__key").agg(F.count(F.lit(1)).alias("__c")).unionByName(below)
    cell = [*by, "__n", "__i"]
    inside = materialize(inside, "quantile-rows")
    while inside.count() > task_rows and (inside.groupBy(*cell).count().agg(F.max("count")).first()[0] or 0) > task_rows + 1:
        smaller = materialize(_narrowed(inside, cell, probs), "quantile-rows")
        if smaller.count() == inside.count():
            break  # single values: nothing left to narrow
        inside = smaller

    at = Window.partitionBy(*cell).orderBy(F.asc_nulls_first("__key")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = inside.withColumn("__start", F.coalesce(F.sum("__c").over(at), F.lit(0)))
    h = _position(probs)
    first, last = F.col("__start") <= F.floor(h), F.col("__start") <= F.ceil(h)
    end = F.col("__start") + F.col("__c")
    in_reach = F.col("__key").isNotNull()
    picked = ranked.groupBy(*cell).agg(
        F.max(F.when(in_reach & first & (F.floor(h) < end), F.col("__key"))).alias("__a"),
        F.max(F.when(in_reach & last & (F.ceil(h) < end), F.col("__key"))).alias("__b"))
    picked = materialize(picked, "quantile-values")  # a row per group and quantile
    missed = picked.where(F.col("__a").isNull() | F.col("__b").isNull()).limit(1).count()
    if missed:
        return exact_from_brackets(data, stats, probs, by, names, task_rows, width * 16, k)
    value = F.col("__a") + (h - F.floor(h)) * (F.col("__b") - F.col("__a"))
    out = picked.withColumn("__v", value).groupBy(*by, "__n") if by else picked.withColumn("__v", value).groupBy("__n")
    out = out.agg(*[F.max(F.when(F.col("__i") == i, F.col("__v"))).alias(nm) for i, nm in enumerate(names)])
    return out.select(*by, F.col("__n").cast("bigint").alias("n"), *names)


def _position(probs: list[float]):
    return (F.col("__n") - 1) * F.element_at(F.array(*[F.lit(float(q)) for q in probs]), F.col("__i") + 1)


def _narrowed(inside: DataFrame, cell: list[str], probs: list[float]) -> DataFrame:
    """The bracket rows of the equal-width bins that hold the two ranks, and one row for all below."""
    span = inside.groupBy(*cell).agg(F.min("__key").alias("__l"), F.max("__key").alias("__h"))
    rows = lookup_join(inside, span, cell, "inner", null_safe=True)
    bin_ = F.floor((F.col("__key") - F.col("__l")) / (F.col("__h") - F.col("__l")) * BINS)
    bin_ = F.when(F.col("__key").isNull(), -1).when(F.col("__h") > F.col("__l"), F.least(bin_, F.lit(BINS - 1))).otherwise(0)
    rows = rows.withColumn("__bin", bin_).drop("__l", "__h")
    bins = rows.groupBy(*cell, "__bin").agg(F.sum("__c").alias("__in"))
    at = Window.partitionBy(*cell).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)  # BINS + 1 rows
    bins = bins.withColumn("__s", F.coalesce(F.sum("__in").over(at), F.lit(0)))
    h = _position(probs)
    low, high = F.floor(h), F.ceil(h)
    end = F.col("__s") + F.col("__in")
    holds = ((F.col("__s") <= low) & (low < end)) | ((F.col("__s") <= high) & (high < end))
    bins = bins.where(holds & (F.col("__bin") >= 0))
    below = bins.groupBy(*cell).agg(F.min("__s").alias("__c")).select(*cell, F.lit(None).cast("double").alias("__key"), "__c")
    kept = lookup_join(rows, bins.select(*cell, "__bin"), [*cell, "__bin"], "left_semi", null_safe=True)
    return kept.select(*cell, "__key", "__c").unionByName(below.where("__c > 0"))


def approx_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | tuple = (),
                     names: list[str] | None = None, accuracy: int = 10000) -> DataFrame:
    """``percentile_approx`` (relative rank error 1/accuracy): one pass, bounded memory."""
    by = list(by)
    names = names or [_qname(q) for q in probs]
    arr = F.percentile_approx(F.col(value).cast("double"), list(probs), accuracy)
    g = df.groupBy(*by) if by else df.groupBy()
    out = g.agg(F.count(value).cast("bigint").alias("n"), arr.alias("__q"))
    return out.select(*by, "n", *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])
