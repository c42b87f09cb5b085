"""The data behind each distribution plot: histograms, densities, box and violin
statistics, regression lines with bands, 2-D binned scatter.

Only bounded summaries leave the cluster: a histogram is ``bins`` rows, a density is
``grid`` rows per group, box statistics one row per variable.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.columns import finite
from pricelens.functions.joins import lookup_join
from pricelens.functions.kernels import kernel_sums
from pricelens.functions.quantiles import approx_quantiles, exact_quantiles
from pricelens.operators.profile import melt_numeric
from pricelens.session import materialize, spread

SQRT_2PI = math.sqrt(2.0 * math.pi)


def _finite(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """Rows with a finite value: nulls, NaN and infinities have no place on an axis."""
    return df.select(*by, finite(value).alias("__x")).where(F.col("__x").isNotNull())


def with_numpy_bin(df: DataFrame, x: str, lo: float, hi: float, bins: int, out: str = "bin") -> DataFrame:
    """Add the bin index numpy's equal-width histogram gives (last bin closed).

    First guess ``floor((x - lo) / (hi - lo) * bins)``, then the same one-step
    corrections numpy applies against the ``linspace`` edges ``i * step + lo``. Each
    step is its own projection so the expression never repeats itself.
    """
    step = (hi - lo) / float(bins)

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))

    xc = F.col(x)
    b = F.floor((xc - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins)))
    df = df.withColumn("__b0", F.when(b == bins, F.lit(bins - 1)).otherwise(b))
    b0 = F.col("__b0")
    df = df.withColumn("__b1", F.when(xc < edge(b0), b0 - 1).otherwise(b0))
    b1 = F.col("__b1")
    df = df.withColumn(out, F.when((xc >= edge(b1 + 1)) & (b1 != bins - 1), b1 + 1).otherwise(b1))
    return df.drop("__b0", "__b1")


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max]: ``(bin, bin_lo, bin_hi, count)``, empty bins kept.

    min/max come back to the driver as two numbers; a constant column widens to
    [v-0.5, v+0.5] like numpy. Empty bins come from a union with a zero row per bin
    and a re-aggregate (at most 2 x ``bins`` rows) rather than a join, which would make
    the optimizer re-evaluate the bin expression in a null filter at the scan.
    """
    data = _finite(df, value)
    lo, hi = data.agg(F.min("__x"), F.max("__x")).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin bigint, bin_lo double, bin_hi double, count bigint")
    if hi <= lo:
        lo, hi = lo - 0.5, hi + 0.5
    counts = (with_numpy_bin(data, "__x", lo, hi, bins).groupBy("bin")
              .agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    frame = spark.range(bins).select(F.col("id").alias("bin"), F.lit(0).cast("bigint").alias("count"))
    step = (hi - lo) / float(bins)
    out = counts.unionByName(frame).groupBy("bin").agg(F.sum("count").alias("count"))
    return out.select(
        F.col("bin").cast("bigint").alias("bin"),
        (F.col("bin").cast("double") * F.lit(step) + F.lit(lo)).alias("bin_lo"),
        F.when(F.col("bin") == bins - 1, F.lit(hi))
         .otherwise((F.col("bin") + 1).cast("double") * F.lit(step) + F.lit(lo)).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def density(df: DataFrame, value: str, by: list[str] | tuple = (), grid_size: int = 200,
            cut: float = 0.0, bw_adjust: float = 1.0, binned: bool = True,
            bins: int = 2048) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth ``std * n^(-1/5)`` on a grid.

    The grid runs from ``min - cut*bw`` to ``max + cut*bw`` (``cut=0``: histogram
    overlay; ``cut=2``, 100 points: violin). By default each group is first reduced to
    ``bins`` weighted bin centres (error below ``bin width / 2`` in x), so the kernel
    work is ``bins x grid`` per group at most; a point adds to the grid points within eight bandwidths; ``binned=False`` evaluates every row. Where an extreme
    value makes these bins wider than an eighth of the bandwidth, bins have that width instead
    and stand for the mean of their values; only non-empty bins are kept. Output:
    ``by..., k, x, density, n, bw``; a group with zero spread has no density rows.
    """
    by = list(by)
    data = _finite(df, value, by)
    stats = data.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("__x").alias("std"),
                                  F.min("__x").alias("mn"), F.max("__x").alias("mx"))
    bw = F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.lit(bw_adjust)
    stats = (stats.withColumn("bw", bw)
                  .withColumn("__lo", F.col("mn") - F.lit(cut) * F.col("bw"))
                  .withColumn("__hi", F.col("mx") + F.lit(cut) * F.col("bw"))
                  .withColumn("__step", (F.col("__hi") - F.col("__lo")) / F.lit(float(grid_size - 1)))
                  .where(F.col("bw") > 0))
    if by:
        stats = stats.checkpoint(eager=True)  # one row per group; reused three times below

        def attach(d: DataFrame, cols: list[str]) -> DataFrame:
            return lookup_join(d, stats.select(*by, *cols), by, "inner", null_safe=True, materialize=False)
    else:
        # One row (or none when the spread is zero): bounded, read to the driver once.
        row = stats.first()
        one = row.asDict() if row is not None else None

        def attach(d: DataFrame, cols: list[str]) -> DataFrame:
            if one is None:
                return d.select("*", *[F.lit(None).cast("double").alias(c) for c in cols]).where(F.lit(False))
            return d.select("*", *[F.lit(one[c]).alias(c) for c in cols])
    weight = None
    points = data
    if binned:
        width, narrow = (F.col("mx") - F.col("mn")) / F.lit(float(bins)), F.col("bw") / F.lit(8.0)
        off = F.col("__x") - F.col("mn")
        pts = attach(data, ["mn", "mx", "bw"])
        pts = pts.withColumn("__b", F.when(narrow < width, F.floor(off / narrow))
                             .otherwise(F.least(F.floor(off / width), F.lit(bins - 1))))
        points = (pts.groupBy(*by, "__b", "mn", "mx", "bw")
                     .agg(F.count(F.lit(1)).alias("__wt"), F.avg(off).alias("__off"))
                     .select(*by, F.when(narrow < width, F.col("mn") + F.col("__off"))
                             .otherwise(F.col("mn") + (F.col("__b") + 0.5) * width).alias("__x"),
                             F.col("__wt").cast("double").alias("__wt")))
        weight = "__wt"
    points = attach(points, ["__lo", "__step", "bw"]).withColumnRenamed("bw", "__bw")
    # Kernel work is CPU-heavy: rows of one large file are spread over the cores first.
    sums = kernel_sums(points if binned else spread(points), by, "__x", weight, grid_size)
    # Grid points that no value reaches have density 0: one more row per group and grid point.
    groups = stats.select(*by) if by else df.sparkSession.range(1 if one is not None else 0).select()
    empty = groups.select(*by, F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("__k"), F.lit(0.0).alias("__sum"))
    sums = sums.unionByName(empty).groupBy(*by, "__k").agg(F.sum("__sum").alias("__sum"))
    out = attach(sums, ["n", "bw", "__lo", "__step"])
    return out.select(
        *by, F.col("__k").cast("bigint").alias("k"),
        (F.col("__k").cast("double") * F.col("__step") + F.col("__lo")).alias("x"),
        (F.col("__sum") / (F.col("n") * F.col("bw") * F.lit(SQRT_2PI))).alias("density"),
        F.col("n").cast("bigint").alias("n"), F.col("bw"))


def box_stats(df: DataFrame, columns: list[str], whis: float = 1.5, approx: bool = False) -> DataFrame:
    """Box-plot statistics per variable: quartiles, IQR, whiskers at the last datum
    inside ``whis * IQR``, and the number of outliers beyond the whiskers.

    The melted columns are written once (narrow); the quartiles read them twice and the
    whiskers once, each time with one small aggregate.
    """
    long = materialize(melt_numeric(df, columns).withColumn("value", finite("value")).where(F.col("value").isNotNull()),
                       "box-values")
    q = (approx_quantiles if approx else exact_quantiles)(
        long, "value", [0.25, 0.5, 0.75], by=["variable"], names=["q1", "median", "q3"])
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lo_lim", F.col("q1") - F.lit(whis) * F.col("iqr"))
          .withColumn("hi_lim", F.col("q3") + F.lit(whis) * F.col("iqr")))
    tagged = lookup_join(long, q.select("variable", "lo_lim", "hi_lim"), ["variable"], "inner", small=True)
    v, lo, hi = F.col("value"), F.col("lo_lim"), F.col("hi_lim")
    whisk = tagged.groupBy("variable").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_lo"), F.max(F.when(v <= hi, v)).alias("whisker_hi"),
        F.sum(F.when((v < lo) | (v > hi), 1).otherwise(0)).cast("bigint").alias("n_outliers"))
    out = lookup_join(q, whisk, ["variable"], "left", small=True)
    return out.select("variable", "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "n_outliers")


def box_outliers(df: DataFrame, columns: list[str], whis: float = 1.5) -> DataFrame:
    """Every outlier point ``(variable, value)`` of the box plot (no cap: distributed)."""
    long = materialize(melt_numeric(df, columns).withColumn("value", finite("value")).where(F.col("value").isNotNull()),
                       "box-values")
    q = exact_quantiles(long, "value", [0.25, 0.75], by=["variable"], names=["q1", "q3"])
    q = q.select("variable", (F.col("q1") - F.lit(whis) * (F.col("q3") - F.col("q1"))).alias("lo_lim"),
                 (F.col("q3") + F.lit(whis) * (F.col("q3") - F.col("q1"))).alias("hi_lim"))
    tagged = lookup_join(long, q, ["variable"], "inner", small=True)
    return tagged.where((F.col("value") < F.col("lo_lim")) | (F.col("value") > F.col("hi_lim"))) \
                 .select("variable", "value")


def violin_quartiles(df: DataFrame, by: str, value: str, approx: bool = False) -> DataFrame:
    """Quartile lines of a violin per group (``inner='quartile'``)."""
    df = df if approx else materialize(df.select(by, value), "violin-values")
    return (approx_quantiles if approx else exact_quantiles)(
        df, value, [0.25, 0.5, 0.75], by=[by], names=["q1", "median", "q3"])


def violin_density(df: DataFrame, by: str, value: str, grid_size: int = 100, cut: float = 2.0,
                   binned: bool = True, bins: int = 2048) -> DataFrame:
    """Per-group density of a violin plot: 100 points reaching 2 bandwidths past the data."""
    return density(df, value, by=[by], grid_size=grid_size, cut=cut, binned=binned, bins=bins)


_REGR_NAMES = ["n", "slope", "intercept", "r2", "sxx", "syy", "sxy", "avg_x", "avg_y", "min_x", "max_x"]


def regression(df: DataFrame, xs: list[str], y: str) -> DataFrame:
    """Least-squares line of ``y`` on each ``x``: one row per x.

    The x columns are unpivoted to ``(x, xv, yv)`` inside the scan pipeline and ONE
    grouped aggregate of the native ``regr_*`` functions follows (partial + final), so
    the aggregation buffer stays small whatever the number of x columns.
    """
    long = (df.select(finite(F.col(f"`{y}`")).alias("__y"), *[finite(F.col(f"`{x}`")).alias(x) for x in xs])
              .unpivot(["__y"], list(xs), "x", "__xv"))
    xv, yv = F.col("__xv"), F.col("__y")
    out = long.groupBy("x").agg(
        F.regr_count(yv, xv).cast("bigint").alias("n"), F.regr_slope(yv, xv).alias("slope"),
        F.regr_intercept(yv, xv).alias("intercept"), F.regr_r2(yv, xv).alias("r2"),
        F.regr_sxx(yv, xv).alias("sxx"), F.regr_syy(yv, xv).alias("syy"), F.regr_sxy(yv, xv).alias("sxy"),
        F.regr_avgx(yv, xv).alias("avg_x"), F.regr_avgy(yv, xv).alias("avg_y"),
        F.min(F.when(yv.isNotNull(), xv)).alias("min_x"), F.max(F.when(yv.isNotNull(), xv)).alias("max_x"))
    return out.select(*_REGR_NAMES[:0], "x", *_REGR_NAMES)


def _inverse_normal(p: float) -> float:
    """Standard normal quantile (Acklam's rational approximation, |error| < 1.2e-9)."""
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
    plow = 0.02425
    if p < plow:
        q = math.sqrt(-2 * math.log(p))
        return (((((c[0]*q+c[1])*q+c[2])*q+c[3])*q+c[4])*q+c[5]) / ((((d[0]*q+d[1])*q+d[2])*q+d[3])*q+1)
    if p > 1 - plow:
        return -_inverse_normal(1 - p)
    q = p - 0.5
    r = q * q
    return (((((a[0]*r+a[1])*r+a[2])*r+a[3])*r+a[4])*r+a[5])*q / (((((b[0]*r+b[1])*r+b[2])*r+b[3])*r+b[4])*r+1)


def t_quantile(p: float, nu: Column) -> Column:
    """Student-t quantile at ``p`` (0.5 < p < 1) for ``nu`` degrees of freedom.

    Exact for 1 and 2. Beyond, the asymptotic expansion of Hill (1970) for the two-tailed
    probability, whose relative error is about 1e-5 at 3 and falls with ``nu``.
    """
    tail = 2.0 * (1.0 - p)
    one = math.tan(math.pi * (p - 0.5))
    two = (2.0 * p - 1.0) * math.sqrt(2.0 / (4.0 * p * (1.0 - p)))
    n = nu
    a = F.lit(1.0) / (n - 0.5)
    b = F.lit(48.0) / (a * a)
    c = ((F.lit(20700.0) * a / b - 98.0) * a - 16.0) * a + 96.36
    d = ((F.lit(94.5) / (b + c) - 3.0) / b + 1.0) * F.sqrt(a * (math.pi / 2.0)) * n
    y = F.pow(d * tail, F.lit(2.0) / n)
    # Centre: a correction of the normal quantile.
    x = F.lit(_inverse_normal(tail / 2.0))
    c_few = F.when(n < 5, c + (n - 4.5) * 0.3 * (x + 0.6)).otherwise(c)
    c_mid = (((d * 0.05 * x - 5.0) * x - 7.0) * x - 2.0) * x + b + c_few
    sq = x * x
    mid = (((((sq * 0.4 + 6.3) * sq + 36.0) * sq + 94.5) / c_mid - sq - 3.0) / b + 1.0) * x
    mid = a * mid * mid
    mid = F.when(mid > 0.002, F.exp(mid) - 1.0).otherwise(mid * mid * 0.5 + mid)
    # Far tail: a power of the tail probability.
    far = (((F.lit(1.0) / (((n + 6.0) / (n * y) - d * 0.089 - 0.822) * (n + 2.0) * 3.0) + F.lit(0.5) / (n + 4.0)) * y - 1.0)
           * (n + 1.0) / (n + 2.0) + F.lit(1.0) / y)
    return (F.when(n == 1, F.lit(one)).when(n == 2, F.lit(two))
            .otherwise(F.sqrt(n * F.when(y > a + 0.05, mid).otherwise(far))))


def regression_band(df: DataFrame, xs: list[str], y: str, level: float = 0.95,
                    grid_size: int = 20) -> DataFrame:
    """Analytic confidence band of the fitted mean on a grid of each x.

    ``fit ± t(level, n-2) * s * sqrt(1/n + (x0 - mean x)^2 / Sxx)``, ``s^2 = SSE/(n-2)``.
    The plotting library bootstraps this band; the closed form is what it estimates.
    """
    st = regression(df, xs, y).where(F.col("n") > 2)
    nu = (F.col("n") - 2).cast("double")
    sse = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    st = (st.withColumn("s", F.sqrt(sse / nu)).withColumn("t", t_quantile(0.5 + level / 2.0, nu))
            .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1)))))
    x0 = F.col("min_x") + F.col("k").cast("double") * (F.col("max_x") - F.col("min_x")) / F.lit(float(grid_size - 1))
    st = st.withColumn("x0", x0)
    fit = F.col("intercept") + F.col("slope") * F.col("x0")
    se = F.col("s") * F.sqrt(F.lit(1.0) / F.col("n") + F.pow(F.col("x0") - F.col("avg_x"), 2) / F.col("sxx"))
    return st.select("x", F.col("k").cast("bigint").alias("k"), "x0", fit.alias("fit"),
                     (fit - F.col("t") * se).alias("lower"), (fit + F.col("t") * se).alias("upper"))


def bootstrap_band(df: DataFrame, xs: list[str], y: str, keys: list[str], level: float = 0.95, grid_size: int = 20,
                   replicates: int = 200, seed: int = 0) -> DataFrame:
    """Bootstrap confidence band of the fitted mean on a grid of each x: ``x, k, x0, lower, upper``.

    A Poisson bootstrap in one pass: each row stands in each replicate a number of times that is drawn, Poisson with
    mean 1, from a hash of its key and the replicate, so the draw does not depend on partitions or retries. A
    task reduces every Arrow batch to the regression sums of all replicates (one matrix product); Spark adds
    them up, 5 numbers per x and replicate. The band is the quantiles of the replicates' lines at each x0.
    """
    st = {r["x"]: r for r in regression(df, xs, y).where("n > 2").collect()}  # one row per x
    names = [x for x in xs if x in st]
    rows = df.select(F.xxhash64(*[F.col(c) for c in keys]).alias("__h"), finite(F.col(f"`{y}`")).alias("__y"),
                     *[finite(F.col(f"`{x}`")).alias(f"__x{i}") for i, x in enumerate(names)]).where("__y is not null")
    centres = [(st[x]["avg_x"], st[x]["avg_y"]) for x in names]

    def sums(batches):
        total = np.zeros((len(names), replicates, 5))
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at:at + 4096]
                weight = poisson_weights(part["__h"].to_numpy(), replicates, seed)
                for i, (cx, cy) in enumerate(centres):
                    dx, dy = part[f"__x{i}"].to_numpy(dtype=float) - cx, part["__y"].to_numpy(dtype=float) - cy
                    ok = ~np.isnan(dx)
                    one = np.stack([ok.astype(float), dx, dy, dx * dx, dx * dy], axis=1)
                    total[i] += weight.T @ np.where(ok[:, None], one, 0.0)
        x, r = np.meshgrid(np.arange(len(names)), np.arange(replicates), indexing="ij")
        yield pd.DataFrame({"__i": x.ravel(), "__r": r.ravel(), **{f"s{j}": total[:, :, j].ravel() for j in range(5)}})

    parts = spread(rows).mapInPandas(sums, "__i int, __r int, s0 double, s1 double, s2 double, s3 double, s4 double")
    lines = parts.groupBy("__i", "__r").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(5)])
    slope = (F.col("s4") - F.col("s1") * F.col("s2") / F.col("s0")) / (F.col("s3") - F.col("s1") * F.col("s1") / F.col("s0"))
    lines = lines.withColumn("slope", slope).withColumn("level", (F.col("s2") - F.col("slope") * F.col("s1")) / F.col("s0"))
    grid = df.sparkSession.createDataFrame(
        [(i, x, k, r["min_x"] + k * (r["max_x"] - r["min_x"]) / (grid_size - 1.0), r["avg_x"], r["avg_y"])
         for i, x in enumerate(names) for r in [st[x]] for k in range(grid_size)],
        "__i int, x string, k long, x0 double, cx double, cy double")
    fits = lines.join(F.broadcast(grid), "__i").select(  # replicates x grid rows per x
        "x", "k", "x0", (F.col("cy") + F.col("level") + F.col("slope") * (F.col("x0") - F.col("cx"))).alias("fit"))
    tail = (1 - level) / 2
    return fits.groupBy("x", "k", "x0").agg(F.percentile("fit", F.lit(tail)).alias("lower"),
                                            F.percentile("fit", F.lit(1 - tail)).alias("upper"))


def poisson_weights(hashes: np.ndarray, replicates: int, seed: int = 0) -> np.ndarray:
    """Rows x replicates numbers, Poisson with mean 1, from 64-bit hashes by the inverse distribution."""
    key = hashes.astype(np.int64).view(np.uint64)[:, None] + np.arange(1, replicates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key += np.uint64(seed)
    key = (key ^ (key >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    key = (key ^ (key >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    share = ((key ^ (key >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
    return np.searchsorted(steps, share.ravel(), side="right").reshape(share.shape).astype(np.float64)


def bins2d(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Counts on a ``bins x bins`` grid over the data range (non-empty cells only)."""
    data = df.select(finite(F.col(f"`{x}`")).alias("__x"), finite(F.col(f"`{y}`")).alias("__y")) \
             .where(F.col("__x").isNotNull() & F.col("__y").isNotNull())
    x0, x1, y0, y1 = data.agg(F.min("__x"), F.max("__x"), F.min("__y"), F.max("__y")).first()

    def b(c, lo, hi):
        if lo is None or not hi > lo:
            return F.lit(0).cast("bigint")
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))),
                       F.lit(bins - 1)).cast("bigint")

    return (data.select(b("__x", x0, x1).alias("x_bin"), b("__y", y0, y1).alias("y_bin"))
                .groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).cast("bigint").alias("count")))
