import math

import numpy as np
import pytest

from pricelens.operators import distribution as dist


def _df(spark, vals, name="x"):
    return spark.createDataFrame([(float(v),) for v in vals], f"{name} double")


@pytest.mark.parametrize("vals", [
    list(np.random.default_rng(3).lognormal(10, 1, 500)),
    list(range(1, 101)) + [10_000],
    [5.0] * 7,  # constant_col: numpy widens to [v-0.5, v+0.5]
])
def test_histogram_matches_numpy(spark, vals):
    h = dist.histogram(_df(spark, vals), "x", bins=50).orderBy("bin").collect()
    counts, edges = np.histogram(np.array(vals, dtype=float), bins=50)
    assert [r["count"] for r in h] == list(counts)
    assert np.allclose([r.bin_lo for r in h], edges[:-1]) and np.isclose(h[-1].bin_hi, edges[-1])
    assert sum(r["count"] for r in h) == len(vals)


def _kde_numpy(x, grid, bw):
    z = (grid[None, :] - x[:, None]) / bw
    return np.exp(-0.5 * z * z).sum(axis=0) / (len(x) * bw * math.sqrt(2 * math.pi))


def test_density_exact_and_binned(spark):
    x = np.random.default_rng(5).normal(100, 15, 3000)
    df = _df(spark, x)
    exact = dist.density(df, "x", grid_size=200, binned=False).orderBy("k").collect()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    expect = _kde_numpy(x, grid, bw)
    assert np.allclose([r.density for r in exact], expect, rtol=1e-9)
    assert np.allclose([r.x for r in exact], grid)
    binned = dist.density(df, "x", grid_size=200).orderBy("k").collect()
    peak = expect.max()
    assert max(abs(r.density - e) for r, e in zip(binned, expect)) < 1e-3 * peak


def test_binned_density_with_one_extreme_value(spark):
    from pyspark.sql import functions as F
    bulk = spark.range(0, 200_000, 1, 4).select(F.lit("a").alias("g"), F.exp(10 + F.randn(3)).alias("x"))
    df = bulk.unionByName(spark.createDataFrame([("a", 1e9)], "g string, x double"))
    for of in (lambda **how: dist.density(df, "x", **how), lambda **how: dist.violin_density(df, "g", "x", **how)):
        exact = [r.density for r in of(binned=False).orderBy("k").collect()]
        binned = [r.density for r in of().orderBy("k").collect()]
        assert np.allclose(binned, exact, rtol=1e-2, atol=1e-6 * max(exact))
        assert np.isclose(max(binned), max(exact), rtol=2e-3)


def test_density_by_group_and_zero_spread(spark):
    rows = [("a", float(v)) for v in range(50)] + [("b", 1.0)] * 10
    df = spark.createDataFrame(rows, "g string, x double")
    out = dist.violin_density(df, "g", "x", binned=False).collect()
    assert {r.g for r in out} == {"a"}  # constant group has no density
    a = np.arange(50, dtype=float)
    bw = a.std(ddof=1) * 50 ** -0.2
    grid = np.linspace(a.min() - 2 * bw, a.max() + 2 * bw, 100)
    got = [r.density for r in sorted(out, key=lambda r: r.k)]
    assert np.allclose(got, _kde_numpy(a, grid, bw), rtol=1e-9)


def test_box_stats_matplotlib_rules(spark):
    vals = list(range(1, 101)) + [10_000]
    df = _df(spark, vals)
    r = dist.box_stats(df, ["x"]).first()
    a = np.array(vals, dtype=float)
    q1, med, q3 = np.percentile(a, [25, 50, 75])
    iqr = q3 - q1
    assert np.allclose([r.q1, r.median, r.q3, r.iqr], [q1, med, q3, iqr])
    assert r.whisker_lo == a[a >= q1 - 1.5 * iqr].min() and r.whisker_hi == a[a <= q3 + 1.5 * iqr].max()
    assert r.n_outliers == 1
    assert [(o.variable, o.value) for o in dist.box_outliers(df, ["x"]).collect()] == [("x", 10000.0)]


def test_regression_and_band(spark):
    rng = np.random.default_rng(11)
    x = rng.uniform(0, 10, 400)
    y = 3 + 2 * x + rng.normal(0, 1, 400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    r = dist.regression(df, ["x"], "y").first()
    slope, intercept = np.polyfit(x, y, 1)
    assert np.isclose(r.slope, slope) and np.isclose(r.intercept, intercept)
    assert np.isclose(r.r2, np.corrcoef(x, y)[0, 1] ** 2)
    band = dist.regression_band(df, ["x"], "y", grid_size=5).orderBy("k").collect()
    assert all(b.lower < b.fit < b.upper for b in band)
    from pyspark.sql import functions as F
    # Published values of Student's t at 0.975.
    table = {1: 12.706205, 2: 4.302653, 3: 3.182446, 4: 2.776445, 5: 2.570582, 10: 2.228139, 30: 2.042272,
             100: 1.983972, 398: 1.965942}
    nus = spark.createDataFrame([(float(n),) for n in table], "nu double")
    for r in nus.select("nu", dist.t_quantile(0.975, F.col("nu")).alias("t"),
                        dist.t_quantile(0.95, F.col("nu")).alias("t95")).collect():
        assert abs(r.t / table[int(r.nu)] - 1) < 5e-5, r
    t95 = {1: 6.313752, 2: 2.919986, 3: 2.353363, 5: 2.015048, 30: 1.697261}
    for r in nus.select("nu", dist.t_quantile(0.95, F.col("nu")).alias("t")).collect():
        assert r.nu not in t95 or abs(r.t / t95[int(r.nu)] - 1) < 5e-5, r


def test_nan_and_infinity_stay_out_of_every_summary(spark):
    from pricelens.operators import profile
    clean = [(float(i % 13), float(i % 7) + 0.1 * i) for i in range(200)]
    dirty = clean + [(float("nan"), 1.0), (1.0, float("nan")), (float("inf"), 2.0), (3.0, float("-inf")), (None, 4.0)]
    a, b = (spark.createDataFrame(rows, "x double, y double") for rows in (clean, dirty))

    def same(f, *keys):
        one, two = ([tuple(r) for r in f(df).orderBy(*keys).collect()] for df in (a, b))
        assert len(one) == len(two) > 0 and all(np.allclose(p, q) if not isinstance(p[0], str) else
                                                np.allclose(p[1:], q[1:]) for p, q in zip(one, two))

    same(lambda df: dist.bins2d(df, "x", "y", bins=5), "x_bin", "y_bin")
    same(lambda df: dist.regression(df, ["x"], "y"), "x")
    same(lambda df: profile.pearson(df, ["x", "y"]).select("r"), "r")
    xs = spark.createDataFrame([(r[0],) for r in clean], "x double")
    bad = xs.unionByName(spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "x double"))
    for f in (lambda df: dist.histogram(df, "x", bins=5), lambda df: dist.density(df, "x", grid_size=9)):
        one, two = ([tuple(r) for r in f(df).collect()] for df in (xs, bad))
        assert len(one) == len(two) > 0 and np.allclose(sorted(one), sorted(two))
    assert dist.box_stats(xs, ["x"]).first() == dist.box_stats(bad, ["x"]).first()
    assert profile.describe_numeric(xs, ["x"]).first() == profile.describe_numeric(bad, ["x"]).first()


def test_bins2d_sum(spark):
    df = spark.createDataFrame([(float(i % 7), float(i % 11)) for i in range(500)], "x double, y double")
    out = dist.bins2d(df, "x", "y", bins=5).collect()
    assert sum(r["count"] for r in out) == 500
    assert all(0 <= r.x_bin < 5 and 0 <= r.y_bin < 5 for r in out)
