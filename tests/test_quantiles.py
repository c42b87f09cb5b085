import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelens.functions.quantiles import (approx_quantiles, exact_quantiles, merge_sketches, quantile_sketches, rank_error,
                                           sketch_quantiles)
from pricelens.session import materialize

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _check(spark, values, groups=None, force_bucketed=False, monkeypatch=None):
    if groups is None:
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        by = []
    else:
        df = spark.createDataFrame([(g, float(v)) for g, v in zip(groups, values)], "g string, x double")
        by = ["g"]
    out = exact_quantiles(df, "x", PROBS, by=by, names=[f"p{i}" for i in range(len(PROBS))],
                          **({"k": 8, "task_rows": 3} if force_bucketed else {}))
    rows = out.collect()
    for r in rows:
        vals = np.array([v for v, g in zip(values, groups or [None] * len(values))
                         if groups is None or g == r["g"]], dtype=float)
        expect = np.percentile(vals, [p * 100 for p in PROBS])  # linear interpolation
        got = [r[f"p{i}"] for i in range(len(PROBS))]
        assert np.allclose(got, expect, rtol=1e-12, atol=1e-9), (got, expect)
        assert r["n"] == len(vals)


@pytest.mark.parametrize("force", [False, True])
def test_exact_matches_numpy(spark, monkeypatch, force):
    rng = np.random.default_rng(7)
    # "outliers" fixture plus heavy duplicates: one value holds a third of the rows
    values = list(range(1, 101)) + [10_000] + [5] * 60 + list(rng.normal(50, 10, 40).round(2))
    _check(spark, values, force_bucketed=force)
    groups = ["a" if i % 2 else "b" for i in range(len(values))]
    _check(spark, values, groups, force_bucketed=force)


@pytest.mark.parametrize("force", [False, True])
def test_single_and_constant(spark, monkeypatch, force):
    _check(spark, [3.5], force_bucketed=force)
    _check(spark, [2.0] * 10, force_bucketed=force)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60))
def test_property_bucketed_equals_numpy(spark, values):
    _check(spark, values, force_bucketed=True)


def test_approx_close(spark):
    values = list(range(1000))
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    r = approx_quantiles(df, "x", [0.5], names=["m"]).first()
    assert abs(r.m - 499.5) <= 2


def test_brackets_hold_a_fraction_of_the_rows(spark):
    from pyspark.sql import functions as F
    df = spark.range(200_000).select((F.xxhash64("id") / 1e12).alias("x"))
    values = np.sort(np.array([r.x for r in df.collect()]))
    r = exact_quantiles(df, "x", [0.25, 0.5, 0.75], names=["a", "b", "c"], k=200).first()
    assert np.allclose([r.a, r.b, r.c], np.percentile(values, [25, 50, 75]), rtol=1e-12) and r.n == 200_000
    r = exact_quantiles(df, "x", [0.25, 0.5, 0.75], names=["a", "b", "c"], k=200, task_rows=50).first()
    assert np.allclose([r.a, r.b, r.c], np.percentile(values, [25, 50, 75]), rtol=1e-12)


def test_no_finite_value(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "x double")
    assert exact_quantiles(df, "x", [0.5]).collect() == []


def test_stored_sketches_merge(spark):
    """Sketches written per day and merged later are within the stated rank error of the exact quantiles."""
    from pyspark.sql import functions as F
    df = spark.range(50_000).select((F.col("id") % 7).alias("day"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"),
                                    F.pow(F.rand(3), 2).alias("x"))
    df = materialize(df, "sketch-values")
    days = materialize(quantile_sketches(df, "x", ["day", "g"]), "sketches")
    merged = {r.g: r for r in sketch_quantiles(merge_sketches(days, ["g"]), [0.1, 0.5, 0.9]).collect()}
    for g in "ab":
        values = np.sort([r.x for r in df.where(F.col("g") == g).select("x").collect()])
        assert merged[g].n == len(values)
        for q, name in ((0.1, "q1"), (0.5, "q5"), (0.9, "q9")):
            rank = np.searchsorted(values, merged[g][name]) / len(values)
            assert abs(rank - q) < 2 * rank_error()
    empty = sketch_quantiles(quantile_sketches(df.where("false"), "x"), [0.5]).collect()
    assert [tuple(r) for r in empty] == [(0, None)]
