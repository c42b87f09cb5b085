import numpy as np

from pricelens.operators import profile
from pricelens.operators.recode import group_rare, price_units


def test_value_counts_ties_and_nulls(spark):
    # freq_ties: two categories with equal counts; nulls excluded
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), ("c",)], "c string")
    vc = {r.c: r["count"] for r in profile.value_counts_one(df, "c").collect()}
    assert vc == {"a": 2, "b": 2, "c": 1}
    fs = profile.freq_share(df, ["c"]).orderBy("rank").collect()
    assert [r.category for r in fs] == ["a", "b", "c"]
    assert abs(sum(r.share for r in fs) - 1.0) < 1e-12


def test_freq_share_distributed_rank(spark, monkeypatch):
    df = spark.createDataFrame([(c,) for c in "aabbbcdddd"], "c string")
    window = {(r.feature, r.category): r.rank for r in profile.freq_share(df, ["c"]).collect()}
    monkeypatch.setattr(profile, "WINDOW_RANK_LIMIT", 0)
    dist = {(r.feature, r.category): r.rank for r in profile.freq_share(df, ["c"]).collect()}
    assert window == dist == {("c", "d"): 1, ("c", "b"): 2, ("c", "a"): 3, ("c", "c"): 4}


def test_describe_matches_pandas_rules(spark):
    vals = list(range(1, 101)) + [10_000]
    df = spark.createDataFrame([(float(v), 1) for v in vals], "x double, k int")
    r = profile.describe_numeric(df, ["x"], digits=None).first()
    a = np.array(vals, dtype=float)
    assert r["count"] == len(a)
    assert np.isclose(r["mean"], a.mean()) and np.isclose(r["std"], a.std(ddof=1))
    assert np.allclose([r.q25, r.q50, r.q75], np.percentile(a, [25, 50, 75]))
    assert (r["min"], r["max"]) == (1.0, 10000.0)


def test_pearson_and_melt(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    y = 2 * x + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    r = profile.pearson(df, ["x", "y"]).first()
    assert np.isclose(r.r, np.corrcoef(x, y)[0, 1])
    assert profile.melt_numeric(df, ["x", "y"]).count() == 400


def test_group_rare(spark):
    # rare_mix: counts 199, 200, 201 and a null
    rows = [("a",)] * 199 + [("b",)] * 200 + [("c",)] * 201 + [(None,)]
    df = spark.createDataFrame(rows, "m string")
    out = {r.m: r["count"] for r in profile.value_counts_one(group_rare(df, "m", 200), "m").collect()}
    assert out == {"Other": 200, "b": 200, "c": 201}


def test_price_units_half_up(spark):
    df = spark.createDataFrame([(125 / 100 * 1000.0,), (2_500_000.0,)], "p double")
    out = price_units(df, "p").collect()
    assert out[0].price_out == round(1250.0 * 0.0036, 3)
    assert out[1].price_label == "3M"  # 2.5 rounds half up in the label text
