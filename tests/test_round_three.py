"""Exact split, bootstrap band, digests before the duplicate compare, malformed CSV lines, forest in parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.operators import distribution as dist
from pricelens.operators import quality
from pricelens.operators.split import exact_split
from pricelens.sources.files import read_checked_csv


@pytest.mark.parametrize("n, share, want", [(1000, 0.2, 200), (997, 0.2, 199), (3, 0.5, 2), (10, 0.0, 0), (10, 1.0, 10), (0, 0.2, 0)])
def test_exact_split_size(spark, n, share, want):
    df = spark.range(n)
    rows = {r.id: r.is_test for r in exact_split(df, ["id"], share).collect()}
    assert len(rows) == n and sum(rows.values()) == want
    assert rows == {r.id: r.is_test for r in exact_split(df.repartition(7), ["id"], share).collect()}


def test_bootstrap_band(spark):
    """Near the closed form where that holds, the same whatever the partitions, blind to nulls and NaN."""
    rng = np.random.default_rng(2)
    x = rng.normal(50, 10, 3000)
    rows = [(i, float(a), float(3 * a + e)) for i, (a, e) in enumerate(zip(x, rng.normal(0, 20, 3000)))]
    rows += [(9001, None, 5.0), (9002, 5.0, None), (9003, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    boot = {r.k: r for r in dist.bootstrap_band(df, ["x"], "y", ["id"]).collect()}
    again = {r.k: r for r in dist.bootstrap_band(df.repartition(5), ["x"], "y", ["id"]).collect()}
    closed = {r.k: r for r in dist.regression_band(df, ["x"], "y").collect()}
    assert boot.keys() == closed.keys() == set(range(20))
    for k, c in closed.items():
        half = (c.upper - c.lower) / 2
        assert abs(boot[k].lower - c.lower) < 0.4 * half and abs(boot[k].upper - c.upper) < 0.4 * half
        assert boot[k].lower == pytest.approx(again[k].lower, rel=1e-9) and boot[k].x0 == pytest.approx(c.x0)


def test_poisson_weights():
    w = dist.poisson_weights(np.arange(20000) * 7919, 50)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.03


def test_duplicate_rows_by_digest(spark):
    rows = [(i, i % 40 if i % 3 else None, "hot" if i % 2 else None) for i in range(600)] + [(1000 + i, i + 500, "one") for i in range(50)]
    df = spark.createDataFrame(rows, "row_id long, a long, b string").repartition(5)
    seen, want = set(), []
    for r in sorted(rows):
        if r[1:] in seen:
            want.append(r)
        seen.add(r[1:])
    assert sorted(tuple(r) for r in quality.duplicate_rows(df, "row_id").collect()) == want
    assert quality.duplicate_rows(df.where("false"), "row_id").collect() == []


def test_every_csv_line_is_good_or_rejected(spark, scratch):
    lines = ["a,b,c", "1,x,2", "1,x", "1,x,2,3,4", '2,"q,r",3', "", "4,,", '5,"never ends,6', "7,y,8"]
    path = f"{scratch}/lines.csv"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    good, bad = read_checked_csv(spark, path, parse=False, ignore=[])
    got = sorted(tuple(r) for r in good.fillna("").collect())
    assert [r for r in got if r[0] != "5"] == [("1", "x", "2"), ("2", "q,r", "3"), ("4", "", ""), ("7", "y", "8")]
    rejected = {r.line: r.n_fields for r in bad.collect()}
    assert rejected["1,x"] == 2 and rejected["1,x,2,3,4"] == 5
    assert good.count() + bad.count() == sum(bool(x) for x in lines) - 1  # empty lines are no records


def test_forest_in_parts_is_one_saved_model(spark, scratch):
    from pricelens.config import LISTING_ROLES as roles
    from pricelens.operators.train import fit_forest, load_model, num_features, save_model
    from pricelens.sources import listings
    df = listings(spark, "/root/testdata/sf0.001").limit(400)
    model = fit_forest(df, roles, trees=5, depth=3, part_trees=2)
    forests = [s for s in model.stages if hasattr(s, "trees")]
    assert [len(f.trees) for f in forests] == [2, 2, 1] and num_features(model) == forests[0].numFeatures
    out = model.transform(df)
    assert not [c for c in out.columns if c.startswith("__part")]
    save_model(model, f"{scratch}/parts-model")
    again = load_model(f"{scratch}/parts-model").transform(df)
    both = [out.agg(F.sum("prediction"), F.min("prediction")).first(), again.agg(F.sum("prediction"), F.min("prediction")).first()]
    assert both[0][0] == pytest.approx(both[1][0]) and both[0][1] == pytest.approx(both[1][1])
    features = type(model)(stages=[s for s in model.stages[:-len(forests) - 1]]).transform(df).select("features").limit(20).collect()
    for r in features:
        mean = np.mean([t.predict(r.features) for f in forests for t in f.trees])
        weighted = sum(len(f.trees) * f.predict(r.features) for f in forests) / 5
        assert mean == pytest.approx(weighted)
