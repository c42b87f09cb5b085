import numpy as np
from pyspark.sql import functions as F

from pricelens.operators.evaluate import regression_metrics
from pricelens.operators.split import hash_folds, hash_split, split_frames


def _keys(spark, n=2000):
    return spark.createDataFrame([(i, i % 7) for i in range(n)], "a long, b int")


def test_hash_split_disjoint_complete_repartition_invariant(spark):
    df = _keys(spark)
    t1 = {(r.a, r.b) for r in hash_split(df, ["a", "b"]).where("is_test").collect()}
    t2 = {(r.a, r.b) for r in hash_split(df.repartition(13), ["a", "b"]).where("is_test").collect()}
    assert t1 == t2
    train, test = split_frames(df, ["a", "b"])
    assert train.count() + test.count() == df.count()
    assert train.join(test, ["a", "b"]).count() == 0
    assert 0.15 < len(t1) / 2000 < 0.25


def test_any_share(spark):
    df = spark.range(40000).select(F.col("id").alias("a"), F.lit(1).alias("b"))
    for share in (0.0, 0.004, 0.005, 0.125, 1.0):
        n = hash_split(df, ["a", "b"], share).where("is_test").count()
        assert abs(n - 40000 * share) <= 4 * (40000 * share * (1 - share)) ** 0.5


def test_folds(spark):
    f = hash_folds(_keys(spark), ["a", "b"], 10)
    counts = {r.fold: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(counts) == set(range(10)) and sum(counts.values()) == 2000


def test_regression_metrics_match_formulas(spark):
    rng = np.random.default_rng(2)
    y = rng.normal(size=300)
    p = y + rng.normal(scale=0.5, size=300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = regression_metrics(df, "y", "p").first()
    e = y - p
    assert np.isclose(r.mae, np.abs(e).mean()) and np.isclose(r.mse, (e ** 2).mean())
    assert np.isclose(r.rmse, np.sqrt((e ** 2).mean()))
    assert np.isclose(r.r2, 1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())
    by = regression_metrics(df.withColumn("g", F.lit("x")), "y", "p", by=["g"]).first()
    assert np.isclose(by.r2, r.r2)
