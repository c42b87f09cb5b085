from pyspark.sql import functions as F

from pricelens.functions.joins import bounded_count, lookup_join


def _big(spark):
    # key 0 holds a third of all rows (hot); some null keys
    rows = [(i, 0 if i % 3 == 0 else (None if i % 17 == 0 else i % 50)) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, k int")


def _small(spark):
    return spark.createDataFrame([(k, f"v{k}") for k in range(0, 40)] + [(None, "vnull")], "k int, v string")


def _collect(df):
    return sorted((r.id, r.v) for r in df.select("id", "v").collect())


def test_bounded_count(spark):
    df = spark.range(10)
    assert bounded_count(df, 10) == 10
    assert bounded_count(df, 9) is None


def test_salted_path_equals_broadcast_path(spark):
    big, small = _big(spark), _small(spark)
    for how in ["left", "inner"]:
        for null_safe in [False, True]:
            a = lookup_join(big, small, ["k"], how, null_safe=null_safe)
            b = lookup_join(big, small, ["k"], how, null_safe=null_safe, max_broadcast_bytes=0,
                            hot_fraction=0.1, salt_buckets=8)
            assert _collect(a) == _collect(b)


def test_semi_anti(spark):
    big, small = _big(spark), _small(spark)
    for force in [None, 0]:
        kw = {} if force is None else {"max_broadcast_bytes": 0, "hot_fraction": 0.1}
        semi = lookup_join(big, small, ["k"], "left_semi", **kw)
        anti = lookup_join(big, small, ["k"], "left_anti", **kw)
        assert semi.count() + anti.count() == big.count()
        assert set(semi.columns) == set(big.columns)
        expected_semi = big.where(F.col("k").isNotNull() & (F.col("k") < 40)).count()
        assert semi.count() == expected_semi


def test_hot_key_rows_are_spread(spark):
    big, small = _big(spark), _small(spark)
    out = lookup_join(big, small, ["k"], "left", max_broadcast_bytes=0, hot_fraction=0.1, salt_buckets=8)
    assert out.where(F.col("k") == 0).select("v").distinct().collect()[0].v == "v0"
    assert out.count() == big.count()


def test_non_unique_lookup_keys_on_both_paths(spark):
    big = spark.createDataFrame([(i, 0 if i % 3 == 0 else i % 5) for i in range(300)], "id long, k int")
    small = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "k int, v string")
    expect = sorted((r.id, r.v) for r in big.join(small, "k", "inner").collect())
    for kw in [{}, {"max_broadcast_bytes": 0, "hot_fraction": 0.1, "salt_buckets": 4}]:
        got = sorted((r.id, r.v) for r in lookup_join(big, small, ["k"], "inner", **kw).collect())
        assert got == expect
