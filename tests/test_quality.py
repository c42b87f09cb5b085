from pricelens.operators import quality


def _dups(spark):
    # dup_index fixture: equal rows, different index; null_category inside a duplicate group
    rows = [(0, "a", 1.0), (1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (4, None, 3.0), (5, None, 3.0),
            (6, "c", float("nan"))]
    return spark.createDataFrame(rows, "idx int, cat string, x double")


def test_dedup_ignores_index(spark):
    df = _dups(spark)
    assert quality.dedup(df).count() == 7  # index makes every row unique (the Spark-job quirk)
    assert quality.dedup(df, ignore=["idx"]).count() == 4
    kept = quality.dedup(df, keep_first_by="idx")
    assert sorted(r.idx for r in kept.collect()) == [0, 2, 3, 6]


def test_duplicate_count_and_rows(spark):
    df = _dups(spark)
    r = quality.duplicate_count(df, ignore=["idx"]).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (7, 4, 3)
    dup = quality.duplicate_rows(df, order_by="idx")
    assert sorted(r.idx for r in dup.collect()) == [1, 4, 5]


def test_missing_counts_nan_and_null(spark):
    out = {r.column: r.n_missing for r in quality.missing_counts(_dups(spark)).collect()}
    assert out == {"idx": 0, "cat": 3, "x": 1}


def test_unique_counts_null_is_a_value(spark):
    out = {r.column: r.n_unique for r in quality.unique_counts(_dups(spark), ["cat", "x"]).collect()}
    assert out["cat"] == 4  # a, b, c, null
    assert out["x"] == 4    # 1, 2, 3, NaN
    approx = {r.column: r.n_unique_approx for r in quality.unique_counts_approx(_dups(spark), ["cat"]).collect()}
    assert approx["cat"] == 4


def test_tiny_tables(spark):
    empty = spark.createDataFrame([], "a string, b double")
    assert quality.duplicate_count(empty).first().n_distinct == 0
    assert quality.dedup(empty).count() == 0
    assert quality.unique_counts(empty, ["a"]).count() == 0
    one = spark.createDataFrame([("x", 1.0)], "a string, b double")
    assert quality.dedup(one).count() == 1
    assert quality.duplicate_count(one).first().n_duplicates == 0
