import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from pricelens.operators import encode


def _data(spark):
    # null_category fixture: a null in the target column and in an ordinal column
    rows = [("a", "x", 10.0), ("a", "x", 12.0), ("a", "y", 14.0), ("b", "y", 20.0),
            ("b", None, 22.0), (None, "x", 30.0), ("c", "y", 5.0)]
    return spark.createDataFrame(rows, "cat string, ord string, y double")


def test_additive_formula_and_nulls(spark):
    df = _data(spark)
    te = encode.SmoothedTargetEncoder(inputCols=["cat"], outputCols=["cat_te"], labelCol="y", smoothing=5.0)
    model = te.fit(df)
    g = np.mean([10, 12, 14, 20, 22, 30, 5])
    assert math.isclose(model.globalMean, g)
    out = {(r.cat, r.y): r.cat_te for r in model.transform(df).collect()}
    a = (3 * 12.0 + 5 * g) / 8
    assert math.isclose(out[("a", 10.0)], a)
    assert math.isclose(out[(None, 30.0)], g)  # join misses null -> global mean
    # encoding lies between the category mean and the global mean
    for (c, _), v in out.items():
        if c == "b":
            assert min(21.0, g) <= v <= max(21.0, g)
    # nullAsCategory: null gets its own statistics
    m2 = encode.SmoothedTargetEncoder(inputCols=["cat"], outputCols=["cat_te"], labelCol="y",
                                      nullAsCategory=True).fit(df)
    v = [r.cat_te for r in m2.transform(df).where(F.col("cat").isNull()).collect()][0]
    assert math.isclose(v, (1 * 30.0 + 5 * g) / 6)


def test_sigmoid_formula(spark):
    df = _data(spark)
    m = encode.SmoothedTargetEncoder(inputCols=["cat"], outputCols=["cat_te"], labelCol="y",
                                     method="sigmoid", smoothing=5.0, minSamplesLeaf=20.0).fit(df)
    g = np.mean([10, 12, 14, 20, 22, 30, 5])
    w = 1 / (1 + math.exp(-(3 - 20) / 5.0))
    got = {r.cat: r.cat_te for r in m.transform(df).collect()}
    assert math.isclose(got["a"], g * (1 - w) + 12.0 * w)
    assert math.isclose(got["c"], g)  # seen once -> prior


def test_unseen_and_roundtrip(spark, scratch):
    df = _data(spark)
    m = encode.SmoothedTargetEncoder(inputCols=["cat"], outputCols=["cat_te"], labelCol="y").fit(df)
    new = spark.createDataFrame([("zzz",), ("a",)], "cat string")
    got = {r.cat: r.cat_te for r in m.transform(new).collect()}
    assert math.isclose(got["zzz"], m.globalMean)
    pm = Pipeline(stages=[encode.SmoothedTargetEncoder(inputCols=["cat"], outputCols=["cat_te"], labelCol="y"),
                          encode.ordinal_indexer(["ord"])]).fit(df)
    path = f"{scratch}/pipe"
    pm.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = sorted(map(tuple, pm.transform(df).select("cat_te", "ord_idx").collect()))
    b = sorted(map(tuple, loaded.transform(df).select("cat_te", "ord_idx").collect()))
    assert a == b


def test_ordinal_orders_and_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "o string")
    freq = encode.ordinal_indexer(["o"], "frequency").fit(df)
    codes = lambda m: {r.category: r.value for r in m.codes.collect()}
    assert codes(freq) == {"a": 0.0, "b": 1.0, "c": 2.0}  # ties broken alphabetically
    alpha = encode.ordinal_indexer(["o"], "alphabet").fit(df)
    assert codes(alpha) == {"a": 0.0, "b": 1.0, "c": 2.0}
    out = {r.o: r.o_idx for r in freq.transform(df).collect()}
    assert out[None] == 3.0  # null -> unknown code = numLabels
    more = spark.createDataFrame([("z",), ("y",), ("z",)], "o string")
    assert codes(encode.ordinal_indexer(["o"], "alphabet").fit(more)) == {"y": 0.0, "z": 1.0}


def test_indexers_take_any_number_of_labels(spark):
    from pricelens.config import ColumnRoles
    df = spark.range(40_000).selectExpr("concat('v', id % 20000) AS wide", "concat('w', id % 20000) AS hot", "1.0D AS n",
                                        "10.0D + id % 10 AS price")
    roles = ColumnRoles(target=(), ordinal=("wide",), onehot=("hot",), numeric=("n",), label="price")
    df = encode.add_label(df, roles)
    pipeline = Pipeline(stages=encode.feature_pipeline(roles).getStages()[:2])  # no target columns here
    m = pipeline.fit(df)
    row = m.transform(df.where("wide = 'v777'")).first()
    order = sorted(f"v{i}" for i in range(20_000))  # equal counts: alphabetical
    assert row.wide_idx == order.index("v777") and row.hot_vec.size == 20_001
    assert encode.one_hot_widths(m) == {"hot": 20_001}


def test_large_tables_take_the_join_without_broadcast(spark):
    df = _data(spark)
    te = encode.SmoothedTargetEncoder(inputCols=["cat"], outputCols=["cat_te"], labelCol="y")
    idx = encode.CategoryIndexer(inputCols=["cat"], outputCols=["cat_ix"])
    one = Pipeline(stages=[te, idx]).fit(df).transform(df)
    two = Pipeline(stages=[te.copy({te.maxBroadcastBytes: 0}), idx.copy({idx.maxBroadcastBytes: 0})]).fit(df).transform(df)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_one_hot_width_and_wide(spark):
    df = spark.createDataFrame([("P",), ("D",), ("P",)], "e string")
    idx, ohe = encode.one_hot_stages(["e"])
    m = Pipeline(stages=[idx, ohe]).fit(df)
    vec = m.transform(df).first().e_vec
    assert vec.size == 3  # 2 labels + one unknown slot
    wide = encode.one_hot_wide(df, ["e"]).collect()
    assert set(wide[0].asDict()) == {"e_D", "e_P"}
    assert all(r.e_D + r.e_P == 1.0 for r in wide)


def test_encoding_map_lists_unknown_slot(spark):
    from pricelens.config import ColumnRoles
    roles = ColumnRoles(target=("cat",), ordinal=("ord",), onehot=("oh",), numeric=("n",), label="price")
    rows = [("a", "x", "p", 1.0, 100.0), ("b", "y", "q", 2.0, 1000.0), ("a", "y", "p", 3.0, 10.0)]
    df = encode.add_label(spark.createDataFrame(rows, "cat string, ord string, oh string, n double, price double"),
                          roles)
    model = encode.feature_pipeline(roles).fit(df)
    em = {(r.kind, r.feature, r.category): r.value for r in encode.encoding_map(model).collect()}
    assert em[("ordinal", "ord", "__unknown__")] == 2.0
    assert em[("onehot", "oh", "p")] == 0.0
    assert ("global_mean", "log_price", None) in em
    assert model.transform(df).first().features.size == 1 + 1 + 3 + 1
