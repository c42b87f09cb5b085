import math
import os

from pyspark.sql import functions as F

from pricelens.functions.columns import (as_float32, clip, finite, inverse_log10, key_hash, log10_label,
                                         numeric_columns, strict_number, string_columns)
from pricelens.operators import distribution as dist
from pricelens.operators import profile
from pricelens.sources.files import write_table


def test_dtype_selection_and_float32(spark):
    df = spark.createDataFrame([(1, "a", 2.5, 3)], "i int, s string, d double, l long")
    assert numeric_columns(df) == ["i", "d", "l"] and string_columns(df) == ["s"]
    assert numeric_columns(df, exclude=["l"]) == ["i", "d"]
    out = as_float32(df, ["d"])
    assert dict(out.dtypes)["d"] == "float"


def test_clip_log_roundtrip_zero_price(spark):
    # zero_price fixture: 0, negative and null price -> null label, never -inf
    df = spark.createDataFrame([(0.0,), (-5.0,), (None,), (1000.0,)], "p double")
    rows = df.select(log10_label("p").alias("l"), clip("p", 1.0, 100.0).alias("c")).collect()
    assert [r.l for r in rows[:3]] == [None, None, None]
    assert math.isclose(rows[3].l, 3.0)
    assert [r.c for r in rows] == [1.0, 1.0, None, 100.0]  # null stays null
    back = df.select(inverse_log10(log10_label("p")).alias("b")).collect()[3].b
    assert math.isclose(back, 1000.0)
    twice = df.select(clip(clip("p", 1.0, 100.0), 1.0, 100.0).alias("c")).collect()
    assert [r.c for r in twice] == [r.c for r in rows]  # clip is idempotent


def test_key_hash_range(spark):
    df = spark.range(500).select(key_hash("id").alias("h"))
    lo, hi = df.agg(F.min("h"), F.max("h")).first()
    assert 0 <= lo < 1 << 25 and (1 << 32) - (1 << 25) < hi < 1 << 32


def test_strict_numbers_and_finite_values(spark):
    texts = ["12", " 1.5 ", "-3e2", ".5", "7.", "abc", "1d", "2018f", "NaN", "Infinity", "-inf", "", " ", None, "1e999", "12x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(strict_number("t").alias("v")).collect()]
    assert got == [12.0, 1.5, -300.0, 0.5, 7.0] + [None] * 11
    nums = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    assert [r.v for r in nums.select(finite("v").alias("v")).collect()] == [1.0] + [None] * 4
    assert [r.v for r in nums.select(strict_number("v").alias("v")).collect()] == [1.0] + [None] * 4


def test_csv_table_sink(spark, scratch):
    df = spark.createDataFrame([(1, "x", 1.5)], "a int, b string, c double")
    out = os.path.join(scratch, "encoded-csv")
    write_table(df, out, fmt="csv")
    back = spark.read.option("header", True).option("inferSchema", True).csv(out)
    assert back.columns == ["a", "b", "c"] and back.first().b == "x"


def test_approx_paths_close_to_exact(spark):
    vals = list(range(1, 1001))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    ex = profile.describe_numeric(df, ["x"], digits=None).first()
    ap = profile.describe_numeric(df, ["x"], approx=True, digits=None).first()
    assert abs(ex.q50 - ap.q50) <= 2 and ex["count"] == ap["count"] == 1000
    bx = dist.box_stats(df, ["x"], approx=True).first()
    assert abs(bx.median - 500.5) <= 2 and bx.n_outliers == 0


def test_label_split_rejects_invalid_prices(spark):
    from pricelens.config import ColumnRoles
    from pricelens.operators.encode import label_split
    roles = ColumnRoles(target=(), ordinal=(), onehot=(), numeric=(), label="price")
    df = spark.createDataFrame([("1000",), ("0",), ("-5",), (None,), ("abc",)], "price string")
    ok, bad = label_split(df, roles)
    assert [r.log_price for r in ok.collect()] == [3.0]
    assert sorted(r.reason for r in bad.collect()) == ["price:missing", "price:not_numeric",
                                                       "price:not_positive", "price:not_positive"]
