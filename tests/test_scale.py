"""Steps that are run once per row, move no row twice or keep a task's rows bounded."""

from collections import Counter

from pyspark.sql import functions as F

from pricelens.config import ColumnRoles
from pricelens.functions.columns import strict_number, with_numbers
from pricelens.operators import quality
from pricelens.operators.encode import add_label
from pricelens.operators.validate import allowed_from_lists, reject_summary, validate

ROLES = ColumnRoles(target=("make",), ordinal=(), onehot=(), numeric=("year", "km"), label="price", keys=("id",))
RECORDS = [(1, "a", "2000", "1.5", 10.0), (2, "c", "2000", "1d", 0.0), (3, None, "1949", "1e999", None),
           (4, "a", "2000.5", None, float("nan")), (5, "b", " +2001 ", ".5", float("inf")), (6, "b", None, "NaN", 1e300)]


def records(spark):
    return spark.createDataFrame(RECORDS, "id long, make string, year string, km string, price double")


def matches(df) -> int:
    """Regular expressions in the plan."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")


def test_numbers_are_read_once(spark):
    df = records(spark).withColumn("n", F.col("id").cast("int"))
    names = ["year", "km", "price", "n"]
    got = with_numbers(df, {f"x_{c}": c for c in names}).select(*[f"x_{c}" for c in names]).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in df.select(*[strict_number(c) for c in names]).collect()]
    labelled = add_label(df, ROLES).where("log_price is not null")
    assert matches(labelled) == 0 and [r.id for r in labelled.orderBy("id").collect()] == [1, 6]


def test_rules_are_judged_once(spark):
    df = records(spark)
    checked = validate(df, ROLES, allowed_from_lists(spark, {"make": ["a", "b"]}))
    assert matches(checked.select("errors")) == len(ROLES.numeric)
    assert matches(reject_summary(checked)) == len(ROLES.numeric)
    errors = {r.id: r.errors for r in checked.collect()}
    assert errors == {1: "", 2: "make:not_allowed,km:not_numeric", 3: "make:missing,year:below_1950,km:not_numeric",
                      4: "year:not_integer,km:missing", 5: "", 6: "year:missing,km:not_numeric"}
    want = Counter(rule for e in errors.values() if e for rule in e.split(","))
    assert {r.rule: r.n_rejected for r in reject_summary(checked).collect()} == want


def test_routed_batch_is_judged_once(spark, scratch, monkeypatch):
    from pricelens.streaming import scoring
    seen = []

    def split(checked):
        seen.append(checked.is_cached)
        return checked.where("is_valid"), checked.where("not is_valid")
    monkeypatch.setattr(scoring, "split_valid", split)
    scoring.route_batch(records(spark), 0, ROLES, f"{scratch}/judged-once", allowed_from_lists(spark, {"make": ["a", "b"]}))
    valid, rejected, _ = scoring.read_routed(spark, f"{scratch}/judged-once")
    assert seen == [True]
    assert sorted(r.id for r in valid.collect()) == [1, 5] and sorted(r.id for r in rejected.collect()) == [2, 3, 4, 6]


def test_repeats_in_a_join_move_no_row_again(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(300).select((F.col("id") % 100).alias("k"), (F.col("id") * 7 % 50).alias("x"), F.col("id").alias("row_id"))
        right = spark.range(100).select(F.col("id").alias("r"), (F.col("id") % 3).cast("string").alias("s"))
        found = quality.duplicate_rows(left.join(right, left.k == right.r).drop("r"), "row_id")
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # the join's own
        assert sorted(r.row_id for r in found.collect()) == list(range(100, 300))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_repeats_of_one_hot_row_ties_and_nulls(spark):
    rows = [(i, None, "hot") for i in range(200)] + [(0, None, "hot"), (None, None, "hot"), (None, 1, "none"), (7, 1, "none"),
            (300, 2, "tie"), (300, 2, "tie"), (301, 2, "tie"), (400, 3, "one")]
    df = spark.createDataFrame(rows, "row_id long, a long, b string").repartition(3)
    got = quality.duplicate_rows(df, "row_id").collect()
    assert sorted(r.row_id for r in got) == [*range(1, 200), 301]


def test_random_split_sorts_bounded_parts(spark, monkeypatch):
    from pricelens.operators import split
    monkeypatch.setattr(split, "SPLIT_ROWS", 100, raising=False)
    df = spark.range(1000).select((F.col("id") % 10 == 0).alias("hot"), (F.col("id") % 4).alias("x")).coalesce(1)
    train, test = split.random_split(df, (0.8, 0.2), 40)
    per_part = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_part) == 10 and max(per_part) < 200
    assert 100 < test.count() < 300
    both = Counter(tuple(r) for r in train.collect()) + Counter(tuple(r) for r in test.collect())
    assert both == Counter(tuple(r) for r in df.collect())


def test_forest_tasks_hold_bounded_bytes(spark, scratch):
    from pyspark.ml.linalg import Vectors
    from pricelens.operators.train import bounded_tasks, point_bytes
    table = spark.createDataFrame([(Vectors.dense([float(i), 1.0]), float(i)) for i in range(500)], ["features", "y"])
    table.coalesce(1).write.parquet(f"{scratch}/points")
    table = spark.read.parquet(f"{scratch}/points")
    assert bounded_tasks(table, 20).rdd.getNumPartitions() == table.rdd.getNumPartitions()
    split = bounded_tasks(table, 20, task_bytes=50 * point_bytes(2, 20))
    assert split.rdd.getNumPartitions() == 10 and split.count() == 500
    assert bounded_tasks(table.where("y < 0"), 20).count() == 0
