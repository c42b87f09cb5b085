from pyspark.sql import functions as F

from pricelens.functions.ranking import sorted_rank
from pricelens.session import materialize, spread


def test_sorted_rank_matches_window(spark):
    rows = [(g, i, (i * 37) % 11) for g in ["a", "b", "c"] for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(5)
    order = [F.col("v").desc(), F.col("i").asc()]
    got = {(r.g, r.i): r.rank for r in sorted_rank(df, order, by=["g"]).collect()}
    for g in ["a", "b", "c"]:
        ranked = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))
        for pos, r in enumerate(ranked, start=1):
            assert got[(g, r[1])] == pos
    flat = {r.i: r.rank for r in sorted_rank(df.where("g = 'a'"), [F.col("i")]).collect()}
    assert flat == {i: i + 1 for i in range(40)}


def test_spread_and_materialize(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = materialize(spark.range(100).repartition(9), "nine")
    assert spread(many, 4) is many  # nine files: nothing to do, and nothing is run to find out
    m = materialize(one, "t", min_partitions=3)
    assert sorted(r.id for r in m.collect()) == list(range(100))


def test_intermediate_folders_are_removed(spark):
    import os
    from pricelens.session import remove_written, written_mark
    kept, mark = materialize(spark.range(3), "kept"), written_mark()
    gone = [materialize(spark.range(3), "gone").inputFiles()[0].removeprefix("file://") for _ in range(2)]
    assert all(map(os.path.exists, gone)) and remove_written(spark, mark) == 2
    assert not any(map(os.path.exists, gone)) and kept.count() == 3
