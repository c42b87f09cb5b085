"""Intermediate tables and shuffle files go when they have been read; large tables are not dealt anew."""

import os

import pytest
from pyspark.sql import functions as F

from pricelens import session
from pricelens.config import ColumnRoles
from pricelens.operators import train as tr
from pricelens.operators.encode import fold_encoded
from pricelens.session import freed_shuffles, materialize, read_finer

ROLES = ColumnRoles(target=("make",), ordinal=("gear",), onehot=("fuel",), numeric=("year", "km"), label="price", keys=("id",))
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cars(spark, n=400):
    return spark.range(n).select(
        "id", F.lit("not a feature").alias("note"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("m"), F.col("id") % 5)).alias("make"),
        F.when(F.col("id") % 4 > 0, F.lit("a")).otherwise(F.lit("b")).alias("gear"),
        F.concat(F.lit("f"), F.col("id") % 3).alias("fuel"), (2000 + F.col("id") % 9).cast("int").alias("year"),
        (F.col("id") * 1.5).alias("km"),
        F.when(F.col("id") % 50 > 0, 1000.0 + F.col("id") % 37 * 100).alias("price"))


def shuffle_files(spark) -> int:
    return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("/shuffle_")


def left(mark: int) -> list[str]:
    return sorted(p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in session._WRITTEN[mark:])


def test_a_written_table_leaves_no_shuffle_files(spark):
    spark.sparkContext._jvm.System.gc()
    df = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count().repartition(5)
    before = shuffle_files(spark)
    with freed_shuffles(spark):
        table = materialize(df, "freed")
        assert spark.conf.get(FREE) == "true"
    assert shuffle_files(spark) <= before and spark.conf.get(FREE) == "false"
    assert sorted(tuple(r) for r in table.collect()) == [(k, 10) for k in range(100)]
    assert df.count() == df.count() == 100


def test_fit_deletes_what_it_has_written(spark):
    mark = session.written_mark()
    model = tr.fit_forest(cars(spark), ROLES, trees=2, depth=2)
    assert not {"train-input", "train-features"} & set(left(mark))
    assert model.transform(cars(spark)).where("prediction is null").count() == 0
    ready = materialize(tr.labelled(cars(spark), ROLES), "ready")
    tr.fit_forest(ready, ROLES, trees=1, depth=1, ready=True)
    assert ready.count() == 392  # the caller's table stays


def test_large_tables_are_not_dealt_and_keep_what_is_learnt_from(spark, monkeypatch):
    rows = materialize(cars(spark).repartition(3), "three")
    par = spark.sparkContext.defaultParallelism
    small = tr.training_rows(rows, ROLES)
    monkeypatch.setattr(session, "DEAL_BYTES", 0)
    dealt = []
    spread = session.spread

    def seen(df, n=None):
        out = spread(df, n)
        dealt.extend([df.columns] if out is not df else [])
        return out

    monkeypatch.setattr(session, "spread", seen)
    large = tr.training_rows(rows, ROLES)
    wanted = [*ROLES.features, ROLES.label_col]
    assert large.columns == wanted and set(small.columns) == {*rows.columns, ROLES.label_col}
    # Only dealt when it was written, as three files are fewer than the cores.
    assert dealt == ([wanted] if par > 3 else []) and len(large.inputFiles()) >= min(par, 3)
    assert sorted(map(repr, large.collect())) == sorted(map(repr, small.select(*wanted).collect()))
    dealt.clear()
    tr.training_rows(materialize(cars(spark).repartition(par + 1), "many"), ROLES)
    assert not dealt


def test_read_finer_moves_nothing(spark):
    table = materialize(spark.range(1000).repartition(2), "files", max_rows=50)
    fine = read_finer(table, 20)
    assert fine.rdd.getNumPartitions() >= 20 and "Exchange" not in fine._jdf.queryExecution().toString()
    assert sorted(r.id for r in fine.collect()) == list(range(1000))
    assert max(fine.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) <= 50


@pytest.mark.parametrize("write_bytes,storage,threads", [(1 << 30, 1 << 40, 2), (0, 0, 1)])
def test_cross_validation_deletes_what_its_folds_have_written(spark, monkeypatch, write_bytes, storage, threads):
    at_once, alive, write, pool = [], [], tr.materialize, tr.ThreadPoolExecutor
    monkeypatch.setattr(tr, "materialize", lambda *a, **how: alive.append(write(*a, **how)) or alive[-1])
    monkeypatch.setattr(tr, "ThreadPoolExecutor", lambda n: at_once.append(n) or pool(n))
    monkeypatch.setattr(tr, "storage_bytes", lambda spark: storage)
    mark = session.written_mark()
    _, metrics = tr.cross_validate(cars(spark, 90), ROLES, folds=2, trees=1, depth=1, refit=False, write_bytes=write_bytes)
    assert not {"cv-input", "train-features", "fold-encoded"} & set(left(mark))
    gone = [f.removeprefix("file://") for t in alive for f in t._jdf.inputFiles()]
    assert len(alive) == (3 if write_bytes else 1) and gone and not any(map(os.path.exists, gone))
    assert metrics.where("fold >= 0").agg(F.sum("n")).first()[0] == 88
    assert at_once == [threads]  # one at a time if two folds' tree points would not stay in memory


def test_dense_features_equal_assembled_ones(spark):
    some = cars(spark).withColumn("km", F.when(F.col("id") % 11 > 0, F.col("km")))
    rows = materialize(tr.labelled(some, ROLES).withColumn("fold", (F.col("id") % 3).cast("int")), "folds")
    table, features = fold_encoded(rows, ROLES, "fold", [0, 1, 2])
    for k in range(3):
        dense, assembled = (sorted((r.log_price, r.features.size, repr(r.features.toArray().tolist()))
                                   for r in features(table, k, dense=d).collect()) for d in (True, False))
        assert dense == assembled


def test_repeats_are_known_by_sixteen_bytes(spark, monkeypatch, scratch):
    from pricelens.streaming import scoring
    cars(spark, 40).write.parquet(f"{scratch}/cars-in")
    stream = spark.readStream.schema(cars(spark, 1).schema).parquet(f"{scratch}/cars-in")
    plan = scoring.drop_repeated(stream, ["id"])._jdf.queryExecution().analyzed().toString()
    assert "unhex(md5" in plan.lower()
