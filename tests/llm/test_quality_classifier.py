import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import quality


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    test = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    out = quality.quality_report(docs, labels.where(~test)).join(labels.where(test), "doc_id").collect()
    right = [r.keep == bool(r.quality) for r in out]
    assert np.mean(right) >= 0.95
    assert np.mean([r.keep for r in out if r.quality]) >= 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_all_rows_scored(messy, no_docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (12, 0, 0), (13, 0, 0), (13, 0, 1), (None, 1, 0), (3, None, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    out = quality.quality_report(messy, labels)
    assert out.count() == messy.count() and quality.quality_report(no_docs, labels).collect() == []
    kept = quality.good_documents(messy, labels)
    assert kept.columns == messy.columns and kept.count() == out.where("keep").count()


@pytest.mark.parametrize(("rows", "score"), [([], 1.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)])
def test_without_both_classes(messy, spark, rows, score):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    assert {r.score for r in quality.quality_report(messy, labels).collect()} == {score}


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = (rng.random(600) < 0.6).astype(float)
    one = np.c_[y * 2 - 1 + rng.normal(size=600) * 0.7, rng.normal(size=(600, 5)), np.ones(600)].astype(np.float32)
    two = np.c_[y * 2 - 1 + rng.normal(size=600) * 0.7, rng.normal(size=(600, 5)), np.ones(600)].astype(np.float32)
    part = lambda a, b: (one[a:b], two[a:b])
    model = quality.co_train(part(0, 60), y[:60], part(60, 400))
    p = model.score(part(400, 600))
    assert np.mean((p >= 0.5) == (y[400:] == 1)) >= 0.93
    assert abs(p.mean() - y[400:].mean()) < 0.12  # calibrated


def test_scores_do_not_hang_on_partitions(small_docs, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    one = {r.doc_id: round(r.score, 9) for r in quality.quality_report(small_docs, labels).collect()}
    two = {r.doc_id: round(r.score, 9) for r in quality.quality_report(small_docs.repartition(5), labels).collect()}
    assert one == two


def test_sample_has_one_row_per_id_in_any_order(spark):
    rows = [(1, f"text {i} " * (i % 7 + 1), "en", "a") for i in range(60)] + [(2, "other", None, "b")]
    got = [quality.sample_views(spark.createDataFrame(some, "doc_id long, text string, lang string, source string")
                                .repartition(parts), [1, 2], "doc_id")
           for some, parts in ((rows, 1), (rows[::-1], 1), (rows, 7))]
    assert all(g.keys() == {1, 2} for g in got)
    assert all(np.array_equal(g[i][v], got[0][i][v]) for g in got for i in (1, 2) for v in (0, 1))


@pytest.mark.parametrize(("n", "wanted"), [(0, 5), (3, 5), (5, 5), (5000, 100), (40_000, 1000), (3000, 2900)])
def test_sample_is_the_least_hashes(spark, n, wanted):
    ids = spark.range(0, n * 3, 3).select(F.col("id").alias("_id"))
    want = sorted((r.h, r._id) for r in ids.select("_id", F.xxhash64(F.lit("sample"), "_id").alias("h")).collect())[:wanted]
    assert [r._id for r in quality.least_hashed(ids.repartition(3), wanted).collect()] == [i for _, i in want]
