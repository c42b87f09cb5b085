import hashlib

import corpus_pipeline
from pricelens.llm import mixture, quality, simhash
from pricelens.llm.queries import ORACLE, QUERIES
from pricelens.llm.sp_encode import PieceEncoder

SF = "/root/testdata/sf0.001"


def test_stages_in_order_keep_columns_and_apply_decisions(spark, small_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs, seen = small_docs.cache(), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        if name != "tokens":
            assert out.columns == small_docs.columns and [t for _, t in out.dtypes] == [t for _, t in small_docs.dtypes]
        seen[name] = (docs, out)
        docs = out
    before, after = seen["quality"]
    keep = {r.doc_id for r in quality.quality_report(before, labels).collect() if r.keep}
    assert {r.doc_id for r in after.collect()} == keep
    before, after = seen["lines"]
    assert before.count() == after.count()
    before, after = seen["near_duplicates"]
    found = simhash.near_duplicates(before).collect()
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in found}
    before, after = seen["mixture"]
    taken = {r.doc_id: r.taken for r in mixture.mix_report(before).collect() if r.taken}
    got = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.encode().split())
    assert got == taken
    before, after = seen["tokens"]
    encoder = PieceEncoder(corpus_pipeline.PIECE_MODEL)
    want = sorted((r.doc_id, hashlib.sha256(",".join(map(str, encoder.library.encode(r.text))).encode()).hexdigest())
                  for r in before.collect())
    assert sorted((r.doc_id, r.ids_sha256) for r in after.collect()) == want


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {*QUERIES, "pipeline"} <= set(names) and set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
