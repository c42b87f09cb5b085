from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pricelens.llm import mixture


def targets(sizes):
    """Reshares what is above a cap by weight until nothing is; ``sizes`` in order of source."""
    weights = [mixture.WEIGHTS[i % 3] for i in range(len(sizes))]
    capped, total = set(), mixture.SHARE * sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - sum(2 * sizes[i] for i in capped)
        level = rest / sum(weights[i] for i in free) if free else 0
        new = {i for i in free if level * weights[i] > 2 * sizes[i]}
        if not new:
            return [2 * sizes[i] if i in capped else level * weights[i] for i in range(len(sizes))]
        capped |= new


def check(docs, block):
    rows = mixture.mix_report(docs, block=block).collect()
    assert len(rows) == docs.count()
    words = {r.doc_id: (len((r.text or "").encode().split()), r.source) for r in docs.collect()}
    by_source, sizes = defaultdict(int), defaultdict(int)
    info = {}
    for r in rows:
        n, source = words[r.doc_id]
        assert r["size"] == n and 0 <= r.taken <= 2 * n
        by_source[source] += r.taken
        sizes[source] += n
        info[source] = (r.source_size, r.target)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    for source, target in zip(order, targets([sizes[s] for s in order])):
        assert info[source][0] == sizes[source] and info[source][1] == pytest.approx(target)
        assert abs(by_source[source] - target) <= 0.5 + 1e-9
    again = mixture.mix_report(docs.repartition(5), block=block).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


@pytest.mark.parametrize("block", [7, 256])
def test_targets_and_taken(messy, block):
    check(messy, block)


def test_small_table(small_docs):
    check(small_docs, 64)


def test_empty_and_wordless(spark, no_docs):
    assert mixture.mix_report(no_docs).collect() == [] and mixture.mixed_documents(no_docs).collect() == []
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", "b"), (2, " ", "b")], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixture.mix_report(docs).collect()] == [(0, 0.0)] * 3


def test_feistel_is_a_permutation(spark):
    for n in (1, 2, 3, 5, 64, 65, 1000):
        df = spark.range(n).select(mixture.feistel(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.col("id") * 0).alias("x"))
        assert sorted(r.x for r in df.collect()) == list(range(n))


def test_every_slot_has_a_shard_and_blocks_repeat_only_by_epoch(small_docs):
    _, sources = mixture.placed(small_docs, 32)
    rows = mixture.slots(sources, 32).collect()
    assert len({(r._sid, r._epoch, r._block) for r in rows}) == len(rows)
    assert len({r._shard for r in rows}) > mixture.SHARDS * 0.9
    per = defaultdict(int)
    for r in rows:
        per[r._sid] += r._take
    assert per == {r._sid: round(r._target) for r in sources.collect() if round(r._target)}


def test_documents_of_the_mix(messy):
    report = mixture.mix_report(messy, block=16).groupBy("doc_id").agg(F.sum("taken").alias("taken")).collect()
    out = mixture.mixed_documents(messy, block=16)
    assert out.columns == messy.columns
    got, texts = defaultdict(int), {r.doc_id: r.text for r in messy.collect()}
    for r in out.collect():
        words = r.text.encode().split()
        got[r.doc_id] += len(words)
        whole = texts[r.doc_id].encode().split()
        assert r.n_chars == len(r.text) and (r.text == texts[r.doc_id] or len(words) < len(whole))
        it = iter(whole)
        assert all(w in it for w in words)  # in order
    assert dict(got) == {r.doc_id: r.taken for r in report if r.taken}


def test_the_draw_fills_the_output_shards(small_docs):
    """Counts by shard and source are a multinomial draw of all slots, and the plan holds them word for word."""
    counts = [r.asDict() for r in mixture.shard_counts(small_docs, block=16).collect()]
    targets = {r.source: round(r.target) for r in mixture.mix_report(small_docs).join(small_docs, "doc_id").collect()}
    by_source, by_shard = defaultdict(int), defaultdict(int)
    for c in counts:
        by_source[c["source"]] += c["n_words"]
        by_shard[c["shard"]] += c["n_slots"]
    assert dict(by_source) == targets
    slots = sum(by_shard.values())
    expect = slots / mixture.SHARDS
    chi2 = sum((by_shard.get(s, 0) - expect) ** 2 / expect for s in range(mixture.SHARDS))
    assert 25 < chi2 < 115  # 63 degrees of freedom: beyond these once in 10,000 draws
    plan = [r.asDict() for r in mixture.mix_plan(small_docs, block=16).collect()]
    words, held = {r.doc_id: len((r.text or "").encode().split()) for r in small_docs.collect()}, defaultdict(int)
    source = {r.doc_id: r.source for r in small_docs.collect()}
    for p in plan:
        assert 0 <= p["first_word"] and p["first_word"] + p["n_words"] <= words[p["doc_id"]]
        held[p["shard"], source[p["doc_id"]]] += p["n_words"]
    assert held == {(c["shard"], c["source"]): c["n_words"] for c in counts}
    shards = defaultdict(set)
    for p in plan:
        shards[p["doc_id"]].add(p["shard"])
    assert all(r.n_shards == len(shards[r.doc_id]) for r in mixture.mix_report(small_docs, block=16).collect())


def test_columns_that_cannot_be_hashed(small_docs):
    with_map = small_docs.limit(30).withColumn("extra", F.create_map(F.lit("k"), F.col("doc_id")))
    assert mixture.mix_report(with_map).count() == 30
    mixed = mixture.mixed_documents(with_map)
    assert mixed.columns == with_map.columns and all(r.extra == {"k": r.doc_id} for r in mixed.collect())
