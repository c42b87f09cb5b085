import random

import xxhash
from pyspark.sql import functions as F

from pricelens.llm import simhash as s
from pricelens.llm.common import prepare


def naive(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, bits):
    """Least member of each value's component, by all pairs."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(root)
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprint_is_the_definition(messy):
    for r in messy.collect():
        assert s.simhash(r.text or "") == naive(r.text)


def test_documents_equal_brute_force(messy, small_docs, no_docs):
    for docs in (messy, small_docs):
        rows = [(r.doc_id, naive(r.text)) for r in docs.collect()]
        root = groups({p for _, p in rows}, 4)
        least = {}
        for i, p in rows:
            if i is not None:
                least[root[p]] = min(i, least.get(root[p], i))
        want = sorted(((i, f"{p:016x}", least.get(root[p])) for i, p in rows), key=str)
        assert sorted((tuple(r) for r in s.near_duplicates(docs).collect()), key=str) == want
    assert s.near_duplicates(no_docs).collect() == []


def planted(n, seed):
    rng = random.Random(seed)
    out = set()
    for _ in range(n):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 9)):
            out.add(v)
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                v ^= 1 << b
    return out


def test_links_and_components_of_planted_chains(spark):
    values = planted(150, 1)
    prints = spark.createDataFrame([(signed(v),) for v in values], "_print long")
    for blocks, shard_rows in ((None, 2048), (None, 4), (6, 2048), (5, 3), (7, 2048), (8, 2048)):
        found = s.components(s.links(prints, 4, blocks, shard_rows)).collect()
        got = {v: v for v in map(signed, values)} | {r._node: r._root for r in found}
        want = groups(values, 4)
        by_root = {}
        for v in values:
            by_root.setdefault(want[v], []).append(signed(v))
        assert got == {x: min(m) for m in by_root.values() for x in m}


def test_dense_ball_in_small_chunks(spark):
    rng = random.Random(3)
    values = {0}
    while len(values) < 400:
        v = rng.choice(sorted(values))
        values.add(v ^ (1 << rng.randrange(64)))
    prints = spark.createDataFrame([(signed(v),) for v in values], "_print long")
    links = s.links(prints, 4, 6, 50)
    roots = {r._root for r in s.components(links).collect()}
    assert roots == {min(map(signed, values))}


def test_tree_search_is_all_pairs():
    values = sorted(planted(80, 2))
    tree = s.BKTree()
    for v in values + values[:5]:
        tree.add(v)
    assert len(tree.value) == len(values)
    for q in values[:50]:
        for radius in (0, 3, 4):
            assert sorted(tree.value[i] for i in tree.within(q, radius)) == [v for v in values if (v ^ q).bit_count() <= radius]


def test_one_document_of_each_group_stays(messy):
    out = s.one_of_each_group(messy)
    assert out.columns == messy.columns
    got = [r.doc_id for r in out.collect()]
    found = s.near_duplicates(messy).where("doc_id is not null").groupBy("component_id").agg(F.min("doc_id")).collect()
    assert sorted(i for i in got if i is not None) == sorted(r.component_id for r in found)
    assert got.count(None) == 1


def test_rows_without_an_id_join_their_group(spark):
    a, b, c = ("one two three four five six seven", "entirely other words stand in this row", "and a third text that is unlike both")
    docs = spark.createDataFrame([(None, a, 1), (5, a, 2), (None, a, 3), (None, b, 4), (None, b, 5), (None, c, 6)],
                                 "doc_id long, text string, n int")
    got = [(r.doc_id, r.text) for r in s.one_of_each_group(docs).collect()]
    assert len(got) == 3 and set(got) == {(5, a), (None, b), (None, c)}


def test_one_of_each_group_with_a_map_column(messy):
    docs = messy.withColumn("extra", F.create_map(F.lit("k"), F.col("doc_id")))
    want = sorted((str(r.doc_id), r.text or "") for r in s.one_of_each_group(messy).collect())
    assert sorted((str(r.doc_id), r.text or "") for r in s.one_of_each_group(docs).collect()) == want


def test_blocks_follow_from_the_count():
    """Shards keep a bound while the fingerprints grow; fewer shards a fingerprint where fewer will do."""
    assert [s.choose_blocks(n) for n in (0, 1000, 64 << 12, (64 << 12) + 1, 64 << 20, (64 << 20) + 1, 64 << 27, (64 << 27) + 1)] == [
        5, 5, 5, 6, 6, 7, 7, 8]
    assert s.choose_blocks(10**9, bits=0) >= 1 and len(s.block_masks(s.choose_blocks(10**6, 2), 2)) <= 15
    for bits in (0, 1, 3, 4, 7):
        for blocks in range(bits + 1, bits + 5):
            masks = s.block_masks(blocks, bits)
            assert all(bin(m & (1 << 64) - 1).count("1") >= (blocks - bits) * (64 // blocks) for m in masks)


def test_trees_of_the_given_documents_are_searched(spark):
    """At sf0.1 most shards have trees of more than two nodes, and a search meets the right ones without seeing all."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    prepare(spark)
    nodes = s.written(s.fingerprints(docs.repartition(8)).select("_print").distinct(), "test-nodes")
    blocks = s.choose_blocks(nodes.count())
    shards = s.shards_of(nodes, 4, blocks).groupBy("_kind", "_key").agg(F.collect_list("_print").alias("p")).where("size(p) > 2")
    trees = [[v & (1 << 64) - 1 for v in r.p] for r in shards.collect()]
    seen = nodes_of_trees = linked = 0

    class Counted(s.BKTree):
        def within(self, value, radius):
            nonlocal seen
            stack = [0]
            while stack:
                at = stack.pop()
                seen += 1
                away = (self.value[at] ^ value).bit_count()
                stack += [c for step, c in self.children[at].items() if away - radius <= step <= away + radius]
            return super().within(value, radius)

    for values in trees:
        tree = Counted()
        for v in values:
            tree.add(v)
        for q in values:
            found = {tree.value[i] for i in tree.within(q, 4)}
            assert found == {v for v in values if (v ^ q).bit_count() <= 4}
            linked += len(found) - 1
            nodes_of_trees += len(values)
    assert len(trees) > 1000 and linked > 0 and seen < 0.9 * nodes_of_trees
