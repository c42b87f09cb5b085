import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pricelens.llm import lexical as x

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def every_score(docs, items, k=10):
    """Every item's documents from the formula, all of them scored."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag, n in bags:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in dict.fromkeys(terms(text)) if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


ITEMS = [(1, "the quick brown FOX, the dog and a passage"), (2, None), (3, ""), (4, "zzz nowhere"), (None, "café word line"),
         (5, "line of a very long text"), (5, "line of a very long text"), (6, "word"), (7, "Ünïcode 你好 it's 3 3 3")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*i, "x", 1) for i in ITEMS], "item_id long, text string, term string, rank int").repartition(2)


@pytest.mark.parametrize("how", [{}, {"shard_docs": 2}, {"shard_terms": 20}])
def test_messy_documents(messy, items, how):
    got = sorted((tuple(r) for r in x.search(messy, items, **how).collect()), key=str)
    assert got == every_score([(r.doc_id, r.text) for r in messy.collect()], ITEMS)


def test_given_documents(spark, small_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = every_score([(r.doc_id, r.text) for r in small_docs.collect()], [tuple(r) for r in items.collect()])
    for how in ({}, {"shard_docs": 30}):
        assert sorted((tuple(r) for r in x.search(small_docs, items, **how).collect()), key=str) == want


def test_nothing_to_search(no_docs, items, messy):
    assert x.search(no_docs, items).collect() == []
    assert x.search(messy, items.where("false")).collect() == []


def shard_of(texts):
    writer = x.ShardWriter()
    for i, t in enumerate(texts):
        writer.add(1000 - i, t)
    return pa.Table.from_batches(list(writer.rows(7)))


def group(index, items, weights):
    """The group that Spark would hand over, for items given as (number, terms)."""
    rows = index.to_pylist()
    asked = {t: [{"n": n, "id": n} for n, ts in items if t in ts] for t in weights}
    rows = [r | {"w": weights.get(r["term"]), "items": asked.get(r["term"])} for r in rows if r["term"] is None or asked.get(r["term"])]
    return pa.Table.from_pylist(rows)


def test_pruning_loses_nothing(monkeypatch):
    """Small blocks and windows, skewed terms, many ties: the same as scoring every document; and blocks stay packed."""
    monkeypatch.setattr(x, "BLOCK", 4)
    monkeypatch.setattr(x, "WINDOW", 16)
    rng = np.random.default_rng(5)
    opened = total = 0
    for k in (1, 3, 10):
        for _ in range(15):
            vocabulary = [f"t{i}" for i in range(40)]
            texts = [" ".join(rng.choice(vocabulary, int(rng.integers(1, 60)), p=zipf(40))) for _ in range(300)]
            index = shard_of(texts)
            n_docs, n_terms = len(texts), sum(len(t.split()) for t in texts)
            df = Counter(t for text in texts for t in set(text.split()))
            weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
            items = [(n, set(rng.choice(vocabulary, 6).tolist())) for n in range(8)]
            want = sorted(every_score([(1000 - i, t) for i, t in enumerate(texts)], [(n, " ".join(ts)) for n, ts in items], k), key=str)
            seen = []
            first = x.Postings.__init__
            monkeypatch.setattr(x.Postings, "__init__", lambda self, *a: (first(self, *a), seen.append(self))[0])
            found = x.search_group(group(index, items, weights), n_docs, n_terms, k).to_pylist()
            monkeypatch.setattr(x.Postings, "__init__", first)
            got, ranks = [], Counter()
            for r in found:
                ranks[r["item_id"]] += 1
                got.append((r["item_id"], ranks[r["item_id"]], r["doc_id"], r["score"]))
            assert sorted(got, key=str) == want
            opened += sum(len(p.read) for p in seen)
            total += sum(len(p.last) for p in seen)
    assert opened < total


def zipf(n):
    p = 1 / np.arange(1, n + 1) ** 1.3
    return p / p.sum()


def test_lists_unpack_to_what_went_in():
    texts = ["a b a", "b", "a " * 70_000, *["a c"] * 500, "c"]
    index = {r["term"]: r for r in shard_of(texts).to_pylist()}
    head = index[None]
    assert head["lengths"] == sorted(len(t.split()) for t in texts)
    p = x.Postings(index["a"]["blocks"], index["a"]["data"], np.ones(len(texts), np.int64))
    counts = dict(zip(head["doc_ids"], range(len(texts))))
    docs, values = p.between(0, len(texts))
    want = {counts[1000 - i]: t.split().count("a") for i, t in enumerate(texts) if "a" in t.split()}
    assert dict(zip(docs.tolist(), values.tolist())) == {d: 10**9 * c // (1000 * c + 8) for d, c in want.items()}
    assert len(p.last) == math.ceil(len(want) / x.BLOCK)


def test_numbers_pack():
    rng = np.random.default_rng(1)
    values = np.r_[rng.integers(0, 300, 500), rng.integers(0, 2**31, 500), 0, 127, 128, 2**31 - 1]
    data, ends = x.varints(values)
    assert (x.from_varints(data) == values).all() and ends[-1] == len(data)


def test_m_beyond_64_bits():
    m = x.m_rule(10**12, 10**15)
    assert m(np.array([5, 10**7])).tolist() == [10 + 90 * 5 * 10**12 // 10**15, 10 + 90 * 10**7 * 10**12 // 10**15]
