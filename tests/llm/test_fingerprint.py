import hashlib
from collections import Counter

import numpy as np
import xxhash

from pricelens.llm import fingerprint as f


def jaccard(a, b):
    a, b = (Counter(x.encode().lower().split()) for x in (a, b))
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 1.0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def ordered(docs):
    """Descending id, nulls last, equal ids by descending text hash, then text."""
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    rows.sort(key=lambda r: (signed(xxhash.xxh64_intdigest(r[1].encode(), 42)), r[1].encode()), reverse=True)
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


def check(docs):
    """Every column against a plain walk over the ordered documents; returns the estimates' errors."""
    got = sorted((tuple(r) for r in f.fingerprint_documents(docs).collect()), key=str)
    rows, errors, want, sampler = ordered(docs), [], [], f.Sampler()
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        new = f.edited(text, following)
        one, two, three = (sampler.fingerprint(t) for t in (text, new, following))
        near, near_next = float((one == two).mean()), float((one == three).mean())
        want.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), f.hexed(one), f.hexed(two), near, near_next))
        errors += [near - jaccard(text, new), near_next - jaccard(text, following)]
        assert text != following or near_next == 1.0
    assert got == sorted(want, key=str)
    return np.array(errors)


def test_edited_texts_and_likeness(messy, small_docs):
    check(messy)
    errors = check(small_docs)
    assert abs(errors.mean()) < 0.01 and errors.std() < 0.05


def test_empty_and_single(spark, no_docs):
    assert f.fingerprint_documents(no_docs).collect() == []
    one = spark.createDataFrame([(5, "alone it stands")], "doc_id long, text string")
    r = f.fingerprint_documents(one).collect()[0]
    assert r.edited_sha256 == hashlib.sha256(b"alone it salone").hexdigest() and r.near_next == 1.0


def test_collision_rate_is_generalised_jaccard():
    sampler = f.Sampler(samples=4096, rows=512, seed=1)
    a, b = "x " * 7 + "y y z " + "q " * 3, "x " * 2 + "y y y z w " + "q " * 3
    same = (sampler.fingerprint(a) == sampler.fingerprint(b)).mean()
    assert abs(same - jaccard(a, b)) < 0.03


def test_a_full_array_starts_anew_and_changes_nothing():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(300)], 200)) for _ in range(40)]
    small, large = f.Sampler(rows=64), f.Sampler()
    assert all((small.fingerprint(t) == large.fingerprint(t)).all() for t in texts)


def test_hot_and_null_ids_span_ranges(spark):
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"row {i} of a table whose ids repeat {i % 11}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(docs)
    keyed = f.in_ranges(docs.select(f.F.col("doc_id").alias("_id"), f.F.xxhash64("text").alias("_tie")), 32)
    sizes = [r["count"] for r in keyed.groupBy("_range").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 60


def test_gamma_numbers():
    x = f.gamma_quantiles(10)
    assert (np.diff(x) > 0).all()
    assert np.allclose(1 - (1 + x) * np.exp(-x), (np.arange(1024) + 0.5) / 1024, atol=1e-9)


def test_words_of_many_documents_in_ranges(spark):
    docs = spark.createDataFrame([(i % 37, f"text {i} " * (i % 5)) for i in range(300)], "doc_id long, text string")
    check(docs)
