import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from pricelens.llm import periodic as x


def brute(words, least=12):
    """Every period, every maximal stretch of equal words that far apart."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            part = words[s:i + q]
            if len(part) >= max(least, 2 * q) and not any(part[:-r] == part[r:] for r in range(1, q)):
                found.append((s, len(part), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


letters = st.integers(1, 4).flatmap(lambda a: st.lists(st.integers(0, a), max_size=70))
repeats = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9), letters).map(lambda t: t[2][:20] + t[0] * t[1] + t[2][20:])


@settings(max_examples=400, deadline=None)
@given(st.one_of(letters, repeats), st.sampled_from([2, 3, 5, 12]))
def test_runs_of_a_sequence(seq, least):
    assert x.runs_of(seq, least) == brute(seq, least)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(letters, repeats), max_size=6), st.sampled_from([2, 7, 12]))
def test_batches_skip_nothing(docs, least):
    texts = [[b"w%d" % w for w in d] for d in docs]
    assert x.batch_runs(texts, least) == [brute(t, least) for t in texts]


def test_strings_of_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert x.runs_of(b, 2) == brute(b, 2) and len(x.runs_of(b)) > 30
    passage = [f"p{i}".encode() for i in range(40)]
    apart = passage + [f"q{i}".encode() for i in range(9)] + passage
    assert x.batch_runs([apart, passage * 2, []]) == [[], [(0, 80, 40)], []]


def words_of(text):
    return (text or "").encode().split()


def want(doc_id, text):
    words = words_of(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    lost = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in lost)
    most = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    return (doc_id, len(runs), *((most[0], most[1], most[2], 1000 * most[1] // most[2]) if most else [None] * 4), digest,
            hashlib.sha256(kept).hexdigest())


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in x.run_report(x.edited(docs)).collect()), key=str)
    assert got == sorted((want(*r) for r in rows), key=str)
    return got


def test_given_documents(spark, small_docs):
    short = small_docs.where("length(text) < 5000")  # brute force is quadratic
    assert sum(r[1] > 0 for r in check(short)) > 8


def test_messy_documents(spark, messy):
    rows = [r for r in messy.select("doc_id", "text").collect() if len(r.text or "") < 5000]
    rows += [(20, "a b c " * 500), (21, "x" * 50_000 + " y " * 30), (None, "no id " * 9), (20, "a b c " * 500), (13, " \t\n"),
             *[(i, "one two three four five six seven eight nine ten eleven twelve thirteen") for i in range(100, 160)]]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, runs string, start int").repartition(3)
    assert sum(r[1] > 0 for r in check(docs)) > 5


def test_long_texts(messy):
    """Texts of some 80,000 words go through whole."""
    got = {r.doc_id: r for r in x.find_runs(messy).collect() if r.doc_id in (12, 13, 15)}
    assert len(got) == 3 and got[15].collapsed == "a" * 30000
    lines = [f"line {i} of a very long text that goes on and on for {i % 7} words" for i in range(6000)]
    assert got[12].collapsed == " ".join(" ".join(lines).split()) and got[12].runs == []


def test_no_rows(no_docs):
    assert x.run_report(x.edited(no_docs)).collect() == []
