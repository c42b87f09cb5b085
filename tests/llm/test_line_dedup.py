import hashlib
from collections import defaultdict

from pricelens.llm import line_dedup

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def expected(rows, min_chars=40, min_docs=5):
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                held[key(line)].add(i)
    lost = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or key(x) not in lost or lost[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_equals_brute_force(messy, no_docs):
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_report(messy).collect()]
    want = expected(rows_of(messy))
    assert sorted(got, key=str) == want and sum(x[2] for x in want) > 4
    assert line_dedup.line_report(no_docs).collect() == []


def test_small_table_equals_brute_force(small_docs):
    got = [tuple(r) for r in line_dedup.line_report(small_docs, min_docs=2, min_chars=20).collect()]
    assert sorted(got, key=str) == expected(rows_of(small_docs), 20, 2)


def test_documents_keep_columns_and_rows(messy):
    out = line_dedup.without_repeated_lines(messy)
    assert out.columns == messy.columns and out.count() == messy.count()
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[5].text == "" and by_id[5].n_chars == 0 and by_id[8].text is None
    assert by_id[3].text == "another line" and by_id[12]._id.startswith("_id")


def test_non_ascii_capitals_differ(spark):
    line = "É" + "x" * 45
    docs = spark.createDataFrame([(i, line if i < 5 else line.lower()) for i in range(9)], "doc_id long, text string")
    assert sorted(r.doc_id for r in line_dedup.line_report(docs).collect() if r.n_dropped) == [0, 1, 2, 3]


def test_long_texts_of_repeated_lines_take_linear_time(spark):
    """Lines that six documents share, 5,000 and 20,000 of them: four times the lines, not sixteen times the time."""
    import time
    took = {}
    for n in (5_000, 20_000, 5_000, 20_000):  # the first round warms up
        text = "\n".join(f"line number {i} of a long text that several documents hold" for i in range(n))
        docs = spark.createDataFrame([(i, text + f"\n{i}") for i in range(6)], "doc_id long, text string").repartition(6)
        t0 = time.perf_counter()
        got = sorted(tuple(r) for r in line_dedup.line_report(docs).collect())
        took[n] = time.perf_counter() - t0
        assert [r[2] for r in got] == [n] * 5 + [0]
        assert got[0][3] == hashlib.sha256(b"0").hexdigest()
    assert took[20_000] < 8 * took[5_000] + 2


def test_rows_that_share_an_id(spark):
    rows = [(i, f"{PASSAGE}\nrow {i}") for i in range(6)] + [(0, f"another text\n{PASSAGE}"), (0, f"another text\n{PASSAGE}"), (5, PASSAGE + "\n" + PASSAGE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in line_dedup.line_report(docs).collect()), key=str) == expected(rows)


PASSAGE = "This passage of well over forty code points stands in many of the documents."
