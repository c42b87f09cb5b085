import re

from pricelens.llm import url_filter as u

URLS = [
    "http://a.example.org/es/1?x#y", "https://EXAMPLE.ORG/en/15", "http://example.org/en/2", "http://notexample.org/es/",
    "http://x.com/fr/", "http://x.com/de/page.html#top", "http://x.com/en/", "http://com/de/", "http://org", "http://org/",
    "http://www.spam-farm.net/a//", "https://spam-farm.net:443/a?q=1", "http://clean.net/a", "no scheme", "", None,
    "://?", "x://y://z/", "http://Ünï.net/É", "http://x.net/\nnew", "http://clean.net/a", "http://%.org/es/",
]


def expected(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    path = re.match(r"[^?#]*", rest[len(raw):]).group()
    best = max(((h + p, v) for h, p, v in u.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)),
               key=lambda r: len(r[0]), default=(None, None))
    key = re.sub(r":(80|443)$", "", re.sub(r"^www\.", "", host)) + re.sub(r"/+$", "", path) if host else None
    return host, path, best[0], best[1] or ("block" if key in listed else "allow")


def run(spark, urls, listed):
    pages = spark.createDataFrame([(i, x, "row", "h", 1) for i, x in enumerate(urls)],
                                  "page_id long, url string, listed string, host string, _block int")
    keys = spark.createDataFrame([(x,) for x in listed], "key string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in u.judge(pages, keys).collect()}


def test_rules_and_list_equal_brute_force(spark):
    listed = ["spam-farm.net/a", "spam-farm.net/a", None, "x.net/other"]
    got = run(spark, URLS, listed)
    assert got == {i: expected(x, set(listed) - {None}) for i, x in enumerate(URLS)}


def test_bloom_filter_has_no_false_negative_and_few_positives(spark):
    listed = [f"host{i}.net/p{i}" for i in range(3000)]
    urls = [f"http://host{i}.net/p{i}" for i in range(0, 6000, 3)]
    got = run(spark, urls, listed)
    assert all((got[k][3] == "block") == (i < 3000) for k, i in enumerate(range(0, 6000, 3)))


def test_a_full_filter_still_gives_right_verdicts(spark):
    pages = spark.createDataFrame([(i, f"http://h.net/{i}") for i in range(400)], "page_id long, url string")
    listed = spark.createDataFrame([(f"h.net/{i}",) for i in range(0, 4000, 2)], "key string")
    rows = u.judge(pages, listed, max_blocks=1).collect()
    assert all((r.verdict == "block") == (r.page_id % 2 == 0) for r in rows) and len(rows) == 400


def test_empty_tables(spark):
    assert run(spark, [], ["a/b"]) == {}
    assert run(spark, ["http://a.net/"], [])[0][3] == "allow"


def test_spam_urls(spark):
    pages = spark.createDataFrame([(1, "http://www.spam-x.net/p/"), (2, "http://ok.net/pills"), (3, None)],
                                  "page_id long, url string")
    assert [r.key for r in u.spam_urls(pages).collect()] == ["spam-x.net/p"]
