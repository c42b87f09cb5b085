"""URL filter: host/path rules, and a list of canonical URLs behind a blocked Bloom filter.

The list is folded into a blocked Bloom filter: each canonical URL picks one 512-bit block and
sets one bit in each of the block's eight 64-bit words. The filter has at most ``max_blocks``
blocks whatever the list's length, so it is broadcast. Only URLs whose eight bits are all set go
on to an exact hash join with the list, which removes the false positives; the rest never shuffle.
A list too long for ``max_blocks`` only lets more URLs through to the exact join.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no rule and is
not listed (verdict ``allow``). Repeated rows are judged one by one; an empty table gives no rows;
an empty list blocks nothing. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import ascii_lower, written

WORDS = 8
#: Bits of filter per listed URL: about 0.5 % false positives with eight bits in one block.
BITS_PER_KEY = 12
#: 64 bytes a block: 8 MB of filter at most.
MAX_BLOCKS = 1 << 17

#: (host, path, verdict): fixed values of the production rule set.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(raw), F.lit("")), F.coalesce(path, F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Scheme, ``www.``, default port, query, fragment and closing slashes dropped; null without a host."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"/+$", "")))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does. A rule fits its host and
    all subdomains when the path starts with the rule's. ``rules`` is a short list (literals)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def _masks(key: Column) -> list[Column]:
    """One bit for each of the block's words, six bits of a second hash each."""
    h = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def bloom_blocks(listed: DataFrame, n_blocks: int) -> DataFrame:
    """Rows ``(_block, _w0 .. _w7)``: the blocks that hold any bit; ``listed`` has a column ``key``."""
    bits = listed.select(_block(F.col("key"), n_blocks).alias("_block"),
                         *[m.alias(f"_w{i}") for i, m in enumerate(_masks(F.col("key")))])
    return bits.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)])


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          max_blocks: int = MAX_BLOCKS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict, listed)`` for every page.

    ``listed`` has one column ``key`` of canonical URLs (nulls and repeats allowed). The verdict is
    the longest fitting rule's, else ``block`` for a listed URL, else ``allow``.
    """
    listed = written(listed.select(F.col(listed.columns[0]).alias("key")).where(F.col("key").isNotNull()).distinct(),
                     "listed-urls")
    n_blocks = min(max_blocks, max(1, -(-listed.count() * BITS_PER_KEY // (64 * WORDS))))
    parts = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), parts[0].alias("host"), parts[1].alias("path"))
    rows = rows.withColumn("_key", canonical(F.col("host"), F.col("path")))
    blooms = F.broadcast(bloom_blocks(listed, n_blocks))
    probed = rows.withColumn("_block", _block(F.col("_key"), n_blocks)).join(blooms, "_block", "left")
    hit = F.lit(True)
    for i, mask in enumerate(_masks(F.col("_key"))):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(mask) != 0)
    probed = probed.withColumn("_hit", F.coalesce(hit & F.col("_key").isNotNull(), F.lit(False)))
    keep = ["page_id", "host", "path", "_key", "_hit"]
    misses = probed.where(~F.col("_hit")).select(*keep, F.lit(False).alias("listed"))
    exact = listed.withColumnRenamed("key", "_key").withColumn("listed", F.lit(True))
    hits = probed.where("_hit").select(*keep).join(exact, "_key", "left")
    hits = hits.select(*keep, F.coalesce("listed", F.lit(False)).alias("listed"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return misses.unionByName(hits).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "listed")


#: Words that mark a spam host: the list of the registered query holds every canonical URL of such hosts.
SPAM_WORDS = ["spam", "pills", "casino", "lottery"]


def spam_urls(pages: DataFrame, words: Sequence[str] = SPAM_WORDS, url_col: str = "url") -> DataFrame:
    """Canonical URLs of the pages whose host has one of the words: the list that the query blocks."""
    host, path = host_and_path(F.col(url_col))
    on = pages.select(host.alias("host"), path.alias("path")).where(
        F.regexp_like(F.col("host"), F.lit("|".join(words))))
    return on.select(canonical(F.col("host"), F.col("path")).alias("key"))
