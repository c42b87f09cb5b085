"""Repeatable train/test splits and cross-validation folds.

A row's side is a function of its key alone (md5 of the key text), so the split is the
same for any partitioning, any number of executors, after a retry, and in any SQL
engine. ``exact_split`` has exactly the rows asked for. ``random_split`` is Spark's Bernoulli ``randomSplit`` for parity only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.columns import HASH_RANGE, key_hash
from pricelens.session import materialize

#: Rows that one task of ``random_split`` sorts.
SPLIT_ROWS = 500_000


def hash_split(df: DataFrame, keys: list[str] | tuple, test_share: float = 0.2,
               name: str = "is_test") -> DataFrame:
    """Add a boolean ``is_test``: true for about ``test_share`` of the rows, any share from 0 to 1."""
    return df.withColumn(name, key_hash(*keys) < F.lit(float(test_share) * HASH_RANGE))


def exact_split(df: DataFrame, keys: list[str] | tuple, test_share: float = 0.2, name: str = "is_test") -> DataFrame:
    """Add a boolean ``is_test`` that is true for exactly ``floor(n * test_share + 1/2)`` rows: those with the
    smallest md5 of their key.

    The threshold is found by counting: rows per first four hex digits (65,536 counts at most), then per next four
    among the rows of the digits that hold it, then among the few rows left. Keys must be unique; rows that
    share the threshold's key all go to the test side. ``df`` is read up to four times: pass a written table.
    """
    digest = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in keys]))
    hashes = df.select(digest.alias("__m"))
    wanted = int(df.count() * float(test_share) + 0.5)
    prefix = ""
    if not 0 < wanted:
        return df.withColumn(name, F.lit(False))
    for _ in range(2):
        step = F.substring("__m", len(prefix) + 1, 4)
        counts = sorted((r[0], r[1]) for r in hashes.where(F.col("__m").startswith(prefix)).groupBy(step.alias("p"))
                        .agg(F.count(F.lit(1))).collect())
        for part, n in counts:
            if wanted <= n:
                prefix += part
                break
            wanted -= n
    last = hashes.where(F.col("__m").startswith(prefix)).orderBy("__m").limit(wanted).agg(F.max("__m")).first()[0]
    return df.withColumn(name, digest <= F.lit(last))


def split_frames(df: DataFrame, keys: list[str] | tuple, test_share: float = 0.2):
    tagged = hash_split(df, keys, test_share, "__t")
    return (tagged.where(~F.col("__t")).drop("__t"), tagged.where(F.col("__t")).drop("__t"))


def fold_of(keys: list[str] | tuple, k: int) -> F.Column:
    """Fold id 0..k-1 from hex digits 9-16 of the key's md5 (independent of the split)."""
    txt = F.concat_ws("-", *[F.col(c).cast("string") for c in keys])
    return F.pmod(F.conv(F.substring(F.md5(txt), 9, 8), 16, 10).cast("bigint"), F.lit(k)).cast("int")


def hash_folds(df: DataFrame, keys: list[str] | tuple, k: int, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_of(keys, k))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 40):
    """Spark's Bernoulli split; depends on partitioning (kept for parity).

    ``randomSplit`` sorts every partition, once per side, and both sides must see the same partitions. The rows are
    written once and, if they are many, dealt by their positions to partitions of about ``SPLIT_ROWS`` rows, so that
    a task's sort does not grow with the table.
    """
    rows = materialize(df, "split-rows")
    parts = -(-rows.count() // SPLIT_ROWS)  # from the files' footers
    if parts > 1:
        rows = rows.withColumn("__at", F.monotonically_increasing_id()).repartition(parts, "__at").drop("__at")
    return rows.randomSplit(list(weights), seed)
