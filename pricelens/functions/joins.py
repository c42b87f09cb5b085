"""Joins of a large table with a lookup table (unique on its key).

``lookup_join`` broadcasts the lookup side only after proving its size: it writes
the lookup once and counts it exactly. Beyond that bound it uses a shuffle join in
which the hot keys of the large side (keys holding at least ``hot_fraction`` of its rows;
there are at most ``1 / hot_fraction`` of them, so they can be broadcast) are answered
from a broadcast copy and their rows are salted across ``salt_buckets`` shuffle
partitions, so a key holding a third of all rows never lands in a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A table is broadcast up to this many bytes of values (about a third of what its hash table takes).
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def table_bytes(df: DataFrame) -> int:
    """Bytes of the table's values, exactly counted in one distributed aggregate: text by its
    length, 8 bytes for other types, 8 more per row."""
    size = F.lit(8)
    for name, kind in df.dtypes:
        size = size + (F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) + 8 if kind == "string" else F.lit(8))
    return int(df.agg(F.sum(size.cast("long"))).first()[0] or 0)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, from the file system's listing: nothing is run."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        at = jvm.org.apache.hadoop.fs.Path(name)
        total += at.getFileSystem(conf).getFileStatus(at).getLen()
    return total


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    return table_bytes(df) <= max_bytes


def bounded_count(df: DataFrame, limit: int) -> int | None:
    """Exact row count of ``df`` if it is at most ``limit``, else None.

    A plain distributed ``count()``: each task counts its own rows and one number per
    task moves. (``limit(n).count()`` would funnel up to ``n`` rows per partition into a
    single task.) Callers pass written or aggregated tables, so the count is cheap.
    """
    n = df.count()
    return n if n <= limit else None


def _eq(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else a == b


def _cond(keys: list[str], null_safe: bool, prefix: str) -> Column:
    cond = None
    for i, k in enumerate(keys):
        c = _eq(F.col(k), F.col(f"{prefix}{i}"), null_safe)
        cond = c if cond is None else cond & c
    return cond


def lookup_join(df: DataFrame, lookup: DataFrame, keys: list[str] | str, how: str = "left",
                null_safe: bool = False, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                hot_keys: DataFrame | None = None, hot_fraction: float = 0.01,
                salt_buckets: int = 32, materialize: bool = True, small: bool | None = None) -> DataFrame:
    """Join ``lookup`` (one row per key) onto ``df``; how in left, inner, left_semi, left_anti.

    ``materialize`` writes the lookup side once to the shared checkpoint folder (lineage
    cut, and the size check does not recompute it); pass False when ``lookup`` is
    already a written table. ``small`` says that the lookup is small by construction (one
    row, one row per column, one per group of a summary) or known to be, or that it is not,
    and saves the size check.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if materialize and not small:
        from pricelens.session import materialize as write_shared
        lookup = write_shared(lookup, "lookup")
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    vals = [c for c in lookup.columns if c not in keys]
    lk = lookup.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *vals,
                       F.lit(True).alias("__m"))
    key_alias = [f"__k{i}" for i in range(len(keys))]

    if small if small is not None else fits_broadcast(lookup, max_broadcast_bytes):
        out = df.join(F.broadcast(lk), _cond(keys, null_safe, "__k"),
                      "left" if how in ("left", "left_semi", "left_anti") else "inner")
        return _finish(out.drop(*key_alias), df.columns, vals, how)

    # Large lookup: salt the hot keys of df, answer them from a broadcast copy.
    if hot_keys is None:
        total = df.count()
        floor = max(1, math.ceil(hot_fraction * total))
        hot_keys = (df.groupBy(*keys).count().where(F.col("count") >= floor).select(*keys))
    limit = int(math.ceil(1.0 / hot_fraction)) + 1
    from pricelens.session import materialize as write_shared
    # More keys than can be hot (a caller's list): any of them will do, the rest stay in the
    # shuffle join, where AQE splits skewed partitions.
    hot_keys = write_shared(hot_keys.select(*keys).distinct().limit(limit), "hot-keys")
    hk = hot_keys.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)]).distinct()
    # Inner, then the few keys without a match: a left join could not broadcast its small left side.
    pairs = _cond_pairs([f"__h{i}" for i in range(len(keys))], key_alias, null_safe)
    found = write_shared(lk.join(F.broadcast(hk), pairs), "hot-rows")  # at most ``limit`` rows
    hot_lk = (hk.join(F.broadcast(found.drop(*[f"__h{i}" for i in range(len(keys))])), pairs, "left")
                .select(*[F.col(f"__h{i}") for i in range(len(keys))],
                        *[F.col(v).alias(f"__hv_{v}") for v in vals],
                        F.col("__m").alias("__hm"), F.lit(True).alias("__hot")))
    step = df.join(F.broadcast(hot_lk), _cond(keys, null_safe, "__h"), "left")
    step = step.drop(*[f"__h{i}" for i in range(len(keys))])
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else any_null | c
    spread = F.col("__hot").isNotNull() if null_safe else (F.col("__hot").isNotNull() | any_null)
    step = step.withColumn(
        "__salt", F.when(spread, 1 + F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets)))
                   .otherwise(F.lit(0)))
    cold = lk.withColumn("__salt0", F.lit(0))
    cond = _cond(keys, null_safe, "__k") & (F.col("__salt") == F.col("__salt0"))
    out = step.join(cold, cond, "left").drop(*key_alias, "__salt", "__salt0")
    out = out.withColumn("__m", F.coalesce(F.col("__hm"), F.col("__m")))
    for v in vals:
        out = out.withColumn(v, F.when(F.col("__hot").isNotNull(), F.col(f"__hv_{v}")).otherwise(F.col(v)))
    out = out.drop("__hm", "__hot", *[f"__hv_{v}" for v in vals])
    return _finish(out, df.columns, vals, how)


def _cond_pairs(left: list[str], right: list[str], null_safe: bool) -> Column:
    cond = None
    for a, b in zip(left, right):
        c = _eq(F.col(a), F.col(b), null_safe)
        cond = c if cond is None else cond & c
    return cond


def _finish(out: DataFrame, left_cols: list[str], vals: list[str], how: str) -> DataFrame:
    matched = F.col("__m").isNotNull()
    if how == "inner":
        out = out.where(matched)
    elif how == "left_semi":
        return out.where(matched).select(*left_cols)
    elif how == "left_anti":
        return out.where(~matched).select(*left_cols)
    return out.select(*left_cols, *[c for c in vals if c not in left_cols])
