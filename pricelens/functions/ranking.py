"""Rank rows in a total order without a single-partition window.

``Window.orderBy`` with no ``partitionBy`` moves every row into one task. Here the
sort is Spark's range-partitioned ``orderBy``; each sorted partition numbers its rows
(``monotonically_increasing_id`` keeps partition order), the per-partition row counts
(one row per partition, a bounded table) give every partition its offset, and the
rank restarts per group through the group's first index (one row per group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.joins import lookup_join


def sorted_rank(df: DataFrame, order: list[Column], by: list[str] | tuple = (),
                name: str = "rank") -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order`` within its ``by`` group.

    ``order`` must be a total order (break ties with a unique column) for the result to
    be deterministic. The numbered table is written to the shared folder so both
    passes over it see the same numbers.
    """
    by = list(by)
    s = df.orderBy(*[F.col(b).asc_nulls_first() for b in by], *order)
    s = (s.withColumn("__pid", F.spark_partition_id())
          .withColumn("__pos", F.monotonically_increasing_id() - F.shiftleft(
              F.spark_partition_id().cast("bigint"), 33)))
    from pricelens.session import materialize
    s = materialize(s, "sorted-rank")  # positions are stored, so file order no longer matters
    per_part = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__pc"))
    offsets = per_part.withColumn(
        "__off", F.coalesce(F.sum("__pc").over(
            Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("__pc")
    s = lookup_join(s, offsets, ["__pid"], "left", small=True)
    s = s.withColumn("__idx", F.col("__off") + F.col("__pos"))
    if by:
        firsts = s.groupBy(*by).agg(F.min("__idx").alias("__first"))
        s = lookup_join(s, firsts, by, "left", null_safe=True)
        s = s.withColumn(name, F.col("__idx") - F.col("__first") + 1).drop("__first")
    else:
        s = s.withColumn(name, F.col("__idx") + 1)
    return s.drop("__pid", "__pos", "__off", "__idx")
