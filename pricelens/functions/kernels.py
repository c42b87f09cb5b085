"""Gaussian kernel sums on a grid, in the JVM.

Every point meets the grid points within ``REACH`` bandwidths only: their indices follow from the grid's
start and step, so the point is exploded to them without a join. The sums over (group, grid point) combine
before the shuffle: a task hands on one row per group and grid point at most, whatever its rows, and a group
holding a third of all rows is spread over every task that reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Beyond eight bandwidths the kernel is below exp(-32) = 1.3e-14 of its peak.
REACH = 8.0


def kernel_sums(df: DataFrame, by: list[str], value: str, weight: str | None, grid_size: int) -> DataFrame:
    """``(by..., __k, __sum)`` with ``sum_i w_i * exp(-0.5 * ((g_k - x_i) / bw)^2)`` for the grid points in reach
    of any point (the others have no row).

    ``df`` carries, per row, the group's grid start ``__lo``, step ``__step`` and bandwidth ``__bw`` next to the
    value (and optional weight); rows with a null value or a bandwidth that is null or not above 0 add nothing.
    """
    by = list(by)
    x, lo, step, bw = F.col(value), F.col("__lo"), F.col("__step"), F.col("__bw")
    # The bounds are cut to the grid as doubles first: an index far outside it would not fit an int.
    top = F.lit(float(grid_size - 1))
    first = F.greatest(F.lit(0.0), F.least(F.ceil((x - REACH * bw - lo) / step).cast("double"), top + 1)).cast("int")
    last = F.least(top, F.greatest(F.floor((x + REACH * bw - lo) / step).cast("double"), F.lit(-1.0))).cast("int")
    rows = df.where(x.isNotNull() & (bw > 0) & (step > 0)).select(
        *by, x.alias("__x"), lo, step, bw, (F.col(weight) if weight else F.lit(1.0)).alias("__w"),
        first.alias("__first"), last.alias("__last"))
    near = rows.where(F.col("__first") <= F.col("__last"))
    near = near.withColumn("__k", F.explode(F.sequence("__first", "__last")))
    z = (lo + F.col("__k") * step - F.col("__x")) / bw
    return near.groupBy(*by, "__k").agg(F.sum(F.col("__w") * F.exp(-0.5 * z * z)).alias("__sum"))
