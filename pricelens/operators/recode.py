"""Value recoding: rare-category grouping, unit conversion, label transform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.config import FX_RATE, RARE_THRESHOLD
from pricelens.functions.joins import lookup_join
from pricelens.operators.profile import value_counts_one


def group_rare(df: DataFrame, column: str, min_count: int = RARE_THRESHOLD, other: str = "Other",
               out: str | None = None, min_ratio: int = 0) -> DataFrame:
    """Replace categories seen fewer than ``min_count`` times (and null) by ``other``;
    with ``min_ratio = K`` those that hold less than 1/K of the non-null rows.

    The frequent set is an aggregate (map-side combined) joined back with a
    size-checked lookup join — no per-row Python and no window over a category.
    """
    out = out or column
    major = value_counts_one(df, column, 1 if min_ratio else min_count, min_ratio).select(column, F.lit(True).alias("__major"))
    tagged = lookup_join(df, major, [column], "left")
    return tagged.withColumn(out, F.when(F.col("__major"), F.col(column)).otherwise(F.lit(other))) \
                 .drop("__major")


def price_units(df: DataFrame, price: str, keep: list[str] | None = None, fx_rate: float = FX_RATE) -> DataFrame:
    """Millions (``price_m``), converted currency rounded half-up to 3 places in decimal
    arithmetic (``price_out``) and the axis label text ``'<n>M'`` (``price_label``)."""
    keep = list(keep or [])
    p = F.col(price).cast("double")
    out = F.round(F.col(price).cast("decimal(18,2)") * F.lit(fx_rate).cast("decimal(10,4)"), 3).cast("double")
    return df.select(*keep, F.round(p / F.lit(1e6), 9).alias("price_m"), out.alias("price_out"),
                     F.format_string("%.0fM", p / F.lit(1e6)).alias("price_label"))
