"""Registered queries: one Spark builder per operator, and the SQL that checks it.

Every builder takes ``(spark, sf_dir)``, reads the driver's tables (through the
listing stand-in) and returns a DataFrame. ``ORACLE`` holds, for the same key, SQL
that DuckDB runs on the same parquet files; doubles are rounded identically on both
sides and counts are BIGINT, so results can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.config import LISTING_KEYS, LISTING_NUMERIC, LISTING_ROLES as ROLES
from pricelens.functions.columns import clip, log10_label, numeric_columns
from pricelens.functions.joins import lookup_join
from pricelens.operators import distribution as dist
from pricelens.operators import encode, profile, quality
from pricelens.operators.evaluate import regression_metrics
from pricelens.operators.split import fold_of, hash_split
from pricelens.operators.validate import allowed_from_data, reject_summary, validate
from pricelens.plans.sql import DIRTY, KEYS_SQL, LABELLED, LISTINGS, SPLIT, freq_codes, target_stats
from pricelens.session import ensure_checkpoint_dir, materialize, spread
from pricelens.sources.tables import dirty_listings, listings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

KEYS = list(LISTING_KEYS)
CATS = ["company", "model", "color", "engine_type", "body_type", "assembly", "transmission", "registration"]
NUMS = list(LISTING_NUMERIC)
FEATURES = CATS + ["model_year", "mileage", "engine_capacity", "price"]
# Parameters of the stand-in queries (the listing table's price range is 900..105,000).
RARE_RATIO = 64             # frequent model: at least 1/64 of the rows (there are about 64 models)
PRICE_CLIP = (5000.0, 100000.0)
SUPPORT_RATIO = 70          # allowed category: at least 1/70 of the training rows
UNSEEN_COMPANY = "Brand#1"  # held out of the fit in encode_unseen
UNSEEN_STATUS = "P"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def R(c, d: int):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def _labelled(spark, sf_dir) -> DataFrame:
    return listings(spark, sf_dir).withColumn("log_price", log10_label("price"))


def _split(spark, sf_dir):
    df = hash_split(_labelled(spark, sf_dir), KEYS, 0.2)
    return df.where(~F.col("is_test")), df.where(F.col("is_test"))


# ---------------------------------------------------------------------------
# Sources, projections, column maths
# ---------------------------------------------------------------------------
@query("scan_listings", f"WITH {LISTINGS} SELECT * FROM listings")
def q_scan(spark, sf_dir):
    return listings(spark, sf_dir)


_CSV_LINE = """CASE WHEN l_orderkey % 50 = 7 THEN 'long' WHEN l_orderkey % 77 = 5 THEN 'short' ELSE 'good' END"""


@query("csv_rejects", f"""WITH {LISTINGS}, lines AS (SELECT {_CSV_LINE} AS kind FROM listings)
SELECT kind <> 'good' AS rejected, CAST(CASE kind WHEN 'long' THEN 8 WHEN 'short' THEN 4 ELSE 6 END AS INTEGER) AS n_fields,
       CAST(count(*) AS BIGINT) AS n FROM lines GROUP BY 1, 2""")
def q_csv_rejects(spark, sf_dir):
    """Listings written as CSV lines, some with two fields too many or too few, and read again: no line is lost."""
    from pricelens.session import shared_path
    from pricelens.sources.files import read_checked_csv, write_lines
    rows = listings(spark, sf_dir)
    fields = [F.col(c).cast("string") for c in [*KEYS, "company", "mileage"]]
    kind = F.expr(_CSV_LINE)
    line = F.when(kind == "long", F.concat_ws(",", *fields, F.lit("x"), F.lit("y"))).when(
        kind == "short", F.concat_ws(",", *fields[:-2])).otherwise(F.concat_ws(",", *fields))
    folder = shared_path(spark, "csv-lines")
    write_lines(rows.select(line.alias("line")), "line", folder)
    good, bad = read_checked_csv(spark, folder, ROLES, names=[*KEYS, "company", "mileage"])
    both = good.select(F.lit(False).alias("rejected"), F.lit(6).alias("n_fields")).unionByName(
        bad.select(F.lit(True).alias("rejected"), "n_fields"))
    return both.groupBy("rejected", "n_fields").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


_NUMBERS = ["model_year", "mileage", "engine_capacity", "price"]


@query("csv_roundtrip", f"""WITH {DIRTY} SELECT row_id, {", ".join(CATS)},
       {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMBERS)} FROM dirty""")
def q_csv_roundtrip(spark, sf_dir):
    """The encoded-table sink as CSV, with an index column, read back without it: every row, null and number is there."""
    from pricelens.session import shared_path
    from pricelens.sources.files import read_listings_csv, write_table
    cols = ["row_id", *CATS, *_NUMBERS]
    rows = dirty_listings(spark, sf_dir).select(F.monotonically_increasing_id().alias("_c0"), *cols)
    folder = shared_path(spark, "listing-csv")
    write_table(rows, folder, fmt="csv")
    return read_listings_csv(spark, folder, ROLES, ignore=["_c0"]).select(*cols)


@query("text_lines", f"""WITH {LISTINGS}
SELECT model AS line, CAST(count(*) AS BIGINT) AS n FROM listings GROUP BY model""")
def q_text_lines(spark, sf_dir):
    """The text-lines sink, read back as text."""
    from pricelens.session import shared_path
    from pricelens.sources.files import write_lines
    folder = shared_path(spark, "lines")
    write_lines(listings(spark, sf_dir), "model", folder)
    return spark.read.text(folder).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("float32_cols", f"""WITH {LISTINGS} SELECT {KEYS_SQL},
       {", ".join(f"CAST(CAST({c} AS REAL) AS DOUBLE) AS {c}" for c in _NUMBERS)} FROM listings""")
def q_float32(spark, sf_dir):
    """What is left of the numbers at the precision of a 32-bit model input."""
    from pricelens.functions.columns import as_float32
    out = as_float32(listings(spark, sf_dir), _NUMBERS)
    return out.select(*KEYS, *[F.col(c).cast("double").alias(c) for c in _NUMBERS])


@query("row_counts", f"""WITH {DIRTY}
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (row_id) FROM dirty)) AS BIGINT) AS n_after_dedup
FROM dirty""")
def q_row_counts(spark, sf_dir):
    dc = quality.duplicate_count(dirty_listings(spark, sf_dir), ignore=["row_id"])
    return dc.select("n_rows", F.col("n_distinct").alias("n_after_dedup"))


@query("preview", f"WITH {LISTINGS} SELECT * FROM listings ORDER BY {KEYS_SQL} LIMIT 5")
def q_preview(spark, sf_dir):
    return listings(spark, sf_dir).orderBy(*KEYS).limit(5)


@query("drop_cols", f"WITH {LISTINGS} SELECT * EXCLUDE ({KEYS_SQL}) FROM listings")
def q_drop(spark, sf_dir):
    return listings(spark, sf_dir).drop(*KEYS)


@query("select_numeric", f"WITH {LISTINGS} SELECT model_year, mileage, engine_capacity, price FROM listings")
def q_select_numeric(spark, sf_dir):
    df = listings(spark, sf_dir)
    return df.select(*numeric_columns(df, exclude=KEYS))


@query("freq_having", f"""WITH {LISTINGS}
SELECT model, CAST(count(*) AS BIGINT) AS count FROM listings WHERE model IS NOT NULL
GROUP BY model HAVING count(*) * {RARE_RATIO} >= (SELECT count(model) FROM listings)""")
def q_freq_having(spark, sf_dir):
    return profile.value_counts_one(listings(spark, sf_dir), "model", min_ratio=RARE_RATIO)


@query("rare_group", f"""WITH {LISTINGS},
major AS (SELECT model FROM listings WHERE model IS NOT NULL GROUP BY model
  HAVING count(*) * {RARE_RATIO} >= (SELECT count(model) FROM listings))
SELECT CASE WHEN m.model IS NOT NULL THEN l.model ELSE 'Other' END AS model_grouped,
       CAST(count(*) AS BIGINT) AS count
FROM listings l LEFT JOIN major m ON l.model = m.model GROUP BY 1""")
def q_rare_group(spark, sf_dir):
    from pricelens.operators.recode import group_rare
    df = group_rare(listings(spark, sf_dir), "model", out="model_grouped", min_ratio=RARE_RATIO)
    return profile.value_counts_one(df, "model_grouped")


@query("clip_price", f"""WITH {LISTINGS}
SELECT {KEYS_SQL}, CAST(CASE WHEN price < {PRICE_CLIP[0]} THEN {PRICE_CLIP[0]} WHEN price > {PRICE_CLIP[1]}
       THEN {PRICE_CLIP[1]} ELSE price END AS DOUBLE) AS price_clipped FROM listings""")
def q_clip(spark, sf_dir):
    return listings(spark, sf_dir).select(*KEYS, clip("price", *PRICE_CLIP).alias("price_clipped"))


@query("log10_roundtrip", f"""WITH {LISTINGS}
SELECT {KEYS_SQL}, round(log10(price), 9) AS log_price, round(pow(10, log10(price)), 4) AS price_back
FROM listings""")
def q_log10(spark, sf_dir):
    df = listings(spark, sf_dir).withColumn("lp", log10_label("price"))
    return df.select(*KEYS, R("lp", 9).alias("log_price"),
                     R(F.pow(F.lit(10.0), F.col("lp")), 4).alias("price_back"))


@query("log1p_cols", f"""WITH {LISTINGS}
SELECT {KEYS_SQL}, round(ln(1 + price), 9) AS log1p_price, round(ln(1 + mileage), 9) AS log1p_mileage
FROM listings""")
def q_log1p(spark, sf_dir):
    df = listings(spark, sf_dir)
    return df.select(*KEYS, R(F.log1p("price"), 9).alias("log1p_price"),
                     R(F.log1p("mileage"), 9).alias("log1p_mileage"))


@query("price_units", f"""WITH {LISTINGS}
SELECT {KEYS_SQL}, round(price / 1000000.0, 9) AS price_m,
       CAST(round(CAST(price AS DECIMAL(18, 2)) * CAST(0.0036 AS DECIMAL(10, 4)), 3) AS DOUBLE) AS price_out,
       printf('%.0fM', price / 1000000.0) AS price_label
FROM listings""")
def q_price_units(spark, sf_dir):
    from pricelens.operators.recode import price_units
    return price_units(listings(spark, sf_dir), "price", keep=KEYS)


@query("fill_global", f"""WITH {DIRTY},
lab AS (SELECT *, CASE WHEN price > 0 THEN log10(price) END AS log_price FROM dirty),
g AS (SELECT avg(log_price) AS g FROM lab),
st AS ({target_stats('lab', ['color'])}),
enc AS (SELECT category, (n * m + 5.0 * g) / (n + 5.0) AS v FROM st, g)
SELECT lab.row_id, lab.color, round(coalesce(enc.v, g.g), 9) AS color_te
FROM lab CROSS JOIN g LEFT JOIN enc ON lab.color = enc.category""")
def q_fill_global(spark, sf_dir):
    df = dirty_listings(spark, sf_dir).withColumn("log_price", log10_label("price"))
    te = encode.SmoothedTargetEncoder(inputCols=["color"], outputCols=["color_te"], labelCol="log_price")
    out = te.fit(df).transform(df)
    return out.select("row_id", "color", R("color_te", 9).alias("color_te"))


# ---------------------------------------------------------------------------
# Data quality (on the overlay with nulls and duplicate rows)
# ---------------------------------------------------------------------------
_DIRTY_FEATURES = ", ".join(KEYS + FEATURES)


@query("dedup", f"WITH {DIRTY} SELECT DISTINCT * EXCLUDE (row_id) FROM dirty")
def q_dedup(spark, sf_dir):
    return quality.dedup(dirty_listings(spark, sf_dir), ignore=["row_id"])


@query("dup_count", f"""WITH {DIRTY},
g AS (SELECT count(*) AS n FROM dirty GROUP BY ALL_COLS)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_distinct,
       CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM g""".replace("ALL_COLS", _DIRTY_FEATURES))
def q_dup_count(spark, sf_dir):
    return quality.duplicate_count(dirty_listings(spark, sf_dir), ignore=["row_id"])


@query("dup_rows", f"""WITH {DIRTY},
r AS (SELECT *, row_number() OVER (PARTITION BY {_DIRTY_FEATURES} ORDER BY row_id) AS rn FROM dirty)
SELECT * EXCLUDE (rn) FROM r WHERE rn > 1""")
def q_dup_rows(spark, sf_dir):
    return quality.duplicate_rows(dirty_listings(spark, sf_dir), order_by="row_id")


@query("missing_counts", f"""WITH {DIRTY}
UNPIVOT (SELECT {", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in KEYS + FEATURES)},
                CAST(count(*) - count(row_id) AS BIGINT) AS row_id FROM dirty)
ON COLUMNS(*) INTO NAME "column" VALUE n_missing""")
def q_missing(spark, sf_dir):
    return quality.missing_counts(dirty_listings(spark, sf_dir))


@query("unique_counts", f"""WITH {DIRTY}
UNPIVOT (SELECT {", ".join(f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in FEATURES)}
         FROM dirty)
ON COLUMNS(*) INTO NAME "column" VALUE n_unique""")
def q_unique(spark, sf_dir):
    return quality.unique_counts(dirty_listings(spark, sf_dir), FEATURES)


_UNIQUE_SQL = ORACLE["unique_counts"]


@query("unique_counts_approx", f"SELECT *, true AS within_3_rsd FROM ({_UNIQUE_SQL})")
def q_unique_approx(spark, sf_dir):
    """The estimate is checked against the exact count: within three standard deviations."""
    df = dirty_listings(spark, sf_dir)
    both = lookup_join(quality.unique_counts(df, FEATURES), quality.unique_counts_approx(df, FEATURES, rsd=0.05),
                       ["column"], "left", small=True)
    near = F.abs(F.col("n_unique_approx") - F.col("n_unique")) <= 0.15 * F.col("n_unique") + 1
    return both.select("column", "n_unique", near.alias("within_3_rsd"))


@query("unique_counts_sketch", f"SELECT *, true AS within_3_rsd, true AS merge_is_one_pass FROM ({_UNIQUE_SQL})")
def q_unique_sketch(spark, sf_dir):
    """Sketches per model year, stored, then merged: within three standard errors of the exact count, and equal to the
    estimate of one pass over all rows."""
    df = materialize(dirty_listings(spark, sf_dir).select(*FEATURES, F.col("model_year").alias("part")), "sketched")
    stored = materialize(quality.distinct_sketches(df, FEATURES, by=["part"]), "distinct-sketches")
    merged = quality.distinct_estimates(stored)
    one = quality.distinct_estimates(quality.distinct_sketches(df, FEATURES)).withColumnRenamed("n_unique_approx", "one")
    both = lookup_join(lookup_join(quality.unique_counts(df, FEATURES), merged, ["column"], "left", small=True), one, ["column"], "left", small=True)
    near = F.abs(F.col("n_unique_approx") - F.col("n_unique")) <= 3 * 1.04 / 64 * F.col("n_unique") + 1
    return both.select("column", "n_unique", near.alias("within_3_rsd"), (F.col("n_unique_approx") == F.col("one")).alias("merge_is_one_pass"))


# ---------------------------------------------------------------------------
# Aggregations, reshape, correlation
# ---------------------------------------------------------------------------
@query("global_mean", f"WITH {LABELLED} SELECT round(avg(log_price), 9) AS global_mean FROM lab")
def q_global_mean(spark, sf_dir):
    return profile.global_mean(_labelled(spark, sf_dir), "log_price").select(R("global_mean", 9).alias("global_mean"))


@query("group_stats", f"""WITH {LABELLED}
SELECT company, round(avg(log_price), 9) AS cat_mean, CAST(count(log_price) AS BIGINT) AS cat_count
FROM lab GROUP BY company""")
def q_group_stats(spark, sf_dir):
    out = profile.group_stats(_labelled(spark, sf_dir), "company", "log_price")
    return out.select("company", R("cat_mean", 9).alias("cat_mean"), "cat_count")


@query("value_counts", f"""WITH {LISTINGS}
SELECT company, CAST(count(*) AS BIGINT) AS count FROM listings WHERE company IS NOT NULL GROUP BY company
ORDER BY count DESC, company""")
def q_value_counts(spark, sf_dir):
    return profile.value_counts_one(listings(spark, sf_dir), "company", ordered=True)


_VC_ALL = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, CAST(count(*) AS BIGINT) AS count "
    f"FROM listings WHERE {c} IS NOT NULL GROUP BY {c}" for c in CATS)


@query("value_counts_all", f"WITH {LISTINGS}, vc AS ({_VC_ALL}) SELECT * FROM vc")
def q_value_counts_all(spark, sf_dir):
    return profile.value_counts(listings(spark, sf_dir), CATS)


@query("freq_share", f"""WITH {LISTINGS}, vc AS ({_VC_ALL})
SELECT feature, category, count,
       round(CAST(count AS DOUBLE) / sum(count) OVER (PARTITION BY feature), 9) AS share,
       CAST(row_number() OVER (PARTITION BY feature ORDER BY count DESC, category) AS BIGINT) AS rank
FROM vc""")
def q_freq_share(spark, sf_dir):
    out = profile.freq_share(listings(spark, sf_dir), CATS)
    return out.select("feature", "category", "count", R("share", 9).alias("share"), "rank")


_MELT = "\n  UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM listings" for c in NUMS)


_FREQUENT = [*CATS, "model_year", "mileage"]


@query("frequent_items", f"""WITH {DIRTY},
vc AS (""" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, count(*) AS n FROM dirty GROUP BY {c}" for c in _FREQUENT) + f""")
SELECT feature, category, CAST(n AS BIGINT) AS n, true AS in_bounds FROM vc
WHERE n * {RARE_RATIO} >= (SELECT count(*) FROM dirty)""")
def q_frequent_items(spark, sf_dir):
    """The frequent values found by sketch, with their exact counts and whether these lie within the sketch's bounds."""
    out = profile.frequent_counts(dirty_listings(spark, sf_dir), _FREQUENT, RARE_RATIO)
    return out.select("feature", "category", F.col("count").cast("bigint").alias("n"),
                      F.col("count").between(F.col("lower"), F.col("upper")).alias("in_bounds"))


@query("melt_numeric", f"WITH {LISTINGS}, m AS ({_MELT}) SELECT * FROM m")
def q_melt(spark, sf_dir):
    return profile.melt_numeric(listings(spark, sf_dir), NUMS)


@query("describe_numeric", f"""WITH {LISTINGS}, m AS ({_MELT})
SELECT variable, CAST(count(value) AS BIGINT) AS count, round(avg(value), 2) AS mean,
       round(stddev_samp(value), 2) AS std, round(min(value), 2) AS min,
       round(quantile_cont(value, 0.25), 2) AS q25, round(quantile_cont(value, 0.5), 2) AS q50,
       round(quantile_cont(value, 0.75), 2) AS q75, round(max(value), 2) AS max
FROM m GROUP BY variable""")
def q_describe(spark, sf_dir):
    return profile.describe_numeric(listings(spark, sf_dir), NUMS)


_PAIRS = [(a, b) for i, a in enumerate(NUMS) for b in NUMS[i + 1:]]


@query("pearson", f"WITH {LISTINGS} " + "\nUNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 12) AS r FROM listings"
    for a, b in _PAIRS))
def q_pearson(spark, sf_dir):
    return profile.pearson(listings(spark, sf_dir), NUMS).select("x", "y", R("r", 12).alias("r"))


# ---------------------------------------------------------------------------
# Join (the encoder's statistics joined back)
# ---------------------------------------------------------------------------
@query("encode_join", f"""WITH {LABELLED},
st AS (SELECT company, avg(log_price) AS cat_mean, count(log_price) AS cat_count FROM lab GROUP BY company)
SELECT {KEYS_SQL}, lab.company, round(st.cat_mean, 9) AS cat_mean, CAST(st.cat_count AS BIGINT) AS cat_count
FROM lab LEFT JOIN st ON lab.company = st.company""")
def q_encode_join(spark, sf_dir):
    df = _labelled(spark, sf_dir)
    st = profile.group_stats(df, "company", "log_price")
    out = lookup_join(df, st, ["company"], "left")
    return out.select(*KEYS, "company", R("cat_mean", 9).alias("cat_mean"), "cat_count")


# ---------------------------------------------------------------------------
# Distributions
# ---------------------------------------------------------------------------
def _hist_sql(expr: str) -> str:
    edge = "CASE WHEN {b} = 50 THEN hi ELSE CAST({b} AS DOUBLE) * step + lo END"
    return f"""WITH {LISTINGS},
d AS (SELECT CAST({expr} AS DOUBLE) AS x FROM listings),
d2 AS (SELECT x FROM d WHERE x IS NOT NULL AND NOT isnan(x)),
r AS (SELECT CASE WHEN max(x) > min(x) THEN min(x) ELSE min(x) - 0.5 END AS lo,
             CASE WHEN max(x) > min(x) THEN max(x) ELSE max(x) + 0.5 END AS hi FROM d2),
r2 AS (SELECT lo, hi, (hi - lo) / CAST(50 AS DOUBLE) AS step FROM r),
b0 AS (SELECT x, lo, hi, step, floor((x - lo) / (hi - lo) * CAST(50 AS DOUBLE)) AS b FROM d2, r2),
b1 AS (SELECT x, lo, hi, step, CASE WHEN b = 50 THEN 49 ELSE b END AS b FROM b0),
b2 AS (SELECT x, lo, hi, step, CASE WHEN x < ({edge.format(b='b')}) THEN b - 1 ELSE b END AS b FROM b1),
b3 AS (SELECT CASE WHEN x >= ({edge.format(b='(b + 1)')}) AND b <> 49 THEN b + 1 ELSE b END AS b FROM b2),
c AS (SELECT CAST(b AS BIGINT) AS b, count(*) AS n FROM b3 GROUP BY 1)
SELECT CAST(g.range AS BIGINT) AS bin, round(CAST(g.range AS DOUBLE) * r2.step + r2.lo, 6) AS bin_lo,
       round(CASE WHEN g.range = 49 THEN r2.hi ELSE CAST(g.range + 1 AS DOUBLE) * r2.step + r2.lo END, 6) AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range(50) g CROSS JOIN r2 LEFT JOIN c ON c.b = g.range"""


def _hist(spark, sf_dir, expr):
    df = listings(spark, sf_dir).select(expr.alias("v"))
    h = dist.histogram(df, "v", bins=50)
    return h.select("bin", R("bin_lo", 6).alias("bin_lo"), R("bin_hi", 6).alias("bin_hi"), "count")


@query("hist_price", _hist_sql("price"))
def q_hist_price(spark, sf_dir):
    return _hist(spark, sf_dir, F.col("price"))


@query("hist_log_price", _hist_sql("ln(1 + price)"))
def q_hist_log_price(spark, sf_dir):
    return _hist(spark, sf_dir, F.log1p("price"))


@query("hist_mileage", _hist_sql("mileage"))
def q_hist_mileage(spark, sf_dir):
    return _hist(spark, sf_dir, F.col("mileage"))


@query("hist_log_mileage", _hist_sql("ln(1 + mileage)"))
def q_hist_log_mileage(spark, sf_dir):
    return _hist(spark, sf_dir, F.log1p("mileage"))


# The margins of the joint plots (price and mileage are above).
@query("hist_model_year", _hist_sql("model_year"))
def q_hist_model_year(spark, sf_dir):
    return _hist(spark, sf_dir, F.col("model_year"))


@query("hist_engine_capacity", _hist_sql("engine_capacity"))
def q_hist_engine_capacity(spark, sf_dir):
    return _hist(spark, sf_dir, F.col("engine_capacity"))


def _kde_sql(binned: bool, value: str = "price", by: str | None = None, grid: int = 200,
             cut: float = 0.0, source: str = "listings", x_digits: int = 4, extra: str = "") -> str:
    grp = by or "0"
    if binned:
        pts = """b AS (SELECT d.grp, least(floor((d.x - s.mn) / ((s.mx - s.mn) / CAST(2048 AS DOUBLE))), 2047) AS b,
                 count(*) AS w FROM d JOIN s ON d.grp IS NOT DISTINCT FROM s.grp GROUP BY 1, 2),
pts AS (SELECT b.grp, s.mn + (b.b + 0.5) * ((s.mx - s.mn) / CAST(2048 AS DOUBLE)) AS x, CAST(b.w AS DOUBLE) AS w
        FROM b JOIN s ON b.grp IS NOT DISTINCT FROM s.grp)"""
    else:
        pts = "pts AS (SELECT grp, x, CAST(1 AS DOUBLE) AS w FROM d)"
    head = f"sums.grp AS {by}, " if by else ""
    return f"""WITH {LISTINGS}{extra},
d AS (SELECT {grp} AS grp, CAST({value} AS DOUBLE) AS x FROM {source} WHERE {value} IS NOT NULL),
s0 AS (SELECT grp, count(*) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM d GROUP BY grp),
s1 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) * 1.0 AS bw FROM s0),
s AS (SELECT *, mn - {cut} * bw AS lo, (mx + {cut} * bw - (mn - {cut} * bw)) / CAST({grid - 1} AS DOUBLE) AS step
      FROM s1 WHERE bw > 0),
{pts},
z AS (SELECT p.grp, g.range AS k, p.w, (CAST(g.range AS DOUBLE) * s.step + s.lo - p.x) / s.bw AS z
      FROM pts p JOIN s ON p.grp IS NOT DISTINCT FROM s.grp CROSS JOIN range({grid}) g),
sums AS (SELECT grp, k, sum(w * exp(-0.5 * z * z)) AS t FROM z GROUP BY grp, k)
SELECT {head}CAST(sums.k AS BIGINT) AS k, round(CAST(sums.k AS DOUBLE) * s.step + s.lo, {x_digits}) AS x,
       round(sums.t / (s.n * s.bw * sqrt(2 * pi())), 12) AS density, CAST(s.n AS BIGINT) AS n, round(s.bw, 6) AS bw
FROM sums JOIN s ON sums.grp IS NOT DISTINCT FROM s.grp"""


def _kde_out(df: DataFrame, by: list[str], x_digits: int = 4) -> DataFrame:
    return df.select(*by, "k", R("x", x_digits).alias("x"), R("density", 12).alias("density"), "n",
                     R("bw", 6).alias("bw"))


@query("kde_price", _kde_sql(False))
def q_kde_price(spark, sf_dir):
    return _kde_out(dist.density(listings(spark, sf_dir), "price", grid_size=200, cut=0.0, binned=False), [])


@query("kde_binned", _kde_sql(True))
def q_kde_binned(spark, sf_dir):
    return _kde_out(dist.density(listings(spark, sf_dir), "price", grid_size=200, cut=0.0), [])


def _kde_of(spark, sf_dir, value):
    df = listings(spark, sf_dir).select(value.alias("v"))
    return _kde_out(dist.density(df, "v", grid_size=200, cut=0.0), [])


@query("kde_mileage", _kde_sql(True, value="mileage"))
def q_kde_mileage(spark, sf_dir):
    return _kde_of(spark, sf_dir, F.col("mileage"))


# A logarithm's last digit differs between engines and may move a value that sits on a bin's
# edge, so the log densities are compared to six digits less.
@query("kde_log_price", _kde_sql(True, value="round(ln(1 + price), 9)"))
def q_kde_log_price(spark, sf_dir):
    return _kde_of(spark, sf_dir, R(F.log1p("price"), 9))


@query("kde_log_mileage", _kde_sql(True, value="round(ln(1 + mileage), 9)"))
def q_kde_log_mileage(spark, sf_dir):
    return _kde_of(spark, sf_dir, R(F.log1p("mileage"), 9))


_CLIPPED = (f"clipped AS (SELECT company, CAST(CASE WHEN price < {PRICE_CLIP[0]} THEN {PRICE_CLIP[0]} "
            f"WHEN price > {PRICE_CLIP[1]} THEN {PRICE_CLIP[1]} ELSE price END AS DOUBLE) AS price FROM listings)")


def _clipped(spark, sf_dir):
    return listings(spark, sf_dir).select("company", clip("price", *PRICE_CLIP).alias("price"))


@query("violin_quartiles", f"""WITH {LISTINGS}, {_CLIPPED}
SELECT company, CAST(count(price) AS BIGINT) AS n, round(quantile_cont(price, 0.25), 6) AS q1,
       round(quantile_cont(price, 0.5), 6) AS median, round(quantile_cont(price, 0.75), 6) AS q3
FROM clipped GROUP BY company""")
def q_violin_quartiles(spark, sf_dir):
    out = dist.violin_quartiles(_clipped(spark, sf_dir), "company", "price")
    return out.select("company", "n", *[R(c, 6).alias(c) for c in ["q1", "median", "q3"]])


@query("violin_density", _kde_sql(True, by="company", grid=100, cut=2.0, source="clipped", x_digits=2,
                                  extra=", " + _CLIPPED))
def q_violin_density(spark, sf_dir):
    out = dist.violin_density(_clipped(spark, sf_dir), "company", "price", grid_size=100, cut=2.0, binned=True)
    return _kde_out(out, ["company"], x_digits=2)


_BOX_SQL = f"""WITH {LISTINGS}, m AS ({_MELT}),
q AS (SELECT variable, count(value) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM m WHERE value IS NOT NULL GROUP BY variable),
lim AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_lim, q3 + 1.5 * (q3 - q1) AS hi_lim FROM q)"""


@query("box_stats", _BOX_SQL + """
SELECT lim.variable, CAST(lim.n AS BIGINT) AS n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(min(CASE WHEN value >= lo_lim THEN value END), 6) AS whisker_lo,
       round(max(CASE WHEN value <= hi_lim THEN value END), 6) AS whisker_hi,
       CAST(sum(CASE WHEN value < lo_lim OR value > hi_lim THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM m JOIN lim ON m.variable = lim.variable
GROUP BY lim.variable, lim.n, q1, median, q3, iqr""")
def q_box_stats(spark, sf_dir):
    out = dist.box_stats(listings(spark, sf_dir), NUMS)
    return out.select("variable", "n", *[R(c, 6).alias(c) for c in
                                         ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"]], "n_outliers")


# Outliers planted in the overlay: one row in 512 (by key) costs 40 times its price, one in 640 has a
# thousandth of its mileage.
_PLANTED_SQL = f"""planted AS (
  SELECT {KEYS_SQL}, CASE WHEN (l_orderkey * 7 + l_linenumber) % 512 = 3 THEN price * 40 ELSE price END AS price,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 640 = 5 THEN -mileage ELSE mileage END AS mileage FROM listings)"""
_PLANTED_BOX_SQL = (_BOX_SQL.replace(f"m AS ({_MELT})", f"""{_PLANTED_SQL},
m AS (SELECT 'price' AS variable, CAST(price AS DOUBLE) AS value FROM planted
      UNION ALL SELECT 'mileage', CAST(mileage AS DOUBLE) FROM planted)"""))


def _planted(spark, sf_dir):
    df, spot = listings(spark, sf_dir), F.col("l_orderkey") * 7 + F.col("l_linenumber")
    return df.select(*KEYS, F.when(spot % 512 == 3, F.col("price") * 40).otherwise(F.col("price")).alias("price"),
                     F.when(spot % 640 == 5, -F.col("mileage")).otherwise(F.col("mileage")).alias("mileage"))


@query("box_outliers", _PLANTED_BOX_SQL + """
SELECT m.variable, round(m.value, 6) AS value FROM m JOIN lim ON m.variable = lim.variable
WHERE m.value < lo_lim OR m.value > hi_lim""")
def q_box_outliers(spark, sf_dir):
    return dist.box_outliers(_planted(spark, sf_dir), ["price", "mileage"]).select("variable", R("value", 6).alias("value"))


@query("box_stats_outliers", _PLANTED_BOX_SQL + """
SELECT lim.variable, CAST(lim.n AS BIGINT) AS n, round(min(CASE WHEN value >= lo_lim THEN value END), 6) AS whisker_lo,
       round(max(CASE WHEN value <= hi_lim THEN value END), 6) AS whisker_hi,
       CAST(sum(CASE WHEN value < lo_lim OR value > hi_lim THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM m JOIN lim ON m.variable = lim.variable GROUP BY lim.variable, lim.n""")
def q_box_stats_outliers(spark, sf_dir):
    out = dist.box_stats(_planted(spark, sf_dir), ["price", "mileage"])
    return out.select("variable", "n", R("whisker_lo", 6).alias("whisker_lo"), R("whisker_hi", 6).alias("whisker_hi"),
                      "n_outliers")


_XS = ["model_year", "mileage", "engine_capacity"]


@query("joint_regression", f"WITH {LISTINGS} " + "\nUNION ALL ".join(
    f"""SELECT '{x}' AS x, CAST(regr_count(price, CAST({x} AS DOUBLE)) AS BIGINT) AS n,
       round(regr_slope(price, CAST({x} AS DOUBLE)), 7) AS slope,
       round(regr_intercept(price, CAST({x} AS DOUBLE)), 2) AS intercept,
       round(regr_r2(price, CAST({x} AS DOUBLE)), 12) AS r2 FROM listings""" for x in _XS))
def q_joint_regression(spark, sf_dir):
    out = dist.regression(listings(spark, sf_dir), _XS, "price")
    # The intercept of the model-year line cancels ~4 digits (mean x is ~2000), so
    # both sides round it to cents.
    return out.select("x", "n", R("slope", 7).alias("slope"), R("intercept", 2).alias("intercept"),
                      R("r2", 12).alias("r2"))


def _bins2d_sql(x: str) -> str:
    return f"""WITH {LISTINGS},
d AS (SELECT CAST({x} AS DOUBLE) AS x, CAST(price AS DOUBLE) AS y FROM listings
      WHERE {x} IS NOT NULL AND price IS NOT NULL),
r AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM d)
SELECT CAST(CASE WHEN x1 - x0 > 0 THEN least(floor((x - x0) / (x1 - x0) * CAST(20 AS DOUBLE)), 19) ELSE 0 END AS BIGINT) AS x_bin,
       CAST(CASE WHEN y1 - y0 > 0 THEN least(floor((y - y0) / (y1 - y0) * CAST(20 AS DOUBLE)), 19) ELSE 0 END AS BIGINT) AS y_bin,
       CAST(count(*) AS BIGINT) AS count
FROM d CROSS JOIN r GROUP BY 1, 2"""


@query("joint_bins2d", _bins2d_sql("mileage"))
def q_joint_bins2d(spark, sf_dir):
    return dist.bins2d(listings(spark, sf_dir), "mileage", "price", bins=20)


@query("joint_bins2d_year", _bins2d_sql("model_year"))
def q_joint_bins2d_year(spark, sf_dir):
    return dist.bins2d(listings(spark, sf_dir), "model_year", "price", bins=20)


@query("joint_bins2d_capacity", _bins2d_sql("engine_capacity"))
def q_joint_bins2d_capacity(spark, sf_dir):
    return dist.bins2d(listings(spark, sf_dir), "engine_capacity", "price", bins=20)


def _band_sql() -> str:
    # Published constants: the normal quantile at 0.975 and the first two terms of its correction
    # for a t distribution of thousands of degrees of freedom (the next is below 1e-9).
    z, g1, g2 = 1.959963984540054, 2.372272, 2.822499
    stats = "\n  UNION ALL ".join(
        f"""SELECT '{x}' AS x, regr_count(price, CAST({x} AS DOUBLE)) AS n, regr_slope(price, CAST({x} AS DOUBLE)) AS slope,
         regr_intercept(price, CAST({x} AS DOUBLE)) AS intercept, regr_sxx(price, CAST({x} AS DOUBLE)) AS sxx,
         regr_syy(price, CAST({x} AS DOUBLE)) AS syy, regr_sxy(price, CAST({x} AS DOUBLE)) AS sxy,
         regr_avgx(price, CAST({x} AS DOUBLE)) AS avg_x,
         min(CASE WHEN price IS NOT NULL THEN CAST({x} AS DOUBLE) END) AS min_x,
         max(CASE WHEN price IS NOT NULL THEN CAST({x} AS DOUBLE) END) AS max_x FROM listings""" for x in _XS)
    return f"""WITH {LISTINGS},
st AS ({stats}),
st2 AS (SELECT *, CAST(n - 2 AS DOUBLE) AS nu FROM st WHERE n > 2),
st3 AS (SELECT *, sqrt(greatest(syy - slope * sxy, 0.0) / nu) AS s,
               {z!r} + {g1!r} / nu + {g2!r} / pow(nu, 2) AS t
        FROM st2),
g AS (SELECT st3.*, CAST(k.range AS BIGINT) AS k,
             min_x + CAST(k.range AS DOUBLE) * (max_x - min_x) / CAST(19 AS DOUBLE) AS x0
      FROM st3 CROSS JOIN range(20) k),
f AS (SELECT *, intercept + slope * x0 AS fit,
             s * sqrt(1.0 / n + pow(x0 - avg_x, 2) / sxx) AS se FROM g)
SELECT x, k, round(x0, 2) AS x0, round(fit, 2) AS fit, round(fit - t * se, 2) AS lower,
       round(fit + t * se, 2) AS upper FROM f"""


@query("regression_band", _band_sql())
def q_regression_band(spark, sf_dir):
    out = dist.regression_band(listings(spark, sf_dir), _XS, "price", level=0.95, grid_size=20)
    return out.select("x", "k", *[R(c, 2).alias(c) for c in ["x0", "fit", "lower", "upper"]])


@query("bootstrap_band", _band_sql().replace("SELECT x, k, ", "SELECT x, k, true AS near_closed_form, "))
def q_bootstrap_band(spark, sf_dir):
    """The bootstrap band beside the closed form that it estimates, whose columns these are: each edge is within
    half of the closed form's half-width of it."""
    df = listings(spark, sf_dir)
    closed = dist.regression_band(df, _XS, "price", level=0.95, grid_size=20)
    boot = dist.bootstrap_band(df, _XS, "price", KEYS, level=0.95, grid_size=20)
    both = lookup_join(closed, boot.select("x", "k", F.col("lower").alias("low"), F.col("upper").alias("high")), ["x", "k"], small=True)
    half = (F.col("upper") - F.col("lower")) / 2
    near = (F.abs(F.col("low") - F.col("lower")) < half * 0.5) & (F.abs(F.col("high") - F.col("upper")) < half * 0.5)
    return both.select("x", "k", near.alias("near_closed_form"), *[R(c, 2).alias(c) for c in ["x0", "fit", "lower", "upper"]])


# ---------------------------------------------------------------------------
# Encoders
# ---------------------------------------------------------------------------
_TE = ["company", "model", "color"]
_ORD = ["assembly", "transmission", "registration"]
_OHE = ["engine_type", "body_type"]


def _te_sql(source: str, fit: str, method: str = "additive", select_from: str | None = None) -> str:
    if method == "additive":
        value = "(n * m + 5.0 * g) / (n + 5.0)"
    else:
        w = "(1.0 / (1.0 + exp(-(n - 20.0) / 5.0)))"
        value = f"CASE WHEN n = 1 THEN g ELSE g * (1.0 - {w}) + m * {w} END"
    rows = select_from or source
    joins = "\n".join(f"LEFT JOIN enc e{i} ON e{i}.feature = '{c}' AND e{i}.category = r.{c}"
                      for i, c in enumerate(_TE))
    cols = ", ".join(f"round(coalesce(e{i}.v, g.g), 9) AS {c}_te" for i, c in enumerate(_TE))
    return f"""g AS (SELECT avg(log_price) AS g FROM {fit}),
st AS ({target_stats(fit, _TE)}),
enc AS (SELECT feature, category, {value} AS v FROM st, g)
SELECT {", ".join("r." + k for k in KEYS)}, {cols}
FROM {rows} r CROSS JOIN g
{joins}"""


def _te_spark(fit_df: DataFrame, apply_df: DataFrame, method: str = "additive") -> DataFrame:
    te = encode.SmoothedTargetEncoder(inputCols=_TE, outputCols=[c + "_te" for c in _TE],
                                      labelCol="log_price", method=method)
    out = te.fit(fit_df).transform(apply_df)
    return out.select(*KEYS, *[R(c + "_te", 9).alias(c + "_te") for c in _TE])


@query("target_encode", f"WITH {LABELLED}, " + _te_sql("lab", "lab"))
def q_target_encode(spark, sf_dir):
    df = _labelled(spark, sf_dir)
    return _te_spark(df, df)


@query("target_encode_sigmoid", f"WITH {LABELLED}, " + _te_sql("lab", "lab", "sigmoid"))
def q_target_encode_sigmoid(spark, sf_dir):
    df = _labelled(spark, sf_dir)
    return _te_spark(df, df, "sigmoid")


@query("encode_train_only", f"WITH {SPLIT}, " + _te_sql("test", "train"))
def q_encode_train_only(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return _te_spark(train, test)


def _oof_sql() -> str:
    def sums(*by):
        return "\n  UNION ALL ".join(
            f"SELECT '{c}' AS feature, {c} AS category, {''.join(b + ', ' for b in by)}sum(log_price) AS s, count(log_price) AS n "
            f"FROM src WHERE f IS NOT NULL GROUP BY {', '.join([c, *by])}" for c in _TE)
    cols, joins = [], []
    for i, c in enumerate(_TE):
        n = f"(coalesce(t{i}.n, 0) - coalesce(o{i}.n, 0))"
        cols.append(f"round(CASE WHEN {n} > 0 THEN (t{i}.s - coalesce(o{i}.s, 0) + 5.0 * r.g) / ({n} + 5.0) ELSE r.g END, 9) AS {c}_te")
        joins.append(f"LEFT JOIN t t{i} ON t{i}.feature = '{c}' AND t{i}.category = r.{c} "
                     f"LEFT JOIN o o{i} ON o{i}.feature = '{c}' AND o{i}.category = r.{c} AND o{i}.f = r.f")
    return f"""WITH {SPLIT},
src AS (SELECT *, CASE WHEN NOT is_test THEN fold END AS f FROM split),
gt AS (SELECT sum(log_price) AS s, count(log_price) AS n FROM src WHERE f IS NOT NULL),
gf AS (SELECT f, sum(log_price) AS s, count(log_price) AS n FROM src WHERE f IS NOT NULL GROUP BY f),
t AS ({sums()}),
o AS ({sums('f')}),
r AS (SELECT src.*, (gt.s - coalesce(gf.s, 0)) / (gt.n - coalesce(gf.n, 0)) AS g
      FROM src CROSS JOIN gt LEFT JOIN gf ON gf.f = src.f)
SELECT {", ".join("r." + k for k in KEYS)}, coalesce(r.f, -1) AS fold, {", ".join(cols)}
FROM r {" ".join(joins)}"""


@query("target_encode_oof", _oof_sql())
def q_target_encode_oof(spark, sf_dir):
    """Training rows by the other nine folds, test rows (no fold) by all ten."""
    df = hash_split(_labelled(spark, sf_dir), KEYS, 0.2).withColumn("fold", F.when(~F.col("is_test"), fold_of(KEYS, 10)))
    df = materialize(df.select(*KEYS, *_TE, "log_price", "fold"), "folds")
    out = encode.out_of_fold_encode(df, _TE, "log_price", "fold")
    return out.select(*KEYS, F.coalesce("fold", F.lit(-1)).alias("fold"), *[R(c + "_te", 9).alias(c + "_te") for c in _TE])


def _ordinal_sql(alphabetical: bool) -> str:
    cols = ", ".join(
        f"CAST(coalesce(i{i}.code, (SELECT count(*) FROM idx WHERE feature = '{c}')) AS DOUBLE) AS {c}_idx"
        for i, c in enumerate(_ORD))
    joins = "\n".join(f"LEFT JOIN idx i{i} ON i{i}.feature = '{c}' AND i{i}.category = l.{c}"
                      for i, c in enumerate(_ORD))
    return f"""WITH {LISTINGS},
idx AS ({freq_codes('listings', _ORD, alphabetical)})
SELECT {", ".join("l." + k for k in KEYS)}, {cols}
FROM listings l
{joins}"""


def _ordinal_spark(spark, sf_dir, order):
    df = listings(spark, sf_dir)
    out = encode.ordinal_indexer(_ORD, order).fit(df).transform(df)
    return out.select(*KEYS, *[c + "_idx" for c in _ORD])


@query("ordinal_freq", _ordinal_sql(False))
def q_ordinal_freq(spark, sf_dir):
    return _ordinal_spark(spark, sf_dir, "frequency")


@query("ordinal_alpha", _ordinal_sql(True))
def q_ordinal_alpha(spark, sf_dir):
    return _ordinal_spark(spark, sf_dir, "alphabet")


# Fixed values of the stand-in table (one-hot labels the SQL check spells out).
_OHE_LABELS = {"engine_type": ["A", "N", "R"],
               "body_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}


@query("onehot_wide", f"WITH {LISTINGS} SELECT {KEYS_SQL}, " + ", ".join(
    f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS {c}_{v}" for c in _OHE for v in _OHE_LABELS[c])
    + " FROM listings")
def q_onehot_wide(spark, sf_dir):
    df = listings(spark, sf_dir).select(*KEYS, *_OHE)
    return encode.one_hot_wide(df, _OHE)


def _pipeline_fit(df: DataFrame):
    """Fit the feature pipeline; returns (model, the written input it was fitted on)."""
    from pricelens.session import materialize
    df = materialize(df, "pipeline-input")  # read by the indexers, the encoder, the transform
    return encode.feature_pipeline(ROLES).fit(df), df


def _feature_names(model) -> list[str]:
    """Assembled slot names, one-hot widths read from the fitted indexer (labels + 1)."""
    width = encode.one_hot_widths(model)
    names = ["model_year", "mileage", "engine_capacity"] + [c + "_idx" for c in _ORD]
    for c in _OHE:
        names += [f"{c}_{i}" for i in range(width[c])]
    return names + [c + "_te" for c in _TE]


@query("feature_table", f"""WITH {LABELLED},
g AS (SELECT avg(log_price) AS g FROM lab),
st AS ({target_stats('lab', _TE)}),
enc AS (SELECT feature, category, (n * m + 5.0 * g) / (n + 5.0) AS v FROM st, g),
idx AS ({freq_codes('lab', _ORD + _OHE)}),
coded AS (
  SELECT {", ".join("r." + k for k in KEYS)}, r.model_year, r.mileage, r.engine_capacity,
         {", ".join(f"coalesce(i_{c}.code, (SELECT count(*) FROM idx WHERE feature = '{c}')) AS {c}_code" for c in _ORD + _OHE)},
         {", ".join(f"coalesce(e_{c}.v, g.g) AS {c}_te" for c in _TE)}
  FROM lab r CROSS JOIN g
  {" ".join(f"LEFT JOIN idx i_{c} ON i_{c}.feature = '{c}' AND i_{c}.category = r.{c}" for c in _ORD + _OHE)}
  {" ".join(f"LEFT JOIN enc e_{c} ON e_{c}.feature = '{c}' AND e_{c}.category = r.{c}" for c in _TE)})
SELECT {KEYS_SQL}, CAST(model_year AS DOUBLE) AS model_year, CAST(mileage AS DOUBLE) AS mileage,
       CAST(engine_capacity AS DOUBLE) AS engine_capacity,
       {", ".join(f"CAST({c}_code AS DOUBLE) AS {c}_idx" for c in _ORD)},
       {", ".join(f"CAST(CASE WHEN engine_type_code = {i} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS engine_type_{i}" for i in range(4))},
       {", ".join(f"CAST(CASE WHEN body_type_code = {i} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS body_type_{i}" for i in range(7))},
       {", ".join(f"round({c}_te, 9) AS {c}_te" for c in _TE)}
FROM coded""")
def q_feature_table(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    model, df = _pipeline_fit(_labelled(spark, sf_dir))
    arr = model.transform(df).select(*KEYS, vector_to_array("features").alias("__f"))
    names = _feature_names(model)
    cols = [F.col("__f")[i].alias(n) for i, n in enumerate(names)]
    out = arr.select(*KEYS, *cols)
    return out.select(*KEYS, *[R(n, 9).alias(n) if n.endswith("_te") else F.col(n) for n in names])


@query("encoding_map", f"""WITH {LABELLED},
g AS (SELECT avg(log_price) AS g FROM lab),
st AS ({target_stats('lab', _TE)}),
idx AS ({freq_codes('lab', _ORD + _OHE)})
SELECT 'target' AS kind, feature, category, round((n * m + 5.0 * g) / (n + 5.0), 9) AS value FROM st, g
UNION ALL SELECT 'global_mean', 'log_price', NULL, round(g, 9) FROM g
UNION ALL SELECT CASE WHEN feature IN ('engine_type', 'body_type') THEN 'onehot' ELSE 'ordinal' END,
                 feature, category, CAST(code AS DOUBLE) FROM idx
UNION ALL SELECT CASE WHEN feature IN ('engine_type', 'body_type') THEN 'onehot' ELSE 'ordinal' END,
                 feature, '__unknown__', CAST(count(*) AS DOUBLE) FROM idx GROUP BY feature""")
def q_encoding_map(spark, sf_dir):
    model, _ = _pipeline_fit(_labelled(spark, sf_dir))
    m = encode.encoding_map(model, spark)
    return m.select("kind", "feature", "category", R("value", 9).alias("value"))


@query("encoding_map_nested", f"""WITH {LABELLED},
g AS (SELECT avg(log_price) AS g FROM lab),
st AS ({target_stats('lab', _TE)}),
idx AS ({freq_codes('lab', _ORD + _OHE)})
SELECT 'target' AS kind, feature, category AS key, round((n * m + 5.0 * g) / (n + 5.0), 9) AS value FROM st, g
UNION ALL SELECT 'global_mean', 'log_price', 'log_price', round(g, 9) FROM g
UNION ALL SELECT CASE WHEN feature IN ('engine_type', 'body_type') THEN 'onehot' ELSE 'ordinal' END,
                 feature, category, CAST(code AS DOUBLE) FROM idx
UNION ALL SELECT CASE WHEN feature IN ('engine_type', 'body_type') THEN 'onehot' ELSE 'ordinal' END,
                 feature, '__unknown__', CAST(count(*) AS DOUBLE) FROM idx GROUP BY feature""")
def q_encoding_map_nested(spark, sf_dir):
    """The nested JSON file, written and read back."""
    from pricelens.session import shared_path
    from pricelens.sources.files import read_nested_encoding_map, write_encoding_map
    model, _ = _pipeline_fit(_labelled(spark, sf_dir))
    path = shared_path(spark, "nested-map")
    write_encoding_map(encode.encoding_map(model, spark), path, nested=True, entries=20)
    m = read_nested_encoding_map(spark, path)
    return m.select("kind", "feature", "key", R("value", 9).alias("value"))


@query("encode_unseen", f"""WITH {LABELLED},
fit AS (SELECT * FROM lab WHERE company <> '{UNSEEN_COMPANY}' AND transmission <> '{UNSEEN_STATUS}'),
g AS (SELECT avg(log_price) AS g FROM fit),
st AS ({target_stats('fit', ['company'])}),
enc AS (SELECT category, (n * m + 5.0 * g) / (n + 5.0) AS v FROM st, g),
idx AS ({freq_codes('fit', ['transmission'])})
SELECT {", ".join("r." + k for k in KEYS)}, r.company, r.transmission,
       round(coalesce(enc.v, g.g), 9) AS company_te,
       CAST(coalesce(idx.code, (SELECT count(*) FROM idx)) AS DOUBLE) AS transmission_idx
FROM lab r CROSS JOIN g LEFT JOIN enc ON enc.category = r.company
LEFT JOIN idx ON idx.category = r.transmission""")
def q_encode_unseen(spark, sf_dir):
    df = _labelled(spark, sf_dir)
    fit = df.where((F.col("company") != UNSEEN_COMPANY) & (F.col("transmission") != UNSEEN_STATUS))
    te = encode.SmoothedTargetEncoder(inputCols=["company"], outputCols=["company_te"], labelCol="log_price")
    idx = encode.ordinal_indexer(["transmission"])
    from pyspark.ml import Pipeline
    model = Pipeline(stages=[te, idx]).fit(fit)
    out = model.transform(df)
    return out.select(*KEYS, "company", "transmission", R("company_te", 9).alias("company_te"),
                      "transmission_idx")


# ---------------------------------------------------------------------------
# Split, folds, metrics
# ---------------------------------------------------------------------------
@query("split_hash", f"WITH {SPLIT} SELECT {KEYS_SQL}, is_test FROM split")
def q_split_hash(spark, sf_dir):
    return hash_split(listings(spark, sf_dir), KEYS, 0.2).select(*KEYS, "is_test")


@query("split_hash_small", f"WITH {SPLIT} SELECT {KEYS_SQL}, is_small AS is_test FROM split")
def q_split_hash_small(spark, sf_dir):
    return hash_split(listings(spark, sf_dir), KEYS, 0.005).select(*KEYS, "is_test")


@query("split_exact", f"""WITH {LISTINGS},
ranked AS (SELECT {KEYS_SQL}, row_number() OVER (ORDER BY md5(concat_ws('-', {KEYS_SQL}))) AS r FROM listings)
SELECT {KEYS_SQL}, r <= (SELECT floor(count(*) * 0.2 + 0.5) FROM listings) AS is_test FROM ranked""")
def q_split_exact(spark, sf_dir):
    from pricelens.operators.split import exact_split
    from pricelens.session import materialize
    return exact_split(materialize(listings(spark, sf_dir).select(*KEYS), "split-keys"), KEYS, 0.2)


@query("split_random", f"""WITH {LISTINGS}
SELECT {KEYS_SQL}, CAST(1 AS BIGINT) AS n_sides, CAST(count(*) AS BIGINT) AS n_rows FROM listings GROUP BY {KEYS_SQL}""")
def q_split_random(spark, sf_dir):
    """The draw itself is random; its facts are not: every row is on one side, none is lost or doubled."""
    from pricelens.operators.split import random_split
    train, test = random_split(listings(spark, sf_dir).select(*KEYS), (0.8, 0.2), 40)
    both = train.withColumn("side", F.lit(0)).unionByName(test.withColumn("side", F.lit(1)))
    return both.groupBy(*KEYS).agg(F.count_distinct("side").alias("n_sides"), F.count(F.lit(1)).alias("n_rows"))


@query("cv_folds", f"""WITH {SPLIT}
SELECT fold, CAST(count(*) AS BIGINT) AS n FROM train GROUP BY fold""")
def q_cv_folds(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return train.withColumn("fold", fold_of(KEYS, 10)).groupBy("fold").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("regression_metrics", f"""WITH {SPLIT},
base AS (SELECT company, avg(log_price) AS pred FROM train GROUP BY company),
scored AS (SELECT t.log_price AS y, b.pred AS p FROM test t JOIN base b ON t.company = b.company
           WHERE t.log_price IS NOT NULL AND b.pred IS NOT NULL)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(abs(y - p)), 9) AS mae, round(avg((y - p) * (y - p)), 9) AS mse,
       round(sqrt(avg((y - p) * (y - p))), 9) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 9) AS r2
FROM scored""")
def q_regression_metrics(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    base = profile.group_stats(train, "company", "log_price").select("company", F.col("cat_mean").alias("pred"))
    scored = lookup_join(test, base, ["company"], "left")
    m = regression_metrics(scored, "log_price", "pred")
    return m.select("n", *[R(c, 9).alias(c) for c in ["mae", "mse", "rmse", "r2"]])


# ---------------------------------------------------------------------------
# Model: forest, cross-validation, scoring. Predictions are beyond SQL, so these queries return
# facts about them that are not: which rows, which errors, and whether each prediction is sound.
# ---------------------------------------------------------------------------
#: Forest of the registered queries. The library's defaults (200 trees of depth 12, in parts) take minutes a
#: fit, times eleven for cross-validation; see the README for figures. Folds are the full ten, with the refit.
Q_TREES, Q_DEPTH = 20, 5


def _fitted(spark, sf_dir):
    """(model, test rows); fitted anew in every query, on the tables as they are then."""
    from pricelens.operators.train import fit_forest
    train, test = _split(spark, sf_dir)
    return fit_forest(train.drop("log_price", "is_test"), ROLES, trees=Q_TREES, depth=Q_DEPTH), test


@query("rf_predict", f"WITH {SPLIT} SELECT {KEYS_SQL}, round(log_price, 9) AS log_price, true AS in_range FROM test")
def q_rf_predict(spark, sf_dir):
    """Every test row is predicted, within the range of the training labels (a forest averages them)."""
    model, test = _fitted(spark, sf_dir)
    train, _ = _split(spark, sf_dir)
    lo, hi = train.agg(F.min("log_price"), F.max("log_price")).first()
    out = model.transform(test.drop("is_test"))
    return out.select(*KEYS, R("log_price", 9).alias("log_price"),
                      F.col("prediction").between(lo, hi).alias("in_range"))


@query("model_roundtrip", f"""WITH {SPLIT},
width AS (SELECT {len(ROLES.target)} + {len(ROLES.ordinal)} + {len(ROLES.numeric)}
                 + {" + ".join(f"count(DISTINCT {c}) + 1" for c in ROLES.onehot)} AS w FROM train)
SELECT {KEYS_SQL}, CAST((SELECT w FROM width) AS BIGINT) AS n_features, true AS same FROM test""")
def q_model_roundtrip(spark, sf_dir):
    """The model saved, loaded and asked again: it predicts every test row as before, from as many features."""
    from pricelens.operators.train import load_model, num_features, save_model
    from pricelens.session import shared_path
    model, test = _fitted(spark, sf_dir)
    folder = shared_path(spark, "saved-model")
    save_model(model, folder)
    again = load_model(folder)
    before = model.transform(materialize(test.drop("is_test"), "model-test"))
    # Both models score the same row, side by side.
    inner = [c for c in before.columns if c not in test.columns and c != "prediction"]
    after = again.transform(before.drop(*inner).withColumnRenamed("prediction", "first"))
    return after.select(*KEYS, F.lit(num_features(again)).cast("bigint").alias("n_features"),
                        F.col("prediction").eqNullSafe(F.col("first")).alias("same"))


@query("rf_predictions", None)
def q_rf_predictions(spark, sf_dir):
    """The predictions themselves."""
    model, test = _fitted(spark, sf_dir)
    return model.transform(test.drop("is_test")).select(*KEYS, "log_price", "prediction")


@query("rf_signal", f"""WITH {SPLIT} SELECT CAST(count(*) AS BIGINT) AS n, true AS learned FROM test""")
def q_rf_signal(spark, sf_dir):
    """A price that hangs on two columns: held-out errors of a forest that learns are a fraction of its spread."""
    from pricelens.operators.evaluate import regression_metrics
    from pricelens.operators.train import fit_forest
    train, test = _split(spark, sf_dir)
    planted = F.pow(F.lit(10.0), 3 + F.col("engine_capacity") / 25 + F.when(F.col("assembly") == "O", 0.7).otherwise(0.0))
    model = fit_forest(train.drop("log_price", "is_test").withColumn("price", planted), ROLES, trees=Q_TREES, depth=Q_DEPTH,
                       subset="all")
    scored = model.transform(test.drop("is_test", "log_price")).withColumn("log_price", F.log10(planted))
    both = regression_metrics(scored, "log_price", "prediction")
    return both.select("n", (F.col("r2") > 0.9).alias("learned"))


@query("cv_rmse", None)
def q_cv_rmse(spark, sf_dir):
    """Each fold's RMSE, their mean and their standard deviation."""
    from pricelens.operators.train import cross_validate
    train, _ = _split(spark, sf_dir)
    return cross_validate(train.drop("log_price", "is_test"), ROLES, trees=Q_TREES, depth=Q_DEPTH)[1]


@query("cv_metrics", f"""WITH {SPLIT}
SELECT fold, CAST(count(*) AS BIGINT) AS n, true AS sound FROM train GROUP BY fold
UNION ALL SELECT -1, CAST(count(*) AS BIGINT), true FROM train""")
def q_cv_metrics(spark, sf_dir):
    """10 folds of the whole pipeline and the refit: each fold's rows, a positive error that is no larger than the range
    of the labels (a forest averages them), and a summary that is the folds' mean."""
    from pricelens.operators.train import cross_validate, cv_rows
    train, _ = _split(spark, sf_dir)
    rows = cv_rows(train.drop("log_price", "is_test"), ROLES)  # joined once, for the labels' range too
    lo, hi = rows.agg(F.min("log_price"), F.max("log_price")).first()
    model, metrics = cross_validate(rows, ROLES, trees=Q_TREES, depth=Q_DEPTH, ready=True)
    mean = metrics.agg(F.avg("rmse")).first()[0]
    sound = F.when(F.col("fold") >= 0, (F.col("rmse") > 0) & (F.col("rmse") <= hi - lo)).otherwise(
        (F.abs(F.col("avg_rmse") - mean) < 1e-9) & F.lit(model is not None))
    return metrics.select("fold", "n", sound.alias("sound"))


def _allowed_sql(ratio: int) -> str:
    having = f"HAVING count(*) * {ratio} >= (SELECT count(*) FROM train)" if ratio else ""
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM train WHERE {c} IS NOT NULL "
        f"GROUP BY {c} {having}" for c in CATS)


# Records as a form or a file delivers them: numbers as text, and one in forty spoiled in each of these ways.
_SPOILED = {
    "mileage": {1: "'abc'", 2: "'NaN'", 3: "'Infinity'", 4: "NULL", 14: "'12x'"},
    "model_year": {5: "'1949'", 6: "'2001.5'", 7: "NULL", 8: "'new'"},
    "engine_capacity": {9: "'1d'", 10: "''", 15: "NULL"},
    "color": {11: "NULL", 12: "'Plaid'"},
    "model": {13: "NULL"},
}
_SPOT = "((l_orderkey * 7 + l_linenumber * 3) % 40)"


def _spoil_sql(column: str) -> str:
    cases = " ".join(f"WHEN {_SPOT} = {k} THEN {v}" for k, v in _SPOILED[column].items())
    return f"CASE {cases} ELSE CAST({column} AS VARCHAR) END AS {column}"


_RECORD_COLS = ", ".join([*KEYS, *[_spoil_sql(c) if c in _SPOILED else c
                                   for c in [*CATS, "model_year", "mileage", "engine_capacity"]], "price"])


def _records(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[c.replace("AS VARCHAR", "AS STRING") for c in [
        *KEYS, *[_spoil_sql(c) if c in _SPOILED else c for c in [*CATS, "model_year", "mileage", "engine_capacity"]],
        "price"]])


_NUMBER_SQL = "regexp_matches(trim(r.{c}), '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$')"


def _rule_sql() -> str:
    parts = []
    for c in CATS:
        parts.append(f"CASE WHEN r.{c} IS NULL THEN '{c}:missing' WHEN a_{c}.category IS NULL "
                     f"THEN '{c}:not_allowed' END")
    year = "TRY_CAST(trim(r.model_year) AS DOUBLE)"
    parts.append("CASE WHEN r.model_year IS NULL THEN 'model_year:missing' "
                 f"WHEN NOT {_NUMBER_SQL.format(c='model_year')} OR {year} <> floor({year}) "
                 f"THEN 'model_year:not_integer' WHEN {year} < 1950 THEN 'model_year:below_1950' END")
    for c in ["mileage", "engine_capacity"]:
        parts.append(f"CASE WHEN r.{c} IS NULL THEN '{c}:missing' WHEN NOT {_NUMBER_SQL.format(c=c)} "
                     f"THEN '{c}:not_numeric' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


def _checked_sql(ratio: int, source: str = "test") -> str:
    return f"""WITH {SPLIT},
records AS (SELECT {_RECORD_COLS} FROM {source}),
allowed AS ({_allowed_sql(ratio)}),
checked AS (
  SELECT {", ".join("r." + k for k in KEYS)}, {_rule_sql()} AS errors
  FROM records r
  {" ".join(f"LEFT JOIN allowed a_{c} ON a_{c}.feature = '{c}' AND a_{c}.category = r.{c}" for c in CATS)})"""


def _validated(spark, sf_dir):
    """The test rows checked against the categories of the training rows; the split listings are written once for both."""
    split = materialize(hash_split(listings(spark, sf_dir), KEYS, 0.2), "split")
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    allowed = allowed_from_data(train, CATS, min_ratio=SUPPORT_RATIO)
    return validate(_records(test), ROLES, allowed)


@query("validate_records", _checked_sql(SUPPORT_RATIO) + f"""
SELECT {KEYS_SQL}, errors, errors = '' AS is_valid FROM checked""")
def q_validate(spark, sf_dir):
    return _validated(spark, sf_dir).select(*KEYS, "errors", "is_valid")


@query("reject_summary", _checked_sql(SUPPORT_RATIO) + """,
parts AS (SELECT unnest(string_split(errors, ',')) AS rule FROM checked WHERE errors <> '')
SELECT rule, CAST(count(*) AS BIGINT) AS n_rejected FROM parts GROUP BY rule""")
def q_reject_summary(spark, sf_dir):
    return reject_summary(_validated(spark, sf_dir))


@query("split_valid", _checked_sql(SUPPORT_RATIO) + """
SELECT CASE WHEN errors = '' THEN 'valid' ELSE 'rejected' END AS side, CAST(count(*) AS BIGINT) AS n
FROM checked GROUP BY 1""")
def q_split_valid(spark, sf_dir):
    from pricelens.operators.validate import split_valid
    valid, rejected = split_valid(materialize(_validated(spark, sf_dir).select(*KEYS, "errors", "is_valid"), "validated"))
    both = valid.select(F.lit("valid").alias("side")).unionByName(rejected.select(F.lit("rejected").alias("side")))
    return both.groupBy("side").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def _scored_sql(source: str) -> str:
    return _checked_sql(0, source) + f"""
SELECT {KEYS_SQL}, CASE WHEN errors <> '' THEN errors END AS error, errors <> '' AS no_price, true AS price_sound
FROM checked"""


def _score_facts(scored: DataFrame) -> DataFrame:
    """A price exactly for the valid records, and equal to the converted power of ten."""
    again = F.round(F.pow(F.lit(10.0), "log_pred").cast("decimal(38,6)") * F.lit(0.0036).cast("decimal(20,10)"), 3)
    sound = F.when(F.col("error").isNull(), (F.col("price_out") == again.cast("double")) & (F.col("price_out") > 0))
    return scored.select(*KEYS, "error", F.col("price_out").isNull().alias("no_price"),
                         F.coalesce(sound, F.col("price_out").isNull()).alias("price_sound"))


@query("score_batch", _scored_sql("test"))
def q_score_batch(spark, sf_dir):
    from pricelens.operators.score import score
    model, test = _fitted(spark, sf_dir)
    train, _ = _split(spark, sf_dir)
    return _score_facts(score(_records(test), model, ROLES, allowed=allowed_from_data(train, CATS), keep=KEYS))


@query("score_prices", None)
def q_score_prices(spark, sf_dir):
    """The prices themselves: log price, price, price shown, and why there is none."""
    from pricelens.operators.score import score
    model, test = _fitted(spark, sf_dir)
    train, _ = _split(spark, sf_dir)
    return score(_records(test), model, ROLES, allowed=allowed_from_data(train, CATS), keep=KEYS)


@query("score_stream", _scored_sql("lab"))
def q_score_stream(spark, sf_dir):
    from pricelens.operators.train import fit_forest, labelled
    from pricelens.session import shared_path
    from pricelens.streaming.scoring import listing_stream, score_stream
    ensure_checkpoint_dir(spark)
    train, _ = _split(spark, sf_dir)
    # Written once with the rows that have no label: they teach the forest nothing, but their categories are allowed.
    # The keys have dealt the rows and teach nothing. Rows are only dealt anew if the join has left fewer files than cores.
    train = materialize(train.drop("log_price", "is_test", *KEYS), "train-input")
    if len(train.inputFiles()) < spark.sparkContext.defaultParallelism:
        train = materialize(spread(train), "train-input")
    model = fit_forest(labelled(train, ROLES), ROLES, trees=Q_TREES, depth=Q_DEPTH, ready=True)
    out = shared_path(spark, "scored-stream")
    q = score_stream(_records(listing_stream(spark, sf_dir)), model, ROLES, out, allowed=allowed_from_data(train, CATS))
    q.awaitTermination()
    return _score_facts(spark.read.parquet(out).drop("epoch"))


@query("stream_sinks", _checked_sql(0, "lab") + f"""
SELECT {KEYS_SQL}, CASE WHEN errors = '' THEN 'valid' ELSE 'rejected' END AS side, errors, true AS counted FROM checked""")
def q_stream_sinks(spark, sf_dir):
    """Every first line item arrives twice; both sinks hold every record once, and the commits count them all."""
    from pricelens.session import shared_path
    from pricelens.streaming.scoring import listing_stream, read_routed, route_stream
    train, _ = _split(spark, sf_dir)
    copies = F.explode(F.when(F.col("l_linenumber") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    arriving = listing_stream(spark, sf_dir).withColumn("__copy", copies).drop("__copy")
    out = shared_path(spark, "routed-stream")
    route_stream(_records(arriving), ROLES, out, allowed_from_data(train, CATS), KEYS).awaitTermination()
    valid, rejected, commits = read_routed(spark, out)
    sides = valid.select(*KEYS, F.lit("valid").alias("side"), F.lit("").alias("errors")).unionByName(
        rejected.select(*KEYS, F.lit("rejected").alias("side"), "errors"))
    said = commits.agg(F.sum("n_valid").alias("valid"), F.sum("n_rejected").alias("rejected")).unpivot([], ["valid", "rejected"], "side", "said")
    held = sides.groupBy("side").agg(F.count(F.lit(1)).alias("held"))
    counted = lookup_join(said, held, ["side"], "left", small=True).select("side", (F.col("said") == F.col("held")).alias("counted"))
    return lookup_join(sides, counted, ["side"], "left", small=True)
