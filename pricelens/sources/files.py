"""File sources and sinks: raw listing CSV, text lines, tables, encoding maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.config import CAR_DROPPED, CAR_ROLES, ColumnRoles
from pricelens.functions.columns import strict_number
from pricelens.session import materialize


def read_listings_csv(spark: SparkSession, path: str, roles: ColumnRoles = CAR_ROLES,
                      schema: T.StructType | None = None,
                      ignore: list[str] | tuple[str, ...] = tuple(CAR_DROPPED),
                      infer: bool = False, parse: bool = True) -> DataFrame:
    """Read a listing CSV with a header row and drop the index / unused columns.

    With ``schema`` the file is read without inference. Otherwise every column is read
    as text (no inference job over the data) and the numeric roles become finite doubles
    (``strict_number``), so a malformed number, ``NaN`` or an infinity becomes null
    instead of failing the job under ANSI mode. ``parse=False`` keeps the text, for a
    validator that reports what was wrong. ``infer=True`` reproduces ``inferSchema`` exactly.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        df = reader.schema(schema).csv(path)
    elif infer:
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.csv(path)
        if parse:
            df = parse_numbers(df, roles)
    present = [c for c in ignore if c in df.columns]
    return df.drop(*present)


REJECTED = "_malformed"


def read_checked_csv(spark: SparkSession, path: str, roles: ColumnRoles = CAR_ROLES,
                     ignore: list[str] | tuple[str, ...] = tuple(CAR_DROPPED),
                     parse: bool = True, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A listing CSV as (good rows, rejected lines): every line of the files but the header is in one of them.
    ``names``: the columns of files without a header line.

    Lines with too few or too many fields, or a quote that never ends, do not become rows with nulls or lost
    fields: they go to the second table whole, as ``line`` and ``n_fields`` (of its plain commas). Read as text
    columns without inference, written once, so that both tables come from one parse.
    """
    reader = spark.read.option("header", names is None).option("mode", "PERMISSIVE")
    names = names or reader.csv(path).columns  # reads the header line
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, REJECTED]])
    read = materialize(reader.schema(schema).option("columnNameOfCorruptRecord", REJECTED).csv(path), "csv-lines")
    good = read.where(F.col(REJECTED).isNull()).drop(REJECTED)
    if parse:
        good = parse_numbers(good, roles)
    bad = read.where(F.col(REJECTED).isNotNull()).select(
        F.col(REJECTED).alias("line"), F.size(F.split(REJECTED, ",", -1)).alias("n_fields"))
    return good.drop(*[c for c in ignore if c in good.columns]), bad


def parse_numbers(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """The numeric roles and the label as finite doubles; text that is no number becomes null."""
    numeric = set(roles.numeric) | {roles.label}
    return df.select(*[strict_number(c).alias(c) if c in numeric else F.col(f"`{c}`") for c in df.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Distributed sink (parquet/csv/json/orc); every task writes its own file."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    """One value per line, like writing a list to a text file, but per partition."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


NULL_CATEGORY = "__null__"


def nested_encoding_map(encoding_map: DataFrame, entries: int = 10_000) -> DataFrame:
    """``(kind, feature, part, mapping)``: the map as ``{category: value}`` objects.

    A feature has one object per about ``entries`` categories (dealt by hash), so none
    is built from an unbounded group and no width is refused; a reader merges the parts.
    The null category has the key ``__null__``; a category of that very text, after any backslashes, gets one
    backslash more in front, so that no two share a key. The prior is an object of its own, kind
    ``global_mean``, with the label's name as key.
    """
    category = F.col("category")
    literal = F.ltrim(category, F.lit("\\")) == F.lit(NULL_CATEGORY)
    key = F.when(F.col("kind") == "global_mean", F.col("feature")).when(category.isNull(), F.lit(NULL_CATEGORY)).when(
        literal, F.concat(F.lit("\\"), category)).otherwise(category)
    keyed = encoding_map.select("kind", "feature", key.alias("__key"), "value")
    parts = keyed.groupBy("kind", "feature").agg(  # one row per feature
        F.ceil(F.count(F.lit(1)) / F.lit(entries)).cast("int").alias("__parts"))
    keyed = keyed.join(F.broadcast(parts), ["kind", "feature"])
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64("__key"), F.col("__parts")).cast("int"))
    return keyed.groupBy("kind", "feature", "part").agg(
        F.map_from_entries(F.collect_list(F.struct("__key", "value"))).alias("mapping"))


def write_encoding_map(encoding_map: DataFrame, path: str, nested: bool = False,
                       entries: int = 10_000) -> None:
    """Write the long ``(kind, feature, category, value)`` map as JSON lines, or with
    ``nested=True`` its ``nested_encoding_map``, the layout of the training job's mapping file."""
    out = nested_encoding_map(encoding_map, entries) if nested else encoding_map
    out.write.mode("overwrite").json(path)


def read_nested_encoding_map(spark: SparkSession, path: str) -> DataFrame:
    """The nested file as ``(kind, feature, key, value)`` rows."""
    schema = "kind string, feature string, part int, mapping map<string,double>"
    return spark.read.schema(schema).json(path).select("kind", "feature", F.explode("mapping").alias("key", "value"))


def read_encoding_map(spark: SparkSession, path: str) -> DataFrame:
    schema = "kind string, feature string, category string, value double"
    return spark.read.schema(schema).json(path)
