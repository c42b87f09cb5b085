"""Helpers that several operators share."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import ensure_checkpoint_dir, materialize

#: The white space that separates words and is stripped from lines: 0x20 and 0x09-0x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows of whole texts that go to a Python worker at once.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """The shared folder, this package on the Python workers' path (where the same path exists), and
    batches of whole texts small enough for a worker."""
    ensure_checkpoint_dir(spark)
    root, env = str(Path(__file__).parents[2]), spark.sparkContext.environment
    if root not in (paths := [p for p in env.get("PYTHONPATH", "").split(":") if p]):
        env["PYTHONPATH"] = ":".join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other letter as it is. ``lower`` does the same on pure ASCII, faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def strip_spaces(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def n_words(text: Column) -> Column:
    """Number of runs of non-space characters; null and blank texts have none."""
    bare = strip_spaces(F.coalesce(text, F.lit("")))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE_CLASS + "+"))).cast("long")


def row_hash(df: DataFrame, at: str = "") -> Column:
    """A 64-bit hash of a row over all its columns (``at``: the struct column that holds them), maps as their JSON."""
    columns = [(F.col(f"{at}`{name}`"), kind) for name, kind in df.dtypes]
    return F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else c for c, kind in columns])


def in_ranges(rows: DataFrame, ranges: int, id_col: str = "_id", tie_col: str = "_tie") -> DataFrame:
    """``rows`` with ``_range``: about equal ranges in the order of (id, tie), null ids in ranges of their own below
    all others. ``tie_col`` holds 64-bit hashes: an id (or null) with the rows of several ranges is cut by them, so
    no id makes a range too large. The cuts are approximate quantiles of the ids, one number a range."""
    found = rows.agg(F.percentile_approx(id_col, [i / ranges for i in range(1, ranges)], 20 * ranges) if ranges > 1 else F.lit(None),
                     F.count(F.lit(1)), F.count(id_col)).first()
    nulls = max(1, round(ranges * (found[1] - found[2]) / max(1, found[1])))
    times = Counter(found[0] or [])
    # A bucket is [edge, next edge); hot ids (below 2^53, where doubles are exact) are buckets of their own.
    edges, parts = [float("-inf")], [1]
    for cut in sorted(times):
        hot = times[cut] > 1 and abs(cut) < 1 << 53
        if edges[-1] != cut:
            edges.append(float(cut))
            parts.append(1)
        if hot:
            parts[-1] = times[cut]
            edges.append(float(cut + 1))
            parts.append(1)
    first = [nulls + sum(parts[:k]) for k in range(len(parts))]
    at = rows.withColumn("_at", F.coalesce(F.col(id_col).cast("double"), F.lit(0.0)))
    if len(edges) > 1:
        at = Bucketizer(splits=[*edges, float("inf")], inputCol="_at", outputCol="_bucket").transform(at)
    else:
        at = at.withColumn("_bucket", F.lit(0))
    bucket = F.col("_bucket").cast("int") + 1
    null = F.col(id_col).isNull()
    n = F.when(null, F.lit(nulls)).otherwise(F.element_at(F.lit(parts), bucket))
    start = F.when(null, F.lit(0)).otherwise(F.element_at(F.lit(first), bucket))
    share = F.shiftrightunsigned(F.col(tie_col).bitwiseXOR(F.lit(-1 << 63)), 33) / F.lit(float(1 << 31))  # 0 to 1
    return at.withColumn("_range", (start + F.floor(share * n)).cast("int")).drop("_at", "_bucket")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs and retries start from files."""
    return materialize(df, name)


def text_slices(batch: pa.RecordBatch, text: int, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts (column number ``text``) hold about ``max_bytes`` at most, or one text."""
    column, start, held = batch.column(text), 0, 0
    for at, size in enumerate(pa.compute.binary_length(column).to_pylist()):
        if held and held + (size or 0) > max_bytes:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)
