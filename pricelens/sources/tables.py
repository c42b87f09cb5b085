"""Scans of the driver's parquet tables and the stand-in listing table.

The listing table is a star join of the fact table ``lineitem`` with ``orders``,
``part`` and ``customer``. Only the columns used are read (the scan's ReadSchema is
pruned) and the joins are plain equi-joins: Spark picks broadcast for a dimension only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE checks
the runtime size again), otherwise a sort-merge join whose skewed partitions AQE
splits. Dimensions are joined to ``orders`` before the fact table where possible, so
the fact table is shuffled once per remaining key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.config import LISTING_KEYS
from pricelens.functions.joins import input_bytes

#: orders ⋈ customer (one row per order) is broadcast up to this many bytes of ``orders`` files.
BROADCAST_BYTES = 16 << 20

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, shaped like a used-car listing (see README)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        *LISTING_KEYS, "l_returnflag", "l_linestatus", "l_discount", "l_extendedprice")
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    pt = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_name", "p_type", "p_size")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    # orders ⋈ customer first: at scale the fact table is then shuffled twice (order
    # key, part key) instead of three times; the planner does not reorder joins
    # without cost-based statistics.
    od_cu = od.join(cu, od.o_custkey == cu.c_custkey)
    # Keep the fact table on the streamed side: broadcast orders ⋈ customer when the files of
    # ``orders`` are small (their lengths are known without running anything); beyond that Spark
    # shuffles both sides and AQE splits skewed partitions.
    if input_bytes(od) <= BROADCAST_BYTES:
        od_cu = F.broadcast(od_cu)
    joined = (li.join(od_cu, li.l_orderkey == od_cu.o_orderkey)
                .join(pt, li.l_partkey == pt.p_partkey))
    return joined.select(
        *LISTING_KEYS,
        F.col("p_brand").alias("company"),
        F.col("p_name").alias("model"),
        F.col("c_mktsegment").alias("color"),
        F.col("l_returnflag").alias("engine_type"),
        F.col("p_type").alias("body_type"),
        F.col("l_linestatus").alias("assembly"),
        F.col("o_orderstatus").alias("transmission"),
        F.when(F.col("l_discount") > 0.05, F.lit("Registered"))
         .otherwise(F.lit("Un-Registered")).alias("registration"),
        F.year("o_orderdate").cast("int").alias("model_year"),
        F.col("o_totalprice").alias("mileage"),
        F.col("p_size").alias("engine_capacity"),
        F.col("l_extendedprice").alias("price"),
    )


def row_id(copy: int = 0):
    """Text row index built from the four-part row key plus a copy number."""
    return F.concat_ws("-", *[F.col(k).cast("string") for k in LISTING_KEYS], F.lit(str(copy)))


def dirty_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlay with nulls and exact duplicates, made deterministically from the data.

    * ``color`` is null where the market segment is BUILDING;
    * every row with ``l_linenumber = 1`` appears twice, the copy carrying a
      different ``row_id`` (same row, new index, like a re-exported CSV).

    The copies come from an ``explode`` in the same pass, not a second scan and join.
    """
    base = listings(spark, sf_dir).withColumn(
        "color", F.when(F.col("color") != "BUILDING", F.col("color")))
    copies = F.when(F.col("l_linenumber") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = base.withColumn("__copy", F.explode(copies))
    keys = [F.col(k).cast("string") for k in LISTING_KEYS]
    return out.withColumn("row_id", F.concat_ws("-", *keys, F.col("__copy").cast("string"))).drop("__copy")
