"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` positions. Each shard has ``nodes`` virtual nodes on it. A row's hash names its
cell; the row goes to the next virtual node clockwise, unless that shard is full: then on to the next one.
A shard is full at its bound: (1 + slack) times its equal part, and with slack 0 exactly the equal part,
the remainder going one row each to the first shards, so counts differ by one at most (law ``rows``).

Which rows of a cell stay and which go on is settled by their rank within the cell, so the walk works on
the counts of the cells alone: a table of ``CELLS`` rows whatever the input. The walk over these counts is
a small loop; its result, a list of (cell, ranks from-to, shard, first slot), is joined back by cell.
Rows never travel for it: one shuffle of (id, hash, size, checksum) by cell gives the ranks, and the slot
within the shard follows from the rank without another.

Defined results: null text has size 1 and the checksum of the empty string; null and repeated ids are
hashed with the text's checksum; equal rows get different slots; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelens.llm.common import written

SHARDS = 16
NODES = 64
CELLS = 1 << 14


def ring(spark: SparkSession, shards: int, nodes: int = NODES, cells: int = CELLS) -> list[int | None]:
    """The shard of the virtual node at each cell, or None. Nodes sit at hashed cells; the lower shard
    keeps a cell that two want, so adding a shard moves no node of the others."""
    at = (spark.range(shards * nodes).select(
        F.floor(F.col("id") / nodes).cast("int").alias("shard"),
        F.pmod(F.xxhash64(F.lit("node"), F.col("id")), F.lit(cells)).alias("cell"))
        .groupBy("cell").agg(F.min("shard").alias("shard")).collect())  # at most shards x nodes rows
    owner: list[int | None] = [None] * cells
    for row in at:
        owner[row["cell"]] = row["shard"]
    return owner


def walk(counts: Mapping[int, int], owner: list[int | None], bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, last rank, shard, first slot): where the rows of each cell go.

    Clockwise turns: rows that arrive at a virtual node enter its shard as far as its bound allows, and the
    others go on with the rows of the next cells. The bounds sum to the rows at least, so all find a place.
    """
    cells, free, used = len(owner), list(bounds), [0] * len(bounds)
    waiting: list[list[int]] = []  # [cell, first rank, last rank], in order of arrival
    out = []
    for turn in range(cells * 2 * max(1, len(bounds))):
        cell = turn % cells
        if turn < cells and counts.get(cell):
            waiting.append([cell, 0, counts[cell] - 1])
        shard = owner[cell]
        while shard is not None and waiting and free[shard]:
            group = waiting[0]
            n = min(free[shard], group[2] - group[1] + 1)
            out.append((group[0], group[1], group[1] + n - 1, shard, used[shard]))
            free[shard] -= n
            used[shard] += n
            group[1] += n
            if group[1] > group[2]:
                waiting.pop(0)
        if turn >= cells - 1 and not waiting:
            return out
    for group in waiting:  # shards without a node on the ring
        for shard, room in enumerate(free):
            n = min(room, group[2] - group[1] + 1)
            if n:
                out.append((group[0], group[1], group[1] + n - 1, shard, used[shard]))
                free[shard] -= n
                used[shard] += n
                group[1] += n
    return out


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows per shard."""
    if slack > 0:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shard_documents(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, slack: float = 0.0,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, size, text_crc32, shard, slot``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("_hash", F.xxhash64("doc_id", "text_crc32", "size"))
    rows = written(rows.withColumn("_cell", F.pmod("_hash", F.lit(CELLS)).cast("int")), "shard-keys")
    counts = {r["_cell"]: r["n"] for r in rows.groupBy("_cell").agg(F.count("*").alias("n")).collect()}  # <= CELLS rows
    plan = walk(counts, ring(spark, shards, nodes), bounds(sum(counts.values()), shards, slack))
    plan_df = spark.createDataFrame(plan, "_cell int, _first long, _last long, shard int, _slot long")
    # Within a cell the rows stand in order of another hash, so that no shard gets the low ids.
    rank = W.partitionBy("_cell").orderBy(F.xxhash64(F.lit("rank"), "_hash"), "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_rank", (F.row_number().over(rank) - 1).cast("long"))
    on = (F.col("p._cell") == F.col("r._cell")) & F.col("_rank").between(F.col("_first"), F.col("_last"))
    placed = ranked.alias("r").join(F.broadcast(plan_df).alias("p"), on)
    return placed.select("doc_id", "size", "text_crc32", "shard",
                         (F.col("_slot") + F.col("_rank") - F.col("_first")).cast("long").alias("slot"))


def shard_report(docs: DataFrame, **how) -> DataFrame:
    """``shard_documents`` under law ``rows``, with the columns of the registered query."""
    return shard_documents(docs, **how).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
