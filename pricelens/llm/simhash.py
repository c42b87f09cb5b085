"""SimHash near-duplicates with BK-trees.

Fingerprint: words of the A-Z lower-cased text, shingles of ``words`` words, their XXH64 (seed 42); a bit
is set where more than half of the shingles' hashes have it. Fingerprints link at ``bits`` or fewer
differing bits, and documents that links connect form a component named by its smallest id.

Search: equal fingerprints are one node. The 64 bits are cut into ``blocks`` blocks; two fingerprints within
``bits`` bits agree in at least ``blocks - bits`` whole blocks, so each fingerprint goes to one shard for
every choice of that many blocks, and linked fingerprints share a shard. The number of blocks follows from the
number of distinct fingerprints (``choose_blocks``): the fewest, hence the fewest shards a fingerprint goes to,
with which an evenly filled shard has at most ``TREE_ROWS``, so the work a fingerprint causes has a bound at every
size of the corpus. In its task a shard's fingerprints are searched in its BK-tree (children keyed by
their Hamming distance to the parent), following only edges within the radius, and then added to it. The trees
are not broadcast: they grow with the corpus, so each is built where its shard lies. A shard of more than
``shard_rows`` fingerprints is cut into chunks by hash and each pair of chunks is a task's work, so no task holds
more than two chunks. A shard hands on a spanning forest of its links, not all pairs.

Components: alternating large-star and small-star steps on the links, each step written to the shared
folder, until nothing changes. Hot fingerprints meet their documents in a join AQE can split.

Defined results: null or wordless text has fingerprint 0, linked like any other; fewer words than a shingle
are one shingle; rows that share an id are separate rows of one component only if their fingerprints link;
a component's name ignores null ids, and is null if it has no other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelens.llm.common import row_hash, shuffle_partitions, written

WORDS = 4
BITS = 4
SEED = 42
SHARD_ROWS = 2048
#: Fingerprints that an evenly filled shard holds at most.
TREE_ROWS = 64


def simhash(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint, unsigned."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]).tolist()
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(joined, seed)
    last = len(parts) - words + 1
    hashes = np.fromiter((digest(joined[a:b - 1], seed) for a, b in zip(starts[:last], ends[words - 1:])),
                         dtype=np.uint64, count=last)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, last, 1 << 16):
        some = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(ones * 2 > last).tolist()))


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(_id, _hash, _print)``: the text's XXH64, and its fingerprint as a signed 64-bit integer."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([simhash(t.as_py(), words) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(prints.view(np.int64))],
                                             names=["_id", "_hash", "_print"])

    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _hash long, _print long")


class BKTree:
    """Integers by Hamming distance: a node's children are keyed by their distance to it."""

    def __init__(self) -> None:
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = 0
        if self.value:
            while True:
                step = (self.value[at] ^ value).bit_count()
                if step == 0:
                    return
                child = self.children[at].get(step)
                if child is None:
                    self.children[at][step] = len(self.value)
                    break
                at = child
        self.value.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Nodes within ``radius`` of ``value``: only edges of distance - radius to distance + radius lead there."""
        found, stack = [], [0] if self.value else []
        while stack:
            at = stack.pop()
            away = (self.value[at] ^ value).bit_count()
            if away <= radius:
                found.append(at)
            for step, child in self.children[at].items():
                if away - radius <= step <= away + radius:
                    stack.append(child)
        return found


def forest(tree_values: list[int], queries: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect what the tree's values and the queries within ``radius`` connect, no cycle among them.
    Without queries, the values among themselves: each is searched before it is added."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = root[x]
        return x

    tree = BKTree()
    for v in tree_values if queries is not None else ():
        tree.add(v)
    out = []
    for q in tree_values if queries is None else queries:
        found = tree.within(q, radius)
        if queries is None:
            tree.add(q)
        for at in found:
            v = tree.value[at]
            a, b = find(v), find(q)
            if a != b:
                root[a] = b
                out.append((v, q))
    return out


def block_masks(blocks: int, bits: int) -> list[int]:
    """A mask for each choice of ``blocks - bits`` blocks of the 64 bits, as signed integers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    one = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    masks = [sum(one[i] for i in chosen) for chosen in combinations(range(blocks), blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def choose_blocks(n: int, bits: int = BITS, tree_rows: int = TREE_ROWS) -> int:
    """The least number of blocks with which ``n`` fingerprints spread evenly over the values of the agreeing
    blocks make shards of ``tree_rows`` at most. Four agreeing blocks (32 bits of 64 at 4 differing ones) are the
    most: 70 shards a fingerprint; beyond 2.7e11 fingerprints shards grow, and are cut by ``shard_rows``."""
    for blocks in range(bits + 1, bits + 4):
        if n <= tree_rows << ((blocks - bits) * (64 // blocks)):
            return blocks
    return bits + 4


def shards_of(prints: DataFrame, bits: int, blocks: int) -> DataFrame:
    """``(_print, _kind, _key)``: the shards of every fingerprint, one for each choice of agreeing blocks."""
    masks = F.array(*[F.lit(m).cast("long") for m in block_masks(blocks, bits)])
    return prints.select("_print", F.posexplode(masks).alias("_kind", "_mask")).select(
        "_print", "_kind", F.col("_print").bitwiseAND(F.col("_mask")).alias("_key"))


def links(prints: DataFrame, bits: int = BITS, blocks: int | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``(_a, _b)`` between distinct fingerprints (column ``_print``) that connect all that are within
    ``bits`` bits of each other. ``blocks``: see ``choose_blocks``, which counts the fingerprints (a written table)."""
    blocks = blocks or choose_blocks(prints.count(), bits)
    shards = shards_of(prints, bits, blocks)
    sizes = shards.groupBy("_kind", "_key").agg(F.count("*").alias("_n")).where("_n > 1")
    sizes = written(sizes.withColumn("_chunks", F.ceil(F.col("_n") / shard_rows).cast("int")), "simhash-shards")
    mine = F.when(F.col("_chunks") > 1, F.pmod(F.xxhash64("_print"), F.col("_chunks"))).otherwise(0).cast("int")
    rows = shards.join(sizes.select("_kind", "_key", "_chunks"), ["_kind", "_key"]).withColumn("_chunk", mine)
    # Chunk c works with every chunk: the pair's name is (lower, higher), and a row lies in all pairs of its chunk.
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    rows = rows.withColumn("_low", F.least("_chunk", "_other")).withColumn("_high", F.greatest("_chunk", "_other"))
    group = ["_kind", "_key", "_low", "_high"]
    rows = rows.select(*group, "_chunk", "_print").repartition(shuffle_partitions(prints.sparkSession), *group)
    rows = rows.sortWithinPartitions(*group, "_chunk", "_print")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = frame[group].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(frame) else np.empty(0, int)
            if len(starts):
                yield search(frame, starts)
                rest = frame.iloc[starts[-1]:]
        if rest is not None:
            yield search(rest, np.array([0, len(rest)]))

    def search(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        """Links of the shards between the starts."""
        prints, chunk, low = (frame[c].to_numpy() for c in ("_print", "_chunk", "_low"))
        high = frame["_high"].to_numpy()
        values = prints.view(np.uint64).tolist()
        found: list[tuple[int, int]] = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b - a == 2 and low[a] == high[a]:  # most shards: one distance
                if (values[a] ^ values[a + 1]).bit_count() <= bits:
                    found.append((values[a], values[a + 1]))
            elif low[a] == high[a]:
                found += forest(values[a:b], None, bits)
            else:
                cut = a + int(np.searchsorted(chunk[a:b], high[a]))
                found += forest(values[a:cut], values[cut:b], bits)
        pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"_a": pairs[:, 0], "_b": pairs[:, 1]})

    return rows.mapInPandas(run, "_a long, _b long")


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``(_node, _root)`` for every node of ``edges`` (``_a, _b``), the root the smallest node connected."""

    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))

    def least(e: DataFrame) -> DataFrame:
        # Written, so that the join with the links shuffles both sides afresh and AQE can split the
        # partition of a node that very many links share.
        return written(e.groupBy("_a").agg(F.least(F.col("_a"), F.min("_b")).alias("_m")), "simhash-least")

    def large_star(e: DataFrame) -> DataFrame:
        e = both(e)
        joined = e.join(least(e), "_a").where(F.col("_b") > F.col("_a"))
        return joined.select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b"))
        low = least(down)
        kept = down.join(low, "_a").select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
        return kept.unionByName(low.select("_a", F.col("_m").alias("_b")))

    def clean(e: DataFrame) -> DataFrame:
        return written(e.where(F.col("_a") != F.col("_b")).distinct(), "simhash-links")

    def state(e: DataFrame) -> tuple:
        # Decimals: sums of hashes would overflow.
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))).first())

    edges = clean(edges.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")))
    seen = state(edges)
    for _ in range(most_rounds if seen[0] else 0):
        edges = clean(small_star(large_star(edges)))
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    # Every node but a root has one edge, to its root.
    roots = edges.select(F.col("_b").alias("_node"), F.col("_b").alias("_root")).distinct()
    return edges.select(F.col("_a").alias("_node"), F.col("_b").alias("_root")).unionByName(roots)


def grouped(docs: DataFrame, words: int, bits: int, blocks: int | None, id_col: str, text_col: str) -> DataFrame:
    """``_id, _hash, _print, _root`` of every row, ``_root`` the least fingerprint connected with its own."""
    prints = written(fingerprints(docs, words, id_col, text_col), "simhash-prints")
    nodes = written(prints.select("_print").distinct(), "simhash-nodes")
    roots = written(components(links(nodes, bits, blocks)), "simhash-roots")
    rooted = prints.join(roots, prints["_print"] == roots["_node"], "left")
    return rooted.select("_id", "_hash", "_print", F.coalesce("_root", "_print").alias("_root"))


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS, blocks: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id``."""
    rows = written(grouped(docs, words, bits, blocks, id_col, text_col), "simhash-rows")
    names = written(rows.groupBy("_root").agg(F.min("_id").alias("component_id")), "simhash-names")
    return rows.join(names, "_root").select(
        F.col("_id").alias("doc_id"), F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, words: int = WORDS, bits: int = BITS, blocks: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near-duplicates: of each component the row of the least id stays (of rows that
    repeat that id one, whichever has the least hash of its text, then of all columns). A null id comes after
    all others."""
    rows = grouped(docs, words, bits, blocks, id_col, text_col)
    best = written(rows.groupBy("_root").agg(F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_hash")).alias("_best"))
                   .select("_best._id", "_best._hash"), "simhash-kept")
    best = best.withColumnsRenamed({"_id": "_keep", "_hash": "_keep_hash"}).distinct()
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    mine = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), text_hash.alias("_hash"))
    kept = mine.join(best, F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_hash") == F.col("_keep_hash")), "left_semi")
    alike = W.partitionBy("_id", "_hash").orderBy(row_hash(docs, "_row."))
    kept = kept.withColumn("_n", F.row_number().over(alike)).where("_n = 1")
    return kept.select("_row.*")
