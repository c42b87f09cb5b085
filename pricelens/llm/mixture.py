"""Mixing sources to target weights.

Each source's words, in a fixed pseudorandom order of its documents, form one stream that is packed into
blocks of ``block`` words (the last block of a source may be shorter). A source's target in words becomes
slots: epoch after epoch, slot ``i`` of an epoch reads block ``perm(i)``, a pseudorandom permutation of the
source's full blocks (a Feistel network on a rectangle that just covers them, walked until it lands
inside); the short block closes each epoch, and the last slot takes only as many words of its block as the
target still lacks. So a block is never used more often than the target needs, and a source gives exactly
its rounded target.

The multinomial draw: every slot of every source draws its output shard. Given a shard's size, its counts
by source are then a multinomial draw with the target weights, while the totals over all shards stay
exact (independent draws per shard would leave a source of few blocks well off its target).

Slots and blocks meet in a join on (source, block index). Scale: a source's stream positions come from
two-level sums (chunks of hashed ids, then chunk totals), never from one window over a source; slots are
made in runs of ``RUN`` so that one source's slots spread over tasks. The tables of sources and of chunk
totals have one row per source, and ``CHUNKS`` rows per source.

Defined results: null text has size 0 and gives nothing; the null source is a source of its own, last in
order; equal rows are separate stream parts; an empty table gives no rows; all sizes 0 gives targets 0.
Extra columns are kept by ``mixed_documents`` and ignored by ``mix_report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelens.llm.common import SPACE_CLASS, n_words, row_hash, shuffle_partitions, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 256
SHARDS = 64
CHUNKS = 1024
RUN = 1 << 16
SEED = 20
ROUNDS = 4
WALKS = 64


def feistel(i: Column, n: Column, *key: Column) -> Column:
    """Permutation of 0..n-1, applied to ``i``: alternating modular Feistel rounds on a grid a x b >= n,
    walked until the image is below n. The grid exceeds n by less than its side, so walks are short."""
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.ceil(n / a).cast("long")

    def half_round(at: Column, r: Column) -> Column:
        left, right, even = at["left"], at["right"], F.pmod(r, F.lit(2)) == 0
        return F.struct(
            F.when(even, F.pmod(left + F.pmod(F.xxhash64(r, right, *key), a), a)).otherwise(left).alias("left"),
            F.when(even, right).otherwise(F.pmod(right + F.pmod(F.xxhash64(r, left, *key), b), b)).alias("right"))

    def step(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("left"), F.pmod(x, b).alias("right"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(2 * ROUNDS)), start, half_round,
                           lambda at: (at["left"] * b + at["right"]).cast("long"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), step(i),
                       lambda x, _: F.when(x < n, x).otherwise(step(x)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(_source, _size_of_source)`` rows -> the same with ``_sid`` and ``_target``. One row per source.

    Targets fill like water: min(most x size, level x weight), the level that uses up share x all sizes;
    the same as resharing the excess over caps by weight until no target is above its cap.
    """
    order = W.orderBy(F.col("_source").isNull(), "_source")
    everything = W.partitionBy(F.lit(1))
    by_ratio = everything.orderBy("_ratio", "_sid")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, W.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("_sid", F.lit(len(weights))) + 1))
    s = sizes.withColumn("_sid", (F.row_number().over(order) - 1).cast("int")).withColumn("_weight", weight)
    s = s.withColumn("_cap", F.col("_size_of_source") * float(most)).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    left = F.sum("_size_of_source").over(everything) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    s = s.withColumn("_level", left / F.sum("_weight").over(after))
    first = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_sid", "_level"))).over(everything)
    level = F.coalesce(first["_level"], F.max("_ratio").over(everything))
    s = s.withColumn("_target", F.least(F.col("_cap"), level * F.col("_weight")))
    return s.select("_source", "_sid", "_size_of_source", "_target")


def placed(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, sources): each document's place in its source's stream, without texts."""
    sized = written(docs.select(
        F.col(id_col).alias("_id"), row_hash(docs).alias("_hash"), F.col(source_col).alias("_source"),
        n_words(F.col(text_col)).alias("_size"),
    ).withColumn("_chunk", F.pmod(F.xxhash64("_id", "_hash"), F.lit(CHUNKS))), "mix-sizes")
    chunks = sized.groupBy("_source", "_chunk").agg(F.sum("_size").alias("_in_chunk"))
    running = W.partitionBy("_source").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = written(chunks.withColumn("_chunk_at", F.coalesce(F.sum("_in_chunk").over(running), F.lit(0))),
                     "mix-chunks")
    sources = written(source_targets(
        chunks.groupBy("_source").agg(F.sum("_in_chunk").alias("_size_of_source"))), "mix-sources")
    chunks = chunks.join(sources, chunks["_source"].eqNullSafe(sources["_source"])).select(
        chunks["_source"].alias("_s"), F.col("_chunk").alias("_c"), "_chunk_at", "_sid", "_size_of_source", "_target")
    within = W.partitionBy("_source", "_chunk").orderBy("_id", "_hash").rowsBetween(W.unboundedPreceding, -1)
    at = sized.withColumn("_in", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    at = at.join(chunks, (F.col("_chunk") == F.col("_c")) & F.col("_source").eqNullSafe(F.col("_s")))
    at = at.select("_id", "_hash", "_size", "_sid", "_size_of_source", "_target",
                   (F.col("_chunk_at") + F.col("_in")).alias("_at"))
    return at, sources


def slots(sources: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every slot of the mix: ``_sid, _epoch, _slot, _block, _take`` (words) and its output ``_shard``."""
    size, words = F.col("_size_of_source"), F.round("_target").cast("long")
    epochs = sources.where((size > 0) & (words > 0)).select(
        "_sid", size.alias("_n"), F.floor(size / block).cast("long").alias("_full"), words.alias("_words"),
        F.explode(F.sequence(F.lit(0), F.ceil(words / size).cast("int") - 1)).alias("_epoch"))
    epochs = epochs.withColumn("_words", F.least(F.col("_n"), F.col("_words") - F.col("_epoch") * F.col("_n")))
    last = F.ceil(F.col("_words") / block).cast("long") - 1
    runs = epochs.withColumn("_last", last).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"), F.lit(RUN).cast("long"))))
    runs = runs.repartition(shuffle_partitions(sources.sparkSession), "_sid", "_epoch", "_from")
    one = runs.withColumn("_slot", F.explode(F.sequence("_from", F.least(F.col("_last"), F.col("_from") + RUN - 1))))
    slot, key = F.col("_slot"), [F.lit(seed), F.col("_sid"), F.col("_epoch")]
    return one.select(
        "_sid", "_epoch", "_slot",
        F.when(slot < F.col("_full"), feistel(slot, F.col("_full"), *key)).otherwise(slot).alias("_block"),
        F.least(F.lit(block).cast("long"), F.col("_words") - slot * block).alias("_take"),
        F.pmod(F.xxhash64(F.lit("shard"), *key, slot), F.lit(shards)).cast("int").alias("_shard"))


def pieces(at: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per document and block of its source's stream that it reaches: words ``_lo`` to ``_hi`` of the
    block. Documents without words have one row with a block below 0, which no slot reads."""
    first = F.floor(F.col("_at") / block).cast("long")
    last = F.floor((F.col("_at") + F.col("_size") - 1) / block).cast("long")
    none = F.array(-F.lit(1) - F.pmod(F.xxhash64("_id", "_hash"), F.lit(RUN)))
    p = at.withColumn("_block", F.explode(F.when(F.col("_size") > 0, F.sequence(first, last)).otherwise(none)))
    begins = F.col("_block") * block
    return p.withColumn("_lo", F.greatest(F.col("_at") - begins, F.lit(0))).withColumn(
        "_hi", F.least(F.col("_at") + F.col("_size") - begins, F.lit(block)))


def taken_parts(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """``pieces`` joined with the slots that read them: ``_words`` words from ``_lo`` on, 0 if unread."""
    at, sources = placed(docs, block, **how)
    # The planner takes the slots for as small as the table of sources they are made from; they grow
    # with the corpus and must not be broadcast.
    joined = pieces(at, block).join(slots(sources, block).hint("merge"), ["_sid", "_block"], "left")
    words = F.greatest(F.least(F.col("_hi"), F.col("_take")) - F.col("_lo"), F.lit(0))
    return joined.withColumn("_words", F.when(F.col("_take").isNull(), 0).otherwise(words))


def mix_report(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken`` and ``n_shards``, the output shards that its
    words were drawn into."""
    row = ["_id", "_hash", "_sid", "_at", "_size", "_size_of_source", "_target"]
    per = taken_parts(docs, block, **how).groupBy(*row).agg(
        F.sum("_words").alias("taken"), F.count("*").alias("_n"),
        F.size(F.collect_set(F.when(F.col("_words") > 0, F.col("_shard")))).cast("long").alias("n_shards"))  # at most SHARDS
    # Equal rows without words share a place; their pieces count them.
    per = per.withColumn("_copies", F.when(F.col("_size") == 0, F.col("_n")).otherwise(F.lit(1)))
    per = per.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return per.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"),
                      F.col("_size_of_source").alias("source_size"), F.col("_target").cast("double").alias("target"),
                      F.col("taken").cast("long").alias("taken"), "n_shards")


def mix_plan(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """What every output shard holds: a row per piece, ``shard, source_number, epoch, slot, doc_id, first_word, n_words``.
    A shard's slots in the order of a hash of (source, epoch, slot) are its content."""
    read = taken_parts(docs, block, **how).where(F.col("_words") > 0)
    return read.select(F.col("_shard").alias("shard"), F.col("_sid").alias("source_number"), F.col("_epoch").alias("epoch"),
                       F.col("_slot").alias("slot"), F.col("_id").alias("doc_id"),
                       (F.col("_block") * block + F.col("_lo") - F.col("_at")).alias("first_word"), F.col("_words").alias("n_words"))


def shard_counts(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """The multinomial draw: ``shard, source, n_slots, n_words``, a row per shard and source drawn."""
    _, sources = placed(docs, block, **how)
    drawn = slots(sources, block).groupBy("_shard", "_sid").agg(
        F.count("*").alias("n_slots"), F.sum("_take").alias("n_words"))
    return drawn.join(sources.select("_sid", F.col("_source").alias("source")), "_sid").select(
        F.col("_shard").alias("shard"), "source", "n_slots", "n_words")


def mixed_documents(docs: DataFrame, block: int = BLOCK, **how) -> DataFrame:
    """The mix as documents with the columns of ``docs``: one row per document and epoch that takes words
    of it, its text those words with the space before each (the whole text if all are taken)."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    read = taken_parts(docs, block, **how).where(F.col("_words") > 0)
    start = F.col("_block") * block + F.col("_lo") - F.col("_at")
    ranges = read.groupBy("_id", "_hash", "_size", "_at", "_epoch").agg(
        F.sort_array(F.collect_list(F.struct(start.alias("from"), F.col("_words").alias("n")))).alias("_ranges"),
        F.sum("_words").alias("_taken"))
    keyed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                        row_hash(docs).alias("_hash"))
    # Equal rows have one range each in ``ranges`` (their places differ), so one of them stands for all.
    alike = W.partitionBy("_id", "_hash").orderBy(F.lit(1))
    keyed = keyed.withColumn("_n", F.row_number().over(alike)).where("_n = 1").drop("_n")
    keyed = keyed.withColumnsRenamed({"_id": "_i", "_hash": "_h"})
    both = ranges.join(keyed, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")))
    words = F.regexp_extract_all(F.col(f"_row.{text_col}"), F.lit(f"{SPACE_CLASS}*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    part = F.array_join(F.flatten(F.transform("_ranges", lambda r: F.slice(
        F.col("_all"), (r["from"] + 1).cast("int"), r["n"].cast("int")))), "")
    whole = F.col("_taken") == F.col("_size")
    both = both.withColumn("_all", F.when(~whole, words))
    both = both.withColumn("_new", F.when(whole, F.col(f"_row.{text_col}")).otherwise(part))
    new = {text_col: F.col("_new"), "n_chars": F.char_length("_new").cast("long")}
    return both.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
