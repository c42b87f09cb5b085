"""Ranked lexical search: an index of compressed postings in shards of documents, searched by Block-Max MaxScore.

Terms are the maximal stretches of ASCII letters, digits and code points beyond ASCII, A-Z lower-cased. With N
documents that have a term, L terms in them, n terms in a document and df documents of a term:
``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``, ``m = 10 + (90 n N) div L``, and a document scores the sum of
``w * ((1000000000 tf) div (1000 tf + 8 m))`` over the query's distinct terms, in 64-bit integers.

Index. A task packs its documents into shards of at most ``SHARD_DOCS`` documents and about ``SHARD_TERMS`` terms.
Inside a shard documents are numbered by their length, so that the documents of a block are about equally long.
A term's list holds document gaps and counts as variable-length bytes in blocks of ``BLOCK`` documents; beside them
stand each block's last document, greatest count, least length and end. The greatest count over the least length
bounds what a document of the block can score, without reading it. One row a shard holds the documents' ids and lengths.

Search. Every (shard, block of items) is one group. A query's lists are ordered by their global bounds (the greatest
block bound); the longest prefix whose bounds sum to less than the k-th best score so far is not essential: no
document with these terms alone can enter. Essential lists are read in windows of documents; what they
find is then held against the block maxima of the other lists, and only what can still enter has their blocks
decompressed. Shards give their k best, and the k best of these are the result: exact, no candidate is given up.

Scale: documents are read once and never shuffled; an index row is bounded by its shard. Searching moves the lists
of the queried terms only. Counts (N, L, df) are sums over all shards. Items go in blocks of ``ITEM_BLOCK``: a group
holds one shard's lists of at most that many items, whatever the number of items. The table of queried terms is
broadcast only up to ``BROADCAST_PAIRS`` rows. Shard results are cut to k an item before and after their shuffle.

Defined results: null or blank text has no terms and counts for nothing; rows are documents and items of
their own, also where they repeat an id or a text; a null doc_id is last among equal scores; items without a term
that occurs have no rows; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelens.llm.common import UPPER, written

K = 10
SHARD_DOCS = 1 << 14
SHARD_TERMS = 1 << 22
BLOCK = 128
#: Documents that a query looks at together.
WINDOW = 2048
ITEM_BLOCK = 512
BROADCAST_PAIRS = 500_000
#: What separates terms: ASCII without letters and digits.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Bytes of terms as they are, A-Z lower-cased, others to a space.
TERM_BYTES = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()
NO_ID = np.iinfo(np.int64).max


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, the highest bit set on all but a number's last; and where each number ends."""
    sizes = np.ones(len(values), np.int64)
    for k in (7, 14, 21, 28):
        sizes += values >> k > 0
    ends = np.cumsum(sizes)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max(initial=1))):
        some = sizes > k
        out[ends[some] - sizes[some] + k] = (values[some] >> 7 * k & 127) | (sizes[some] > k + 1) * 128
    return out, ends


def from_varints(data: np.ndarray) -> np.ndarray:
    last = data < 128
    ends = np.flatnonzero(last)
    starts = np.r_[0, ends[:-1] + 1]
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, starts)


class ShardWriter:
    """Collects documents and packs them into the rows of a shard."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids: list[int | None] = []
        self.terms: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = text.encode().translate(TERM_BYTES).split()
        if words:
            self.ids.append(doc_id)
            self.terms.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
            self.size += len(words)

    def full(self, docs: int, terms: int) -> bool:
        return len(self.ids) >= docs or self.size >= terms

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(t) for t in self.terms], np.int64)
        order = np.argsort(lengths, kind="stable")
        lengths, docs = lengths[order], len(order)
        yield index_rows([shard], [None], [docs], [None], [None],
                         pa.array([[self.ids[k] for k in order]], pa.list_(pa.int64())),
                         pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())))
        key = np.concatenate([self.terms[k] for k in order]).astype(np.int64) * docs + np.repeat(np.arange(docs), lengths)
        key, tf = np.unique(key, return_counts=True)
        term, doc = key // docs, key % docs
        df = np.bincount(term, minlength=len(self.numbers))
        first = np.cumsum(df) - df  # of each term
        place = np.arange(len(key)) - first[term]
        gaps = np.diff(doc, prepend=-1)
        gaps[first] = doc[first] + 1
        numbers = np.empty(2 * len(key), np.int64)
        numbers[::2], numbers[1::2] = gaps, tf
        data, ends = varints(numbers)
        ends = ends[1::2]
        begin = np.flatnonzero(place % BLOCK == 0)
        stop = np.r_[begin[1:], len(key)] - 1
        term_from = np.r_[0, ends[first[1:] - 1]]
        heads = np.stack([doc[stop], np.maximum.reduceat(tf, begin), lengths[doc[begin]],
                          ends[stop] - term_from[term[begin]]], axis=1).astype("<i4")
        blocks = (df + BLOCK - 1) // BLOCK
        rows = index_rows(np.full(len(df), shard), [t.decode() for t in self.numbers], df,
                          slices(heads.tobytes(), 16 * np.r_[0, np.cumsum(blocks)]),
                          slices(data.tobytes(), np.r_[term_from, len(data)]), None, None)
        for at in range(0, len(df), 10_000):
            yield rows.slice(at, 10_000)


def slices(data: bytes, ends: np.ndarray) -> pa.Array:
    """A binary column whose values lie one after another in ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(data)])


INDEX_SCHEMA = "shard long, term string, df int, blocks binary, data binary, doc_ids array<long>, lengths array<int>"


def index_rows(shard, term, df, blocks, data, doc_ids, lengths) -> pa.RecordBatch:
    n = len(df)
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int64()), pa.array(term, pa.string()), pa.array(df, pa.int32()),
         blocks if isinstance(blocks, pa.Array) else pa.nulls(n, pa.binary()),
         data if isinstance(data, pa.Array) else pa.nulls(n, pa.binary()),
         pa.nulls(n, pa.list_(pa.int64())) if doc_ids is None else doc_ids,
         pa.nulls(n, pa.list_(pa.int32())) if lengths is None else lengths],
        names=["shard", "term", "df", "blocks", "data", "doc_ids", "lengths"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS,
                shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The index, a written table: a row per shard and term, and a row per shard with null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer = TaskContext.get().partitionId() << 24, ShardWriter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, doc_id in enumerate(ids):
                writer.add(doc_id, batch.column(1)[at].as_py())
                if writer.full(shard_docs, shard_terms):
                    yield from writer.rows(shard)
                    shard, writer = shard + 1, ShardWriter()
        if writer.ids:
            yield from writer.rows(shard)

    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    return written(rows.mapInArrow(run, INDEX_SCHEMA), "postings")


class Postings:
    """A term's list in one shard; blocks are decompressed when asked for, once."""

    def __init__(self, blocks: bytes, data: bytes, saturation: np.ndarray):
        heads = np.frombuffer(blocks, "<i4").reshape(-1, 4)
        self.last, self.ends = heads[:, 0], heads[:, 3]
        self.data, self.saturation = np.frombuffer(data, np.uint8), saturation
        # min. length of a block is that of its first document, so its m is the least of the block
        most = heads[:, 1].astype(np.int64)
        self.least = heads[:, 2]
        self.most = most
        self.bounds = np.empty(0, np.int64)
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bound(self, m_of_length) -> None:
        self.bounds = impact(self.most, m_of_length(self.least))

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        if k not in self.read:
            numbers = from_varints(self.data[self.ends[k - 1] if k else 0:self.ends[k]])
            docs = np.cumsum(numbers[::2]) + (self.last[k - 1] if k else -1)
            self.read[k] = docs, impact(numbers[1::2], self.saturation[docs])
        return self.read[k]

    def between(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from a to b - 1 and their impacts."""
        k, to = np.searchsorted(self.last, (a, b)).tolist()
        found = [self.block(x) for x in range(k, min(to + 1, len(self.last)))]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, values = (np.concatenate(x) for x in zip(*found))
        i, j = np.searchsorted(docs, (a, b))
        return docs[i:j], values[i:j]


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Both terms of a score's fraction are whole numbers; the fraction grows with tf and falls with m."""
    return 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * m)


def m_rule(n_docs: int, n_terms: int):
    """m as a function of document lengths."""

    def m(lengths: np.ndarray) -> np.ndarray:
        lengths = np.asarray(lengths).astype(np.int64)
        if len(lengths) and 90 * int(lengths.max()) * n_docs >= 1 << 63:
            return np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        return 10 + 90 * lengths * n_docs // n_terms

    return m


class Best:
    """The k best documents so far; equal scores by id."""

    def __init__(self, k: int, ids: np.ndarray):
        self.k, self.ids = k, ids
        self.docs, self.scores = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def entry(self) -> int:
        """The least score that can enter."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.entry
        if good.any():
            docs, scores = np.r_[self.docs, docs[good]], np.r_[self.scores, scores[good]]
            order = np.lexsort((self.ids[docs], -scores))[:self.k]
            self.docs, self.scores = docs[order], scores[order]


def search_shard(lists: list[tuple[int, Postings]], ids: np.ndarray, k: int) -> Best:
    """The k best of a shard for one query, given its (weight, list) pairs."""
    best, size = Best(k, ids), len(ids)
    lists = sorted(((w, p) for w, p in lists if w > 0), key=lambda x: x[0] * int(x[1].bounds.max()))
    reach = np.cumsum([w * int(p.bounds.max()) for w, p in lists])  # of a list and all before it
    for a in range(0, size, WINDOW):
        b, entry = min(a + WINDOW, size), best.entry
        first = int(np.searchsorted(reach, entry))  # lists before it are not essential
        if first == len(lists):
            break
        total = np.zeros(b - a, np.int64)
        for w, p in lists[first:]:
            docs, values = p.between(a, b)
            total[docs - a] += w * values
        found = np.flatnonzero(total)
        score, docs = total[found], found + a
        # Block maxima of the other lists, the greatest bound first.
        rest = []
        for w, p in reversed(lists[:first]):
            at = np.searchsorted(p.last, docs)
            rest.append((w, p, at, w * np.append(p.bounds, 0)[at]))
        limit = score + sum((r[3] for r in rest), np.zeros(len(docs), np.int64))
        alive = np.flatnonzero(limit >= entry)
        for w, p, at, most in rest:
            if not len(alive):
                break
            limit[alive] -= most[alive]
            for block in np.unique(at[alive]).tolist():
                if block == len(p.last):
                    continue
                here = alive[at[alive] == block]
                held, values = p.block(block)
                place = np.searchsorted(held, docs[here]).clip(max=len(held) - 1)
                gain = np.where(held[place] == docs[here], w * values[place], 0)
                score[here] += gain
                limit[here] += gain
            alive = alive[limit[alive] >= entry]
        best.offer(docs[alive], score[alive])
    return best


def search_group(group: pa.Table, n_docs: int, n_terms: int, k: int) -> pa.Table:
    """All items of one block against one shard."""
    rows = group.to_pylist()
    head = next(r for r in rows if r["term"] is None)
    m = m_rule(n_docs, n_terms)
    ids = np.array([NO_ID if i is None else i for i in head["doc_ids"]], np.int64)
    saturation = m(np.array(head["lengths"]))
    queries: dict[int, tuple[int | None, list]] = {}
    for r in rows:
        if r["term"] is not None:
            postings = Postings(r["blocks"], r["data"], saturation)
            postings.bound(m)
            for item in r["items"]:
                queries.setdefault(item["n"], (item["id"], []))[1].append((r["w"], postings))
    out = []
    for n, (item_id, lists) in queries.items():
        best = search_shard(lists, ids, k)
        out += [(n, item_id, head["doc_ids"][d], s) for d, s in zip(best.docs.tolist(), best.scores.tolist())]
    kinds = [pa.int64()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, kinds)], names=["n", "item_id", "doc_id", "score"])


def terms_of(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``n, block, item_id, term``: the distinct terms of each item, a written table."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, UPPER.lower())
    numbered = items.select(F.monotonically_increasing_id().alias("n"), F.col(id_col).cast("long").alias("item_id"), text.alias("_text"))
    terms = F.array_distinct(F.filter(F.split("_text", BETWEEN), lambda t: t != ""))
    return written(numbered.select("n", F.floor(F.col("n") / ITEM_BLOCK).alias("block"), "item_id",
                                   F.explode(terms).alias("term")), "query-terms")


def search_index(index: DataFrame, items: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Each item's k best documents: ``item_id, rank, doc_id, score``."""
    terms = terms_of(items, id_col, text_col)
    pairs = terms.count()
    sums = index.where("term is null").select("df", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("terms"))
    n_docs, n_terms = sums.agg(F.sum("df"), F.sum("terms")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 1

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if pairs <= BROADCAST_PAIRS else df

    lists = index.where("term is not null")
    counts = lists.join(small(terms.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("_df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("_df") + 1)))
    asked = terms.groupBy("block", "term").agg(F.collect_list(F.struct("n", F.col("item_id").alias("id"))).alias("items"))
    asked = written(asked.join(counts, "term").select("block", "term", "items", weight.alias("w")), "query-weights")
    blocks = [r[0] for r in asked.select("block").distinct().collect()]  # one number per 512 items
    found = lists.join(small(asked), "term").select("block", "shard", "term", "w", "items", "blocks", "data", "doc_ids", "lengths")
    heads = index.where("term is null").select(
        F.explode(F.lit(blocks or [0]).cast("array<long>")).alias("block"), "shard", "term", F.lit(None).cast("long").alias("w"),
        F.lit(None).cast("array<struct<n:long,id:long>>").alias("items"), "blocks", "data", "doc_ids", "lengths")

    def run(group: pa.Table) -> pa.Table:
        return search_group(group, n_docs, n_terms, k)

    best = found.unionByName(heads).groupBy("block", "shard").applyInArrow(
        run, "n long, item_id long, doc_id long, score long")
    rank = F.row_number().over(W.partitionBy("n").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, **how) -> DataFrame:
    """``search_index`` over a new index of ``docs``."""
    return search_index(build_index(docs, **how), items, k)
