"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Inner products are turned into distances band by band of equal norm: every vector is divided by its own
norm, so that among vectors of one norm the nearest has the largest product, and no vector's norm shrinks
the others. Norms differ in what they need: a vector of a norm above ``LONG`` times the median one can be
a neighbour at a wide angle, so these are no matter of buckets but seen by every query, in chunks like a
hot bucket's. Each of ``TABLES`` tables hashes a vector by ``PROJECTIONS`` Gaussian projections, floor((a x +
b) / ``WIDTH``). A query visits its own bucket and ``PROBES`` - 1 perturbed ones per table, in the order of
estimated success: its coordinates' distances to their cell borders are sorted, and perturbation sets are
taken in the order of the expected sum of squares of the distances at their ranks. Candidates of all
tables are scored exactly in double precision on the original vectors, and the best are merged.

Scale: buckets are dealt to shards of about ``SHARD_ROWS`` vectors per table; a query goes to the shards
of its probed buckets only, with the buckets' keys. A shard that is larger (a hot bucket), or that too many
queries visit, is cut into chunks, and each pair of a vector chunk and a query chunk is one group, so no
group is larger than two chunks. A group hands on ``k + 1`` hits per query, as one row. Equal vectors are
one entry with their ``k + 1`` smallest ids (no query needs more of them), so a vector that a third of the
rows share is searched and found once; its queries meet the hits in a join that AQE can split. A query
for which the probes find fewer than ``k``, or none but negative products for the last, is searched again
against all vectors, in the same blocks.

On the given vectors (64 components, close to random: the 20th neighbour is at about three quarters of the mean distance)
a recall above 0.9 needs most buckets, so a query's candidates are a large share of the table; with data
that has nearer neighbours fewer probes do. ``recall`` measures it against brute force.

Defined results: vectors that are null, zero, hold null or non-finite components, have a null id, or a
length other than the most common one take no part; a row repeated in id and vector counts once; a query
never finds its own id; with fewer than ``k`` others all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelens.functions.joins import lookup_join
from pricelens.llm.common import written

K = 20
QUERY_STEP = 20
TABLES = 8
PROJECTIONS = 8
WIDTH = 2.2
PROBES = 96
LONG = 1.5
SHARD_ROWS = 8192
QUERY_ROWS = 4096
SEED = 5


def perturbations(m: int, n: int) -> list[tuple[int, ...]]:
    """The first ``n`` sets of ranks 1..2m (ranks of the distances to the 2m cell borders), by the expected sum
    of their squared distances; no set moves one coordinate both ways (ranks j and 2m + 1 - j)."""
    def expected(j: int) -> float:
        up = lambda i: i * (i + 1) / (4 * (m + 1) * (m + 2))
        return up(j) if j <= m else 1 - (2 * m + 1 - j) / (m + 1) + up(2 * m + 1 - j)

    found: list[tuple[int, ...]] = [()]
    heap = [(expected(1), (1,))]
    while heap and len(found) < n:
        cost, ranks = heapq.heappop(heap)
        if not any(2 * m + 1 - j in ranks for j in ranks):
            found.append(ranks)
        if (last := ranks[-1]) < 2 * m:
            heapq.heappush(heap, (cost + expected(last + 1) - expected(last), (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (cost + expected(last + 1), (*ranks, last + 1)))
    return found


class Hashes:
    """The tables' projections; the same on every worker."""

    def __init__(self, dim: int, tables: int, projections: int, width: float, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.tables, self.m, self.width = tables, projections, width
        self.a = rng.normal(size=(tables, dim, projections))
        self.b = rng.uniform(0, width, size=(tables, projections))
        self.key = rng.integers(1, 1 << 62, size=(tables, projections), dtype=np.int64) | 1

    def cells(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket keys, and the place of each coordinate within its cell (0 to 1)."""
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no square of it overflows
        f = (x / np.linalg.norm(x, axis=1, keepdims=True) @ self.a[table] + self.b[table]) / self.width
        cell = np.floor(f)
        return (cell.astype(np.int64) * self.key[table]).sum(axis=1), f - cell

    def probes(self, x: np.ndarray, table: int, sets: list[tuple[int, ...]]) -> np.ndarray:
        """Keys of the buckets to visit, a row per vector."""
        own, inside = self.cells(x, table)
        order = np.argsort(np.hstack([inside, 1 - inside]), axis=1)  # a lower neighbour, then an upper one
        step = np.hstack([-self.key[table], self.key[table]])[order]
        out = np.empty((len(x), len(sets)), dtype=np.int64)
        for i, ranks in enumerate(sets):
            out[:, i] = own + step[:, [r - 1 for r in ranks]].sum(axis=1) if ranks else own
        return out


def entries(embeddings: DataFrame, k: int, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(distinct vectors with ``_rep, _vec, _ids``; rows ``_id, _h, _g`` with their vector's hashes)."""
    vec = F.col(vec_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("_id"), vec.alias("_vec")).where(
        F.col("_id").isNotNull() & F.col("_vec").isNotNull() & (F.size("_vec") > 0)
        & F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("_vec", lambda x: x != 0))
    common = rows.groupBy(F.size("_vec").alias("_dim")).agg(F.count("*").alias("_n"))
    common = common.agg(F.max(F.struct("_n", (-F.col("_dim")).alias("_dim")))["_dim"]).first()[0]
    rows = rows.where(F.size("_vec") == -(common or 0))
    rows = written(rows.withColumns({"_h": F.xxhash64("_vec"), "_g": F.xxhash64(F.lit(1), "_vec")}).distinct(), "ann-rows")
    order = W.partitionBy("_h", "_g").orderBy("_id")
    few = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    reps = few.groupBy("_h", "_g").agg(F.min("_id").alias("_rep"), F.first("_vec").alias("_vec"),
                                       F.sort_array(F.collect_list("_id")).alias("_ids"))
    return written(reps, "ann-vectors"), rows.select("_id", "_h", "_g")


def tile_hits(data: DataFrame, queries: DataFrame, most: int, shard_rows: int, query_rows: int) -> DataFrame:
    """``data`` (``_table, _shard, _bucket, _rep, _vec``) against ``queries`` (``_table, _shard, _q, _vec,
    _buckets``): rows ``_q, _hits``, the best ``most`` of a chunk as (-score, rep), nearest first."""
    place = ["_table", "_shard"]
    n_data = data.groupBy(*place).agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("_nd"))
    n_query = queries.groupBy(*place).agg(F.ceil(F.count("*") / query_rows).cast("int").alias("_nq"))
    sizes = written(n_data.join(n_query, place), "ann-shards")
    data = lookup_join(data, sizes, place, "inner", materialize=False).withColumn("_dc", F.pmod(F.xxhash64("_rep"), "_nd").cast("int"))
    data = data.withColumn("_qc", F.explode(F.sequence(F.lit(0), F.col("_nq") - 1)))
    queries = lookup_join(queries, sizes, place, "inner", materialize=False).withColumn("_qc", F.pmod(F.xxhash64("_q"), "_nq").cast("int"))
    queries = queries.withColumn("_dc", F.explode(F.sequence(F.lit(0), F.col("_nd") - 1)))
    tile = [*place, "_dc", "_qc"]
    data, queries = data.select(*tile, "_bucket", "_rep", "_vec"), queries.select(*tile, "_q", "_vec", "_buckets")

    def score(d: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(d) or not len(q):
            return pd.DataFrame({"_q": np.empty(0, np.int64), "_hits": []})
        x, rep = np.stack(d["_vec"].to_numpy()), d["_rep"].to_numpy()
        buckets, bucket = np.unique(d["_bucket"].to_numpy(), return_inverse=True)
        names, hits = q["_q"].to_numpy(), []
        kept = []
        for at in range(0, len(q), 256):
            some = q.iloc[at:at + 256]
            visits = np.zeros((len(some), len(buckets)), dtype=bool)
            for i, keys in enumerate(some["_buckets"].to_numpy()):
                pos = np.minimum(np.searchsorted(buckets, keys), len(buckets) - 1)
                visits[i, pos[buckets[pos] == keys]] = True
            near = np.flatnonzero(visits.any(axis=0)[bucket])  # vectors in a bucket that some query visits
            vectors = np.stack(some["_vec"].to_numpy())
            scores = vectors @ x[near].T
            scores[~visits[:, bucket[near]]] = -np.inf
            for i in range(len(some)):
                row = scores[i]
                floor = np.partition(row, -most)[-most] if len(row) > most else -np.inf
                take = np.flatnonzero((row >= floor) & (row > -np.inf))
                if len(take):
                    # Scored pair by pair: a product's last digit must not hang on the block it is in, or
                    # a vector that two tables find would count twice.
                    found, exact = rep[near[take]], (x[near[take]] * vectors[i]).sum(axis=1)
                    best_first = np.lexsort((found, -exact))[:most]
                    kept.append(names[at + i])
                    hits.append([{"away": -exact[k], "rep": found[k]} for k in best_first])
        return pd.DataFrame({"_q": np.array(kept, dtype=np.int64), "_hits": hits})

    return data.groupBy(*tile).cogroup(queries.groupBy(*tile)).applyInPandas(
        score, "_q long, _hits array<struct<away: double, rep: long>>")


def best(hits: DataFrame, most: int, tables: int) -> DataFrame:
    """The best ``most`` hits of each query over all tables and chunks. A query has at most ``most`` from
    each shard it visits, and visits at most as many as it has probes. A vector is found once a table, with
    one score, so the first ``most * tables`` hold ``most`` vectors if there are so many."""
    merged = F.array_distinct(F.slice(F.sort_array(F.flatten(F.collect_list("_hits"))), 1, most * tables))
    return hits.groupBy("_q").agg(F.slice(merged, 1, most).alias("_hits"))


def neighbours(embeddings: DataFrame, k: int = K, query_step: int = QUERY_STEP, tables: int = TABLES,
               projections: int = PROJECTIONS, width: float = WIDTH, probes: int = PROBES,
               shard_rows: int = SHARD_ROWS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the queries: the rows whose id is divisible by ``query_step``."""
    reps, rows = entries(embeddings, k, id_col, vec_col)
    queries = rows.where(F.pmod("_id", F.lit(query_step)) == 0).join(reps.select("_h", "_g", "_rep"), ["_h", "_g"])
    queries = written(queries.select(F.col("_id").alias("query_id"), F.col("_rep").alias("_q")), "ann-queries")
    norm = F.sqrt(F.aggregate("_vec", F.lit(0.0), lambda s, x: s + x * x))
    about = reps.agg(F.count("*"), F.percentile_approx(norm, 0.5), F.max(F.size("_vec"))).first()
    n, long, dim = about[0], norm > LONG * (about[1] or 1.0), about[2] or 1
    shards = max(1, -(-n // shard_rows))
    asked = reps.select("_rep", "_vec").join(queries.select(F.col("_q").alias("_rep")).distinct(), "_rep", "left_semi")
    asked = written(asked, "ann-asked")
    sets = perturbations(projections, probes)

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes(dim, tables, projections, width)
        for f in frames:
            if len(f):
                x = np.stack(f["_vec"].to_numpy())
                for t in range(tables):
                    key = hashes.cells(x, t)[0]
                    yield pd.DataFrame({"_table": t, "_shard": shard_of(key, shards), "_bucket": key,
                                        "_rep": f["_rep"], "_vec": f["_vec"]})

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes(dim, tables, projections, width)
        for f in frames:
            if len(f):
                x = np.stack(f["_vec"].to_numpy())
                for t in range(tables):
                    keys = hashes.probes(x, t, sets)
                    to = shard_of(keys, shards)
                    out = [(s, f["_rep"].iat[i], f["_vec"].iat[i], keys[i, to[i] == s])
                           for i in range(len(f)) for s in np.unique(to[i]).tolist()]
                    yield pd.DataFrame(out, columns=["_shard", "_q", "_vec", "_buckets"]).assign(_table=t)

    def whole(vectors: DataFrame, table: int) -> DataFrame:
        """One bucket of ``vectors``; ``searched`` are the queries that see all of it."""
        return vectors.select(F.lit(table).alias("_table"), F.lit(0).cast("long").alias("_shard"),
                              F.lit(0).cast("long").alias("_bucket"), "_rep", "_vec")

    def searched(queries: DataFrame, table: int) -> DataFrame:
        return queries.select(F.lit(0).cast("long").alias("_shard"), F.col("_rep").alias("_q"), "_vec",
                              F.array(F.lit(0).cast("long")).alias("_buckets"), F.lit(table).alias("_table"))

    data = reps.where(~long).select("_rep", "_vec").mapInPandas(
        index, "_table int, _shard long, _bucket long, _rep long, _vec array<double>")
    probing = asked.select("_rep", "_vec").mapInPandas(
        visit, "_shard long, _q long, _vec array<double>, _buckets array<long>, _table int")
    data = data.unionByName(whole(reps.where(long), tables))
    probing = probing.unionByName(searched(asked, tables))
    found = written(best(tile_hits(data, probing, k + 1, shard_rows, QUERY_ROWS), k + 1, tables), "ann-found")
    # Other queries see every vector: too few hits, or products so small that the nearest are beyond a right
    # angle, where buckets say nothing. One bucket, cut into chunks like any hot bucket.
    enough = (F.size("_hits") >= n) | ((F.size("_hits") > k) & (F.element_at("_hits", -1)["away"] < 0))
    few = asked.join(found.where(enough).select(F.col("_q").alias("_rep")), "_rep", "left_anti")
    again = tile_hits(whole(reps, 0), searched(few, 0), k + 1, shard_rows, QUERY_ROWS)
    found = found.where(enough).unionByName(best(again, k + 1, 1))
    hits = found.select("_q", F.explode("_hits").alias("_hit"))
    hits = hits.select("_q", (-F.col("_hit.away")).alias("score"), F.col("_hit.rep").alias("_rep"))
    hits = hits.join(reps.select("_rep", "_ids"), "_rep").select("_q", "score", F.explode("_ids").alias("vec_id"))
    nearest = F.row_number().over(W.partitionBy("_q").orderBy(F.desc("score"), "vec_id"))
    hits = written(hits.withColumn("_n", nearest).where(F.col("_n") <= k + 1).drop("_n"), "ann-hits")
    out = queries.join(hits, "_q").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = out.withColumn("rank", rank).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    x = key.view(np.uint64)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % shards


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours (``query_id, vec_id``) that were found."""
    both = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id"), ["query_id", "vec_id"])
    return both.count() / max(1, exact.count())
