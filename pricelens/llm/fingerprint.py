"""Document fingerprints by consistent weighted sampling.

A text is the bag of its words (A-Z lower-cased runs of non-space bytes), each weighted by its count. For
each of ``SAMPLES`` slots every word draws r, c ~ Gamma(2, 1) and b ~ U(0, 1), all from a hash of the word and the
slot, and its weight is rounded to a step t = floor(ln w / r + b); the word of the least
ln a = ln c - r (t - b) - r is the slot's sample. ln a hangs on (word, t, slot) only, so equal samples have equal least
values and others do not; the value is hashed to 16 bits. Two texts agree in a slot with the probability of their
generalised Jaccard similarity (sum of least weights over sum of greatest), so the share of equal slots
estimates it; 16 bits add 1/65536 of chance agreement. The gamma numbers come from tables of 2^16 quantiles.

The draws depend on (word, count) only. A worker keeps the slots' ln a of the pairs it has met in an array of
``ROWS`` rows, and a document's fingerprint is a column-wise minimum over its rows. When the array is full it starts
anew. Words are numbered as they come, so that all but the new words of a text is done on arrays of numbers.

The edited text needs the next document in descending id. Rows are cut into ranges of (id, text hash), from
quantiles of the id alone; each range is sorted in one task, and the first document of every range is sent to the
range before it as well: texts shuffle once, plus one document a range. An id that many rows share, or null, spans
several ranges.

Defined results: null text is empty; no words: every slot is ``ffff``, so two wordless texts have likeness
1; null ids come last and equal ids in descending order of the text's XXH64 (seed 42, signed), then of text; a single
document is its own next one; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import in_ranges, shuffle_partitions

SAMPLES = 128
#: (word, count) pairs that a worker remembers: 128 x 4 bytes each.
ROWS = 1 << 18
SEED = 6
#: An odd 64-bit number without pattern: 2^64 over the golden ratio.
GOLDEN = 0x9E3779B97F4A7C15


def gamma_quantiles(bits: int = 16) -> np.ndarray:
    """Gamma(2, 1) numbers at the middles of 2^bits equal shares, by Newton's method on 1 - (1 + x) e^-x."""
    share = (np.arange(1 << bits) + 0.5) / (1 << bits)
    x = np.sqrt(2 * share) - np.log1p(-share)  # near 0 the first, far out the second
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - share) / (x * np.exp(-x)), 1e-6)
    return x


class Numbers(dict):
    """Words numbered as they come; ``fresh`` lists the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.fresh.append(word)
        return n


class Sampler:
    def __init__(self, samples: int = SAMPLES, rows: int = ROWS, seed: int = SEED):
        self.samples, self.rows, self.seed = samples, rows, seed
        self.values = np.empty((rows, samples), dtype=np.float32)  # ln a
        self.slots = np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(GOLDEN)
        gamma = gamma_quantiles()
        self.gamma, self.log_gamma = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        self.forget_words()

    def forget_words(self) -> None:
        self.numbers = Numbers()
        self.hashes = np.empty(0, np.uint64)  # by word number
        self.single = np.empty(0, np.int64)  # row of the word standing once, or -1
        self.forget_rows()

    def forget_rows(self) -> None:
        self.held = 0
        self.single[:] = -1
        self.several: dict[int, int] = {}  # count << 32 | word number -> row

    def words(self, text: str) -> np.ndarray:
        """The numbers of a text's words."""
        if len(self.numbers) > 2 * self.rows:
            self.forget_words()
        numbers, words = self.numbers, text.encode().lower().split()
        out = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        if numbers.fresh:
            hashes = np.array([xxhash.xxh64_intdigest(w, self.seed) for w in numbers.fresh], np.uint64)
            known = len(numbers) - len(hashes)
            if len(numbers) > len(self.hashes):
                more = len(numbers)
                self.hashes = np.r_[self.hashes[:known], hashes, np.empty(more, np.uint64)]
                self.single = np.r_[self.single[:known], np.full(len(hashes) + more, -1)]
            self.hashes[known:known + len(hashes)] = hashes
            numbers.fresh.clear()
        return out

    def draw(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """ln a of (word, count) pairs in every slot. Everything hangs on the word's hash and the count."""
        log_w = np.log(counts.astype(np.float32))[:, None]
        parts = mix(self.hashes[words][:, None] + self.slots).view(np.uint16).reshape(len(words), self.samples, 4)
        r, log_c = self.gamma.take(parts[..., 0]), self.log_gamma.take(parts[..., 1])
        b = parts.view(np.uint32)[..., 1].astype(np.float32) * np.float32(2.0**-32)
        return log_c - r * (np.floor(log_w / r + b) - b + np.float32(1))

    def rows_of(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The pairs' rows, which are drawn where they are new."""
        rows = self.single[words]
        many = np.flatnonzero(counts > 1)
        keys = (counts[many] << 32 | words[many]).tolist()
        get = self.several.get
        rows[many] = [get(k, -1) for k in keys]
        new = np.flatnonzero(rows < 0)
        if len(new):
            if self.held + len(new) > self.rows:
                self.forget_rows()
                return self.rows_of(words, counts)
            rows[new] = np.arange(self.held, self.held + len(new))
            self.values[self.held:self.held + len(new)] = self.draw(words[new], counts[new])
            self.held += len(new)
            once = counts == 1
            self.single[words[once]] = rows[once]
            self.several.update(zip(keys, rows[many].tolist()))
        return rows

    def fingerprint(self, text: str) -> np.ndarray:
        words, counts = np.unique(self.words(text), return_counts=True)
        best = np.full(self.samples, np.inf, np.float32)
        step = min(4096, self.rows)
        for at in range(0, len(words), step):
            rows = self.rows_of(words[at:at + step], counts[at:at + step])
            np.minimum(best, self.values.take(rows, axis=0).min(axis=0), out=best)
        hashed = (mix(best.view(np.uint32) + self.slots) >> np.uint64(48)).astype(np.uint16)
        return hashed if len(words) else np.full(self.samples, 0xFFFF, np.uint16)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers: two rounds of multiply and shift."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SAMPLERS: dict[tuple[int, int, int], Sampler] = {}


def sampler_of(samples: int = SAMPLES, rows: int = ROWS, seed: int = SEED) -> Sampler:
    """The worker's sampler: later tasks of the same worker find its arrays filled."""
    key = (samples, rows, seed)
    if key not in _SAMPLERS:
        _SAMPLERS[key] = Sampler(*key)
    return _SAMPLERS[key]


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many (or all) first ones of the next text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def hexed(marks: np.ndarray) -> str:
    return marks.astype(">u2").tobytes().hex()


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          partitions: int | None = None) -> DataFrame:
    """Per document: ``doc_id, n_chars, edited_sha256`` and both fingerprints with their likenesses."""
    spark = docs.sparkSession
    partitions = partitions or shuffle_partitions(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = in_ranges(docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"),
                                  F.xxhash64(text).alias("_tie")), 4 * partitions)
    # The first document of a range has its greatest (id, text hash, text); nulls are below all ids.
    order = F.struct(F.coalesce(F.col("_id"), F.lit(-1 << 63)).alias("i"), F.col("_id").isNotNull().alias("n"), F.col("_tie").alias("t"))
    heads = [tuple(r) for r in keyed.groupBy("_range").agg(F.max(order).alias("m")).select("_range", "m.i", "m.n", "m.t").collect()]
    ranges = sorted(h[0] for h in heads)
    above = {r: ranges[(i + 1) % len(ranges)] for i, r in enumerate(ranges)}  # the greatest range follows the least
    first = spark.createDataFrame([(*h, above[h[0]]) for h in heads], "_r int, _i long, _n boolean, _t long, _above int")
    head = keyed.join(F.broadcast(first), (F.col("_range") == F.col("_r")) & (F.col("_tie") == F.col("_t"))
                      & F.col("_id").eqNullSafe(F.when(F.col("_n"), F.col("_i"))))
    head = head.groupBy("_r", "_above").agg(F.max("_text").alias("_text"), F.max("_id").alias("_id"), F.max("_tie").alias("_tie"))
    extra = head.select(F.col("_above").alias("_range"), "_id", "_text", "_tie", F.lit(1).alias("_extra"))
    rows = keyed.select("_range", "_id", "_text", "_tie", F.lit(0).alias("_extra")).unionByName(extra)
    rows = rows.repartition(partitions, "_range").sortWithinPartitions(
        F.asc("_range"), F.asc("_extra"), F.desc_nulls_last("_id"), F.desc("_tie"), F.desc("_text")).drop("_tie")

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = sampler_of()
        out: list[tuple] = []
        held: tuple | None = None  # the document whose next one is still to come
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for at in range(batch.num_rows):
                _, doc_id, text, is_extra = (c[at].as_py() for c in columns)
                print_ = sampler.fingerprint(text)
                if held is not None:
                    held_id, held_text, held_print = held
                    new = edited(held_text, text)
                    new_print = held_print if new == held_text else sampler.fingerprint(new)
                    out.append((held_id, len(held_text), hashlib.sha256(new.encode()).hexdigest(), hexed(held_print),
                                hexed(new_print), float((held_print == new_print).mean()),
                                float((held_print == print_).mean())))
                held = None if is_extra else (doc_id, text, print_)
                if len(out) >= 512:
                    yield _batch(out, names)
                    out.clear()
        if out:
            yield _batch(out, names)

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
