"""Quality classifier by co-training.

Two logistic models see two views of a document. The content view is its words and punctuation runs,
hashed to ``DIM`` buckets (square roots of their shares), with the shares of the commonest and of distinct
tokens. The page view is metadata and layout: language, source, length, lines, words, the shares of
letters, capitals, digits, spaces, punctuation and bytes beyond ASCII, and how often a word repeats the
one before it, never which words they are.

Training works on a bounded sample: at most ``LABELLED`` labelled documents and ``POOL`` unlabelled ones,
both those of least id hash, so it does not grow with the corpus; only their features reach the driver. A
quarter of the labelled ones is held out. In each of ``ROUNDS`` rounds both models are fitted; each gives its
most confident predictions on the pool, in the classes' proportion, to the *other* model's training set as
pseudo-labels. At the end each view's margin is calibrated (Platt) on the held-out quarter, and the mean
of the two calibrated log-odds scores every document, whole, in one pass.

Defined results: null text is empty; null ``lang`` and ``source`` are values of their own; labels with null
id or class are left out, repeated ones averaged; ids without a document do nothing; without labels of both
classes every document scores the labels' mean (1 without labels); an empty table gives no rows.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import written

DIM = 1024
PAGE_DIM = 64
LABELLED = 4000
POOL = 4000
ROUNDS = 4
#: Pseudo-labels per round and model, and how sure it must be of each.
GIVEN = 400
SURE = 0.9
STEPS = 150
PENALTY = 1e-5
REJECT = 0.5

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
#: Bytes by kind: other ASCII, capital, small letter, digit, space, line end, punctuation, beyond ASCII.
KINDS = 8


def _byte_kinds() -> np.ndarray:
    kind = np.zeros(256, dtype=np.uint8)
    for b in range(256):
        c = chr(b)
        kind[b] = (7 if b > 127 else 1 if c.isupper() else 2 if c.islower() else 3 if c.isdigit() else
                   5 if c == "\n" else 4 if c.isspace() else 6 if c.isprintable() else 0)
    return kind


KIND = _byte_kinds()
#: Token buckets that a worker remembers.
_BUCKETS: dict[str, int] = {}
REMEMBERED = 300_000


def _bucket(token: str) -> int:
    if len(_BUCKETS) >= REMEMBERED:
        _BUCKETS.clear()
    b = _BUCKETS[token] = zlib.crc32(token.encode()) % DIM
    return b


def content_view(text: str) -> np.ndarray:
    tokens = TOKEN.findall(text)
    x = np.zeros(DIM + 3, dtype=np.float32)
    if tokens:
        get = _BUCKETS.get
        counts = np.bincount([b if (b := get(t)) is not None else _bucket(t) for t in tokens], minlength=DIM)
        x[:DIM] = np.sqrt(counts / len(tokens))
        x[DIM] = counts.max() / len(tokens)
        x[DIM + 1] = len(set(tokens)) / len(tokens)
    x[DIM + 2] = 1
    return x


def page_view(text: str, lang: str | None, source: str | None) -> np.ndarray:
    data = text.encode()
    x = np.zeros(PAGE_DIM, dtype=np.float32)
    n = max(1, len(data))
    kinds = np.zeros(KINDS)
    for at in range(0, len(data), 1 << 20):
        kinds += np.bincount(KIND[np.frombuffer(data, np.uint8, min(1 << 20, len(data) - at), at)], minlength=KINDS)
    words, lines = max(1.0, kinds[4] + kinds[5]), kinds[5] + 1
    x[:KINDS] = kinds / n
    x[KINDS:2 * KINDS] = np.sqrt(kinds / n)
    x[16:21] = [1, np.log1p(n) / 10, np.log1p(lines) / 10, np.log1p(n / lines) / 10, np.log1p(n / words) / 5]
    x[21] = kinds[1] / max(1.0, kinds[1] + kinds[2])
    x[22] = min(1.0, kinds[6] / words)
    parts = data.split()
    x[23] = sum(map(operator.eq, parts, parts[1:])) / max(1, len(parts))
    x[24 + zlib.crc32(f"lang {lang}".encode()) % 8] = 0.3
    x[32 + zlib.crc32(f"source {source}".encode()) % 32] = 0.3
    return x


def fit(x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None, steps: int = STEPS) -> np.ndarray:
    """Logistic weights by full-batch Adam."""
    w = np.zeros(x.shape[1], dtype=np.float32) if start is None else start.copy()
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, steps + 1):
        g = x.T @ (sigmoid(x @ w) - y) / np.float32(len(y)) + np.float32(PENALTY) * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = (w - 0.3 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class CoTrained:
    """Weights of both views, and (slope, shift) that calibrate their margins."""
    weights: tuple[np.ndarray, np.ndarray] | None
    scale: tuple[tuple[float, float], tuple[float, float]]
    constant: float = 1.0

    def score(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(views[0]), self.constant)
        odds = [a * (x @ w) + b for x, w, (a, b) in zip(views, self.weights, self.scale, strict=True)]
        return sigmoid((odds[0] + odds[1]) / 2)


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift, fitted by Newton steps on Platt's softened targets."""
    good = y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    spread = float(margin.std()) or 1.0
    z = np.stack([margin / spread, np.ones_like(margin)], axis=1).astype(np.float64)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(z @ w)
        g = z.T @ (p - target) + 1e-3 * w
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, g), -1, 1)
    return float(w[0]) / spread, float(w[1])


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray],
             rounds: int = ROUNDS) -> CoTrained:
    """Both views of the labelled rows, their labels, and both views of the pool."""
    none = ((1.0, 0.0), (1.0, 0.0))
    if len(set(y.tolist())) < 2:
        return CoTrained(None, none, float(y.mean()) if len(y) else 1.0)
    held = np.arange(len(y)) % 4 == 3
    if len(y) < 40 or len(set(y[held].tolist())) < 2:
        held = np.zeros(len(y), dtype=bool)
    own = [v[~held] for v in views]
    known, share = y[~held].astype(np.float32), float(y[~held].mean())
    told: list[dict[int, float]] = [{}, {}]  # pool row -> pseudo-label, per learner
    weights: list[np.ndarray | None] = [None, None]

    def refit(learner: int) -> np.ndarray:
        extra = sorted(told[learner])
        x = np.vstack([own[learner], pool[learner][extra]]) if extra else own[learner]
        return fit(x, np.concatenate([known, [told[learner][i] for i in extra]]).astype(np.float32), weights[learner])

    for _ in range(rounds):
        weights = [refit(0), refit(1)]
        for teacher in (0, 1):
            p = sigmoid(pool[teacher] @ weights[teacher]) if len(pool[teacher]) else np.empty(0)
            free = [i for i in np.argsort(-p, kind="stable").tolist() if i not in told[1 - teacher]]
            good = [i for i in free[:round(GIVEN * share)] if p[i] >= SURE]
            bad = [i for i in free[::-1][:GIVEN - round(GIVEN * share)] if p[i] <= 1 - SURE]
            told[1 - teacher] |= dict.fromkeys(good, 1.0) | dict.fromkeys(bad, 0.0)
    weights = [refit(0), refit(1)]
    at = held if held.any() else ~held
    scale = tuple(platt(v[at] @ w, y[at]) for v, w in zip(views, weights, strict=True))
    return CoTrained(tuple(weights), scale)


def _text(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name == "text" else F.col(name).cast("string")


def sample_views(docs: DataFrame, ids: list[int], id_col: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Features of the named documents (a bounded list), computed on the executors: one row per id, of rows that
    repeat it the one of the least hash of its text, then of all three columns."""
    if not ids:
        return {}
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(i,) for i in ids], "_id long"))
    rows = docs.select(F.col(id_col).alias("_id"), *[_text(c).alias(c) for c in ("text", "lang", "source")])
    rows = rows.join(wanted, "_id", "left_semi")
    least = F.struct(F.xxhash64("text").alias("_h"), F.xxhash64("text", "lang", "source").alias("_g"), "text", "lang", "source")
    rows = rows.groupBy("_id").agg(F.min(least).alias("_row")).select("_id", "_row.text", "_row.lang", "_row.source")

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            one = [np.concatenate([content_view(t), page_view(t, la, so)]).tobytes()
                   for t, la, so in zip(f["text"], f["lang"], f["source"])]
            yield pd.DataFrame({"_id": f["_id"], "_x": one})

    got = rows.mapInPandas(features, "_id long, _x binary").toPandas()
    out = {}
    for i, x in zip(got["_id"].tolist(), got["_x"]):
        x = np.frombuffer(x, dtype=np.float32)
        out[i] = (x[:DIM + 3], x[DIM + 3:])
    return out


def least_hashed(ids: DataFrame, wanted: int) -> DataFrame:
    """The ``wanted`` rows of least hash of ``_id`` (distinct), or all if there are fewer.

    Hashes are even, so a bound on them that follows from the count leaves little more than ``wanted`` rows: the
    sort sees these alone, not ``wanted`` of every partition. Should the bound leave too few, all are sorted.
    """
    ids = written(ids, "quality-ids")
    by_hash = F.xxhash64(F.lit("sample"), "_id")
    share = (wanted + 8 * wanted**0.5 + 50) / max(1, ids.count())
    if share < 0.5:
        near = ids.where(by_hash < F.lit(round(share * 2**64) - 2**63))
        if near.count() >= wanted:
            ids = near
    return ids.orderBy(by_hash, "_id").limit(wanted)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          labelled: int = LABELLED, pool: int = POOL) -> CoTrained:
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).where(
        F.col("_id").isNotNull() & F.col("_y").isNotNull()).groupBy("_id").agg(F.avg("_y").alias("_y"))
    ids = docs.select(F.col(id_col).alias("_id")).where("_id is not null")
    rows = least_hashed(known.join(ids.distinct(), "_id", "left_semi"), labelled).collect()
    others = least_hashed(ids.join(known, "_id", "left_anti").distinct(), pool).collect()
    views = sample_views(docs, [r["_id"] for r in rows] + [r["_id"] for r in others], id_col)

    def stacked(some: list) -> tuple[np.ndarray, np.ndarray]:
        got = [views[r["_id"]] for r in some if r["_id"] in views]
        return (np.array([g[0] for g in got], np.float32).reshape(-1, DIM + 3),
                np.array([g[1] for g in got], np.float32).reshape(-1, PAGE_DIM))

    rows = [r for r in rows if r["_id"] in views]
    y = np.array([float(r["_y"] >= 0.5) for r in rows])
    return co_train(stacked(rows), y, stacked(others))


def scored(docs: DataFrame, model: CoTrained, text_col: str = "text") -> DataFrame:
    """``docs`` as ``_row``, with ``_content, _page`` (calibrated probabilities of the views) and ``_score``."""
    rows = docs.select(F.struct("*").alias("_row"), *[_text(c).alias(c) for c in ("text", "lang", "source")])
    names = ["_content", "_page", "_score"]
    schema = "_content double, _page double, _score double"

    @F.pandas_udf(schema)
    def score(frames: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, lang, source in frames:
            out = []
            for at in range(0, len(text), 256):
                cut = slice(at, at + 256)
                views = (np.stack([content_view(t) for t in text[cut]]),
                         np.stack([page_view(t, a, b) for t, a, b in zip(text[cut], lang[cut], source[cut])]))
                p = [sigmoid(a * (x @ w) + b) for x, w, (a, b) in zip(views, model.weights, model.scale)] \
                    if model.weights else [model.score(views)] * 2
                out.append(np.stack([*p, model.score(views)], axis=1))
            yield pd.DataFrame(np.vstack(out) if out else np.empty((0, 3)), columns=names)

    return rows.select("_row", score("text", "lang", "source").alias("_s")).select("_row", "_s.*")


def quality_report(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """Per document: ``doc_id, content_score, page_score, score, keep``."""
    model = train(docs, labels)
    return scored(docs, model).select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_content").alias("content_score"),
        F.col("_page").alias("page_score"), F.col("_score").alias("score"), (F.col("_score") >= reject).alias("keep"))


def good_documents(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``docs`` without those that score below ``reject``; the same columns."""
    return scored(docs, train(docs, labels)).where(F.col("_score") >= reject).select("_row.*")

