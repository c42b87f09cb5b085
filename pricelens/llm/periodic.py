"""Periodic run detection: stretches of words that repeat with a period, found whole and once each.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of length at
least ``max(min_words, 2 q)`` that no neighbouring word extends keeping the period.

Method. The suffix automaton of a word sequence has a state for every set of end positions; its suffix
links form a tree in which the path from the state of a prefix to the root holds all suffixes of that
prefix. Appending word i gives that path the colour i (link-cut access: the path becomes one preferred
path). Before that, it falls into segments that share a colour j, the last place where their strings ended.
Where d = i - j is one of the lengths of a segment, the suffix of length d ended d words earlier and
nowhere between: a square with a primitive root of d words, and every such square is met this way. The square
is extended to both sides by comparing words d apart, which gives its run; later squares of a run are
known by its end. The link tree does not change any more once the automaton is complete, so the preferred
paths are kept as stacks of (greatest length, colour) along heavy chains instead of splay trees: an access
visits O(log n) chains, and the segments it takes off are paid for by the accesses that put them there.

Only stretches that can hold a run go through the automaton. A run of at least ``min_words`` words repeats k =
ceil(min_words / 2) words at distance q, and all its words lie in such repeated k-grams. Grams are hashed for
a batch of documents at once (equal grams have equal hashes, so nothing is missed); touching repeated grams
are one stretch, and stretches whose grams repeat only outside of it are dropped, until none is left to drop.

Scale: a narrow step without shuffle; a task holds a batch of texts, and the automaton of one stretch at a
time, linear in the stretch's words, which for very long periodic texts is about 1 KB a word. Time is
O(n log n) whatever the text repeats.

Defined results: null text is empty; texts without words have no runs; repeated rows and ids are rows of
their own; an empty table gives no rows. Other columns are ignored. ``edited``: rows with null id stay as
they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import SPACE_CLASS, strip_spaces, text_slices

MIN_WORDS = 12
#: An odd 64-bit number without pattern, base of the rolling hashes.
BASE = 0x9E3779B97F4A7C15

Run = tuple[int, int, int]  # start, length, period


def suffix_links(seq: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton of ``seq``: per state its greatest length and its suffix link, and per prefix its state."""
    moves: list[dict[int, int]] = [{}]
    length, link, ends = [0], [-1], []
    last = 0
    for c in seq:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q, short = moves[p][c], length[p] + 1
            if length[q] != short:
                split = len(moves)
                moves.append(moves[q].copy())
                length.append(short)
                link.append(link[q])
                link[q] = split
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = split
                    p = link[p]
                q = split
            link[new] = q
        last = new
        ends.append(new)
    return length, link, ends


def heavy_heads(length: list[int], link: list[int]) -> list[int]:
    """Per state the top state of its heavy chain in the link tree."""
    order = np.argsort(np.array(length), kind="stable").tolist()
    weight, heavy, most = [1] * len(link), [0] * len(link), [0] * len(link)
    for v in reversed(order[1:]):
        p, w = link[v], weight[v]
        weight[p] += w
        if w > most[p]:
            most[p], heavy[p] = w, v
    head = list(range(len(link)))
    for v in order[1:]:
        p = link[v]
        if p and heavy[p] == v:
            head[v] = head[p]
    return head


def runs_of(seq: list[int], min_words: int = MIN_WORDS) -> list[Run]:
    """All runs of a sequence of word numbers, by start and period."""
    length, link, ends = suffix_links(seq)
    head = heavy_heads(length, link)
    segments: list[list[tuple[int, int]]] = [[] for _ in link]  # of a chain's top: the segment nearest the root is last
    known: dict[int, int] = {}  # period -> end of its latest run
    runs, n = [], len(seq)
    for i, u in enumerate(ends):
        while u:
            top = head[u]
            stack, above, to = segments[top], link[top], length[u]
            low = length[above]
            while stack and low < to:
                reach, colour = stack[-1]
                d = i - colour
                if low < d <= min(reach, to) and i >= known.get(d, 0):
                    s = i - 2 * d + 1
                    while s and seq[s - 1] == seq[s - 1 + d]:
                        s -= 1
                    e = i + 1
                    while e < n and seq[e] == seq[e - d]:
                        e += 1
                    known[d] = e
                    if e - s >= min_words:
                        runs.append((s, e - s, d))
                if reach > to:
                    break
                stack.pop()
                low = reach
            stack.append((to, i))
            u = above
    return sorted(runs, key=lambda r: (r[0], r[2]))


def stretches(owner: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Stretches (start, end) of a batch's words that can hold runs. ``words`` are word hashes of many
    documents one after another, ``owner`` the document of each."""
    k = (min_words + 1) // 2
    n = len(words) - k + 1
    if n <= 0:
        return []
    gram = np.zeros(n, np.uint64)
    for j in range(k):
        gram = gram * np.uint64(BASE) + words[j:j + n]
    at = np.flatnonzero(owner[:n] == owner[k - 1:])  # grams inside one document
    part, gram = owner[at].astype(np.uint64), gram[at]
    while len(at):
        keyed = gram ^ (part + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.argsort(keyed)
        same = keyed[order[1:]] == keyed[order[:-1]]
        repeated = np.zeros(len(at), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        kept, gram_kept = at[repeated], gram[repeated]
        if not len(kept):
            return []
        # A new stretch begins where the words of two neighbouring grams do not touch, or at a new document.
        cut = np.flatnonzero((np.diff(kept) > k) | (owner[kept[1:]] != owner[kept[:-1]])) + 1
        if len(kept) == len(at):
            first, last = np.r_[0, cut], np.r_[cut, len(kept)] - 1
            spans = zip(kept[first].tolist(), (kept[last] + k).tolist())
            return [(a, b) for a, b in spans if b - a >= min_words]
        part = np.zeros(len(kept), np.uint64)
        part[cut] = 1
        part = np.cumsum(part, dtype=np.uint64)
        at, gram = kept, gram_kept
    return []


def batch_runs(texts: list[list[bytes]], min_words: int = MIN_WORDS) -> list[list[Run]]:
    """The runs of each document of a batch, given as words."""
    runs: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = [w for t in texts for w in t]
    hashes = np.fromiter(map(hash, flat), np.int64, len(flat)).view(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    for a, b in stretches(owner, hashes, min_words):
        doc = int(owner[a])
        number: dict[bytes, int] = {}
        seq = [number.setdefault(w, len(number)) for w in flat[a:b]]
        shift = a - int(starts[doc])
        runs[doc] += [(s + shift, n, q) for s, n, q in runs_of(seq, min_words)]
    return runs


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    lost = np.zeros(len(words) + 1, np.int32)
    for s, n, q in runs:
        lost[s + q] += 1
        lost[s + n] -= 1
    keep = np.cumsum(lost[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


RUN_FIELDS = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``runs`` (array of start, length, period, by start and period; words count from 0)
    and ``collapsed``, the text without the repetitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in text_slices(batch, 1):
                words = [t.encode().split() for t in some.column(1).to_pylist()]
                runs = batch_runs(words, min_words)
                ends = np.cumsum([0, *map(len, runs)], dtype=np.int32)
                columns = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3).T
                fields = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(RUN_FIELDS))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.ListArray.from_arrays(pa.array(ends), fields),
                     pa.array([collapsed(w, r).decode() for w, r in zip(words, runs)], pa.string())],
                    names=["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: with h = crc32 of the decimal id and g = h div 10, texts of n > 0 words whose h ends in 0
    repeat from word a = g mod n on with period p = 1 + (n - a) div (3 + g mod 8); their words are then joined
    by one space. Other texts stay as they are."""
    text = F.col(text_col)
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    bare = strip_spaces(text)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       (F.coalesce(h % 10 == 0, F.lit(False)) & (F.coalesce(bare, F.lit("")) != "")).alias("_periodic"),
                       F.floor(h / 10).alias("_g"))

    def repeated(w: Column, g: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat_ws(" ", F.slice(w, 1, a), F.slice(F.flatten(F.array_repeat(
            F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int"))), 1, n - a))

    words = F.split(strip_spaces(F.col("text")), SPACE_CLASS + "+")
    periodic = rows.withColumn("_words", F.when(F.col("_periodic"), words))
    return periodic.select("doc_id", F.when(F.col("_periodic"), repeated(F.col("_words"), F.col("_g")))
                           .otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``find_runs``: number of runs, the greatest (ties: smallest start, then period) and digests."""
    found = find_runs(docs, min_words)
    runs = F.col("runs")
    greatest = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    found = found.withColumn("_most", greatest)
    most = F.col("_most")
    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), (-most["start"]).alias("start"),
        most["length"].alias("length"), (-most["period"]).alias("period"),
        F.floor(1000 * most["length"] / -most["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
