"""SentencePiece encoding and decoding for merge-type (BPE) models, exact, by backtracking.

A text's symbols are merged by score in such a model. The same tokens are found from left to right: take
the longest piece that starts here (Aho-Corasick), accept it if it and the token before it stay apart when
the two are merged anew, else try the next shorter piece, else mark the position as failed in a bit field
and step back. The model file is read with the sentencepiece library (pieces, scores, byte pieces);
``encode`` of that library is not used. Decoding is the library's ``decode``.

No piece of such a model holds a space mark after another character, and many characters are in no longer
piece at all: no merge crosses those places, so a text is cut there, and each worker keeps the tokens of
short stretches that it has met (at most twice ``CACHE`` of them). Pieces of equal score would be merged from
the left, which pairs can't tell; runs of space marks are such pieces, and are merged directly.

Defined results: null text is encoded as the empty text, which has no ids; characters without a piece
become byte pieces (or the unknown id, if the model has none); any length of text or run is allowed; an
empty table gives no rows; other columns ride along in ``_row``.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: Stretches that each of two generations holds in a worker, and the longest of them.
CACHE = 300_000
CACHED_CHARS = 48


class PieceEncoder:
    """Encoder of one model file; built once per worker."""

    def __init__(self, model_path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = sp.unk_id()
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = sp.get_score(i)
        long = [p for p in self.ids if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in long):
            raise ValueError("pieces that hold a space mark inside are not supported")
        runs = [p for p in long if not p.strip(MARK)]
        words = [p for p in long if p.strip(MARK)]
        if any(p.startswith(MARK * 2) for p in words):
            raise ValueError("pieces with several space marks before text are not supported")
        #: Ties between word pieces can only be settled by merging from the left.
        self.tied = len({self.scores[p] for p in words}) < len(words)
        lowest = min((self.scores[p] for p in words), default=0.0)
        if any(self.scores[p] >= lowest for p in runs):
            raise ValueError("runs of space marks must be merged after words")
        self.runs = set(runs)
        inner = "".join(sorted({c for p in words for c in p} - {MARK}))
        joins = f"[{re.escape(inner)}]" if inner else r"(?!)"
        self.cut = re.compile(f"{MARK}*{joins}+|{MARK}+|[^{re.escape(inner)}{MARK}]", re.S)
        self.automaton = ahocorasick.Automaton()
        for p in words:
            self.automaton.add_word(p, len(p))
        self.words = set(words)
        self.ranks = {p: r for r, p in enumerate(sorted(words, key=lambda p: -self.scores[p]))}
        self.halves: dict[str, tuple[str, str]] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.in_order: dict[str, bool] = {}
        self.packed: dict[str, bytes] = {}
        if words:
            self.automaton.make_automaton()
        self.apart: dict[tuple[str, str], bool] = {}
        self.shorter: dict[str, str] = {}
        #: Ids as the bytes of 32-bit integers: a text's ids are then one join of what its stretches have.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def regular(self, piece: str) -> bool:
        """Whether merging makes this piece, each part of it from pieces of better score."""
        if len(piece) == 1:
            return True
        known = self.in_order.get(piece)
        if known is None:
            known = self.merged(piece, self.words) == [piece]
            if known:
                rank, ranks = self.ranks[piece], self.ranks
                known = all(ranks.get(h, -1) < rank and self.regular(h) for h in self.halves[piece])
            self.in_order[piece] = known
        return known

    def merged(self, text: str, pieces: set[str]) -> list[str]:
        """Plain merging: the pair of the best score first, the leftmost among equals."""
        part: list[str] = list(text)
        left, right = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(part) and (both := part[i] + part[j]) in pieces:
                heapq.heappush(heap, (-self.scores[both], i, both))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i]
            if not part[i] or j >= len(part) or part[i] + part[j] != both:
                continue
            if len(both) == len(text):
                self.halves[text] = (part[i], part[j])
            part[i], part[j] = both, ""
            right[i] = right[j]
            if right[j] < len(part):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in part if p]

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The token and what it was merged from, always the half on ``side``, down to one character, each
        with its rank (characters: -1). For regular pieces."""
        known = self.spines[side].get(token)
        if known is None:
            known, at = [], token
            while len(at) > 1:
                known.append((at, self.ranks[at]))
                at = self.halves[at][side]
            known.append((at, -1))
            self.spines[side][token] = known
        return known

    def stays_apart(self, before: str, token: str) -> bool:
        """Whether ``before`` and ``token`` come out of merging their text anew as they are: their merges
        are undone from the last to the first, and at no time may a merge across their border be due."""
        key = (before, token)
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= 2 * CACHE:
                self.apart.clear()
            known = self.apart[key] = self.border_holds(before, token)
        return known

    def border_holds(self, before: str, token: str) -> bool:
        if not before or not (self.regular(before) and self.regular(token)):
            return self.merged(before + token, self.words) == ([before, token] if before else [token])
        a, b = self.spine(before, 1), self.spine(token, 0)
        i = j = 0
        due = len(self.ranks)  # merges of a lower rank come before the pair in sight is used up
        ranks = self.ranks
        while True:
            (x, x_rank), (y, y_rank) = a[i], b[j]
            if ranks.get(x + y, due) < due:
                return False
            if x_rank > y_rank:
                due = x_rank  # on the left of the border: it goes first among equals
                i += 1
            elif y_rank >= 0:
                due = y_rank + 1  # on the right: an equal merge across the border goes first
                j += 1
            else:
                return True

    def next_shorter(self, token: str) -> str:
        """The longest piece or single character that starts ``token`` and is shorter."""
        known = self.shorter.get(token)
        if known is None:
            n = len(token) - 1
            while n > 1 and token[:n] not in self.words:
                n -= 1
            known = self.shorter[token] = token[:n]
        return known

    def word_pieces(self, text: str) -> list[str]:
        """Tokens of a stretch by backtracking."""
        if len(text) == 1:
            return [text]
        if self.tied:
            return self.merged(text, self.words)
        n = len(text)
        longest = [1] * n
        for end, size in self.automaton.iter(text):
            if size > longest[end - size + 1]:
                longest[end - size + 1] = size
        failed = 0 if n < 4096 else bytearray(n // 8 + 1)  # one bit a position; a plain number in short texts
        small = n < 4096
        apart, shorter = self.apart.get, self.shorter.get
        tokens: list[str] = []
        at, before, token = 0, "", text[:longest[0]]
        while True:
            end = at + len(token)
            open_end = not (failed >> end & 1 if small else failed[end >> 3] >> (end & 7) & 1)
            if open_end and ((ok := apart((before, token))) or ok is None and self.stays_apart(before, token)):
                tokens.append(token)
                if end == n:
                    return tokens
                at, before = end, token
                token = text[at:at + longest[at]]
                continue
            while len(token) == 1:  # nothing shorter starts here: the position fails, step back
                if small:
                    failed |= 1 << at
                else:
                    failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()
                at -= len(token)
                before = tokens[-1] if tokens else ""
            token = shorter(token) or self.next_shorter(token)

    def piece_ids(self, piece: str) -> bytes:
        known = self.packed.get(piece)
        if known is None:
            ids = [self.ids[piece]] if piece in self.ids else (
                [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown])
            known = np.array(ids, dtype=np.int32).tobytes()
            if len(self.packed) < CACHE:
                self.packed[piece] = known
        return known

    def stretch_ids(self, stretch: str) -> bytes:
        """Ids of a run of space marks, a word with the marks before it, or a character that joins nothing."""
        known = self.older.get(stretch)
        if known is not None:
            self.remember(stretch, known)
            return known
        word = stretch.lstrip(MARK)
        marks = len(stretch) - len(word)
        pieces: list[str] = []
        if word:
            pieces = self.word_pieces((MARK if marks else "") + word)
            marks -= bool(marks)
            if pieces[0] == MARK:  # it stayed alone, so it may still join the run
                pieces.pop(0)
                marks += 1
        if marks:
            pieces = self.merged(MARK * marks, self.runs) + pieces
        ids = b"".join(map(self.piece_ids, pieces))
        self.remember(stretch, ids)
        return ids

    def remember(self, stretch: str, ids: bytes) -> None:
        """Two generations: what was not used while the younger filled up is forgotten."""
        if len(stretch) <= CACHED_CHARS:
            if len(self.cache) >= CACHE:
                self.older, self.cache = self.cache, {}
            self.cache[stretch] = ids

    def packed_ids(self, text: str) -> bytes:
        """The text's ids, as the bytes of 32-bit integers."""
        if not text:
            return b""
        get, slow = self.cache.get, self.stretch_ids
        return b"".join([get(s) or slow(s) for s in self.cut.findall(MARK + text.replace(" ", MARK))])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed_ids(text), dtype=np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder_of(model_path: str) -> PieceEncoder:
    """The worker's encoder of this model: later tasks of the same worker find it warm."""
    if model_path not in _ENCODERS:
        _ENCODERS[model_path] = PieceEncoder(model_path)
    return _ENCODERS[model_path]


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text", keep: list[str] | None = None,
                     decoded: bool = True) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: its id) with ``_ids`` (array of int) and ``_decoded``."""
    keep = ["doc_id"] if keep is None else keep
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    fields = [*kept.schema.fields[:-1], T.StructField("_ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField("_decoded", T.StringType()))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model_path)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                ids = [encoder.packed_ids(t) for t in batch.column(len(keep)).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                flat = np.frombuffer(b"".join(ids), dtype=np.int32)
                columns = [*batch.columns[:len(keep)], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decoded:
                    texts = [encoder.decode(np.frombuffer(x, dtype=np.int32).tolist()) for x in ids]
                    columns.append(pa.array(texts, type=pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(run, T.StructType(fields))


def token_report(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    out = encode_documents(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model_path)
    return out.select("doc_id", F.size("_ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("_ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("_decoded", 256).alias("decoded_sha256"))
