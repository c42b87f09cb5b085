"""Token ids in flat binary files.

Format, per part ``part-<number>``:
  ``.bin``  token ids of the part's documents, one after another, unsigned little-endian integers of
            2 bytes (4 if an id needs them)
  ``.idx``  64-bit little-endian integers: where each document's ids begin in the part, then their end
  ``.doc``  64-bit little-endian integers: every document's id (0 for null), then the number of documents
            with null id (they come first)
Parts are in order of document id, documents in a part as well. Manifest rows (part, documents, tokens,
base) are a table beside the files; a part's ``base``, the ids in all parts before it, is a prefix sum over
the parts. Reading maps the files into memory (local and mounted paths) or reads them slice by slice.

Scale: texts are encoded where they lie; one shuffle moves the packed ids (two bytes each) to their ranges of
(document id, text hash), which are cut by quantiles of the ids alone; an id that many rows share, or null, spans
several ranges. A task streams its documents into its files and never holds more than a batch. A file gets its name
only when complete, by a rename, so an attempt that is lost or runs twice leaves nothing half written. The prefix
sum runs over parts, not documents.

Defined results: null text is empty and has the end id alone; null ids come first, equal ids in order of
the text's XXH64 (seed 42, signed), then of their packed ids; equal rows are written once each; an empty table
writes no part. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from pricelens.llm.common import in_ranges, shuffle_partitions, text_slices, written
from pricelens.session import shared_path

END_ID = 1
#: Stretches between white space that each of two generations holds in a worker, and the longest of them.
CACHE = 750_000
CACHED_CHARS = 48
#: A comma or stop before a space that does not follow a letter or digit.
AFTER_SYMBOL = re.compile(r"[.,](?<=[^\w\s][.,]|_[.,])[ \n]")


#: With ``islower``, small letters of Latin scripts, composed already: one word to the tokenizer.
LETTERS = re.compile("[a-zß-öø-ÿā-ɏ]+")
#: Such a word and ASCII marks after it (no apostrophe, which may belong to an ending): two words to the tokenizer.
MARKED = re.compile(rf"({LETTERS.pattern})([!-&(-/:-@\\[-`{{-~]+)?")
#: Words that go to the library in one text.
JOINED = 512
PROBES = "a the unbelievably straße garçon niño ǆ ɏ zzzzqqqq éèêë antidisestablishmentarianism end. wow!!! x_#".split()


class Known(dict):
    """Ids of the stretches met, in two generations. An unknown stretch is noted and gets a buffer, to be filled."""

    def __init__(self, older: dict[str, bytes]):
        super().__init__()
        self.older = older
        self.noted: dict[str, bytearray] = {}

    def __missing__(self, stretch: str) -> bytes | bytearray:
        ids = self.older.get(stretch)
        if ids is not None:
            self[stretch] = ids
            return ids
        return self.noted.setdefault(stretch, bytearray())


def byte_letters() -> dict[int, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as itself, the others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)).difference(shown)))}


class IdPacker:
    """Ids of whole texts as bytes, with the tokenizers library. For a tokenizer that drops white space and
    treats what is between it apart, the library encodes every distinct stretch once. Stretches that are one
    word of letters go straight to the library's model, many in one text."""

    def __init__(self, tokenizer_path: str):
        self.library = Tokenizer.from_file(tokenizer_path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = Known({})
        self.model = Tokenizer.from_file(tokenizer_path)
        self.model.normalizer = None
        self.model.pre_tokenizer = WhitespaceSplit()
        self.bytes = byte_letters()
        self.short_way = self.of_words(PROBES) == self.one_by_one(PROBES)  # the tokenizer treats words as expected

    def one_by_one(self, stretches: list[str]) -> list[bytes]:
        kind = self.dtype.char
        return [array(kind, e.ids).tobytes() for e in self.library.encode_batch(stretches, add_special_tokens=False)]

    def of_words(self, stretches: list[str]) -> list[bytes]:
        """Ids of words of letters, with or without marks behind them."""
        out: list[bytes] = []
        width = self.dtype.itemsize
        for at in range(0, len(stretches), JOINED):
            parts = [MARKED.fullmatch(s).groups() for s in stretches[at:at + JOINED]]
            text = " ".join([w if m is None else f"{w} {m}" for w, m in parts])
            if not text.isascii():
                text = " ".join([w if w.isascii() else w.encode().decode("latin-1").translate(self.bytes) for w in text.split(" ")])
            found = self.model.encode(text, add_special_tokens=False)
            word = np.array(found.word_ids)
            ends = np.r_[0, np.flatnonzero(np.diff(word)) + 1, len(word)]  # of words in ids
            ends = ends[np.cumsum([0, *[1 if m is None else 2 for _, m in parts]])].tolist()  # of stretches
            ids = np.array(found.ids, self.dtype).tobytes()
            out += [ids[a * width:b * width] for a, b in zip(ends, ends[1:])]
        return out

    def learn(self) -> None:
        """Fills the buffers of the stretches noted, and keeps those that may be kept."""
        known, noted = self.known, self.known.noted
        words = [s for s in noted if MARKED.fullmatch(s) and s.islower()] if self.short_way else []
        others = list(noted.keys() - words) if words else list(noted)
        got = [*zip(words, self.of_words(words), strict=True), *zip(others, self.one_by_one(others), strict=True)]
        for s, ids in got:
            noted[s] += ids
        kept = [(s, ids) for s, ids in got if len(s) <= CACHED_CHARS]
        if len(known) + len(kept) > CACHE:
            known = self.known = Known(dict(known))
        known.update(kept[:CACHE])
        known.noted = {}

    def pack(self, texts: list[str]) -> list[bytes]:
        get = self.known.__getitem__
        found = [list(map(get, split_spaces(separated(t)))) for t in texts]
        if self.known.noted:
            self.learn()
        return [b"".join(ids) for ids in found]


def has_separators(text: str) -> bool:
    """Whether the text holds one of the four control codes that only Python takes for white space."""
    return any(c in text for c in "\x1c\x1d\x1e\x1f")


def separated(text: str) -> str:
    """A text of the same ids with fewer distinct stretches: in lower case, where the tokenizer's own (letter by
    letter, after composing accents) gives the same, and then with a space before each comma or stop that
    ends a stretch, if a letter or digit stands before all of them: such marks are split off anyway."""
    # Special tokens keep their letters; a last capital sigma differs; control codes count as marks.
    if "<|" in text or "\u03a3" in text or has_separators(text):
        return text
    low = text.lower()
    if not (text.isascii() or (is_normalized("NFC", text) and is_normalized("NFC", low))):
        return text
    if not AFTER_SYMBOL.search(low):
        low = low.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n").replace(",\n", " ,\n")
    return low


def split_spaces(text: str) -> list[str]:
    """Stretches between white space, as the tokenizer and Python agree on it: all but four control codes."""
    if has_separators(text):
        return [s for s in re.split(r"[ \n\t\r]+", text) if s]
    return text.split()


_PACKERS: dict[str, IdPacker] = {}


def packer_of(path: str) -> IdPacker:
    """The worker's tokenizer: later tasks of the same worker find it warm."""
    if path not in _PACKERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core: more threads only wait for it
        _PACKERS[path] = IdPacker(path)
    return _PACKERS[path]


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of the shared folder and the path in it, for ``file:``, ``hdfs:`` and the like."""
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), uri)


class PartWriter:
    """Writes one part's three files under passing names, and renames them when they are whole."""

    def __init__(self, folder: str, part: int):
        self.fs, self.folder = file_system(folder)
        self.part, self.name, self.mark = part, f"part-{part:06d}", uuid.uuid4().hex
        self.fs.create_dir(self.folder, recursive=True)
        self.out = {kind: self.fs.open_output_stream(self.passing(kind)) for kind in ("bin", "idx", "doc")}
        self.at = self.documents = self.nulls = 0

    def passing(self, kind: str) -> str:
        return f"{self.folder}/_{self.name}-{self.mark}.{kind}"

    def add(self, doc_ids: list[int | None], ids: list[bytes], width: int) -> None:
        """Documents, in order."""
        self.out["bin"].write(b"".join(ids))
        ends = self.at + np.cumsum([0, *map(len, ids)], dtype="<i8") // width
        self.out["idx"].write(ends[:-1].tobytes())
        self.out["doc"].write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
        self.at = int(ends[-1])
        self.documents += len(ids)
        self.nulls += doc_ids.count(None)

    def close(self) -> None:
        for kind, last in (("idx", self.at), ("doc", self.nulls)):
            self.out[kind].write(np.array([last], "<i8").tobytes())
        for kind, out in self.out.items():
            out.close()
            self.fs.move(self.passing(kind), f"{self.folder}/{self.name}.{kind}")


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files of ``docs`` under ``folder`` and returns the manifest: ``part, documents, tokens,
    base, width``, a written table."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_tie"))
    parts = shuffle_partitions(docs.sparkSession)
    rows = in_ranges(rows, parts).select("_range", "_id", "_tie", "_text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = packer_of(tokenizer_path)
        end = np.array([end_id], dtype=packer.dtype).tobytes()
        for batch in batches:
            for some in text_slices(batch, 3, 1 << 20):
                ids = [x + end for x in packer.pack(some.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array(ids, pa.binary())], names=["_range", "_id", "_tie", "_ids"])

    width = (2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else 4)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None

        def finished() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"part": pa.array([out.part], pa.int32()), "documents": [out.documents],
                                               "tokens": [out.at], "width": pa.array([width], pa.int32())})

        for batch in batches:
            part = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)] if len(part) else [0]
            for a, b in zip(cuts, cuts[1:]):
                if out and out.part != part[a]:
                    yield finished()
                    out = None
                out = out or PartWriter(folder, int(part[a]))
                out.add(batch.column(1)[a:b].to_pylist(), batch.column(2)[a:b].to_pylist(), width)
        if out:
            yield finished()

    packed = rows.mapInArrow(encode, "_range int, _id long, _tie long, _ids binary").repartition(parts, "_range")
    packed = packed.sortWithinPartitions("_range", "_id", "_tie", "_ids").select("_range", "_id", "_ids")
    parts = written(packed.mapInArrow(write, "part int, documents long, tokens long, width int"), "id-parts")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per part file
    return parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


def values_of(fs: pafs.FileSystem, path: str, dtype: str) -> Callable[[int, int], np.ndarray]:
    """Reads numbers a to b - 1 of a file: mapped into memory where the file system is local, else read as a slice."""
    if isinstance(fs, pafs.LocalFileSystem):
        mapped = np.memmap(path, dtype=dtype, mode="r") if fs.get_file_info(path).size else np.empty(0, dtype)
        return lambda a, b: mapped[a:b]
    file, width = fs.open_input_file(path), np.dtype(dtype).itemsize
    return lambda a, b: np.frombuffer(file.read_at((b - a) * width, a * width), dtype=dtype)


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start`` (ids of all documents before it), ``n_tokens,
    ids_crc32`` (of its ids as 32-bit little-endian integers). One task reads one part."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name, size = f"{path}/part-{row['part']:06d}", row["documents"]
                ids = values_of(fs, f"{name}.bin", f"<u{row['width']}")
                starts, docs = values_of(fs, f"{name}.idx", "<i8"), values_of(fs, f"{name}.doc", "<i8")
                nulls = docs(size, size + 1)[0]
                for at in range(0, size, 4096):
                    to = min(at + 4096, size)
                    ends = starts(at, to + 1)
                    sums = [zlib.crc32(ids(a, b).astype("<u4").tobytes()) for a, b in zip(ends.tolist(), ends[1:].tolist())]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(docs(at, to), pa.int64(), mask=np.arange(at, to) < nulls),
                        "start": pa.array(row["base"] + ends[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(ends), pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64())})

    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def id_report(docs: DataFrame, tokenizer_path: str, **how) -> DataFrame:
    """``docs`` written to a new folder of the shared place and read back."""
    folder = shared_path(docs.sparkSession, "token-ids")
    return read_ids(write_ids(docs, folder, tokenizer_path, **how), folder)
