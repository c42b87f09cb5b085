import glob
import zlib

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pyarrow import fs as pafs

from pricelens.llm import binary
from pricelens.llm.queries import WORD_MODEL
from pricelens.session import shared_path

PACKER = binary.IdPacker(WORD_MODEL)


def ids_of(text):
    return PACKER.library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="aB's\u00e9 \n\t\r\x0b\x85\x1c\u0308\u03a3\u03c2\u0130J\u030c.,_*1\u095c<|", max_size=60)), max_size=5))
def test_packed_ids_as_the_library(texts):
    packed = [np.frombuffer(b, PACKER.dtype).tolist() for b in PACKER.pack(texts)]
    assert packed == [ids_of(t) for t in texts]


def text_hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def expected(docs):
    at, out = 0, []
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, text_hash(r.text or ""))):
        ids = [*ids_of(r.text), binary.END_ID]
        out.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=str)


def test_files_read_back_as_the_library_encodes(messy, small_docs, no_docs):
    for docs in (messy, small_docs, no_docs):
        assert sorted((tuple(r) for r in binary.id_report(docs, WORD_MODEL).collect()), key=str) == expected(docs)


def test_file_format(small_docs):
    folder = shared_path(small_docs.sparkSession, "test-ids")
    manifest = binary.write_ids(small_docs, folder, WORD_MODEL).orderBy("part").collect()
    local = folder.removeprefix("file:")
    assert not glob.glob(f"{local}/_part*")  # nothing half written stays
    base, docs = 0, []
    for row in manifest:
        ids = np.memmap(f"{local}/part-{row.part:06d}.bin", dtype="<u2", mode="r")
        starts = np.memmap(f"{local}/part-{row.part:06d}.idx", dtype="<i8", mode="r")
        names = np.memmap(f"{local}/part-{row.part:06d}.doc", dtype="<i8", mode="r")
        assert row.base == base and len(ids) == row.tokens == starts[-1] and len(starts) == row.documents + 1
        assert names[-1] == 0 and all(ids[starts[1:] - 1] == binary.END_ID)
        docs += names[:-1].tolist()
        base += row.tokens
    assert docs == sorted(docs) and len(docs) == small_docs.count()


def test_a_second_attempt_replaces_the_first(tmp_path):
    for ids in (b"\x01\x00", b"\x02\x00\x03\x00"):
        part = binary.PartWriter(str(tmp_path / "out"), 3)
        part.add([None], [ids], 2)
        part.close()
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["part-000003.bin", "part-000003.doc", "part-000003.idx"]
    assert (tmp_path / "out/part-000003.bin").read_bytes() == b"\x02\x00\x03\x00"


def test_hot_and_null_ids_span_parts(spark):
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"row {i} of a table whose ids repeat {i % 11}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = shared_path(spark, "test-hot-ids")
    manifest = binary.write_ids(docs, folder, WORD_MODEL)
    assert max(r.documents for r in manifest.collect()) < 200
    assert sorted((tuple(r) for r in binary.read_ids(manifest, folder).collect()), key=str) == expected(docs)


def test_slices_without_a_map(tmp_path):
    """What a file system gives that cannot be mapped."""
    values = np.arange(1000, dtype="<i8")
    (tmp_path / "x").write_bytes(values.tobytes())
    fs = pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem())
    read = binary.values_of(fs, "x", "<i8")
    assert read(3, 9).tolist() == list(range(3, 9)) and binary.values_of(pafs.LocalFileSystem(), str(tmp_path / "x"), "<i8")(3, 9).tolist() == list(range(3, 9))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abcxyzßàöøÿāɏłœéñ", min_size=1, max_size=30), st.text(alphabet="!#$%&*,.-/:;<=>?@[]^_`{|}~(+", max_size=5))
                .map("".join), min_size=1, max_size=30))
def test_words_by_the_short_way(words):
    assert PACKER.short_way
    assert PACKER.of_words(words) == PACKER.one_by_one(words)


def test_every_letter_by_the_short_way():
    letters = [chr(c) for c in range(0x250) if binary.LETTERS.fullmatch(chr(c)) and chr(c).islower()]
    marks = [chr(c) for c in range(128) if binary.MARKED.fullmatch("a" + chr(c)) and not chr(c).isalpha()]
    words = letters + [a + "a" for a in letters] + ["z" + a for a in letters] + [f"a{m}{n}" for m in marks for n in marks]
    assert PACKER.of_words(words) == PACKER.one_by_one(words)


def test_cache_generations():
    small = binary.IdPacker(WORD_MODEL)
    binary_cache, binary.CACHE = binary.CACHE, 3
    try:
        texts = ["one two three four five six", "six five four three two one seven", "one " * 50 + "x" * 200]
        for _ in range(3):
            assert [np.frombuffer(b, small.dtype).tolist() for b in small.pack(texts)] == [ids_of(t) for t in texts]
    finally:
        binary.CACHE = binary_cache
