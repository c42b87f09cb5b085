import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelens.llm.queries import PIECE_MODEL
from pricelens.llm.sp_encode import MARK, PieceEncoder, encode_documents, token_report

ENCODER = PieceEncoder(PIECE_MODEL)
PIECES = sorted(ENCODER.ids)


def same(text):
    assert ENCODER.encode(text) == ENCODER.library.encode(text), repr(text)


@settings(max_examples=400, deadline=None)
@given(st.one_of(
    st.text(alphabet="aeinorsth ", max_size=60), st.text(max_size=40),
    st.text(alphabet="ab \n\t.é你😀▁\x00<s>", max_size=80),
    st.lists(st.sampled_from(PIECES), max_size=12).map(lambda p: "".join(p).replace(MARK, " "))))
def test_any_text_as_the_library(text):
    same(text)


@pytest.mark.parametrize("text", ["", " ", " " * 500, "a" * 20000, "Orre" * 5000, " " * 33 + "the", "x" + " " * 17, "\n" * 300])
def test_edges(text):
    same(text)


def test_border_check_is_re_merging():
    for text in ("internationalization", " thereof the others", "unbelievably", "ststst"):
        ENCODER.encode(text)
    for before, token in list(ENCODER.apart)[:3000]:
        again = ENCODER.merged(before + token, ENCODER.words)
        assert ENCODER.apart[before, token] == (again == ([before, token] if before else [token]))


def test_backtracking_without_cuts():
    text = MARK + "the" + "ouringthestreangthening" * 3
    assert ENCODER.word_pieces(text) == ENCODER.merged(text, ENCODER.words)


def digest(text):
    ids = ENCODER.library.encode(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(ENCODER.library.decode(ids).encode()).hexdigest())


def test_report_equals_library(messy, no_docs):
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in token_report(messy, PIECE_MODEL).collect())
    assert got == sorted((r.doc_id or -1, *digest(r.text)) for r in messy.collect())
    assert token_report(no_docs, PIECE_MODEL).collect() == []


def test_other_columns_ride_along(messy):
    out = encode_documents(messy, PIECE_MODEL, keep=["key", "_id", "doc_id"], decoded=False)
    assert out.columns == ["key", "_id", "doc_id", "_ids"] and out.count() == messy.count()
