"""Encoding and decoding against the sentencepiece library."""

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm import pieces
from tests.llm.shared import documents, read

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = [
    "", " ", "  ", "a", "Hello  wörld\n ▁x \t日本\U00020000", "\x00a", " a  ", "▁", "a▁▁b", "aaaaaaaaaaaaa", "<s></s><unk><0x0A>",
    "1234567890", "�", "é", "\U0001f600\U0001f600", "a" * 5000, "ab" * 3000, "the " * 3000, "\n\n\n", "    indented", "=" * 777,
]


def ours(texts):
    got = list(pieces._encoded(PATH, True, pa.array(texts, pa.string())))
    return [x for g in got for x in g[0].to_pylist()], [x for g in got for x in g[1].to_pylist()]


def expected(texts):
    ids = LIBRARY.encode([t or "" for t in texts])
    return ids, [LIBRARY.decode(i) for i in ids]


def test_odd_texts():
    assert ours([*ODD, None]) == expected([*ODD, None])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text("aehilnorst ▁\n", max_size=80), max_size=6))
def test_any_texts(texts):
    assert ours(texts) == expected(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31999) | st.integers(0, 300), max_size=30))
def test_any_ids_decode_as_the_library_does(ids):
    assert pieces.decode_slice(pieces.load(PATH), np.array(ids, int), np.array([len(ids)])) == [LIBRARY.decode(ids)]


def test_no_character_reaches_over_a_control_id():
    rows = [[197, 1, 131], [300, 197, 2, 131, 300], [229, 156, 1, 168], [1, 197, 131, 2], [1, 35, 300, 197, 1], [197, 0, 131], [1, 2], []]
    ids, counts = np.array([i for r in rows for i in r], int), np.array([len(r) for r in rows])
    assert pieces.decode_slice(pieces.load(PATH), ids, counts) == [LIBRARY.decode(r) for r in rows]


def test_whole_table(spark):
    docs = read(spark, "documents")
    rows = pieces.encode(docs, PATH, decoded_col="decoded").collect()
    ids, texts = expected([r["text"] for r in rows])
    assert [r["ids"] for r in rows] == ids
    assert [r["decoded"] for r in rows] == texts


def test_decoding_rows_and_null_ids(spark):
    rows = pieces.encode(documents(spark, ["one  two", None, ""]), PATH).selectExpr("if(doc_id = 1, null, ids) ids", "Text_", "text")
    got = {r["text"]: r["decoded"] for r in pieces.decode(rows, PATH).collect()}
    assert got == {"one  two": "one  two", None: "", "": ""}


def test_empty_table(spark):
    assert pieces.encode(documents(spark, ["a"]).limit(0), PATH, decoded_col="d").count() == 0
