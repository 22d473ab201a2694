"""Token ids against the public library, and an exact round trip."""

from __future__ import annotations

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayledger.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.isdir(bpe.DEFAULT_DIR), reason="no vocabulary")
ODD = ["", " ", "\n\n", "a", "<|endoftext|>", "x" * 3000, "ab1" * 900, " " * 700 + "z", "日本語 🙂🙂", "it's we've 're", "a\r\n\tb", "½ — \x00 ", "é" * 600]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary.load(), keep=50)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{bpe.DEFAULT_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def split(ids, counts):
    at, out = 0, []
    for n in counts:
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_odd_texts(encoder, library):
    assert split(*encoder.encode(ODD)) == [e.ids for e in library.encode_batch(ODD, add_special_tokens=False)]


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(max_size=60), max_size=8))
def test_any_text(encoder, library, texts):
    assert split(*encoder.encode(texts)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_text_longer_than_a_chunk(encoder, library):
    text = "One two, três 4. " * 70_000
    assert split(*encoder.encode([text]))[0] == library.encode(text, add_special_tokens=False).ids


def test_long_pieces_agree_with_short_ones(encoder):
    word = "unverständlichkeiten" * 20
    raw = encoder.v.of_byte[list(word.encode())]
    out, n = bpe._merge_matrix(raw[None, :], encoder.table)
    assert bpe._merge_long(raw, encoder.table).tolist() == out[0, : n[0]].tolist()


def test_documents(spark, library):
    df = spark.createDataFrame([(1, "hello world", 5), (1, "hello world", 6), (2, None, 7), (3, "", 8), (None, "a", 9)], "doc_id long, text string, ids int")
    got = sorted(((r.doc_id, r.ids) for r in bpe.encode_documents(df).collect()), key=str)
    hello = library.encode("hello world", add_special_tokens=False).ids
    assert got == sorted([(1, hello), (1, hello), (2, []), (3, []), (None, library.encode("a").ids)], key=str)
    assert bpe.encode_documents(df.where("false")).count() == 0


def test_whole_table_round_trip(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    ids = {r.doc_id: r.ids for r in bpe.encode_documents(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        assert library.decode(ids[r.doc_id], skip_special_tokens=False) == (r.text or "")
