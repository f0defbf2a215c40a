"""Byte-level BPE by trie traversal, against the public libraries."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gramsmith.llm import encode as E

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def encoder():
    with open(E.vocabulary_path(), "rb") as f:
        return E.TrieEncoder(E.parse_ranks(f.read()))


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=E.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


def ids(encoder, text):
    return list(encoder.encode([text])[0])


@pytest.mark.parametrize("text", ["", " ", "a", "Flour  and\n\n milk's", "½ dl crème brûlée 卵と小麦粉 👩🏽‍🍳", "<|endoftext|> is text", "x" * 5000, "aàa" * 700, "1234567890" * 40, "\t\r\n   x", "كوب ٣ ﬁn ﻿"])
def test_texts(encoder, library, text):
    assert ids(encoder, text) == library.encode_ordinary(text)


def test_long_words(encoder, library):
    """Words of many kilobytes, some sharing long prefixes; time grows with their length."""
    import random
    import time

    r = random.Random(2)
    base = "".join(r.choice("abcdethinéß") for _ in range(3000))
    for texts in ([base, base + "ing", base[:2000] + "zz" * 300], ["".join(r.choice("theinga") for _ in range(20_000))], ["é" * 4000]):
        got, offsets = encoder.encode(texts)
        assert [list(got[a:b]) for a, b in zip(offsets, offsets[1:])] == [library.encode_ordinary(t) for t in texts]
    began = time.time()
    assert len(ids(encoder, "thequickbrownfox" * 20_000)) > 10_000
    assert time.time() - began < 20


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(encoder, library, text):
    assert ids(encoder, text) == library.encode_ordinary(text)


@given(st.text(alphabet="abthe ing ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_shared_prefixes(encoder, library, text):
    assert ids(encoder, text) == library.encode_ordinary(text)


def test_every_token_round_trip(encoder):
    words = sorted({b for b in encoder.ranks if len(b) > 1})[::7]
    for w, got in zip(words, encoder.traverse(words), strict=True):
        assert b"".join(encoder.bytes[i] for i in got) == w


def test_table(spark, encoder, library):
    rows = [(1, "butter and flour", "x"), (2, None, "x"), (3, "", "x"), (1, "butter and flour", "x"), (4, "  ", "x")]
    got = sorted((r["doc_id"], r["ids"]) for r in E.encode(spark.createDataFrame(rows, "doc_id bigint, text string, ids string"), "doc_id", "text", E.vocabulary_path()).collect())
    assert got == sorted((i, library.encode_ordinary(t or "")) for i, t, _ in rows)
    assert E.encode(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text", E.vocabulary_path()).count() == 0


def test_corpus_equals_libraries(spark, data, library):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in E.encode(docs, "doc_id", "text", E.vocabulary_path()).collect():
        assert r["ids"] == t.encode(texts[r["doc_id"]], add_special_tokens=False).ids == library.encode_ordinary(texts[r["doc_id"]])


def test_other_vocabulary(spark):
    path = E.vocabulary_path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = E.parse_ranks(f.read())
    lib = tiktoken.Encoding("m", pat_str=E.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "Vispa ägg och mjölk, 2½ dl."
    got = E.encode(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), "doc_id", "text", path).first()["ids"]
    assert got == lib.encode_ordinary(text)
