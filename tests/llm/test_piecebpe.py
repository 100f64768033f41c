"""Ids and bytes of the sentencepiece model against the tiktoken library on the same ranks."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.data import documents, empty
from tidemark.llm import piecebpe as B
from tidemark.llm import queries as Q

PATH = public_tokenizers.path(B.VOCABULARY)
TOKENS = B.read_ranks(PATH)
CODEC = B.Codec(B.serialised(TOKENS), public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "own",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks={t: k for k, t in enumerate(TOKENS)},
    special_tokens={},
)


def library_ids(text):
    return np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text("ab c\n'tsrevmld.,!1ü東😀▁⁇Ġ<unk>", max_size=200))
def test_equals_tiktoken(text):
    ids = CODEC.encode(text)
    assert ids == library_ids(text)
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize(
    "text", ["a" * 50_000, "ab" * 20_000, " " * 30_000, "\n \t" * 10_000, "<unk><s></s> <|endoftext|>", "\x00\x1c\x85"]
)
def test_long_and_odd(text):
    assert CODEC.encode(text) == library_ids(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


def test_every_token_is_itself():
    assert B.read_ranks(PATH) == [CODEC.bytes_of[k] for k in range(len(TOKENS))]
    pieces = [CODEC.model.id_to_piece(k) for k in range(len(TOKENS))]
    assert CODEC.model.encode(pieces) == [[k] for k in range(len(TOKENS))]
    assert [CODEC.model.get_score(k) for k in (0, 1, 50_255)] == [0, -1, -50_255]


def test_whole_token_that_no_merge_reaches():
    tokens = [bytes([b]) for b in range(256)] + [b"abc"]
    codec = B.Codec(B.serialised(tokens), r"\S+|\s+")
    want = tiktoken.Encoding(
        "x", pat_str=r"\S+|\s+", mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={}
    )
    for text in ("abc abcd", "abc", "xabc"):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == want.encode_ordinary(text)


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 5)
    codec = B.Codec(B.serialised(TOKENS), public_tokenizers.PATTERN)
    for text in ("one two three", "four five six seven", "a b c d e f g h i j", "one " + "x" * 100):
        assert codec.encode(text) == library_ids(text)
        assert len(codec.known) <= 5


def test_ranks_must_be_whole(tmp_path):
    bad = tmp_path / "ranks"
    bad.write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b"b") + b" 2\n")
    with pytest.raises(ValueError, match="gaps"):
        B.read_ranks(str(bad))


def test_rows_of_all_kinds(spark):
    model = B.Model(spark)
    docs = documents(spark)
    rows = B.decoded(B.encoded(docs, model), model).collect()
    want = [(r["doc_id"], library_ids(r["text"] or ""), (r["text"] or "").encode()) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = [(r["id"], bytes(r["ids"]), bytes(r["data"])) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert B.decoded(B.encoded(empty(spark), model), model).count() == 0


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in Q.table(spark, sf_dir, "documents").collect()}
    df = Q.op11_sentencepiece_bpe(spark, sf_dir)
    rows = df.collect()
    assert dict(df.dtypes)["n_tokens"] == "bigint" and len(rows) == len(texts)
    for r in rows:
        ids = library_ids(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) // 4
        assert r["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
