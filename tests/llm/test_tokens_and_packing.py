import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import TEXTS, documents, empty
from tidemark.llm import packing as P
from tidemark.llm import tokens as T
from tidemark.llm.tokens import Encoder, tokenizer_path


@pytest.fixture(scope="module")
def encoder():
    return Encoder()


def whole(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(encoder):
    rng = random.Random(1)
    parts = list("ab \n\t  .,'s1é\x85　\x1c\xa0<|>\r") + ["<|endoftext|>", "'ll", "word", " the", "東京"]
    texts = [t or "" for _, t, *_ in TEXTS]
    texts += ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(3000)]
    small = Encoder(remembered=20)
    for text, a, b in zip(texts, encoder.batches(texts), small.batches(texts)):
        want = whole(encoder, text)
        assert a.tolist() == want and b.tolist() == want


def test_added_tokens_are_those_of_a_fresh_tokenizer():
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|endof", "text|>", " ", "\n", "word", " the", "é"]
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "<|endoftext|>", "a <|endof text|> b"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(500)]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    assert [ids.tolist() for ids in Encoder().batches(texts)] == want


@pytest.mark.parametrize("n", [1, 7, 8, 9, 16, 17])
def test_only_the_first_piece_is_short(n):
    got = P.cut(n, 8)
    assert [a for a, _ in got] == [sum(x for _, x in got[:k]) for k in range(len(got))]
    assert sum(x for _, x in got) == n and all(x == 8 for _, x in got[1:]) and got[0][1] > 0


def test_fullest_equals_all_subsets():
    rng = random.Random(2)
    for _ in range(200):
        counts = [0] * 31
        for _ in range(rng.randrange(9)):
            counts[rng.randrange(1, 31)] += 1
        lengths = [x for x in range(30, 0, -1) if counts[x]]
        sums = {0}
        for x in lengths:
            for _ in range(counts[x]):
                sums |= {s + x for s in sums}
        chosen = P.fullest(counts, 30, lengths)
        assert sum(x * k for x, k in chosen.items()) == max(s for s in sums if s <= 30)
        assert all(k <= counts[x] for x, k in chosen.items())


def test_plan_uses_every_piece_once():
    rng = random.Random(3)
    histogram = Counter(rng.choice([3, 7, 20, rng.randrange(1, 65)]) for _ in range(5000))
    bins = P.plan(dict(histogram), 64)
    used: Counter = Counter()
    for chosen, times in bins:
        assert sum(x * k for x, k in chosen.items()) <= 64
        for x, k in chosen.items():
            used[x] += k * times
    assert used == histogram
    # The sum of lengths is a lower bound, which a third of equal lengths may not allow.
    assert sum(t for _, t in bins) <= 1.01 * sum(x * n for x, n in histogram.items()) / 64


@pytest.mark.parametrize("bucket", [10, 500_000])
def test_pieces_fill_their_bins_without_gaps(spark, encoder, bucket):
    rows = spark.createDataFrame(
        [(i % 50, 0, 0, 1 + i * 7 % 30 if i % 3 else 12, 5) for i in range(900)],
        "id int, piece int, start long, length long, crc32 long",
    )
    got = P.packed(rows, 64, bucket).collect()
    assert Counter(r["length"] for r in got) == Counter(r["length"] for r in rows.collect())
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= 1.02 * sum(r["length"] for r in got) / 64


def test_rows_of_all_kinds(spark, encoder):
    docs = documents(spark)
    pieces = P.token_pieces(docs, capacity=512, with_ids=True)
    by_doc = defaultdict(list)
    for r in pieces.collect():
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["crc32"]
        by_doc[r["id"]].append(r)
    for i, text in {t[0]: t[1] for t in TEXTS if t[0]}.items():
        want = [*whole(encoder, text), P.END_ID]
        rows = sorted(by_doc[i], key=lambda r: r["piece"])[:: 2 if i == 8 else 1]
        assert [x for r in rows for x in r["ids"]] == want
    packed = P.packed(P.saved(pieces, "test"), 512)
    total = sum(len(r["ids"]) for rows in by_doc.values() for r in rows)
    ids = [len(r["ids"]) for r in P.sequences(packed).collect()]
    assert sum(ids) == total and max(ids) <= 512
    assert P.pack_documents(empty(spark)).collect() == []


@pytest.mark.parametrize("remembered, together", [(T.REMEMBERED, T.ARROW_TOGETHER), (40, 300)])
def test_arrow_arrays_as_the_library_has_them(monkeypatch, remembered, together):
    monkeypatch.setattr(T, "ARROW_TOGETHER", together)
    if remembered == 40:
        monkeypatch.setattr(T, "STRUNG", 7)
        monkeypatch.setattr(T, "LEARNT", 3)
    near = ["\u2019", "\u2014", "\x00", "\x1c", "\u200b", "\u2060", "\u00c2"]
    odd = [f"a{x}b c" for x in (*T.ODD_SPACE, *T.RUNS, *near)]
    texts = [
        *(None, "", " ", "\n", "x", " x", "x ", "\nx", "x\n", "x", "\u3000", "x y"),
        *("a <|endoftext|> b", "<|endoftext|>"),
        *odd,
        *("été ça où 東京 \U0001f600 ünï", "don't won't it's\nI'll 'tis", "1 22 333\n55555 x1", "!? ...\n(a)"),
        *(" ".join(f"word{i * k % 97}" for i in range(60)) for k in range(1, 12)),
        *("\n".join(f"l{i % 7} z" for i in range(50)), "x" * 500, "y " * 40 + "y"),
    ]
    encoder = T.ArrowEncoder(remembered=remembered)
    library = T.Encoder().tokenizer
    whole_ = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    sliced = pa.array(["q q", *texts, "r"]).slice(1, len(texts))
    for array in (pa.array(texts), sliced, pa.array(texts, pa.large_string())):
        assert [x.tolist() for x in encoder.batches(array)] == whole_
    assert list(encoder.batches(pa.array([], pa.string()))) == []
    assert [x.tolist() for x in encoder.batches(pa.array([None, ""], pa.string()))] == [[], []]


def test_plain_texts_are_those_that_are_cut():
    rng = np.random.default_rng(3)
    letters = ["a", "é", "東", " ", "\n", "\t", "\u2003", "\u2019", "\u3000", "\xa0", "b", "c", "d", "e", "f"]
    texts = ["".join(rng.choice(letters, int(rng.integers(0, 9)))) for _ in range(3000)]
    cut = [t != "" and T.words_of(t) is not None for t in texts]
    assert any(cut) and T.plain(pa.array(texts)).tolist() == cut
    assert T.plain(pa.array(texts).slice(100, 50)).tolist() == cut[100:150]
