import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.data import documents, empty
from tidemark.llm import lmscore as M


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=200), st.sampled_from([1, 5, 1000, 2**40]))
def test_elias_fano(values, scale):
    values = np.sort(np.array(values, np.uint64) // np.uint64(scale))
    for s in (M.EliasFano.of(values), M.EliasFano.from_bytes(M.EliasFano.of(values).to_bytes())):
        assert (s.all() == values).all()
        if len(values):
            assert (s.get(np.arange(len(values))) == values).all()
        asked = np.unique(np.concatenate([values, values + np.uint64(1), np.array([0, 2**62], np.uint64)]))
        place = {int(v): k for k, v in reversed(list(enumerate(values)))}
        assert s.find(asked).tolist() == [place.get(int(x), -1) for x in asked]


def test_sent_lists_are_near_the_least_bits():
    """Hashes within a bit of what a set of them takes, counts below the one byte of a number."""
    rng = np.random.default_rng(3)
    for n in (1, 700, 3000, 4097):
        values = np.sort(rng.integers(0, 2**56, n).astype(np.uint64))
        data = M.EliasFano.of(values).to_bytes()
        assert (M.EliasFano.from_bytes(data).all() == values).all()
        assert 8 * len(data) < n * (56 - math.log2(n) + 2.1) + 8 * 16
    counts = rng.geometric(0.8, 3000) - 1
    assert len(M.packed_counts(counts)) < 3000 * 1.6 / 8 < len(M.packed(counts))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 9), max_size=60), st.integers(0, 63))
@example([2**64 - 1], 0)
@example([0, 2**64 - 1], 0)
def test_counts_and_words_come_back(values, shift):
    values = np.array(values, np.uint64) >> np.uint64(shift)
    assert (M.unpacked(M.packed_counts(values)).astype(np.uint64) == values).all()
    words = np.unique(values)
    assert (M.rising_from_bytes(M.rising_to_bytes(words)) == words).all()
    counts = (words % np.uint64(2 * M.RARE)).astype(np.int64) + 1
    order = np.lexsort((words, -counts))
    stored = M.packed_words(words[order], counts[order])
    assert (M.unpacked_words(stored) == words[order]).all()


def test_a_saved_trie_answers_like_the_one_in_memory(tmp_path):
    rng = np.random.default_rng(1)
    words = 30
    pairs = np.unique(rng.integers(0, words, 200) * words + rng.integers(0, words, 200))
    a, b = pairs // words, pairs % words
    triples = [(p, q) for p in range(len(pairs)) for q in np.flatnonzero(a == b[p]) if rng.random() < 0.3]
    prefix, suffix = np.array(sorted(triples)).T
    logs = [-rng.random(n) * 5 for n in (words, len(pairs), len(prefix))]
    trie = M.Trie.build(words, (a, b), (prefix, suffix), logs, [-rng.random(n) for n in (words, len(pairs))])
    with open(tmp_path / "t", "wb") as f:
        trie.save(f)
    mapped = M.Trie.open(str(tmp_path / "t"))
    x, y = (v.ravel() for v in np.meshgrid(np.arange(words), np.arange(words)))
    want = {(int(i), int(j)): k for k, (i, j) in enumerate(zip(a, b))}
    for t in (trie, mapped):
        assert t.bigram(x, y).tolist() == [want.get((int(i), int(j)), -1) for i, j in zip(x, y)]
        assert (t.trigram(prefix, b[prefix], suffix) == np.arange(len(prefix))).all()
    assert np.abs(M.restored(mapped.prob[2]) - logs[2]).max() < 5e-4


def slow(rows, learn, mu):
    texts = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    one, two, three = (collections.Counter() for _ in range(3))
    for k, (_, w) in enumerate(texts):
        if learn[k]:
            one.update(w)
            two.update(zip(w, w[1:]))
            three.update(zip(w, w[1:], w[2:]))
    n, v = sum(one.values()), len(one)
    out = []
    for k, (i, w) in enumerate(texts):
        base = score = 0.0
        for j, x in enumerate(w):
            p = (one[x] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            if j >= 1:
                p = (two[w[j - 1], x] + mu[0] * p) / (one[w[j - 1]] + mu[0])
            if j >= 2:
                p = (three[w[j - 2], w[j - 1], x] + mu[1] * p) / (two[w[j - 2], w[j - 1]] + mu[1])
            score += math.log10(p)
        out.append((i, learn[k], len(w), sum(one[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("sizes", [(40, 50), (M.CHUNK_TOKENS, M.SHARD_GRAMS)])
def test_scores_equal_brute_force(spark, sizes):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    learn = [zlib.crc32(str(i or "").encode()) % 5 != 1 for i, _ in rows]
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    got = M.scored(df, hashed % 5 != 1, chunk_tokens=sizes[0], shard_grams=sizes[1], mu=(8.0, 2.0)).collect()
    key = lambda x: (x[0] is None, str(x[:4]))
    want = sorted(slow(rows, learn, (8.0, 2.0)), key=key)
    have = sorted(
        (
            (r["id"], r["learn"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
            for r in got
        ),
        key=key,
    )
    assert [x[:5] for x in have] == [x[:5] for x in want]
    for a, b in zip(have, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert abs(a[6] - b[6]) < 5e-4 * a[2]


def test_a_stranger_with_the_same_hash_is_not_a_known_3_gram(monkeypatch):
    """At few bits 3-grams that were not learnt get counts, and so do some whose 2-grams have none."""
    monkeypatch.setattr(M, "HASH_BITS", 12)
    monkeypatch.setattr(M, "_KEPT", np.uint64(0xFFF << 52), raising=False)
    rng = np.random.default_rng(1)
    words = np.sort(rng.integers(1, 2**63, 60).astype(np.uint64))
    sizes = np.full(40, 20, "<u4")
    tokens = rng.integers(0, 60, 800).astype(np.uint32)
    learn = (np.arange(40) % 4 > 0).astype(np.uint8)
    chunk = M.Chunk(learn.tobytes(), sizes.tobytes(), words.tobytes(), M.packed(tokens))
    grams = chunk.grams()
    suffix = M.suffixes(chunk, grams)
    totals = []
    for g in grams:  # what the shards answer
        _, place = np.unique(g.hashes, return_inverse=True)
        totals.append(np.bincount(place, g.counts).astype(np.int64)[place])
    two, three = totals[1][grams[1].by_key], totals[2][grams[2].by_key]
    stranger = (three > 0) & ((two[grams[2].keys // 60] == 0) | (two[suffix] == 0))
    assert stranger.any()
    v, n = int((grams[0].counts > 0).sum()), int(grams[0].counts.sum())
    trie = M.trie_of(chunk, grams, suffix, totals, v, n, (8.0, 2.0))
    ids = trie.ids[1].all()
    assert (ids[1:] > ids[:-1]).all()
    kept = (three > 0) & ~stranger
    a, b = grams[1].keys // 60, grams[1].keys % 60
    entry = trie.bigram(a, b)
    prefix = grams[2].keys // 60
    found = trie.trigram(entry[prefix[kept]], b[prefix[kept]], entry[suffix[kept]])
    assert found.tolist() == list(range(kept.sum()))
    assert np.isfinite(M.token_logs(chunk, grams, suffix, trie)).all()


def test_longer_grams_meet_by_all_bits():
    words = np.arange(1, 200, dtype=np.uint64) << np.uint64(40)
    tokens = np.random.default_rng(2).integers(0, 199, 5000).astype(np.uint32)
    chunk = M.Chunk(b"\1", np.array([5000], "<u4").tobytes(), words.tobytes(), M.packed(tokens))
    for g in chunk.grams()[1:]:
        assert (g.hashes & np.uint64(0xFFFF)).any()


def test_nothing_to_learn_from(spark):
    rows = M.scored(documents(spark), F.lit(False)).collect()
    assert {(r["base_score"], r["score"], r["train_tokens"], r["n_known"]) for r in rows} == {(0.0, 0.0, 0, 0)}
    assert M.scored(empty(spark), F.lit(True)).count() == 0


def test_counts_beyond_32_bits():
    """Totals of two chunks that add up to more than 2**32 come back whole."""
    for values in ([], [0], [255, 256], [2**32 - 1], [2**32 + 5, 1], [2**63, 0]):
        want = np.array(values, np.uint64)
        assert (M.unpacked(M.packed(want)).astype(np.uint64) == want).all()
    hashes = np.array([3, 9, 2**63], np.uint64)
    rows = [(c, np.array([2**32 - 1, 7, 2**33 + c], np.int64)) for c in range(2)]
    table = pa.table(
        {
            "shard": [0, 0],
            "chunk": [c for c, _ in rows],
            "level": pa.array([0, 0], pa.int32()),
            "grams": [M.EliasFano.of(hashes - hashes[0]).to_bytes()] * 2,
            "counts": [hashes[0].tobytes() + M.packed(n) for _, n in rows],
        }
    )
    out = {(r["chunk"], r["level"]): r["totals"] for r in M.summed(table).to_pylist()}
    want = [2**33 - 2, 14, 2**34 + 1]
    assert M.unpacked(out[0, 0]).tolist() == want == M.unpacked(out[1, 0]).tolist()
    assert np.frombuffer(out[-1, -1], np.int64).tolist() == [3, sum(want)]


def test_chunks_are_not_shuffled_again(spark):
    """Only the answers meet the chunks by an exchange; the catalogue is left as it was."""
    before = {t.name for t in spark.catalog.listTables()}
    found = M.scored(documents(spark), F.lit(True), chunk_tokens=500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert found.count() == documents(spark).count()
    assert {t.name for t in spark.catalog.listTables()} == before
