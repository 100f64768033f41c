import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.data import documents, empty
from tidemark.llm import simhash as S


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, radius=3):
    up = list(range(len(ids)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                up[root(a)] = root(b)
    least = defaultdict(list)
    for k, i in enumerate(ids):
        least[root(k)].append(i)
    return [min((i for i in least[root(k)] if i is not None), default=None) for k in range(len(ids))]


@pytest.mark.parametrize("text", [None, "", "A b", "A b C", "a b c d", "é\x85x \x1c y z", "x " * 500])
def test_fingerprint(text):
    assert S.fingerprint((text or "").encode()) == slow_fingerprint(text)


def test_masks_keep_close_numbers_together():
    rng = random.Random(1)
    masks = S.block_masks(3)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    values = np.unique(centre ^ (np.uint64(1) << rng.integers(0, 64, (400, 4)).astype(np.uint64)).sum(1))
    found = {(n, int(q)) for n, near in S.BKTree(values).search(values, 3) for q in near}
    away = np.bitwise_count(values[:, None] ^ values[None, :])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(away <= 3))))


@pytest.mark.parametrize("shard", [3, 4096])
def test_links_and_components(spark, shard):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for f in list(fps):  # chains of near fingerprints, and a crowd around one
        for _ in range(4):
            f ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(f)
    hub = rng.getrandbits(64)
    fps |= {hub ^ (1 << b) for b in range(64)} | {hub}
    fps = sorted(fps)
    df = spark.createDataFrame([(S.signed(f),) for f in fps], "fp long")
    labels = {r["node"]: r["label"] for r in S.components(S.links(df, 3, shard)).collect()}
    ids = [S.signed(f) for f in fps]
    want = slow_components(ids, fps)
    assert [labels.get(i, i) for i in ids] == want


def test_rows_of_all_kinds(spark):
    got = S.near_duplicates(documents(spark)).collect()
    rows = documents(spark).collect()
    ids, fps = [r["doc_id"] for r in rows], [slow_fingerprint(r["text"]) for r in rows]
    key = lambda x: (x[0] is None, str(x))
    want = sorted(zip(ids, map(S.signed, fps), slow_components(ids, fps)), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want
    assert S.near_duplicates(empty(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark)
    kept = S.one_per_component(docs)
    assert kept.schema == docs.schema
    # 2 repeats 1; 4 and 6 have no word, like 3; of the twin rows 8 one stays.
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 3, 5, 7, 8, 9]
    assert kept.filter("doc_id IS NULL").count() == 2
    assert S.one_per_component(empty(spark)).count() == 0
