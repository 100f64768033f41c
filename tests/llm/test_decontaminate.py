import random
import re

import pytest

from tests.llm.data import documents, empty
from tidemark.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(text, items, width=13):
    d, hit, names = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(width, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(d) - n + 1):
            if tuple(d[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                names.add(item)
    return len(d), len(hit), sorted(str(x) for x in names if x is not None)


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "東京"]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(draw(rng.choice([1, 2, 5, 12, 13, 14, 30])))) for k in range(20)]
    items += [(3, items[3][1]), (None, " ".join(draw(16))), (90, None), (91, "--- !")]
    docs = []
    for k in range(60):
        w = draw(rng.randrange(0, 80))
        if k % 3 == 0:
            w[10:10] = items[rng.randrange(20)][1].split()
        docs.append((k, "-".join(w).upper() if k % 2 else " ".join(w)))
    docs += [docs[0], (docs[0][0], "other text"), (None, docs[3][1]), (70, None), (71, "")]
    got = D.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        block_bytes=block_bytes,
    ).collect()
    key = lambda x: (x[0] is None, str(x))
    want = []
    for i, t in docs:
        n, hit, names = slow(t, items)
        want.append((i, n, hit, names, hit > 0 and 20 * hit >= n))
    have = [(r["id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)


def test_rows_of_all_kinds(spark):
    docs = documents(spark)
    items = spark.createDataFrame([(1, docs.first()["text"], "x")], "item_id long, text string, n_hit string")
    kept = D.clean(docs, items)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 5, 6, 7, 8, 8, 9]
    assert D.clean(empty(spark), items).count() == 0
    assert D.clean(docs, items.limit(0)).count() == docs.count()
