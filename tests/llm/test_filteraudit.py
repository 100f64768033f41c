"""The filter audit against a plain simulation of all orders, one document after the other."""

import re
from itertools import permutations

from tests.llm.data import documents, empty
from tidemark.llm import filteraudit as A

METRICS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    return out


def slow(docs, labels):
    """{(part, order, step): metrics} for rows (doc_id, text, part) and labels (doc_id, quality, toxic)."""
    docs = [(i, t or "", p or "") for i, t, p in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, t, p in docs:
        f = fails(t)
        if i is not None and any(j is not None and j < i and u == t for j, u, _ in docs):
            f.add("E")
        rows.append((i, p, f))
    out = {}
    for part in {p for _, p, _ in rows}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[1] == part]
            gone = []
            for k, x in enumerate(order, 1):
                here = [r for r in left if x in r[2]]
                out[part, order, k] = [
                    len(left) - len(here),
                    len(here),
                    sum(x in r[2] for r in gone),
                    sum(r[1] == part and r[2] == {x} for r in rows),
                    sum(r[0] in good for r in here),
                    sum(r[0] in toxic for r in here),
                ]
                left = [r for r in left if x not in r[2]]
                gone += here
                shapley[x] += len(here)
        for (p, order, k), m in out.items():
            if p == part:
                m.append(shapley[order[k - 1]])
    return out


def got(df):
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): [r[m] for m in METRICS] for r in rows}
    assert len(found) == len(rows)
    return found


def test_equals_simulation(spark):
    prose = " ".join(f"w{i}" for i in range(120))
    texts = [
        (1, prose, "en", "a"),
        (2, prose, "en", "a"),
        (2, prose, "fr", "a"),
        (3, prose.upper(), "en", "a"),
        (4, prose + " 5%", "en", "a"),
        (5, "SHORT | one", "fr", "a"),
        (6, "a b " * 80, None, "a"),
        (7, None, None, "a"),
        (8, "", "", "a"),
        (None, prose, "en", "a"),
        (None, None, "en", "a"),
        (9, "A" * 3 + "é" * 27, "fr", "a"),
        (10, "A" * 4 + "é" * 27, "fr", "a"),
        (11, " ".join(["x"] * 20 + [f"y{i}" for i in range(79)]), "en", "a"),
        (12, " ".join(["x"] * 21 + [f"y{i}" for i in range(79)]), "en", "a"),
        (13, " ".join(["x"] * 22 + [f"y{i}" for i in range(79)]), "en", "a"),
    ]
    marks = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (5, None, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    want = slow([(i, t, p) for i, t, p, _ in texts], marks)
    assert got(A.audited(documents(spark, texts), labels)) == want
    assert len(want) == 3 * 600


def test_rows_of_all_kinds(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark)
    want = slow([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], [(1, 1, 0)])
    assert got(A.audited(docs, labels.limit(0))) == {
        k: m[:4] + [0, 0] + m[6:] for k, m in want.items()
    }
    assert got(A.audited(docs, labels)) == want


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audited(empty(spark), labels).count() == 0


def test_hot_text_is_joined_by_its_ids(spark):
    rows = [(i, "same text", "en", "a") for i in range(3000)] + [(None, "same text", "en", "a")] * 500
    cells = {(r["part"], r["mask"]): r["docs"] for r in A.mask_cells(documents(spark, rows), spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int")).collect()}
    assert cells == {("en", 1): 501, ("en", 17): 2999}


def test_more_parts_than_the_session_allows(spark):
    before = spark.conf.get(A.ROW_LIMIT)
    try:
        spark.conf.set(A.ROW_LIMIT, "1000")
        rows = [(i, "a", f"l{i}", "a") for i in range(5)]
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        assert A.audited(documents(spark, rows), labels).count() == 5 * 600
    finally:
        spark.conf.set(A.ROW_LIMIT, before)
