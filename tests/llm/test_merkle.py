"""Roots and proofs against a tree built in plain Python."""

import hashlib
import zlib

import pytest

from tests.llm.data import documents, empty
from tidemark.llm import merkle as M
from tidemark.llm import queries as Q


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests):
    """All levels, from the leaves to the top."""
    levels = [digests]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([H(*now[i : i + 2]) for i in range(0, len(now), 2)])
    return levels


def path(levels, i):
    """(side, sibling) on the way up; side is None where there is no sibling."""
    out = []
    for now in levels[:-1]:
        j = i ^ 1
        out.append((None, "") if j >= len(now) else ("left" if j < i else "right", now[j]))
        i //= 2
    return out


def fold(leaf, steps):
    for side, sibling in steps:
        leaf = H(sibling, leaf) if side == "left" else H(leaf, sibling)
    return leaf


def slow(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the rows of the query."""
    parts = {}
    for r in rows:
        leaf = H(*map(field, r))
        parts.setdefault(r[2], []).append(((r[0] is not None, r[0] or 0), leaf, r))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: tree([leaf for _, leaf, _ in sorted(parts[p], key=lambda x: x[:2])]) for p in names}
    top = tree([trees[p][-1][0] for p in names])
    out = []
    for k, p in enumerate(names):
        for i, (_, leaf, r) in enumerate(sorted(parts[p], key=lambda x: x[:2])):
            steps = path(trees[p], i) + path(top, k)
            claimed = leaf
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 0:
                claimed = H(*map(field, (*r[:3], None if r[3] is None else r[3] + 1, r[4])))
            folded = fold(claimed, steps)
            root = top[-1][0]
            siblings = H(*[s for side, s in steps if side])
            out.append((r[0], leaf, trees[p][-1][0], root, siblings, folded, folded == root))
    return out


def table_of(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def check(spark, tmp_path, docs):
    got = Q.op12_merkle_manifest(spark, table_of(spark, tmp_path, docs)).collect()
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    want = slow([tuple(r) for r in rows])
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    return want


@pytest.mark.parametrize("sizes", [[1], [2], [3], [1, 1], [5, 1, 2], [1025, 3, 1], [2100]])
def test_trees_of_all_sizes(spark, tmp_path, sizes):
    rows = [(n * 7919 % 100_003, f"t{n}", f"l{p}", "s") for p, k in enumerate(sizes) for n in range(k)]
    want = check(spark, tmp_path, documents(spark, rows))
    assert len(want) == sum(sizes)
    if sum(sizes) > 100:
        assert 0 < sum(not w[-1] for w in want) < len(want)


def test_rows_of_all_kinds(spark, tmp_path):
    check(spark, tmp_path, documents(spark))


def test_largest_number_is_tampered_with(spark, tmp_path):
    docs = documents(spark, [(i, "x", "en", "a") for i in range(40)])
    docs = docs.selectExpr("doc_id", "text", "lang", "source", "9223372036854775807L AS n_chars")
    assert any(not w[-1] for w in check(spark, tmp_path, docs))


def test_many_parts(spark, tmp_path):
    rows = [(i, "x", None if i == 3 else f"p{i % 70}é", "a") for i in range(150)]
    check(spark, tmp_path, documents(spark, rows))


def test_hot_part_and_repeated_rows(spark, tmp_path):
    rows = [(5, "same", "en", "a")] * 700 + [(None, None, "en", "a")] * 30 + [(i, "x", "fr", "b") for i in range(9)]
    check(spark, tmp_path, documents(spark, rows))


def test_empty(spark, tmp_path):
    assert Q.op12_merkle_manifest(spark, table_of(spark, tmp_path, empty(spark))).count() == 0


def test_rounds_double(spark, monkeypatch):
    """A tree of 12 levels is done after four rounds, and few nodes are asked in the last."""
    names = []
    write = M.saved
    monkeypatch.setattr(M, "saved", lambda df, name: names.append(name) or write(df, name))
    leaves = spark.range(2100).selectExpr(
        "'p' AS part", "id", "unhex(sha2(string(id), 256)) AS leaf", "CAST(NULL AS BINARY) AS claimed"
    )
    assert M.proofs(leaves).count() == 2100
    assert [n for n in names if n.startswith("jump")] == ["jump-1", "jump-2", "jump-4", "jump-8", "jump-16"]
