"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import math

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.data import documents, empty
from tests.llm.test_decontaminate import slow as contaminated_by
from tests.llm.test_hostrules import slow as measure
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.oracle import compare, connect
from tidemark.llm import queries as Q
from tidemark.llm import secrets
from tidemark.llm.tokens import Encoder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, con, name):
    verdict, detail = compare(Q.QUERIES[name](spark, SF_DIR), con, Q.SQL[name])
    assert verdict == "ok", detail


def test_all_are_registered():
    names = set(entry.queries())
    assert {"pipeline", *Q.QUERIES} <= names
    assert {int(n[2:].split("_")[0]) for n in Q.QUERIES} == set(range(1, 11)) | {11, 12, 13}
    assert set(Q.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_every_document_has_a_row(spark, name):
    ids = [r["doc_id"] for r in Q.QUERIES[name](spark, SF_DIR).select("doc_id").collect()]
    want = Q.table(spark, SF_DIR, "documents").count()
    assert len(set(ids)) == want and (len(ids) == want or name.startswith("op7_"))


def slow_pipeline(docs, benchmark):
    """What is left of (doc_id, text, source) rows, with their token numbers."""
    rows = []
    for i, text, source in docs:
        m = measure(text)
        n = m["n_words"]
        base = n < 50 or 100 * m["n_repeat_words"] > 50 * n
        soft = (
            10 * m["n_symbols"] > n
            or 10 * m["n_dup_lines"] > 3 * m["n_lines"]
            or not 3 * n <= m["word_chars"] <= 10 * n
        )
        rows.append((i, text, source, base, soft))
    hosts = {}
    for *_, source, base, soft in rows:
        n, f = hosts.get(source, (0, 0))
        hosts[source] = n + 1, f + (base or soft)
    own = [f / n for n, f in hosts.values()]
    m = sum(f for _, f in hosts.values()) / len(rows)
    v = sum(x * x for x in own) / len(own) - 2 * m * sum(own) / len(own) + m * m
    s = max(1.0, m * (1 - m) / v - 1)
    bad = {h for h, (n, f) in hosts.items() if (f + m * s) / (n + s) > 0.5}
    rows = [(i, t) for i, t, h, base, soft in rows if not base and not (h in bad and soft)]
    ids = [i for i, _ in rows]
    component = slow_components(ids, [slow_fingerprint(t) for _, t in rows])
    rows = [r for r, c in zip(rows, component) if r[0] == c]
    kept = []
    for i, t in rows:
        n, hit, _ = contaminated_by(t, benchmark)
        if not (hit > 0 and 20 * hit >= n):
            kept.append((i, secrets.redact(t)))
    tokenizer = Encoder().tokenizer
    return {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept}


def test_pipeline_equals_brute_force(spark):
    docs = Q.table(spark, SF_DIR, "documents").select("doc_id", "text", "source").collect()
    benchmark = [tuple(r) for r in Q.table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    want = slow_pipeline([tuple(r) for r in docs], benchmark)
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    got: dict = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want and 0 < len(want) < len(docs)
    sizes: dict = {}
    for r in rows:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert max(sizes.values()) <= 2048 and len(sizes) <= math.ceil(sum(want.values()) / 2048) + 1


def test_stages_take_rows_of_all_kinds(spark):
    for start in (documents, empty):
        docs = start(spark)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
            after = stage(spark, docs, SF_DIR)
            if k < len(corpus_pipeline.STAGES):
                assert after.dtypes == docs.dtypes
            # Each stage gets all kinds of rows, not only what others keep.
            assert after.count() <= (docs.count() if k < len(corpus_pipeline.STAGES) else 1000)
