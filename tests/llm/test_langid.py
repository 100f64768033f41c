import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, empty
from tidemark.llm import langid as L
from tidemark.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"


def test_ngrams_are_counted_whole_and_in_chunks(monkeypatch):
    text = "Ärger über 12 Bücher, \U0001f600 und MEHR " * 40
    want = np.sort(np.concatenate(list(L.buckets(text))))
    n = len(f" {text} ")
    assert len(want) == n + (n - 1) + (n - 2)
    monkeypatch.setattr(L, "CHUNK", 64)
    assert (np.sort(np.concatenate(list(L.buckets(text)))) == want).all()


def test_posterior_equals_formula(spark):
    docs = spark.createDataFrame(
        [("ab ab", "x"), ("cd", "y"), ("ab cd cd", "y"), (None, "x"), ("zz", None)], "text string, lang string"
    )
    model = L.train(docs, F.lit(True))
    assert model.langs == ["x", "y"]
    counts = np.full((2, 1 << L.BITS), L.SMOOTHING)
    for t, k in (("ab ab", 0), ("cd", 1), ("ab cd cd", 1)):
        for b in L.buckets(t):
            np.add.at(counts[k], b, 1)
    logs = np.log(counts / counts.sum(1, keepdims=True))
    score = np.log([1 / 3, 2 / 3]) + sum(logs[:, b].sum(1) for b in L.buckets("cd ab"))
    want = np.exp(score - score.max())
    assert np.allclose(model.posterior("cd ab"), want / want.sum())


def test_held_out_accuracy(spark):
    got = Q.op5_language_id(spark, SF_DIR).filter("held_out")
    docs = Q.table(spark, SF_DIR, "documents").select("doc_id", "lang")
    right = got.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_too_many_languages_is_an_error(spark):
    docs = spark.createDataFrame([(f"text {i}", f"l{i}") for i in range(5)], "text string, lang string")
    with pytest.raises(ValueError, match="5 languages"):
        L.train(docs, F.lit(True), max_matrix=4 * (1 << L.BITS) * 8)


def test_rows_of_all_kinds(spark):
    docs = documents(spark)
    model = L.train(docs, F.lit(True))
    rows = L.predicted(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang"] for r in rows if r["id"] in (3, 4, 6)} == {L.UNKNOWN}
    nothing = L.train(empty(spark), F.lit(True))
    assert {(r["lang"], r["score"]) for r in L.predicted(docs, nothing).collect()} == {(L.UNKNOWN, 0.0)}
    assert L.predicted(empty(spark), model).count() == 0


def test_signs_that_are_no_letters(spark):
    docs = spark.createDataFrame([("ab ab", "x"), ("cd", "y")], "text string, lang string")
    model = L.train(docs, F.lit(True))
    for text in ("² ½", "① ৴", "12 !?", "", " ", None):
        assert model.predict(text) == (L.UNKNOWN, 0.0)
    for text in ("²a", "ª", "東"):
        assert model.predict(text)[0] in ("x", "y")
