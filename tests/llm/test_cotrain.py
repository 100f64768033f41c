import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, empty
from tidemark.llm import cotrain as C
from tidemark.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"
META = ["source", "lang", "n_chars"]


def good_label():
    return F.col("quality") == 1


def auc(score, good):
    rank = np.argsort(np.argsort(score)) + 1
    n1, n0 = good.sum(), (~good).sum()
    return (rank[good].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def corpus(spark, n=900, labelled=240):
    """Bad texts hold bad words; nine in ten of them come from one source."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        words = [f"w{rng.randrange(300)}" for _ in range(40)] + [] if good else [f"w{rng.randrange(300)}" for _ in range(38)] + ["spam", "junk"]
        source = ("a" if rng.random() < 0.9 else "b") if good else ("b" if rng.random() < 0.9 else "a")
        rows.append((i, " ".join(words), source, "en", 100, good))
        if i < labelled:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, good boolean")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int")


def test_both_views_learn_and_the_combination_is_calibrated(spark):
    docs, labels = corpus(spark)
    model = C.train(docs, labels, good_label(), META)
    got = C.classified(docs, model, META).join(docs.select(F.col("doc_id").alias("id"), "good"), "id").toPandas()
    good = got["good"].to_numpy()
    assert auc(got["text_score"].to_numpy(), good) > 0.9
    assert auc(got["meta_score"].to_numpy(), good) > 0.85
    assert (got["kept"].to_numpy() == good).mean() > 0.9
    assert abs(got["score"].mean() - good.mean()) < 0.05


def test_a_view_passes_its_labels_on():
    """Few labels teach the words little; the sure view's labels teach them more."""
    rng = random.Random(3)

    def text(good):
        return " ".join(rng.choices([f"{'g' if good else 'b'}{k}" for k in range(400)], k=6)).encode()

    y = np.array([k % 2 for k in range(40)] + [-1] * 600)
    truth = np.array([k % 2 for k in range(640)])
    features = [
        [C.text_features(text(t)) for t in truth],
        [C.meta_features([f"s{t}"]) for t in truth],
    ]
    fold = np.arange(640) // 2 % 4
    scores = []
    for rounds in (0, 3):
        model = C.co_train(features, y, fold, rounds, 0.9)
        scores.append(auc(model.score([C.Rows(f, w) for f, w in zip(features, C.WIDTHS)])[0], truth == 1))
    assert scores[1] > scores[0]


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    rows = C.Rows([(rng.integers(0, 9, 4), rng.random(4)) for _ in range(5)], 9)
    w = rng.random(9)
    dense = np.zeros((5, 9))
    np.add.at(dense, (rows.row, rows.at), rows.value)
    assert np.allclose(rows.dot(w), dense @ w)
    assert np.allclose(rows.back(np.arange(5.0)), dense.T @ np.arange(5.0))


def test_held_out_labels_of_the_tables(spark):
    got = Q.op3_cotrained_quality(spark, SF_DIR)
    labels = Q.table(spark, SF_DIR, "labels")
    rows = got.join(labels, "doc_id").toPandas()
    good = ((rows["quality"] == 1) & (rows["toxic"] == 0)).to_numpy()
    assert auc(rows["score"].to_numpy(), good) > 0.9
    assert got.count() == Q.table(spark, SF_DIR, "documents").count()


def test_rows_of_all_kinds(spark):
    docs, labels = documents(spark), spark.createDataFrame(
        [(1, 1), (1, 0), (2, 1), (4, 0), (8, None), (None, 1)], "doc_id long, quality int"
    )
    model = C.train(docs, labels, good_label(), META)
    rows = C.classified(docs, model, META).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for given, share in ((labels.limit(0), 1.0), (labels.filter("doc_id = 4"), 0.0)):
        none = C.train(docs, given, good_label(), META)
        assert {r["score"] for r in C.classified(docs, none, META).collect()} == {share}
    assert C.classified(empty(spark), C.train(empty(spark), labels, good_label(), META), META).count() == 0


@pytest.mark.parametrize("size", [100, 10_000])
def test_samples_are_bounded(spark, size):
    n = C.sampled(spark.range(5000), "id", size, 1).count()
    assert n == 5000 if size > 5000 else 50 < n < 200
