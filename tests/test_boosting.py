"""Leaf-wise trees against a grower that splits rows one leaf at a time in plain Python."""

import math
import random

import numpy as np
import pytest

from tidemark.operators.boosting import Boosted, Settings, drawn, fit_boosted


def soft(g, l1):
    return math.copysign(max(abs(g) - l1, 0.0), g)


def slow_fit(rows, labels, s):
    """Predictions of the rows: candidate cuts are all values, NULL below them."""
    rows = [[-math.inf if v is None or math.isnan(v) else v for v in r] for r in rows]
    f = [sum(labels) / len(labels)] * len(rows)

    def score(ids, g):
        return soft(sum(g[i] for i in ids), s.l1) ** 2 / (len(ids) + s.l2)

    def split(ids, g):
        best = (s.min_gain, None)
        for k in range(len(rows[0])):
            for cut in sorted({rows[i][k] for i in ids})[:-1]:
                low = [i for i in ids if rows[i][k] <= cut]
                high = [i for i in ids if rows[i][k] > cut]
                if min(len(low), len(high)) < s.min_rows:
                    continue
                gain = score(low, g) + score(high, g) - score(ids, g)
                if gain > best[0] + 1e-9:
                    best = (gain, (low, high))
        return best

    for _ in range(s.rounds):
        g = [a - y for a, y in zip(f, labels)]
        leaves = [(split(range(len(rows)), g), list(range(len(rows))))]
        while len(leaves) < s.leaves:
            leaves.sort(key=lambda x: -x[0][0])
            (_, parts), _ = leaves[0]
            if parts is None:
                break
            leaves = leaves[1:] + [(split(p, g), p) for p in parts]
        for _, ids in leaves:
            value = -s.step * soft(sum(g[i] for i in ids), s.l1) / (len(ids) + s.l2)
            for i in ids:
                f[i] += value
    return f


def sample(n, seed=1):
    rnd = random.Random(seed)
    rows = [[round(rnd.gauss(0, 1), 1), rnd.randrange(5), rnd.choice([None, 0.5, 1.5, math.nan])] for _ in range(n)]
    labels = [3 * (r[0] > 0.3) + r[1] ** 2 * (r[0] < 0) + (r[2] is None) + rnd.gauss(0, 0.3) for r in rows]
    return rows, labels


def frame(spark, rows, labels, parts=3):
    data = [(*map(lambda v: None if v is None else float(v), r), float(y), i) for i, (r, y) in enumerate(zip(rows, labels))]
    return spark.createDataFrame(data, "a double, b double, c double, y double, i long").repartition(parts)


@pytest.mark.parametrize(
    "settings",
    [
        Settings(rounds=3, leaves=6, step=0.5, min_rows=5),
        Settings(rounds=2, leaves=12, step=0.3, min_rows=3, l1=2.0, l2=5.0),
        Settings(rounds=1, leaves=2, min_rows=1),
    ],
)
def test_equals_a_plain_grower(spark, settings):
    rows, labels = sample(150)
    df = frame(spark, rows, labels)
    model = fit_boosted(df, None, ["a", "b", "c"], "y", settings)
    got = {r.i: r.prediction for r in model.transform(df).collect()}
    want = slow_fit(rows, labels, settings)
    assert [got[i] for i in range(150)] == pytest.approx(want, abs=1e-9)
    assert all(sum(c < 0 for c in t.column) <= settings.leaves for t in model.trees)


def test_validation_stops_and_keeps_the_best(spark):
    rows, labels = sample(600, 2)
    train, valid = frame(spark, rows[:400], labels[:400]), frame(spark, rows[400:], labels[400:])
    s = Settings(rounds=30, leaves=8, step=0.8, min_rows=1, patience=3, row_fraction=0.8, row_every=5, column_fraction=0.9)
    model = fit_boosted(train, valid, ["a", "b", "c"], "y", s)
    assert len(model.trees) == int(np.argmin(model.errors)) < 30
    errors = [(r.prediction - r.y) ** 2 for r in model.transform(valid).collect()]
    assert math.sqrt(sum(errors) / len(errors)) == pytest.approx(min(model.errors))
    assert min(model.errors) < model.errors[0] / 2
    assert sum(v for _, v in model.importance()) == pytest.approx(1)
    # The same rows, however they are dealt, and a model that was saved.
    again = Boosted.from_json(model.to_json())
    want = [r.prediction for r in model.transform(valid).orderBy("i").collect()]
    assert [r.prediction for r in again.transform(valid.repartition(7)).orderBy("i").collect()] == want


def test_edge_cases(spark):
    rows, labels = sample(40, 3)
    df = frame(spark, rows, labels)
    same = fit_boosted(df.withColumn("y", df.y * 0 + 7), None, ["a", "b"], "y", Settings(rounds=5))
    assert same.trees == [] and {r.prediction for r in same.transform(df).collect()} == {7.0}
    empty = fit_boosted(df.limit(0), None, ["a"], "y", Settings(rounds=2))
    assert empty.trees == [] and empty.base == 0.0
    nulls = df.selectExpr("CAST(NULL AS DOUBLE) AS a", "IF(i % 2 = 0, y, NULL) AS y")
    assert fit_boosted(nulls, None, ["a"], "y", Settings(rounds=2)).trees == []


def test_rows_are_drawn_evenly():
    key = np.arange(100_000)
    a, b = drawn(key, 1, 0.3), drawn(key, 2, 0.3)
    assert abs(a.mean() - 0.3) < 0.01 and abs((a & b).mean() - 0.09) < 0.01
    assert (drawn(key[::-1], 1, 0.3)[::-1] == a).all()
