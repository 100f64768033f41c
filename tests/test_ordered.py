import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import encode, metrics, ordered, profile, snapshots, trials


@pytest.fixture(params=["one range", "many ranges"])
def ranges(spark, request):
    """Small tables in one range, as adaptive execution leaves them, or in eight."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param == "one range")
    yield
    spark.conf.unset(name)


@pytest.mark.parametrize("how", ["sum", "max"])
def test_scan_before_equals_loop(spark, how, ranges):
    rng = random.Random(7)
    keys = rng.sample(range(-5000, 5000), 300)
    rows = [(k / 4, rng.randrange(100)) for k in keys]
    df = spark.createDataFrame(rows, "k double, v bigint")
    got = {r.k: r.before for r in ordered.scan_before(df, "k", "v", "before", how).collect()}
    for k, _ in rows:
        below = [v for x, v in rows if x < k]
        want = sum(below) if how == "sum" else max(below, default=None)
        assert got[k] == want


def test_scan_before_text_keys(spark, ranges):
    df = spark.createDataFrame([("it's",), ("b\\c",), ("é",), ("",)], "k string").withColumn(
        "v", F.lit(1)
    )
    got = {r.k: r.n for r in ordered.scan_before(df, "k", "v", "n").collect()}
    assert got == {"": 0, "b\\c": 1, "it's": 2, "é": 3}


def test_head_tail_split_cuts_by_order(spark, ranges):
    df = spark.range(101).select((100 - F.col("id")).alias("id"))
    out = encode.head_tail_split(df, ["id"], 0.9)
    assert sorted(r.id for r in out.where("part = 'predict'").collect()) == list(range(90, 101))
    assert encode.head_tail_split(df.limit(0), ["id"], 0.9).count() == 0
    assert encode.head_tail_split(df, ["id"], 1.0).where("part = 'predict'").count() == 0


def test_auc_counts_ties_half(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (None, 0.3)]
    df = spark.createDataFrame(rows, "y int, s double")
    out = metrics.binary_metrics(df, "y", "s").first()
    assert out.roc_auc == 0.875 and out.precision == round(2 / 3, 6) and out.recall == 1.0


def test_pareto_front_equals_brute_force(spark, ranges):
    rng = random.Random(1)
    rows = [(i, float(rng.randrange(40)), float(rng.randrange(40))) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, cost double, comfort double")
    got = {r.i for r in trials.pareto_front(df, "cost", "comfort").collect()}
    want = {
        i
        for i, c, f in rows
        if not any((c2 <= c and f2 >= f) and (c2 < c or f2 > f) for _, c2, f2 in rows)
    }
    assert got == want


def test_describe_reads_its_input_once(spark, tmp_path):
    spark.range(50).selectExpr("id % 7 AS a", "id * 2 AS b", "cast(id as string) AS c").write.parquet(
        str(tmp_path / "t")
    )
    df = spark.read.parquet(str(tmp_path / "t"))
    seen = []
    real = ordered.freeze
    ordered.freeze = lambda x, name: (seen.append(x._jdf.queryExecution().optimizedPlan()), real(x, name))[1]
    try:
        out = profile.describe(df, ["a", "b", "c"])
    finally:
        ordered.freeze = real
    path = str(tmp_path / "t")
    assert sum(str(p.toString()).count("Relation [") for p in seen) == 1
    assert path not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r.cnt for r in out.orderBy("column_name").collect()] == [50, 50, 50]


def test_describe_small_column(spark, ranges):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (4.0, "b"), (None, None)], "x double, t string")
    t, x = profile.describe(df, ["x", "t"]).orderBy("column_name").collect()
    assert (x.cnt, x["min"], x.p25, x.p50, x.p75, x["max"]) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert (t.cnt, t.distinct_values, t.top, t.freq) == (3, 2, "a", 2)


def test_null_and_distinct_counts(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "y")], "a int, b string")
    assert {tuple(r) for r in profile.null_counts(df).collect()} == {("a", 1, 3), ("b", 1, 3)}
    assert {tuple(r) for r in profile.distinct_counts(df).collect()} == {("a", 1), ("b", 2)}
    assert profile.distinct_counts(df, approx=True).count() == 2


def test_distinct_counts_of_all_types(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (0.0D, -0.0D, 1.50, true, DATE'2024-01-01', TIMESTAMP'2024-01-01', TIMESTAMP_NTZ'2024-01-01', X'00', array(1), 'a'),
        (-0.0D, double('NaN'), 1.5, null, DATE'2024-01-01', null, null, X'01', array(1), 'A'),
        (1.0D, double('NaN'), null, false, null, TIMESTAMP'2024-01-02', null, X'00', null, 'a ')
        AS t(d, n, m, b, day, at, wall, raw, list, `a b`)"""
    )
    want = {c: df.select(F.countDistinct(f"`{c}`")).first()[0] for c in df.columns}
    assert {r.column_name: r.distinct_values for r in profile.distinct_counts(df).collect()} == want
    assert want["d"] == want["n"] == 2
    only = df.select("raw", "list")
    assert {tuple(r) for r in profile.distinct_counts(only).collect()} == {("raw", 2), ("list", 1)}
    none = {tuple(r) for r in profile.distinct_counts(df.limit(0)).collect()}
    assert none == {(c, 0) for c in df.columns}


def test_scans_keep_nulls_and_batches(spark):
    """Values that are missing, and ranges that come in many batches."""
    rng = random.Random(5)
    rows = [(k, rng.choice([None, rng.randrange(-50, 50)])) for k in range(400)]
    df = spark.createDataFrame(rows, "k int, v int")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "7")
    try:
        for how, fold in (("sum", sum), ("max", lambda x: max(x, default=None))):
            got = {r.k: r.b for r in ordered.scan_before(df, "k", "v", "b", how).collect()}
            assert got == {k: fold([v for x, v in rows[:k] if v is not None]) for k, _ in rows}
        with_time = df.selectExpr("k % 3 AS e", "k AS t", "v")
        left = spark.range(400).selectExpr("id % 3 AS e", "id + 0.5 AS at")
        feats = with_time.where("v IS NOT NULL").selectExpr("e AS entity", "double(t) AS t", "v")
        got = {r["at"]: r.v for r in snapshots.pit_join(left, feats, "e", "entity", "at", "t").collect()}
        for i in range(400):
            below = [v for k, v in rows if k % 3 == i % 3 and k <= i and v is not None]
            assert got[i + 0.5] == (below[-1] if below else None)
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize("what", ["describe", "pit_join", "metrics", "split", "front"])
def test_rows_are_shuffled_once(spark, monkeypatch, what):
    """Into ranges; what follows moves one row per range, column or key alone."""
    written = []
    real = ordered.freeze

    def freeze(df, name):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(ordered, "freeze", freeze)
    df = spark.range(500).selectExpr("id % 9 AS e", "id AS t", "double(id % 50) AS v", "int(id % 2) AS y")
    if what == "describe":
        out = profile.describe(df, ["e", "v"])
    elif what == "pit_join":
        out = snapshots.pit_join(df.drop("y"), df.selectExpr("e AS f", "t AS ft", "y"), "e", "f", "t", "ft")
    elif what == "metrics":
        out = metrics.binary_metrics(df, "y", "v")
    elif what == "split":
        out = encode.head_tail_split(df, ["t"])
    else:
        out = trials.pareto_front(df, "v", "t")
    assert len(written) == 1 and written[0].count("Exchange rangepartitioning") == 1
    after = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in after and "Window [last(_inside" not in after
    if what == "pit_join":
        assert written[0].count("Exchange") == 1
        # The totals of the ranges, their order, and their broadcast.
        assert after.count("Exchange") == 3
