import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning as C
from tidemark.operators import customers as U

D = dt.datetime
DATES = ["2011-06-01", "2011-07-01"]
SCHEMA = (
    "customer_id string, invoice string, stock_code string, quantity int, price double, "
    "invoice_date timestamp_ntz, country string"
)


def line(customer, invoice, when, country="UK", amount=10.0, stock="s1"):
    return (customer, invoice, stock, 1, amount, when, country)


def lines(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clean(spark, rows):
    return C.clean_transactions(lines(spark, rows))


@pytest.fixture(scope="module")
def random_tx(spark):
    rng = random.Random(7)
    rows = [
        line(
            f"c{rng.choice([0, 0, 0, 1, 2, 3])}",
            f"i{rng.randrange(60)}",
            D(2011, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 240)),
            rng.choice(["UK", "FR", "DE"]),
            rng.randrange(1, 5000) / 100,
            f"s{rng.randrange(9)}",
        )
        for _ in range(600)
    ]
    return clean(spark, rows).cache()


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_clean_drops_unknown_cancelled_and_unpaid(spark):
    when = D(2011, 1, 1)
    rows = [
        line("a", "1", when),
        line(None, "2", when),
        line("a", "C3", when),
        line("a", "4C4", when),
        line("a", "5", when, amount=0.0),
        line("a", "6", when, amount=-1.0),
    ]
    assert [r.invoice for r in clean(spark, rows).collect()] == ["1"]


def test_anomaly_counts(spark):
    when = D(2011, 1, 1)
    rows = [line("a", "C1", when), line("a", "2", when, amount=-1.0), line("a", "3", when)]
    counts = dict(map(tuple, C.anomaly_counts(lines(spark, rows)).collect()))
    assert counts == {
        "cancelled": 1,
        "negative_quantity": 0,
        "negative_price": 1,
        "quantity_below_one": 0,
        "any": 2,
    }


def test_window_borders(spark):
    p = D(2011, 7, 1)
    day = dt.timedelta(days=1)
    inside = {"a": p - 90 * day, "b": p - day, "c": p - day + dt.timedelta(minutes=1)}
    outside = {"z": p - 91 * day, "d": p}
    tx = clean(spark, [line("x", k, v) for k, v in {**inside, **outside}.items()])
    found = {r.invoice for r in U.lookback_lines(tx, DATES[1:], 90).collect()}
    assert found == {"a", "b", "c"}
    at_midnight = U.lookback_lines(tx, DATES[1:], 90, window="timestamp")
    assert {r.invoice for r in at_midnight.collect()} == {"a", "b"}
    ahead = {"e": p, "f": p + 29 * day + dt.timedelta(hours=12), "g": p + 30 * day}
    tx = clean(spark, [line("x", k, v) for k, v in ahead.items()])
    assert {r.invoice for r in U.forward_lines(tx, DATES[1:], 30).collect()} == {"e", "f"}


def test_anchors_need_an_earlier_purchase(spark):
    tx = clean(spark, [line("a", "1", D(2011, 6, 1)), line("b", "2", D(2011, 1, 1))])
    got = {(r[0], str(r[1])) for r in U.make_anchors(tx, DATES).collect()}
    assert got == {("a", "2011-07-01"), ("b", "2011-06-01"), ("b", "2011-07-01")}


def test_anchor_rewrite_equals_cross_join(spark, random_tx):
    dates = spark.createDataFrame([(d,) for d in DATES], "d string").select(
        F.to_date("d").alias("prediction_date")
    )
    naive = (
        random_tx.crossJoin(dates)
        .where("date < prediction_date")
        .select("customer_id", "prediction_date")
        .distinct()
    )
    assert rows_of(naive) == rows_of(U.make_anchors(random_tx, DATES))


def test_general_range_join_equals_generator(random_tx):
    anchors = U.make_anchors(random_tx, DATES)
    assert rows_of(U.lookback_join(anchors, random_tx, 90)) == rows_of(
        U.lookback_lines(random_tx, DATES, 90)
    )


def test_forward_join_keeps_anchors_without_lines(spark):
    tx = clean(spark, [line("a", "1", D(2011, 5, 1)), line("b", "2", D(2011, 6, 5)),
                       line("b", "3", D(2011, 1, 5))])
    out = U.forward_join(U.make_anchors(tx, DATES[:1]), tx, 30)
    assert {(r.customer_id, r.invoice) for r in out.collect()} == {("a", None), ("b", "2")}


def test_one_reading_equals_separate_aggregates(random_tx):
    joined = U.lookback_lines(random_tx, DATES, 90)
    by = "purchase_amount_by_"
    separate = U.assemble(
        U.base_features(joined),
        U.activity_features(joined),
        U.second_level_stats(U.invoice_summary(random_tx), "invoice_amount", f"{by}invoice", DATES),
        U.second_level_stats(U.date_summary(random_tx), "date_amount", f"{by}date", DATES),
    )
    assert rows_of(U.customer_features(random_tx, DATES)) == rows_of(separate)


def test_invoice_across_the_border_counts_whole_or_cut(spark):
    rows = [
        line("a", "1", D(2011, 6, 30, 10), amount=5.0),
        line("a", "1", D(2011, 7, 2), amount=7.0),
    ]
    tx = clean(spark, rows)
    whole = U.customer_features(tx, DATES[1:]).first()
    assert whole.purchase_amount_by_invoice_max == 12.0 and whole.purchase_amount_sum == 5.0
    rows[0] = line("a", "1", D(2011, 6, 30), amount=5.0)
    cut = U.customer_features(clean(spark, rows), DATES[1:], window="timestamp").first()
    assert cut.purchase_amount_by_invoice_max == 5.0


def test_mode_tie_goes_to_the_latest(spark):
    df = lines(
        spark,
        [
            line("a", "1", D(2011, 1, 1), "UK"),
            line("a", "2", D(2011, 1, 3), "FR"),
            line("a", "3", D(2011, 1, 2), "DE"),
            line("a", "4", D(2011, 1, 9), None),
        ],
    )
    out = U.mode_of(df, ["customer_id"], "country", "invoice_date", "mode")
    assert out.first().mode == "FR"


def test_target_left_and_inner(random_tx):
    full = U.training_set(random_tx, DATES)
    assert full.where("target IS NULL").count() == 0
    inner = U.concat_folds(random_tx, DATES)
    assert inner.where("target <= 0").count() == 0
    assert inner.count() <= full.count() == U.customer_features(random_tx, DATES).count()


def test_merge_windows_keeps_all_customers(spark):
    tx = clean(spark, [line("a", "1", D(2011, 6, 20)), line("b", "2", D(2011, 5, 10))])
    parts = {
        d: U.activity_features(U.lookback_lines(tx, DATES[1:], d)).select(*U.KEYS, "record_cnt")
        for d in (30, 60)
    }
    rows = {tuple(r) for r in U.merge_windows(parts).collect()}
    assert rows == {("a", 1, 1), ("b", None, 1)}


def test_folds_repeat_rows_per_role(spark):
    df = spark.createDataFrame([("a", "2011-06-01"), ("b", "2011-09-01")], "c string, d string")
    df = df.select("c", F.to_date("d").alias("prediction_date"))
    folds = {"f1": {"train": ["2011-06-01"]}, "f2": {"valid": ["2011-06-01"]}}
    rows = {(r.c, r.fold, r.role) for r in U.time_series_folds(df, folds).collect()}
    assert rows == {("a", "f1", "train"), ("a", "f2", "valid")}


def test_split_label_is_null_outside(spark):
    df = spark.createDataFrame([("2011-06-01",), ("2012-01-01",)], "d string").select(
        F.to_date("d").alias("d")
    )
    out = C.split_label(df, "d", {"TRAIN": ["2011-06-01"]}).orderBy("d").collect()
    assert [r.split_label for r in out] == ["TRAIN", None]


def test_feature_columns_exact_and_substring(spark):
    df = spark.createDataFrame(
        [("a", 1, 2, 3, "UK")],
        "customer_id string, date_min int, purchase_amount_by_date_min int, target int, "
        "country_mode string",
    )
    exact = C.feature_columns(df)
    assert exact == (["purchase_amount_by_date_min", "country_mode"], ["country_mode"])
    assert C.feature_columns(df, substring=True)[0] == ["country_mode"]


def test_placeholder_rows_and_nulls_are_dropped(spark):
    df = spark.createDataFrame([("a", "x"), (" ?", "x"), (None, "x"), ("b", "?")], "w string, o string")
    assert [r.w for r in C.exclude_placeholder(df, ["w", "o"]).collect()] == ["a"]


def test_hash_sample_keeps_equal_values_together(spark):
    df = spark.range(4000).withColumn("ts", F.timestamp_seconds(F.col("id") % 50))
    kept = C.hash_sample(df, "ts", 10).groupBy("ts").count().collect()
    assert {r["count"] for r in kept} <= {80} and 0 < len(kept) < 20


def test_keyword_search_ignores_case(spark):
    df = spark.createDataFrame([(i, f"Big Query {i}") for i in range(9)], "t int, p string")
    out = C.keyword_search(df, "p", "bIG", "t", ["t"], 5)
    assert [r.t for r in out.collect()] == [8, 7, 6, 5, 4]


def test_merged_sketches_find_the_mode(spark):
    rows = [("a", f"c{k % (1 + d % 7)}", dt.date(1998, 1, 1) + dt.timedelta(days=d)) for d in range(90) for k in range(40)]
    rows += [("b", None, dt.date(1998, 2, 1)), ("b", "x", dt.date(1998, 2, 1)), ("c", None, dt.date(1998, 2, 1))]
    tx = spark.createDataFrame(rows, "customer_id string, country string, date date")
    sketches = U.daily_sketches(tx, "country")
    assert sketches.count() == 91
    got = {(r.customer_id, str(r.prediction_date)): (r.mode, r.n) for r in U.approx_mode(sketches, ["1998-02-01", "1998-04-01"], 90).collect()}
    counts: dict = {}
    for c, v, d in rows:
        for p in (dt.date(1998, 2, 1), dt.date(1998, 4, 1)):
            if v and p - dt.timedelta(days=90) <= d < p:
                key = c, str(p)
                counts.setdefault(key, {}).setdefault(v, 0)
                counts[key][v] += 1
    assert got == {k: max(v.items(), key=lambda x: x[1]) for k, v in counts.items()}


def test_sketches_of_many_values_keep_their_bound(spark):
    """Of 2,000 values, one is a tenth of all: it is found, and its estimate is not too low."""
    rows = [("a", f"v{k % 2000}" if k % 10 else "hot", dt.date(1998, 1, 1 + k % 28)) for k in range(20_000)]
    tx = spark.createDataFrame(rows, "customer_id string, country string, date date")
    (r,) = U.approx_mode(U.daily_sketches(tx, "country"), ["1998-02-01"], 90).collect()
    assert r.mode == "hot" and 2000 <= r.n <= 2000 + 20_000 * 3.5 / 128
