import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import drift, snapshots as N
from tidemark.operators.ordered import RANGE, last_so_far, scanned

D = dt.datetime
KEYS = ("zone", "entity_id", "ts", "ft")
EVENTS = "eid int, zone string, ts timestamp_ntz"
FEATS = "entity_id string, ft timestamp_ntz, v int"


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(3)
    base = D(2024, 1, 1)
    # One zone holds most rows; some keys and times are NULL; some times repeat.
    events = [
        (
            i,
            rng.choice(["hot", "hot", "hot", "a", "b", "unknown", None]),
            None if i % 40 == 0 else base + dt.timedelta(hours=rng.randrange(24 * 20)),
        )
        for i in range(500)
    ]
    feats = [
        (
            rng.choice(["hot", "a", "b", None]),
            None if i % 30 == 0 else base + dt.timedelta(hours=rng.randrange(24 * 20)),
            i,
        )
        for i in range(90)
    ]
    return events, feats


def by_rank(left, feats, left_key, feat_key, left_ts, feat_ts):
    """One row per (key, time) the textbook way: rows times versions, then the newest one."""
    hit = (F.col(left_key) == F.col(feat_key)) & (F.col(feat_ts) <= F.col(left_ts))
    pairs = left.join(feats, hit, "left").drop(feat_key)
    rest = [c for c in feats.columns if c not in (feat_key, feat_ts)]
    kept = Window.partitionBy(left_key, left_ts).orderBy(
        F.col(feat_ts).desc_nulls_last(),
        *[F.col(c).desc_nulls_last() for c in rest],
        *[F.col(c) for c in left.columns],
    )
    return pairs.withColumn("_rn", F.row_number().over(kept)).where("_rn = 1").drop("_rn")


@pytest.fixture(params=["one range", "many ranges"])
def ranges(spark, request):
    """Small tables in one range, as adaptive execution leaves them, or in eight."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param == "one range")
    yield
    spark.conf.unset(name)


def brute(events, feats):
    want = []
    for eid, zone, ts in events:
        hits = [
            (ft, v) for e, ft, v in feats if e is not None and e == zone and ft and ts and ft <= ts
        ]
        ft, v = max(hits) if hits else (None, None)
        want.append((eid, ft, ts, v, zone))
    return sorted(want, key=str)


def test_pit_join_equals_brute_force(spark, cases, ranges):
    events, feats = cases
    left, right = spark.createDataFrame(events, EVENTS), spark.createDataFrame(feats, FEATS)
    assert rows_of(N.pit_join(left, right, *KEYS)) == brute(events, feats)


def test_pit_join_splits_a_hot_key(spark, ranges):
    """Nine rows in ten have one key in one hour; more than one range holds it."""
    rng = random.Random(9)
    base = D(2024, 1, 1)
    events = [
        (i, "hot", base + dt.timedelta(seconds=rng.randrange(3600)))
        if i % 10
        else (i, f"z{i % 7}", base + dt.timedelta(hours=rng.randrange(48)))
        for i in range(2000)
    ]
    feats = [("hot", base + dt.timedelta(seconds=60 * k), k) for k in range(30)]
    feats += [(f"z{k % 7}", base + dt.timedelta(hours=k), k) for k in range(30)]
    left, right = spark.createDataFrame(events, EVENTS), spark.createDataFrame(feats, FEATS)
    assert rows_of(N.pit_join(left, right, *KEYS)) == brute(events, feats)
    order = ["zone", "ts"]
    dealt = scanned(left, order, order, "eid", "same", left.schema["eid"].dataType, last_so_far)
    assert dealt.where("eid <> same").count() == 0
    if spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "false":
        assert dealt.where("zone = 'hot'").select(RANGE).distinct().count() > 1


def test_pit_join_splits_equal_times(spark, ranges):
    t = D(2024, 1, 1)
    events = [(i, "hot", t) for i in range(500)]
    feats = [("hot", t, 1), ("hot", t, 2), ("hot", t + dt.timedelta(seconds=1), 3)]
    left, right = spark.createDataFrame(events, EVENTS), spark.createDataFrame(feats, FEATS)
    assert rows_of(N.pit_join(left, right, *KEYS)) == brute(events, feats)


def test_pit_join_dedupe_equals_rank(spark, cases, ranges):
    events, feats = cases
    left = spark.createDataFrame(events, EVENTS)
    right = spark.createDataFrame(feats, FEATS)
    assert rows_of(N.pit_join(left, right, *KEYS, dedupe=True)) == rows_of(
        by_rank(left, right, *KEYS)
    )


def test_pit_join_takes_equal_times(spark, ranges):
    t = D(2024, 1, 5)
    left = spark.createDataFrame([(1, "a", t)], EVENTS)
    right = spark.createDataFrame([("a", t, 7), ("a", t + dt.timedelta(seconds=1), 8)], FEATS)
    assert N.pit_join(left, right, *KEYS).first().v == 7


def test_pit_join_without_versions(spark):
    left = spark.createDataFrame([(1, "a", D(2024, 1, 5))], EVENTS)
    out = N.pit_join(left, spark.createDataFrame([], FEATS), *KEYS).collect()
    assert [(r.eid, r.v) for r in out] == [(1, None)]


def trips(spark, n=400):
    rng = random.Random(5)
    rows = [
        (
            rng.choice(["hot", "hot", "x", "y", None]),
            D(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 30)),
            rng.randrange(0, 900) / 100,
            rng.randrange(3) * 1.0,
            rng.randrange(0, 50) * 1.0,
            rng.randrange(0, 300) / 100,
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "pickup_location_id string, pickup_datetime timestamp_ntz, fare_amount double, "
        "tolls_amount double, trip_distance double, tip_amount double",
    )


def test_zone_stats_equals_fanout(spark):
    snaps = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-29 00:00:00"]
    df = trips(spark)
    fanned = N.snapshot_fanout(
        df.where("trip_distance > 0 AND fare_amount > 0 AND pickup_location_id IS NOT NULL"),
        "pickup_datetime",
        snaps,
    )
    naive = (
        fanned.groupBy(F.col("pickup_location_id").alias("entity_id"), "snapshot")
        .agg(F.count("*").alias("n"), F.round(F.avg("trip_distance"), 6).alias("d"))
        .where("n >= 10")
    )
    got = N.zone_stats(df, snaps).select(
        "entity_id",
        F.col("feature_timestamp").alias("snapshot"),
        F.col("trip_count").alias("n"),
        F.round("avg_distance", 6).alias("d"),
    )
    assert rows_of(got) == rows_of(naive) and got.count() > 3


def test_trip_at_the_snapshot_counts_for_the_next(spark):
    df = trips(spark, 1).withColumns(
        {
            "pickup_location_id": F.lit("z"),
            "pickup_datetime": F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"),
            "fare_amount": F.lit(1.0),
            "trip_distance": F.lit(1.0),
        }
    )
    snaps = ["2024-01-08 00:00:00", "2024-01-15 00:00:00"]
    out = N.zone_stats(df, snaps, min_trips=1).collect()
    assert [str(r.feature_timestamp) for r in out] == ["2024-01-15 00:00:00"]


def test_latest_ignores_null_times(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), 1), ("a", None, 2), ("a", D(2024, 1, 2), 3), ("b", None, 4)], FEATS
    )
    assert rows_of(N.latest_per_entity(df, "entity_id", "ft").select("entity_id", "v")) == [
        ("a", 3),
        ("b", 4),
    ]


def test_drift_simulate_rounds_counts(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), 5)], "entity_id string, ft timestamp_ntz, v bigint"
    )
    out = N.drift_simulate(df, {"v": 0.5}, "ft", "2024-01-01", "2024-02-01")
    assert sorted(r.v for r in out.collect()) == [3, 5]


def test_drift_is_zero_for_a_copy_and_one_for_disjoint(spark):
    rows = [(str(i), D(2024, 1, 1), float(i)) for i in range(50)]
    rows += [(str(i), D(2024, 1, 2), float(i)) for i in range(50)]
    rows += [(str(i), D(2024, 1, 3), float(i) + 1000) for i in range(50)]
    df = spark.createDataFrame(rows, "e string, ft timestamp_ntz, v double")
    same = drift.drift_report(df, ["v"], "ft", "2024-01-01", "2024-01-02").first()
    far = drift.drift_report(df, ["v"], "ft", "2024-01-01", "2024-01-03").first()
    assert (same.deviation, same.drift_detected) == (0.0, False)
    assert (far.deviation, far.drift_detected) == (1.0, True)


def test_histogram_places_edges(spark):
    rows = [("a", D(2024, 1, 1), 0.0), ("b", D(2024, 1, 1), 10.0), ("c", D(2024, 1, 2), -1.0),
            ("d", D(2024, 1, 2), 11.0), ("e", D(2024, 1, 2), 5.0)]
    df = spark.createDataFrame(rows, "e string, ft timestamp_ntz, v double")
    stats = drift.feature_stats(df, ["v"], "ft", "2024-01-01").orderBy("snapshot", "bin").collect()
    assert [r.bin for r in stats] == [1, 10, 0, 6, 11]
