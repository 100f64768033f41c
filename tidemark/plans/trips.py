"""Trips: preparation, sampling, zone statistics, point-in-time joins, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cleaning as C
from tidemark.operators import drift as D
from tidemark.operators import metrics
from tidemark.operators import snapshots as N
from tidemark.plans.adapters import (
    FEATURES,
    PREPARED,
    SNAPSHOTS,
    TRIPS,
    ZONES,
    Tables,
    hash_sql,
    zone_sql,
)
from tidemark.plans.registry import query, with_ctes
from tidemark.session import freeze, shared_dir


def zones(t: Tables):
    return N.zone_stats(t.trips(), SNAPSHOTS)


def zone_table(t: Tables):
    """The statistics as the stored table that training reads."""
    return freeze(zones(t), "zone_stats")


@query("prepare_trips", with_ctes(PREPARED, select="SELECT * FROM prepared"))
def _(t: Tables):
    return C.prepare_trips(t.trips())


@query("sample_rows")
def _(t: Tables):
    return C.sample_rows(C.prepare_trips(t.trips()), 0.1)


@query(
    "hash_sample",
    with_ctes(TRIPS, select=f"SELECT * FROM trips WHERE {hash_sql('pickup_datetime')} % 10 = 0"),
)
def _(t: Tables):
    return C.hash_sample(t.trips(), "pickup_datetime", 10)


def farm_steps(source: str, text: str) -> list[str]:
    """CTEs that give each row of ``source`` the fingerprint r of a text of 17 to 32 bytes,
    by arithmetic modulo 2**64."""
    m, k1, k2 = (f"{n}::UHUGEINT" for n in (2**64, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F))

    def word(at: str) -> str:
        bytes_ = f"[ascii(s[{at} + k + 1])::UHUGEINT * (1::UHUGEINT << (8 * k)::UHUGEINT) FOR k IN range(8)]"
        return f"list_reduce({bytes_}, lambda p, q: p + q)"

    def turn(x: str, bits: int) -> str:
        return f"(({x}) // {2**bits}::UHUGEINT + ({x}) % {2**bits}::UHUGEINT * {2 ** (64 - bits)}::UHUGEINT)"

    def fold(x: str) -> str:
        return f"xor({x}, {x} // {2**47}::UHUGEINT)"

    return [
        f"s0 AS (SELECT *, {text} AS s, ({k2} + (2 * strlen({text}))::UHUGEINT) % {m} AS f FROM {source})",
        f"s1 AS (SELECT *, {word('0')} * {k1} % {m} AS a, {word('8')} AS b, "
        f"{word('strlen(s) - 8')} * f % {m} AS c, {word('strlen(s) - 16')} * {k2} % {m} AS d FROM s0)",
        f"s2 AS (SELECT *, ({turn(f'(a + b) % {m}', 43)} + {turn('c', 30)} + d) % {m} AS y, "
        f"(a + {turn(f'(b + {k2}) % {m}', 18)} + c) % {m} AS z FROM s1)",
        f"s3 AS (SELECT *, xor(y, z) * f % {m} AS x FROM s2)",
        f"s4 AS (SELECT * REPLACE (xor(z, {fold('x')}) * f % {m} AS x) FROM s3)",
        f"s5 AS (SELECT *, {fold('x')} * f % {m} AS r FROM s4)",
    ]


TIME_TEXT = (
    "(regexp_replace(strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f'), '\\.000000$|000$', '') || '+00')"
)


@query(
    "fingerprint_sample",
    with_ctes(
        TRIPS,
        *farm_steps("trips", TIME_TEXT),
        select=f"""
SELECT event_id, pickup_datetime FROM s5
WHERE CASE WHEN r >= {2**63}::UHUGEINT THEN {2**64}::UHUGEINT - r ELSE r END % 10 = 0""",
    ),
)
def _(t: Tables):
    """The rows that the warehouse's own fingerprint picks."""
    found = C.hash_sample(t.trips(), "pickup_datetime", 10, fingerprint="farm")
    return found.select("event_id", "pickup_datetime")


@query(
    "sample_blocks",
    """
SELECT (SELECT count(*) FROM events) AS n_all, true AS some_but_not_all, true AS whole_files,
  true AS the_same_again""",
)
def _(t: Tables):
    """Trips written in 64 files, of which a quarter is drawn, twice."""
    path = shared_dir(t.spark, "blocks")
    t.trips().repartition(64, "event_id").withColumn("block", F.spark_partition_id()).write.parquet(path)
    whole = t.spark.read.parquet(path).groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    drawn = C.sample_blocks(t.spark, path, 0.25)
    per_block = drawn.groupBy("block").agg(F.count(F.lit(1)).alias("got"))
    again = C.sample_blocks(t.spark, path, 0.25).agg(F.count(F.lit(1))).scalar()
    both = whole.join(per_block, "block", "left").withColumn("again", again)
    return both.agg(
        F.sum("n").alias("n_all"),
        ((F.count("got") > 0) & (F.count("got") < F.count("n"))).alias("some_but_not_all"),
        F.every(F.coalesce(F.col("got") == F.col("n"), F.lit(True))).alias("whole_files"),
        (F.sum("got") == F.max("again")).alias("the_same_again"),
    )


@query("outlier_filter", with_ctes(PREPARED, select="SELECT * FROM prepared WHERE tip_amount < 50"))
def _(t: Tables):
    return C.outlier_filter(C.prepare_trips(t.trips()), "tip_amount", 50)


@query(
    "safe_ratio",
    with_ctes(TRIPS, select="SELECT event_id, tip_amount / nullif(tolls_amount, 0) AS ratio FROM trips"),
)
def _(t: Tables):
    from tidemark.functions.scalars import safe_ratio

    return t.trips().select("event_id", safe_ratio("tip_amount", "tolls_amount").alias("ratio"))


@query(
    "rmse",
    with_ctes(
        PREPARED,
        select="""
SELECT round(sqrt(avg((tip_amount - trip_distance / 10) * (tip_amount - trip_distance / 10))), 6)
         AS rmse, count(*) AS n
FROM prepared""",
    ),
)
def _(t: Tables):
    rows = C.prepare_trips(t.trips()).withColumn("guess", F.col("trip_distance") / 10)
    return metrics.rmse(rows, "tip_amount", "guess")


SNAP_VALUES = ", ".join(f"(TIMESTAMP '{s}')" for s in SNAPSHOTS)


@query(
    "snapshot_fanout",
    with_ctes(
        TRIPS,
        select=f"""
SELECT event_id, pickup_datetime, snapshot FROM trips
CROSS JOIN (VALUES {SNAP_VALUES}) AS s(snapshot) WHERE pickup_datetime < snapshot""",
    ),
)
def _(t: Tables):
    rows = t.trips().select("event_id", "pickup_datetime")
    return N.snapshot_fanout(rows, "pickup_datetime", SNAPSHOTS)


@query(
    "union_years",
    with_ctes(
        TRIPS,
        select="""
SELECT event_id, pickup_datetime FROM trips
WHERE pickup_datetime >= TIMESTAMP '2024-01-01' AND pickup_datetime < TIMESTAMP '2024-01-15'
UNION ALL
SELECT event_id, pickup_datetime FROM trips
WHERE pickup_datetime >= TIMESTAMP '2024-01-15' AND pickup_datetime < TIMESTAMP '2024-01-29'""",
    ),
)
def _(t: Tables):
    rows = t.trips().select("event_id", "pickup_datetime")
    parts = [(rows, "2024-01-01", "2024-01-15"), (rows, "2024-01-15", "2024-01-29")]
    return N.union_years(parts, "pickup_datetime")


@query("zone_stats", with_ctes(ZONES, select="SELECT * FROM zones"))
def _(t: Tables):
    return zones(t)


@query(
    "zone_stats_sampled",
    with_ctes(
        TRIPS,
        zone_sql(where=f"{hash_sql('pickup_datetime')} % 10 = 0"),
        select="SELECT * FROM zones",
    ),
)
def _(t: Tables):
    """With the sampling step that belongs to the statistic."""
    return N.zone_stats(t.trips(), SNAPSHOTS, sample_mod=10)


LATEST = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY feature_timestamp DESC) AS rn
  FROM zones) WHERE rn = 1"""


@query("latest_per_entity", with_ctes(ZONES, select=LATEST))
def _(t: Tables):
    return N.latest_per_entity(zones(t), "entity_id", "feature_timestamp")


@query(
    "row_number_top1",
    with_ctes(
        TRIPS,
        select="""
SELECT * EXCLUDE (rn) FROM (
  SELECT event_id, pickup_location_id, payment_type, pickup_datetime, fare_amount,
         row_number() OVER (PARTITION BY pickup_location_id, payment_type
                            ORDER BY pickup_datetime DESC, event_id DESC) AS rn
  FROM trips) WHERE rn = 1""",
    ),
)
def _(t: Tables):
    cols = ["event_id", "pickup_location_id", "payment_type", "pickup_datetime", "fare_amount"]
    part = ["pickup_location_id", "payment_type"]
    return N.top1(t.trips().select(*cols), part, [F.col("pickup_datetime"), F.col("event_id")])


@query(
    "sort_filtered",
    with_ctes(
        ZONES,
        select="SELECT * FROM zones WHERE entity_id = (SELECT min(entity_id) FROM zones)",
    ),
)
def _(t: Tables):
    """History of one entity: the first by name."""
    stats = zones(t)
    first = stats.agg(F.min("entity_id")).scalar()
    return N.entity_history(stats, "entity_id", first, "feature_timestamp")


PIT = """
SELECT t.event_id, t.pickup_location_id, t.pickup_datetime, z.feature_timestamp, z.trip_count,
       z.avg_fare, z.avg_distance, z.tip_rate
FROM trips t ASOF LEFT JOIN zones z
  ON t.pickup_location_id = z.entity_id AND t.pickup_datetime >= z.feature_timestamp"""


@query("pit_join", with_ctes(ZONES, select=PIT))
def _(t: Tables):
    rows = t.trips().select("event_id", "pickup_location_id", "pickup_datetime")
    keys = ("pickup_location_id", "entity_id", "pickup_datetime", "feature_timestamp")
    return N.pit_join(rows, zone_table(t), *keys)


RANGES = [("2024-01-09", "2024-01-12"), ("2024-01-23", "2024-01-26")]


@query(
    "pit_training_set",
    with_ctes(
        ZONES,
        """
riding AS (
  SELECT min({'distance': trip_distance, 'people': passenger_count, 'tip': tip_amount}) AS least,
    pickup_location_id, pickup_datetime
  FROM trips
  WHERE least(trip_distance, fare_amount, tip_amount) > 0 AND passenger_count >= 0
    AND (pickup_datetime::DATE BETWEEN DATE '2024-01-09' AND DATE '2024-01-11'
      OR pickup_datetime::DATE BETWEEN DATE '2024-01-23' AND DATE '2024-01-25')
  GROUP BY pickup_location_id, pickup_datetime)""",
        select="""
SELECT pickup_location_id, pickup_datetime, least.distance AS trip_distance,
  least.people AS passenger_count, date_part('hour', pickup_datetime)::INTEGER AS hourofday,
  least.tip AS label, feature_timestamp, trip_count AS zone_trip_count,
  avg_fare AS zone_avg_fare, avg_distance AS zone_avg_distance, tip_rate AS zone_tip_rate
FROM riding ASOF LEFT JOIN zones
  ON entity_id = pickup_location_id AND feature_timestamp <= pickup_datetime""",
    ),
)
def _(t: Tables):
    return N.pit_training_set(t.trips(), zone_table(t), RANGES)


FACTORS = {"trip_count": 3, "avg_fare": 2.5, "avg_distance": 2.0, "tip_rate": 0.3}
SHIFTED = "2024-02-05 00:00:00"


def drifted(t: Tables):
    return N.drift_simulate(zone_table(t), FACTORS, "feature_timestamp", SNAPSHOTS[-1], SHIFTED)


DRIFTED = f"""
drifted AS (
  SELECT entity_id, feature_timestamp, trip_count, avg_fare, avg_distance, tip_rate FROM zones
  UNION ALL
  SELECT entity_id, TIMESTAMP '{SHIFTED}', trip_count * 3, avg_fare * 2.5::DOUBLE,
         avg_distance * 2.0::DOUBLE, tip_rate * 0.3::DOUBLE
  FROM zones WHERE feature_timestamp = TIMESTAMP '{SNAPSHOTS[-1]}')
"""


@query("drift_simulate", with_ctes(ZONES, DRIFTED, select="SELECT * FROM drifted"))
def _(t: Tables):
    return drifted(t)


def stats_sql(base: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, feature_timestamp AS snapshot, {c}::DOUBLE AS v FROM drifted"
        for c in FEATURES
    )
    return f"""
long_ AS (SELECT * FROM ({rows}) WHERE v IS NOT NULL),
edges AS (
  SELECT feature, min(v) AS lo, max(v) AS hi FROM long_
  WHERE snapshot = TIMESTAMP '{base}' GROUP BY feature),
binned AS (
  SELECT feature, snapshot,
         CASE WHEN v < lo THEN 0 WHEN v > hi THEN 11 WHEN v = hi THEN 10
              ELSE floor((v - lo) / (hi - lo) * 10)::INTEGER + 1 END AS bin
  FROM long_ JOIN edges USING (feature)),
stats AS (
  SELECT feature, snapshot, least(bin, CASE WHEN bin = 11 THEN 11 ELSE 10 END)::INTEGER AS bin,
         count(*) AS n
  FROM binned GROUP BY ALL)
"""


BASE = SNAPSHOTS[0]


@query("feature_stats", with_ctes(ZONES, DRIFTED, stats_sql(BASE), select="SELECT * FROM stats"))
def _(t: Tables):
    return D.feature_stats(drifted(t), FEATURES, "feature_timestamp", BASE)


def deviation_sql(pairs: dict[str, str]) -> str:
    rows = ", ".join(f"(TIMESTAMP '{c}', TIMESTAMP '{b}')" for c, b in pairs.items())
    return f"""
pairs AS (SELECT * FROM (VALUES {rows}) AS v(cur, base)),
shares AS (
  SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY feature, snapshot) AS share FROM stats),
bins AS (
  SELECT DISTINCT s.feature, p.cur, p.base, s.bin FROM stats s
  JOIN pairs p ON s.snapshot = p.cur OR s.snapshot = p.base),
pq AS (
  SELECT b.feature, b.cur, coalesce(x.share, 0) AS p, coalesce(y.share, 0) AS q
  FROM bins b
  LEFT JOIN shares x ON x.feature = b.feature AND x.bin = b.bin AND x.snapshot = b.cur
  LEFT JOIN shares y ON y.feature = b.feature AND y.bin = b.bin AND y.snapshot = b.base),
devs AS (
  SELECT feature, cur AS snapshot,
         round(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                  + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 6) AS deviation
  FROM pq GROUP BY feature, cur)
"""


@query(
    "drift_report",
    with_ctes(
        ZONES,
        DRIFTED,
        stats_sql(SNAPSHOTS[-1]),
        deviation_sql({SHIFTED: SNAPSHOTS[-1]}),
        select="SELECT feature, deviation, deviation > 0.3 AS drift_detected FROM devs",
    ),
)
def _(t: Tables):
    return D.drift_report(drifted(t), FEATURES, "feature_timestamp", SNAPSHOTS[-1], SHIFTED)


RUNS = {s: BASE for s in [*SNAPSHOTS[1:], SHIFTED]}


@query(
    "drift_history",
    with_ctes(
        ZONES,
        DRIFTED,
        stats_sql(BASE),
        deviation_sql(RUNS),
        select=f"""
SELECT snapshot, {", ".join(f"max(deviation) FILTER (feature = '{f}') AS {f}" for f in FEATURES)},
       snapshot = (SELECT max(snapshot) FROM devs) AS latest
FROM devs GROUP BY snapshot""",
    ),
)
def _(t: Tables):
    stats = D.feature_stats(drifted(t), FEATURES, "feature_timestamp", BASE)
    return D.drift_history(D.deviations(stats, RUNS), FEATURES)
