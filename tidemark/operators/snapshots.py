"""Zone statistics per snapshot, point-in-time joins, newest version per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.cleaning import hash_sample
from tidemark.operators.ordered import RANGE, last_so_far, scanned, totals_before


def union_years(parts: list[tuple[DataFrame, str, str]], ts: str) -> DataFrame:
    """Stack tables, each cut to its own half-open time range."""
    cut = [
        df.where(
            (F.col(ts) >= F.lit(a).cast("timestamp_ntz"))
            & (F.col(ts) < F.lit(b).cast("timestamp_ntz"))
        )
        for df, a, b in parts
    ]
    return reduce(DataFrame.unionByName, cut)


def snapshot_fanout(df: DataFrame, ts: str, snapshots: Sequence[str], out: str = "snapshot") -> DataFrame:
    """Each row once per snapshot after its time."""
    later = F.filter(S.timestamps_array(snapshots), lambda s: s > F.col(ts))
    return df.withColumn(out, F.explode(later))


def zone_stats(
    trips: DataFrame, snapshots: Sequence[str], sample_mod: int | None = None, min_trips: int = 10
) -> DataFrame:
    """Statistics of all trips before each snapshot, per zone.

    Trips are first summed per zone and gap between two snapshots, then those few
    sums are added up per snapshot: a trip is read and shuffled once, however many
    snapshots follow it.
    """
    snaps = S.timestamps_array(sorted(snapshots))
    gap = F.size(F.filter(snaps, lambda s: s <= F.col("pickup_datetime")))
    valid = trips.where(
        (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & F.col("pickup_location_id").isNotNull()
        # Trips after the last snapshot count for none; the bound reaches the scan.
        & (F.col("pickup_datetime") < F.lit(max(snapshots)).cast("timestamp_ntz"))
    )
    if sample_mod:
        valid = hash_sample(valid, "pickup_datetime", sample_mod)
    fare, tolls = S.money("fare_amount"), S.money("tolls_amount")
    parts = (
        valid.groupBy(F.col("pickup_location_id").alias("entity_id"), gap.alias("_gap"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(fare + tolls).alias("paid"),
            F.count(fare + tolls).alias("n_paid"),
            F.sum(S.money("trip_distance")).alias("distance"),
            F.sum(S.money("tip_amount")).alias("tip"),
            F.sum(fare).alias("fare"),
        )
    )
    after = F.slice(snaps, F.col("_gap") + 1, F.lit(len(snapshots)))
    return (
        parts.withColumn("feature_timestamp", F.explode(after))
        .groupBy("entity_id", "feature_timestamp")
        .agg(
            F.sum("n").alias("trip_count"),
            S.mean_of(F.sum("paid"), F.sum("n_paid")).alias("avg_fare"),
            S.mean_of(F.sum("distance"), F.sum("n")).alias("avg_distance"),
            S.safe_ratio(F.sum("tip"), F.sum("fare")).alias("tip_rate"),
        )
        .where(F.col("trip_count") >= min_trips)
    )


def top1(df: DataFrame, part: list[str], order: list[Column]) -> DataFrame:
    """The row with the largest ``order`` per ``part``; ties go to the larger row.

    An aggregate instead of ``row_number() = 1``: it combines before the shuffle,
    so a heavy key is not sorted in one task. NULL order values lose.
    """
    whole = F.struct(*df.columns)
    best = df.groupBy(*part).agg(F.max_by(whole, F.struct(*order, whole)).alias("_best"))
    return best.select("_best.*")


def latest_per_entity(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Newest version per entity: what a key lookup returns after a sync."""
    return top1(df, [key], [F.col(ts)])


def pit_join(
    left: DataFrame,
    feats: DataFrame,
    left_key: str,
    feat_key: str,
    left_ts: str,
    feat_ts: str,
    dedupe: bool = False,
) -> DataFrame:
    """Point-in-time left join: newest feature version not after the row's time.

    Every left row is kept, with NULL features when nothing matches. ``dedupe``
    keeps one row per (key, time), the smallest, as a partition-and-pick query
    over these columns would.

    Rows and versions are put in one order of key and time and dealt into ranges,
    so that a hot key is split by time, and equal times by a hash of the row. Each
    range finds the last version before a row; the last version of the ranges
    before it, one row per range, is carried in.
    """
    if dedupe:
        left = (
            left.groupBy(F.col(left_key).alias("_k"), F.col(left_ts).alias("_t"))
            .agg(F.min(F.struct(*left.columns)).alias("_row"))
            .select("_row.*")
        )
    payload = [c for c in feats.columns if c != feat_key]
    versions = feats.where(F.col(feat_key).isNotNull() & F.col(feat_ts).isNotNull()).select(
        F.col(feat_key).alias("_key"),
        F.col(feat_ts).alias("_t"),
        # At equal times the version comes first; equal versions go by content.
        F.lit(0).alias("_side"),
        F.lit(0).cast("bigint").alias("_salt"),
        F.struct(F.col(feat_key).alias("key"), F.struct(*payload).alias("feat")).alias("_version"),
    )
    rows = left.select(
        F.col(left_key).alias("_key"),
        F.col(left_ts).alias("_t"),
        F.lit(1).alias("_side"),
        F.xxhash64(*left.columns).alias("_salt"),
        F.struct(*left.columns).alias("_row"),
    )
    order = ["_key", "_t", "_side", "_salt"]
    both = rows.unionByName(versions, allowMissingColumns=True)
    kind = both.schema["_version"].dataType
    dealt = scanned(both, order, [*order, "_version"], "_version", "_inside", kind, last_so_far)
    # One row per range, as many as the session has shuffle partitions.
    newest = F.max_by(
        "_version", F.when(F.col("_side") == 0, F.struct("_key", "_t", "_version"))
    )
    carried = totals_before(dealt, newest, lambda c: F.last(c, ignorenulls=True), "_carried")
    # The last version in the order is of an earlier key where the row's has none.
    found = F.coalesce("_inside", "_carried")
    return (
        dealt.where("_side = 1")
        .join(F.broadcast(carried), RANGE, "left")
        .select("_row", F.when(found["key"] == F.col("_key"), found["feat"]).alias("_feat"))
        .select("_row.*", "_feat.*")
    )


def pit_training_set(
    trips: DataFrame,
    feats: DataFrame,
    ranges: list[tuple[str, str]],
    dedupe: bool = True,
) -> DataFrame:
    """Training rows of the given time ranges with the zone's features as of pickup."""
    ts = F.col("pickup_datetime")
    in_range = reduce(
        lambda a, b: a | b,
        [
            (ts >= F.lit(a).cast("timestamp_ntz")) & (ts < F.lit(b).cast("timestamp_ntz"))
            for a, b in ranges
        ],
    )
    rows = trips.where(
        (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & (F.col("tip_amount") > 0)
        & F.col("passenger_count").isNotNull()
        & in_range
    ).select(
        "pickup_location_id",
        "pickup_datetime",
        F.col("trip_distance").cast("double").alias("trip_distance"),
        "passenger_count",
        S.hour_of_day("pickup_datetime").alias("hourofday"),
        F.col("tip_amount").cast("double").alias("label"),
    )
    zone = feats.select(
        "entity_id",
        "feature_timestamp",
        F.col("trip_count").alias("zone_trip_count"),
        F.col("avg_fare").alias("zone_avg_fare"),
        F.col("avg_distance").alias("zone_avg_distance"),
        F.col("tip_rate").alias("zone_tip_rate"),
    )
    return pit_join(
        rows,
        zone,
        "pickup_location_id",
        "entity_id",
        "pickup_datetime",
        "feature_timestamp",
        dedupe=dedupe,
    ).orderBy("pickup_datetime")


def entity_history(df: DataFrame, key: str, value: str, ts: str) -> DataFrame:
    """All versions of one entity by time."""
    return df.where(F.col(key) == value).orderBy(ts)


def drift_simulate(
    df: DataFrame, factors: dict[str, float], ts: str, from_ts: str, to_ts: str
) -> DataFrame:
    """Add a copy of the snapshot ``from_ts``, scaled per column, as snapshot ``to_ts``."""
    stamp = lambda t: F.lit(t).cast("timestamp_ntz")
    shifted = df.where(F.col(ts) == stamp(from_ts)).withColumn(ts, stamp(to_ts))
    whole = {f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long")}
    for name, factor in factors.items():
        scaled = F.col(name) * F.lit(factor)
        shifted = shifted.withColumn(name, S.to_whole(scaled) if name in whole else scaled)
    return df.unionByName(shifted)
