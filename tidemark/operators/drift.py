"""Distribution statistics per snapshot and deviation between snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 10
THRESHOLD = 0.3


def _long(df: DataFrame, cols: list[str], ts: str) -> DataFrame:
    values = df.select(ts, *[F.col(c).cast("double").alias(c) for c in cols])
    return values.unpivot(ts, cols, "feature", "value").where(F.col("value").isNotNull())


def feature_stats(
    df: DataFrame, cols: list[str], ts: str, base_ts: str, bins: int = BINS
) -> DataFrame:
    """Histogram per feature and snapshot: (feature, snapshot, bin, n).

    Equal-width bins between the extremes of the snapshot ``base_ts``; bin 0 lies
    below and bin ``bins + 1`` above them.
    """
    long = _long(df, cols, ts)
    edges = (
        long.where(F.col(ts) == F.lit(base_ts).cast("timestamp_ntz"))
        .groupBy("feature")
        .agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    )
    share = F.try_divide(F.col("value") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    place = (
        F.when(F.col("value") < F.col("_lo"), 0)
        .when(F.col("value") > F.col("_hi"), bins + 1)
        # The top edge, and a snapshot of one value, belong to the last bin.
        .otherwise(F.least(F.coalesce(F.floor(share * bins), F.lit(bins)) + 1, F.lit(bins)))
    )
    # One edge row per feature: bounded by the number of columns.
    return (
        long.join(F.broadcast(edges), "feature")
        .groupBy("feature", F.col(ts).alias("snapshot"), place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _half_kl(p: Column, m: Column) -> Column:
    return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)


def deviations(stats: DataFrame, pairs: dict[str, str], thr: float = THRESHOLD) -> DataFrame:
    """Jensen-Shannon divergence (base 2, in [0, 1]) of each snapshot from its baseline.

    ``pairs`` maps a snapshot to its baseline. The measure is this library's choice.
    """
    stamp = lambda t: F.lit(t).cast("timestamp_ntz")
    entries = F.array(
        *[
            F.struct(stamp(cur).alias("snapshot"), stamp(snap).alias("src"))
            for cur, base in pairs.items()
            for snap in dict.fromkeys((cur, base))
        ]
    )
    base_of = F.create_map(*[stamp(x) for pair in pairs.items() for x in pair])
    used = stats.withColumn(
        "_e", F.explode(F.filter(entries, lambda e: e["src"] == F.col("snapshot")))
    ).select("feature", F.col("_e.snapshot").alias("snapshot"), "_e.src", "bin", "n")
    used = used.withColumn("_base", F.element_at(base_of, F.col("snapshot")))
    sums = used.groupBy("feature", "snapshot", "bin").agg(
        F.coalesce(F.sum(F.when(F.col("src") == F.col("_base"), F.col("n"))), F.lit(0)).alias("q"),
        F.coalesce(F.sum(F.when(F.col("src") == F.col("snapshot"), F.col("n"))), F.lit(0)).alias(
            "p"
        ),
    )
    # A group is one histogram, so the window is bounded by the number of bins.
    whole = Window.partitionBy("feature", "snapshot")
    shares = sums.withColumns(
        {
            "q": F.try_divide(F.col("q").cast("double"), F.sum("q").over(whole)),
            "p": F.try_divide(F.col("p").cast("double"), F.sum("p").over(whole)),
        }
    ).withColumn("m", (F.col("p") + F.col("q")) / 2)
    part = (_half_kl(F.col("p"), F.col("m")) + _half_kl(F.col("q"), F.col("m"))) / 2
    return (
        shares.groupBy("feature", "snapshot")
        .agg(F.round(F.sum(part), 6).alias("deviation"))
        .withColumn("drift_detected", F.col("deviation") > thr)
    )


def drift_report(
    df: DataFrame, cols: list[str], ts: str, base_ts: str, cur_ts: str, thr: float = THRESHOLD
) -> DataFrame:
    """Deviation of each feature between two snapshots, flagged above ``thr``."""
    both = df.where(
        F.col(ts).isin(F.lit(base_ts).cast("timestamp_ntz"), F.lit(cur_ts).cast("timestamp_ntz"))
    )
    stats = feature_stats(both, cols, ts, base_ts)
    return deviations(stats, {cur_ts: base_ts}, thr).drop("snapshot")


def drift_history(reports: DataFrame, features: list[str]) -> DataFrame:
    """Deviation per feature over the runs in order: one row per run.

    Also gives ``latest``, true on the last run that has any result.
    """
    newest = reports.agg(F.max("snapshot")).scalar()
    wide = reports.groupBy("snapshot").agg(
        *[F.max(F.when(F.col("feature") == f, F.col("deviation"))).alias(f) for f in features]
    )
    return wide.withColumn("latest", F.col("snapshot") == newest)
