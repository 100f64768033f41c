"""Row filters, projections and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import scalars as S
from tidemark.functions.farmhash import farm_fingerprint

# Object classes kept for image analysis.
ARTWORK_CLASSES = ("Prints", "Drawings", "Paintings")


def clean_transactions(df: DataFrame) -> DataFrame:
    """Lines of known customers, not cancelled, with a positive amount.

    A ``C`` anywhere in the invoice marks a cancellation.
    """
    amount = F.col("quantity") * F.col("price")
    return df.where(
        F.col("customer_id").isNotNull() & ~F.col("invoice").contains("C") & (amount > 0)
    ).select(
        "customer_id",
        "invoice",
        "stock_code",
        "quantity",
        "price",
        "country",
        F.col("invoice_date").alias("timestamp"),
        F.to_date("invoice_date").alias("date"),
        S.money(amount).alias("purchase_amount"),
    )


def prepare_trips(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Training columns of plausible trips, with weekday (1 = Sunday) and hour.

    ``keys`` are passed through.
    """
    return df.where(
        (F.col("tip_amount") >= 0)
        & (F.col("trip_distance") > 0)
        & (F.col("passenger_count") > 0)
        & (F.col("fare_amount") > 0)
    ).select(
        *keys,
        "pickup_datetime",
        "passenger_count",
        "trip_distance",
        F.col("payment_type").cast("string").alias("payment_type"),
        S.day_of_week("pickup_datetime").alias("day_of_week"),
        S.hour_of_day("pickup_datetime").alias("hour_of_day"),
        "tip_amount",
    )


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Approximate row sample; the rows depend on the partitioning."""
    return df.sample(fraction=fraction, seed=seed)


def sample_blocks(
    spark: SparkSession, path: str, fraction: float = 0.1, seed: int = 42, schema: StructType | None = None
) -> DataFrame:
    """A sample of whole files of a Parquet table: the others are not opened.

    A file is drawn by a hash of its name and the seed, so that every reading sees the
    same rows. The draw is a filter on the files' metadata, which Spark applies to the
    listing, before the scan. Rows that were written together stay or go together, as in
    any block sample; a table in few files gives a coarse one.
    """
    drawn = F.pmod(F.xxhash64("_metadata.file_name", F.lit(seed)), F.lit(1_000_000))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(drawn < round(fraction * 1_000_000))


def time_text(ts: str) -> Column:
    """A time as the warehouse writes it: UTC, with a fraction of 3 or 6 digits if there is one."""
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.000000$|000$", ""), F.lit("+00"))


def hash_sample(df: DataFrame, column: str, mod: int = 10, fingerprint: str = "md5") -> DataFrame:
    """About one row in ``mod``, chosen by the text of ``column``: repeatable, and
    rows with equal values stay or go together.

    ``fingerprint="farm"`` takes the rows whose FarmHash fingerprint, without its sign, is
    divisible by ``mod``, as the warehouse query does; times are written its way. A NULL
    has no fingerprint there and goes.
    """
    if fingerprint == "md5":
        return df.where(S.stable_hash(column) % mod == 0)
    if fingerprint != "farm":
        raise ValueError(f"no fingerprint {fingerprint}")
    is_time = df.schema[column].dataType.typeName().startswith("timestamp")
    text = time_text(column) if is_time else F.col(column).cast("string")
    # The remainder first: the smallest integer has no absolute value.
    return df.where(farm_fingerprint(text) % mod == 0)


def filter_run_day(df: DataFrame, ts: str, run_ts: Column | str, tz: str) -> DataFrame:
    """Rows of the day before the run, as a half-open range so that files can be skipped."""
    day = S.run_day(F.lit(run_ts) if isinstance(run_ts, str) else run_ts, tz)
    dtype = df.schema[ts].dataType
    return df.where(
        (F.col(ts) >= day.cast(dtype)) & (F.col(ts) < F.date_add(day, 1).cast(dtype))
    )


def star_except(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def exclude_placeholder(df: DataFrame, cols: list[str], mark: str = "?") -> DataFrame:
    """Drop rows with ``mark`` in, or NULL for, any of ``cols``."""
    for name in cols:
        df = df.where(~F.col(name).contains(mark))
    return df


def filter_artworks(
    df: DataFrame, classes: tuple[str, ...] = ARTWORK_CLASSES, last_segment: str = "0.jpg"
) -> DataFrame:
    """Kept classes with a known culture, year and URL, first image only."""
    return df.where(
        F.col("gcs_url").isNotNull()
        & F.col("object_begin_date").isNotNull()
        & F.col("culture").isNotNull()
        & F.col("classification").isin(*classes)
        & (S.last_path_segment("gcs_url") == last_segment)
    )


def outlier_filter(df: DataFrame, column: str = "tip_amount", limit: float = 50) -> DataFrame:
    return df.where(F.col(column) < limit)


def anomaly_conditions() -> dict[str, Column]:
    cancelled = F.col("invoice").contains("C")
    return {
        "cancelled": cancelled,
        "negative_quantity": ~cancelled & (F.col("quantity") < 0),
        "negative_price": F.col("price") < 0,
        "quantity_below_one": F.col("quantity") < 1,
        "any": cancelled | (F.col("price") < 0) | (F.col("quantity") < 0),
    }


def anomaly_rows(df: DataFrame, kind: str) -> DataFrame:
    return df.where(anomaly_conditions()[kind])


def anomaly_counts(df: DataFrame) -> DataFrame:
    """Rows per anomaly, counted in one pass: (kind, n)."""
    conditions = anomaly_conditions()
    wide = df.agg(*[F.count_if(c).alias(k) for k, c in conditions.items()])
    return wide.unpivot([], list(conditions), "kind", "n")


def keyword_search(
    df: DataFrame, column: str, term: str, ts: str, out: list[str], n: int = 5
) -> DataFrame:
    """Newest ``n`` rows whose ``column`` holds ``term`` in any case.

    Equal times go by the columns of the result.
    """
    return (
        df.where(F.contains(F.lower(column), F.lower(F.lit(term))))
        .orderBy(F.col(ts).desc_nulls_last(), *out)
        .limit(n)
        .select(*out)
    )


def add_suffix(df: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keys})


def feature_columns(
    df: DataFrame,
    drop: tuple[str, ...] = ("customer_id", "date_min", "date_max", "prediction_date", "target"),
    categories: tuple[str, ...] = ("country_mode",),
    substring: bool = False,
) -> tuple[list[str], list[str]]:
    """(feature columns, category columns) by exact name.

    With ``substring`` a name is dropped when it contains an entry of ``drop``;
    that also drops ``purchase_amount_by_date_min`` and ``..._max``.
    """

    def hit(name: str, patterns: tuple[str, ...]) -> bool:
        return any(p in name if substring else p == name for p in patterns)

    return (
        [c for c in df.columns if not hit(c, drop)],
        [c for c in df.columns if hit(c, categories)],
    )


def clip_lower(df: DataFrame, column: str, out: str, floor: float = 0.0) -> DataFrame:
    return df.withColumn(out, S.clip_low(column, floor))


def split_label(df: DataFrame, column: str, mapping: dict[str, list[str]]) -> DataFrame:
    """``split_label`` by date, NULL for other dates."""
    label = F.lit(None).cast("string")
    for name, dates in mapping.items():
        label = F.when(
            F.col(column).isin(*[F.lit(d).cast("date") for d in dates]), F.lit(name)
        ).otherwise(label)
    return df.withColumn("split_label", label)
