"""Chat categorisation as rows arrive, and as a daily job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.chat import RUN_ZONE, Scorer, categorize, daily_rows, run_day_of
from tidemark.sources.sinks import overwrite_days

BATCH = "batch_id"


def daily_increment(
    chat: DataFrame, run_ts: str, scorer: Scorer, target: str, tz: str = RUN_ZONE
) -> None:
    """Categorise the day before the run into the table ``target``, partitioned by day; a
    rerun replaces that day, also by nothing."""
    rows = categorize(daily_rows(chat, run_ts, tz), scorer)
    overwrite_days(rows, target, "timestamp", [run_day_of(run_ts, tz)])


def stream_categorize(
    chat: DataFrame,
    scorer: Scorer,
    sink: str,
    checkpoint: str,
    watermark: dt.timedelta = dt.timedelta(days=1),
    once: bool = False,
) -> StreamingQuery:
    """Categorise each new row once; folders ``rows`` and ``late`` below ``sink``.

    A row is a repeat only if all its columns are equal to another's. Repeats are
    dropped by Spark's state, which a row leaves once the watermark has passed it.
    Rows not after the newest time of the batches before, less ``watermark``, go to
    ``late``, as they came. What Spark drops as late is never newer than that, since
    its own watermark is of the same or an earlier batch, so nothing is lost. A row
    without a time is never late, and repeats rows of its own batch alone. A repeated
    batch replaces its own folders.
    """
    names = chat.columns
    timed = chat.withColumn("_event", F.col("timestamp").cast("timestamp"))
    delay = f"{int(watermark.total_seconds() * 1000)} milliseconds"
    first = timed.withWatermark("_event", delay).dropDuplicatesWithinWatermark(names)
    # The rows as they came stand beside the first of each, in one query.
    both = first.withColumn("_first", F.lit(True)).unionByName(timed.withColumn("_first", F.lit(False)))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        before = _newest(batch.sparkSession, sink, batch_id - 1)
        late = F.lit(False)
        if before is not None:
            late = F.coalesce(F.unix_micros("_event") <= before - watermark // dt.timedelta(microseconds=1), late)
        missed = batch.where(~F.col("_first") & late).select(*names)
        missed.write.mode("overwrite").parquet(f"{sink}/late/{BATCH}={batch_id}")
        done = categorize(batch.where(F.col("_first") & ~late).select(*names), scorer)
        done.write.mode("overwrite").parquet(f"{sink}/rows/{BATCH}={batch_id}")
        # One row: the newest time up to this batch.
        newest = batch.agg(F.greatest(F.max(F.unix_micros("_event")), F.lit(before).cast("long")).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{sink}/times/{BATCH}={batch_id}")
        batch.unpersist()

    writer = both.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _newest(spark: SparkSession, sink: str, batch_id: int) -> int | None:
    """The newest time up to a batch, in microseconds; None before the first batch."""
    if batch_id < 0:
        return None
    return spark.read.schema("newest long").parquet(f"{sink}/times/{BATCH}={batch_id}").first()[0]


def read_categories(spark: SparkSession, sink: str) -> DataFrame:
    """The categorised rows of all batches."""
    return spark.read.parquet(f"{sink}/rows").drop(BATCH)


def read_late(spark: SparkSession, sink: str) -> DataFrame:
    """The rows that came after their watermark."""
    return spark.read.parquet(f"{sink}/late").drop(BATCH)
