"""Newest row per entity, kept up to date from a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.snapshots import latest_per_entity

BATCH = "batch_id"


def stream_latest(
    stream: DataFrame,
    key: str,
    ts: str,
    sink: str,
    checkpoint: str,
    once: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Log the newest row of each entity that a batch touches, below ``sink``.

    The newest row per entity is the state of a streaming aggregate, one row in the
    state store for each entity, so an older version that comes late never wins. A
    batch writes only the entities it touches, to a folder of its own that a repeated
    batch replaces; what it writes follows the batch, not the number of entities.
    ``once`` handles what is there and stops.
    """
    whole = F.struct(*stream.columns)
    newest = (
        stream.where(F.col(ts).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        # Largest time first, then the larger row, as ``latest_per_entity`` has it.
        .agg(F.max(F.struct(F.col(ts).alias("ts"), whole.alias("row"))).alias("_newest"))
        .select("_newest.row.*")
    )

    def log(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch_id}")

    writer = (
        newest.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(log)
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def read_latest_view(spark: SparkSession, sink: str, key: str, ts: str) -> DataFrame:
    """The key-value view: the newest row per entity of the log."""
    try:
        changes = spark.read.parquet(sink).drop(BATCH)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no changes below {sink} yet") from problem
        raise
    return latest_per_entity(changes, key, ts)


def sync_once(stream: DataFrame, key: str, ts: str, sink: str, checkpoint: str) -> None:
    """One scheduled sync: take in what has arrived since the last one."""
    stream_latest(stream, key, ts, sink, checkpoint, once=True).awaitTermination()
