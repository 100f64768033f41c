"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job should run with, on a laptop or on a cluster.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split skewed join partitions even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows may be whole objects: batches to Python are bounded by bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # Streaming state on disk: it may hold one row for each of very many entities.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with ``BASE_CONF``; keyword keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """New folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are folders that the driver and all executors reach, in any master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    For a result that several jobs read: they see the same rows, and neither
    they nor a lost executor compute it again.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
