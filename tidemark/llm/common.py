"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that ends a word, as a Java pattern: space and 0x09 to 0x0D.
SPACE = r"[ \x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    A session without that setting (as in tests) uses its warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written once in the shared folder and read back.

    Later jobs see the same rows, and a lost executor costs no recomputation.
    """
    path = shared_folder(df.sparkSession, name)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_in_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``saved``, dealt by ``key`` into as many buckets as the session has shuffle
    partitions: a later grouping by the key reads the rows where they are, without a shuffle.

    The catalogue is only asked to read the buckets as such; no table stays in it.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.option("path", shared_folder(spark, name)).bucketBy(buckets, key)
    writer.saveAsTable(table)
    out = spark.table(table)
    out.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {table}")
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside lambdas an ordinary column expression would be computed anew for
    each element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def bytes_of(column: str) -> Column:
    """The UTF-8 bytes of a text column; null is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
