"""Writers: CSV, tables, views, appends."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Replace the folder by CSV files, one per task."""
    df.write.mode("overwrite").option("header", header).csv(path)


def write_csv_matrix(df: DataFrame, vector: str, path: str) -> None:
    """Replace the folder by CSV files with one number per vector slot and no header."""
    values = F.transform(vector_to_array(vector), lambda x: x.cast("string"))
    df.select(F.array_join(values, ",").alias("value")).write.mode("overwrite").text(path)


def write_objects(objects: DataFrame, root: str) -> None:
    """Each row (path, content) as one stored object below ``root``; paths must differ.

    A task that runs again writes the same objects. ``root`` also gets a hidden folder,
    which listings pass over, with the number of objects that each task wrote.
    """

    def write(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        made, written = set(), 0
        for batch in batches:
            for path, content in zip(*batch.columns):
                place = f"{base}/{path.as_py()}"
                folder = place.rpartition("/")[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(place, compression=None) as out:
                    out.write(content.as_buffer())
                written += 1
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["written"])

    rows = objects.select("path", "content")
    rows.mapInArrow(write, "written long").write.parquet(f"{root}/_written")


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Empty Parquet table; ``append`` checks its required columns."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")


def save_table(df: DataFrame, name: str, replace: bool = True) -> None:
    """``df`` as the table ``name``; an earlier table is replaced as a whole.

    The rows go to a table of another name, which then takes the old one's place in
    the catalogue: readers find the old rows or the new ones, and a write that fails
    leaves the old. The old table may be read by ``df`` itself. A swap that was cut
    off between its two steps is undone by the next call.
    """
    spark, aside, fresh = df.sparkSession, f"{name}__replaced", f"{name}__{uuid.uuid4().hex}"
    exists = spark.catalog.tableExists
    if not exists(name) and exists(aside):
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
    if not replace:
        df.write.mode("errorifexists").saveAsTable(name)
        return
    try:
        df.write.saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    if exists(name):
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {aside}")


def save_view(spark: SparkSession, name: str, query: str) -> None:
    """A view that the catalogue keeps, over stored tables, from the text of a query."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def append(df: DataFrame, name: str, required: Sequence[str] = ()) -> None:
    """Append by column name; a NULL in a ``required`` column fails the write.

    Parquet tables do not check NOT NULL on their own, so the check is part of
    the written expression and needs no pass of its own.
    """
    target = df.sparkSession.table(name)
    wanted = [*required, *[f.name for f in target.schema.fields if not f.nullable]]
    cols = []
    for f in target.schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in wanted:
            c = F.coalesce(c, F.raise_error(F.lit(f"{f.name} must not be NULL")).cast(f.dataType))
        cols.append(c.alias(f.name))
    df.select(*cols).write.mode("append").insertInto(name)


def append_rows(spark: SparkSession, name: str, rows: Sequence[Sequence[Any]]) -> None:
    """Append literal rows in the column order of the table."""
    schema = spark.table(name).schema
    append(spark.createDataFrame([tuple(r) for r in rows], schema), name)


def overwrite_days(df: DataFrame, name: str, ts: str, days: Sequence[str]) -> None:
    """Replace these days of the table ``name``, which is partitioned by ``day``.

    One insert writes all days: partitions that get rows are overwritten, others stay. A day
    whose old files are still there got no row, and is dropped from the table.
    """
    spark = df.sparkSession
    in_days = F.col("day").isin(*[F.lit(d).cast("date") for d in days])
    rows = df.withColumn("day", F.to_date(ts)).where(in_days)
    if not spark.catalog.tableExists(name):
        rows.limit(0).write.partitionBy("day").saveAsTable(name)
    before = set(spark.table(name).where(in_days).inputFiles())
    mode = "spark.sql.sources.partitionOverwriteMode"
    held = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, held)
    spark.catalog.refreshTable(name)
    kept = before & set(spark.table(name).where(in_days).inputFiles())
    for day in {m for f in kept for m in re.findall(r"/day=([0-9-]+)/", f)}:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (day = DATE '{day}')")


def project_predictions(df: DataFrame, run_ts: str) -> DataFrame:
    """Typed prediction columns from the result struct, stamped with the run."""
    value = F.col("predicted_target.value")
    return df.select(
        "customer_id",
        "prediction_date",
        F.lit(run_ts).cast("timestamp_ntz").alias("job_run_at"),
        S.clip_low(value).alias("pred"),
        value.alias("pred_raw"),
        F.col("predicted_target.lower_bound").alias("pred_lower"),
        F.col("predicted_target.upper_bound").alias("pred_upper"),
    )


def _age(spark: SparkSession, table: str, prefix: str) -> tuple:
    """What orders prediction tables: time of creation, then the numbers in the name."""
    told = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    numbers = re.findall(r"\d+", table.rpartition(".")[2].removeprefix(prefix))
    return told.get("created_time", ""), tuple(map(int, numbers))


def append_latest(
    spark: SparkSession, db: str, prefix: str, target: str, run_ts: str
) -> str | None:
    """Move the newest ``<prefix>...`` table into ``target``; returns its name, if any.

    Newest by time of creation, then by the numbers of its name (its run time). Two
    tables that neither tells apart are an error. The source is dropped only after
    the write has succeeded.
    """
    ages = {
        t.name: _age(spark, f"{db}.{t.name}", prefix)
        for t in spark.catalog.listTables(db)
        if t.name.startswith(prefix) and t.name != target and not t.isTemporary
    }
    if not ages:
        return None
    newest = [name for name, age in ages.items() if age == max(ages.values())]
    if len(newest) > 1:
        raise ValueError(f"cannot tell which is newest: {', '.join(sorted(newest))}")
    (name,) = newest
    rows = project_predictions(spark.table(f"{db}.{name}"), run_ts)
    if spark.catalog.tableExists(f"{db}.{target}"):
        append(rows, f"{db}.{target}")
    else:
        save_table(rows, f"{db}.{target}", replace=False)
    spark.sql(f"DROP TABLE {db}.{name}")
    return name
