"""Readers with declared schemas."""

from __future__ import annotations

import fnmatch

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def listed(spark: SparkSession, pattern: str) -> DataFrame:
    """(path) of the files that match a glob, through the file system of the path.

    No content is read, and the list stays where Spark has it. An error when nothing matches.
    """
    try:
        listing = spark.read.format("binaryFile").load(pattern).select("path")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no files match {pattern}") from problem
        raise
    return listing


def _one_file(spark: SparkSession, pattern: str, pick: Column) -> str:
    path = listed(spark, pattern).agg(pick).first()[0]
    if path is None:
        raise FileNotFoundError(f"no files match {pattern}")
    return path


def first_file(spark: SparkSession, pattern: str) -> str:
    """The first path that matches a glob, in the order of the paths."""
    return _one_file(spark, pattern, F.min("path"))


def last_file(spark: SparkSession, pattern: str) -> str:
    return _one_file(spark, pattern, F.max("path"))


def _csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """CSV whose header must name the schema's columns in their order, and whose values fit."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` itself, or an error that lists what is missing; runs no job."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_csv_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    names: list[str] | None = None,
    ts_cols: dict[str, str | None] | None = None,
) -> DataFrame:
    """CSV with a header and declared types; columns renamed by position, times parsed.

    ``ts_cols`` maps a (new) column name to its pattern, ``None`` for the standard one.
    """
    df = _csv(spark, path, schema)
    if names:
        df = df.toDF(*names)
    for name, pattern in (ts_cols or {}).items():
        stamp = F.to_timestamp(name, pattern) if pattern else F.to_timestamp(name)
        df = df.withColumn(name, stamp.cast("timestamp_ntz"))
    return df


def read_csv_shards(spark: SparkSession, glob: str, schema: T.StructType | str) -> DataFrame:
    """All files of a glob as one table; an error when nothing matches."""
    if listed(spark, glob).isEmpty():
        raise FileNotFoundError(f"no files match {glob}")
    return _csv(spark, glob, schema)


def read_first_shard(spark: SparkSession, glob: str, schema: T.StructType | str) -> DataFrame:
    """Only the first file by name, for a quick look."""
    return _csv(spark, first_file(spark, glob), schema)


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    drop_bad: bool = True,
    name_glob: str | None = None,
) -> DataFrame:
    """JSON Lines; blank lines are skipped, broken lines dropped or an error.

    Every action sees the same rows: a line is judged before its columns are picked.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    bad = "_corrupt_line"
    whole = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    reader = spark.read.option("pathGlobFilter", name_glob) if name_glob else spark.read
    line = F.from_json(
        "value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    )
    rows = reader.text(path).where(F.trim("value") != "").select(line.alias("line"), "value")
    broken = F.col("line").isNull() | F.col(f"line.{bad}").isNotNull()
    if drop_bad:
        rows = rows.where(~broken)
    else:
        fault = F.raise_error(F.concat(F.lit("not a JSON line: "), "value")).cast("boolean")
        rows = rows.where(F.when(broken, fault).otherwise(True))
    return rows.select(*[F.col(f"line.`{f.name}`").alias(f.name) for f in schema.fields])


def read_latest(
    spark: SparkSession, root: str, name: str, schema: T.StructType | str
) -> DataFrame:
    """The file called ``name`` with the last path in the tree below ``root``."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name)
        .load(root)
    )
    last = listing.agg(F.max("path")).first()[0]
    if last is None:
        raise FileNotFoundError(f"no {name} below {root}")
    return read_jsonl(spark, last, schema, drop_bad=False)


def list_objects(
    spark: SparkSession, root: str, glob: str = "*.jpg", folders: DataFrame | None = None
) -> DataFrame:
    """(uri, size, modified) of the stored objects; their content is not read.

    Without ``folders`` this is Spark's listing, which reaches every store that Spark reads,
    is held by the driver, and passes over empty objects. ``folders`` (folder), paths below
    ``root``, are listed by the tasks instead, each with all that is below it: the list does
    not pass the driver, and empty objects are in it.
    """
    if folders is not None:
        return _listed_by_tasks(folders, root, glob)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select(
            F.col("path").alias("uri"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
        )
    )


def _listed_by_tasks(folders: DataFrame, root: str, glob: str) -> DataFrame:
    def listing(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                below = system.get_file_info(fs.FileSelector(f"{base}/{folder}", recursive=True))
                found = [i for i in below if i.is_file and fnmatch.fnmatchcase(i.base_name, glob)]
                times = pa.array([i.mtime_ns // 1000 for i in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([root.rstrip("/") + i.path[len(base) :] for i in found], pa.string()),
                        pa.array([i.size for i in found], pa.int64()),
                        times.cast(pa.timestamp("us", "UTC")),
                    ],
                    ["uri", "size", "modified"],
                )

    return folders.select("folder").mapInArrow(listing, "uri string, size long, modified timestamp")


def read_objects(spark: SparkSession, root: str, glob: str = "*.jpg") -> DataFrame:
    """(uri, content) for scoring."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select(F.col("path").alias("uri"), "content")
    )


def image_manifest(
    listing: DataFrame, labels: list[str], root: str, prefix: str = ""
) -> DataFrame:
    """(uri, label) with the first folder below the regex ``root`` as the label.

    Sorted by the order of ``labels``, then path; files outside these folders are
    left out, and a label without a file is an error.
    """
    relative = F.regexp_extract("uri", f"^(?:{root})/?(.*)$", 1)
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label"))
    rows = (
        listing.select(relative.alias("_path"))
        .withColumn("label", F.regexp_extract("_path", r"^([^/?#]+)/", 1))
        .where(F.col("label").isin(*labels))
    )
    seen = {r["label"] for r in rows.select("label").distinct().collect()}
    missing = [x for x in labels if x not in seen]
    if missing:
        raise ValueError(f"no files for label: {', '.join(missing)}")
    return rows.orderBy(place, "_path").select(
        F.concat(F.lit(prefix), "_path").alias("uri"), "label"
    )
