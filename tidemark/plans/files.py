"""Readers, sinks and tables: written from a table, read back, and held against it."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.evaluation import aggregate_metrics
from tidemark.plans.adapters import RUN_TS, Tables, database
from tidemark.plans.registry import query
from tidemark.plans.retail import predictions
from tidemark.session import shared_dir
from tidemark.sources import readers, sinks

ORDER = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus"]
ORDER_SQL = f"SELECT {', '.join(ORDER)} FROM orders"
CSV = (
    "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderstatus string"
)


def orders(t: Tables) -> DataFrame:
    return t.raw("orders").select(*ORDER)


def exported(t: Tables) -> str:
    folder = shared_dir(t.spark, "csv")
    sinks.write_csv(orders(t), folder)
    return folder


@query("write_csv_export", ORDER_SQL)
def _(t: Tables):
    return t.spark.read.schema(CSV).option("header", True).csv(exported(t))


@query("read_csv_shards", ORDER_SQL)
def _(t: Tables):
    return readers.read_csv_shards(t.spark, exported(t) + "/*.csv", CSV)


#: Which sixteenth of the range of keys an order is in.
SHARD = "(o_orderkey * 16) {div} ((SELECT max(o_orderkey) FROM orders) + 1)"


@query("read_first_shard", f"{ORDER_SQL} WHERE {SHARD.format(div='//')} = 0")
def _(t: Tables):
    """One write makes a shard of each sixteenth of the keys; the first is read."""
    folder = shared_dir(t.spark, "shards")
    most = t.raw("orders").agg(F.max("o_orderkey") + 1).scalar()
    part = F.floor(F.col("o_orderkey") * 16 / most).cast("int")
    rows = orders(t).withColumn("shard", F.lpad(part.cast("string"), 2, "0"))
    rows.repartition(16, "shard").write.partitionBy("shard").option("header", True).csv(folder)
    return readers.read_first_shard(t.spark, folder + "/*/*.csv", CSV)


@query(
    "read_csv_typed",
    """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
       o_orderdate AS ordered_at, o_orderstatus AS status FROM orders""",
)
def _(t: Tables):
    """Columns renamed by position, the time parsed from text."""
    folder = shared_dir(t.spark, "typed")
    text = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss").alias("o_orderdate")
    sinks.write_csv(orders(t).withColumn("o_orderdate", text), folder)
    schema = CSV.replace("o_orderdate timestamp_ntz", "o_orderdate string")
    names = ["order_id", "customer_id", "amount", "ordered_at", "status"]
    return readers.read_csv_typed(
        t.spark, folder, schema, names, {"ordered_at": "dd.MM.yyyy HH:mm:ss"}
    )


@query("require_columns", ORDER_SQL)
def _(t: Tables):
    return readers.require_columns(orders(t), ORDER)


@query(
    "write_csv_matrix",
    "SELECT CAST(CAST(o_orderkey AS DOUBLE) AS VARCHAR) || ',' "
    "|| CAST(CAST(o_custkey AS DOUBLE) AS VARCHAR) AS line FROM orders",
)
def _(t: Tables):
    folder = shared_dir(t.spark, "matrix")
    vectors = VectorAssembler(inputCols=["o_orderkey", "o_custkey"], outputCol="v")
    sinks.write_csv_matrix(vectors.transform(orders(t)), "v", folder)
    return t.spark.read.text(folder).withColumnRenamed("value", "line")


@query("read_jsonl_tolerant", ORDER_SQL + " WHERE o_orderkey % 7 <> 0")
def _(t: Tables):
    """Every seventh line is cut off, and there are blank lines."""
    folder = shared_dir(t.spark, "jsonl")
    line = F.to_json(F.struct(*ORDER))
    cut = F.when(F.col("o_orderkey") % 7 == 0, F.substring(line, 1, 20)).otherwise(line)
    lines = orders(t).select(F.explode(F.array(cut, F.lit(""))).alias("value"))
    lines.write.text(folder)
    return readers.read_jsonl(t.spark, folder, CSV)


@query(
    "read_latest_results",
    """
SELECT 'AVERAGE' AS "aggregationMetric", 'quality' AS metric, round(avg(quality), 6) AS score
FROM labels UNION ALL
SELECT 'AVERAGE', 'toxic', round(avg(toxic), 6) FROM labels UNION ALL
SELECT 'STANDARD_DEVIATION', 'quality', round(stddev_samp(quality), 6) FROM labels UNION ALL
SELECT 'STANDARD_DEVIATION', 'toxic', round(stddev_samp(toxic), 6) FROM labels""",
)
def _(t: Tables):
    """Two evaluation runs leave their results; the later one is found, read and reshaped."""
    root = shared_dir(t.spark, "evaluation")
    metrics = ["quality", "toxic"]
    results = aggregate_metrics(t.raw("labels"), metrics)
    for run, rows in (("run1", results.limit(1)), ("run2", results)):
        rows.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(f"{root}/{run}")
    # The last folder by name; its file has a name of Spark's.
    last = readers.last_file(t.spark, f"{root}/*/part-*.txt")
    name = last.rpartition("/")[2]
    schema = "aggregationMetric string, " + ", ".join(f"{m} struct<score:double>" for m in metrics)
    found = readers.read_latest(t.spark, root, name, schema)
    return found.select(
        "aggregationMetric",
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}.score").alias("score")) for m in metrics])
        ),
    )


@query("list_objects", "SELECT page_id, CAST(strlen(html) AS BIGINT) AS size FROM pages")
def _(t: Tables):
    """The pages as stored objects, a thousand ids in a folder, listed without being read.

    A page without html is an empty object; pages that share an id are objects of their own.
    """
    root = shared_dir(t.spark, "objects")
    folder = F.coalesce(F.expr("page_id div 1000"), F.lit(0)).cast("string")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    row = F.monotonically_increasing_id().cast("string")
    path = F.concat(folder, F.lit("/page_"), page, F.lit("_"), row, F.lit(".html"))
    content = F.coalesce("html", F.lit("")).cast("binary")
    sinks.write_objects(t.raw("pages").select(path.alias("path"), content.alias("content")), root)
    folders = t.raw("pages").select(folder.alias("folder")).distinct()
    found = readers.list_objects(t.spark, root, "*.html", folders)
    named = F.regexp_extract("uri", r"/page_(-?\d*)_\d+\.html$", 1)
    page_id = F.nullif(named, F.lit("")).cast("long").alias("page_id")
    return found.select(page_id, "size")


@query("create_typed_table", ORDER_SQL)
def _(t: Tables):
    name = f"{database(t)}.orders"
    sinks.create_table(t.spark, name, orders(t).schema)
    sinks.append(orders(t), name)
    return t.spark.table(name)


@query("ctas_replace", ORDER_SQL + " WHERE o_orderstatus = 'F'")
def _(t: Tables):
    name = f"{database(t)}.orders"
    sinks.save_table(orders(t), name)
    sinks.save_table(orders(t).where("o_orderstatus = 'F'"), name)
    return t.spark.table(name)


@query("create_schema_if_missing", ORDER_SQL)
def _(t: Tables):
    name = database(t)
    sinks.ensure_schema(t.spark, name)
    sinks.save_table(orders(t), f"{name}.orders")
    return t.spark.table(f"{name}.orders")


@query("replace_view", ORDER_SQL + " WHERE o_orderstatus = 'F'")
def _(t: Tables):
    """A stored view, made twice, and read in another session."""
    db = database(t)
    sinks.save_table(orders(t), f"{db}.orders")
    sinks.save_view(t.spark, f"{db}.done", f"SELECT * FROM {db}.orders")
    sinks.save_view(t.spark, f"{db}.done", f"SELECT * FROM {db}.orders WHERE o_orderstatus = 'F'")
    return t.spark.newSession().table(f"{db}.done")


@query("insert_select", f"{ORDER_SQL} WHERE o_orderstatus = 'F' UNION ALL {ORDER_SQL}")
def _(t: Tables):
    """By name: the second write has its columns in another order."""
    name = f"{database(t)}.orders"
    sinks.create_table(t.spark, name, orders(t).schema)
    sinks.append(orders(t).where("o_orderstatus = 'F'"), name)
    sinks.append(orders(t).select(*reversed(ORDER)), name, required=["o_orderkey"])
    return t.spark.table(name)


@query(
    "insert_values",
    "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT -1, 'x' UNION ALL SELECT -2, NULL",
)
def _(t: Tables):
    name = f"{database(t)}.orders"
    sinks.save_table(t.raw("orders").select("o_orderkey", "o_orderstatus"), name)
    sinks.append_rows(t.spark, name, [(-1, "x"), (-2, None)])
    return t.spark.table(name)


@query(
    "append_latest_predictions",
    """
SELECT o_custkey::VARCHAR AS customer_id, o_orderdate::DATE AS prediction_date,
       CASE WHEN v IS NULL THEN NULL WHEN v < 0 THEN 0 ELSE v END AS pred, v AS pred_raw
FROM (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice - 150000 END AS v FROM orders)""",
)
def _(t: Tables):
    """Table 10 is newer than table 9, which stays where it is."""
    db = database(t)
    sinks.save_table(predictions(t).limit(1), f"{db}.predictions_9")
    sinks.save_table(predictions(t), f"{db}.predictions_10")
    sinks.append_latest(t.spark, db, "predictions_", "predicted_results", RUN_TS)
    out = t.spark.table(f"{db}.predicted_results")
    return out.select("customer_id", "prediction_date", "pred", "pred_raw")
