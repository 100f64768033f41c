import datetime as dt
import time

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.catalog import QUERIES
from tidemark.sources import readers, sinks
from tidemark.streaming import categorize as SC
from tidemark.streaming import latest as SL
from tidemark.operators.chat import keyword_scorer
from tidemark.operators.cleaning import sample_blocks
from tidemark.session import freeze, shared_dir

D = dt.datetime


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_read_csv_typed_renames_and_parses(spark, tmp_path):
    write(tmp_path / "r.csv", "Invoice,InvoiceDate,Price,Customer ID\n0012,2011-01-02 03:04:05,1.5,\n")
    df = readers.read_csv_typed(
        spark,
        str(tmp_path / "r.csv"),
        "Invoice string, InvoiceDate string, Price double, `Customer ID` string",
        ["invoice", "invoice_date", "price", "customer_id"],
        {"invoice_date": "yyyy-MM-dd HH:mm:ss"},
    )
    assert tuple(df.first()) == ("0012", D(2011, 1, 2, 3, 4, 5), 1.5, None)


def test_read_shards_all_and_first(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"taxi-{i}.csv", f"a\n{i}\n")
    glob = str(tmp_path / "taxi-*.csv")
    assert sorted(r.a for r in readers.read_csv_shards(spark, glob, "a int").collect()) == [0, 1, 2]
    assert [r.a for r in readers.read_first_shard(spark, glob, "a int").collect()] == [0]
    for read in (readers.read_csv_shards, readers.read_first_shard):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / "none-*.csv"), "a int")


def test_require_columns_lists_missing_sorted(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert readers.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="missing columns: b, c"):
        readers.require_columns(df, ["c", "a", "b"])


def test_csv_round_trip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (5, 3):
        sinks.write_csv(spark.range(n), path)
    assert readers.read_csv_shards(spark, path + "/*.csv", "id long").count() == 3


def test_matrix_has_no_header(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.dense([1.0, 0.5]),)], ["v"])
    sinks.write_csv_matrix(df, "v", str(tmp_path / "m"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ["1.0,0.5"]


def test_jsonl_skips_blank_and_broken(spark, tmp_path):
    write(tmp_path / "prediction.results-00000", '{"p": 1}\n\n{"p": \n{"p": 2}\n')
    df = readers.read_jsonl(spark, str(tmp_path), "p int", name_glob="prediction.results-*")
    assert sorted(r.p for r in df.collect()) == [1, 2]


def test_read_latest_by_path(spark, tmp_path):
    for run, v in (("run1", 1), ("run2", 2)):
        write(tmp_path / run / "aggregation_results.jsonl", f'{{"v": {v}}}\n')
        write(tmp_path / run / "evaluation_results.jsonl", f'{{"v": {v + 10}}}\n')
    out = readers.read_latest(spark, str(tmp_path), "aggregation_results.jsonl", "v int")
    assert [r.v for r in out.collect()] == [2]
    with pytest.raises(FileNotFoundError):
        readers.read_latest(spark, str(tmp_path), "other.jsonl", "v int")


LABELS = ["daisy", "dandelion", "roses", "sunflowers", "tulips"]


def test_manifest_from_listed_files(spark, tmp_path):
    for label in LABELS:
        write(tmp_path / "photos" / label / f"{label}.jpg", "x")
    write(tmp_path / "photos" / "LICENSE.txt", "x")
    listing = readers.list_objects(spark, str(tmp_path / "photos"))
    assert listing.columns == ["uri", "size", "modified"]
    root = "file:" + str(tmp_path / "photos")
    prefix = "gs://example-bucket/data/photos/"
    rows = [tuple(r) for r in readers.image_manifest(listing, LABELS, root, prefix).collect()]
    assert len(rows) == 5
    assert rows[0] == (prefix + "daisy/daisy.jpg", "daisy")
    assert [r[1] for r in rows] == LABELS
    with pytest.raises(ValueError, match="lilies"):
        readers.image_manifest(listing, [*LABELS, "lilies"], root, prefix)
    assert readers.read_objects(spark, str(tmp_path / "photos")).first().content == b"x"


def test_tasks_list_what_spark_lists_and_empty_objects(spark, tmp_path):
    objects = [("a/x.jpg", b"1"), ("a/b/y é.jpg", b"22"), ("c/z.jpg", b""), ("c/z.txt", b"4")]
    root = f"file://{tmp_path}/objects"
    sinks.write_objects(spark.createDataFrame(objects, "path string, content binary"), root)
    whole = readers.list_objects(spark, root)
    folders = spark.createDataFrame([("a",), ("c",)], "folder string")
    by_tasks = readers.list_objects(spark, root, folders=folders)
    assert by_tasks.schema == whole.schema
    name = F.regexp_extract("uri", "/objects/(.*)$", 1).alias("name")
    seen = {tuple(r) for r in whole.select(name, "size").collect()}
    assert seen == {("a/x.jpg", 1), ("a/b/y é.jpg", 2)}
    assert {tuple(r) for r in by_tasks.select(name, "size").collect()} == seen | {("c/z.jpg", 0)}
    times = (x.select(name, F.unix_millis("modified")).where("name like 'a/%'") for x in (whole, by_tasks))
    assert len({frozenset(map(tuple, x.collect())) for x in times}) == 1
    assert {r.uri[:5] for r in by_tasks.collect()} == {"file:"}


def test_each_page_is_a_stored_object_of_its_own(spark, tmp_path):
    pages = [(1, "ab"), (65, "é"), (65, "é"), (-3, "x\n"), (None, "abc"), (2, ""), (3, None)]
    for name, rows in (("some", pages), ("none", [])):
        df = spark.createDataFrame(rows, "page_id long, html string")
        df.write.parquet(str(tmp_path / name / "pages.parquet"))
    listed = QUERIES["list_objects"](spark, str(tmp_path / "some"))
    assert listed.columns == ["page_id", "size"]
    assert "binaryFile" not in listed._jdf.queryExecution().executedPlan().toString()
    want = [(page, len((html or "").encode())) for page, html in pages]
    assert sorted(map(str, (tuple(r) for r in listed.collect()))) == sorted(map(str, want))
    assert QUERIES["list_objects"](spark, str(tmp_path / "none")).count() == 0


def test_tables_views_and_required_columns(spark):
    sinks.ensure_schema(spark, "chatbot")
    schema = T.StructType(
        [T.StructField("t", T.TimestampNTZType(), False), T.StructField("c", T.StringType(), False)]
    )
    sinks.create_table(spark, "chatbot.cats", schema)
    sinks.append_rows(spark, "chatbot.cats", [(D(2026, 1, 1), "x")])
    # By name: the order of the columns does not matter.
    more = spark.createDataFrame([("y", D(2026, 1, 2))], "c string, t timestamp_ntz")
    sinks.append(more, "chatbot.cats")
    assert {r.c for r in spark.table("chatbot.cats").collect()} == {"x", "y"}
    bad = spark.createDataFrame([(None, D(2026, 1, 2))], "c string, t timestamp_ntz")
    with pytest.raises(Exception, match="must not be NULL"):
        sinks.append(bad, "chatbot.cats", required=["c"])
    sinks.save_table(spark.range(3), "chatbot.numbers")
    sinks.save_table(spark.range(4), "chatbot.numbers")
    assert spark.table("chatbot.numbers").count() == 4


def test_a_view_is_there_in_another_session(spark):
    sinks.ensure_schema(spark, "views")
    sinks.save_table(spark.range(5), "views.numbers")
    sinks.save_view(spark, "views.few", "SELECT * FROM views.numbers WHERE id < 2")
    assert spark.newSession().table("views.few").count() == 2
    sinks.save_view(spark, "views.few", "SELECT id, id + 1 AS next FROM views.numbers")
    assert spark.newSession().table("views.few").columns == ["id", "next"]
    # A view follows its table, also when that is replaced.
    sinks.save_table(spark.range(7), "views.numbers")
    assert spark.newSession().table("views.few").count() == 7


def tables_of(spark, db):
    return {t.name for t in spark.catalog.listTables(db)}


def test_a_write_that_fails_leaves_the_old_table(spark):
    sinks.ensure_schema(spark, "swap")
    sinks.save_table(spark.range(100), "swap.t")
    # Most tasks write their rows; the one with the last row fails.
    broken = spark.range(0, 100, 1, 8).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    with pytest.raises(Exception, match="half-way"):
        sinks.save_table(broken, "swap.t")
    assert spark.table("swap.t").count() == 100 and tables_of(spark, "swap") == {"t"}
    with pytest.raises(Exception, match="half-way"):
        sinks.save_table(broken, "swap.new")
    assert tables_of(spark, "swap") == {"t"}


def test_replacing_a_table(spark):
    sinks.ensure_schema(spark, "swap2")
    sinks.save_table(spark.range(3), "swap2.t")
    # From itself, with other columns.
    sinks.save_table(spark.table("swap2.t").selectExpr("id", "id * 2 AS twice"), "swap2.t")
    assert sorted(map(tuple, spark.table("swap2.t").collect())) == [(0, 0), (1, 2), (2, 4)]
    with pytest.raises(Exception, match="already exists"):
        sinks.save_table(spark.range(1), "swap2.t", replace=False)
    # A swap that ended between its two steps is undone first.
    spark.sql("ALTER TABLE swap2.t RENAME TO swap2.t__replaced")
    broken = spark.range(1).select(F.raise_error(F.lit("again")).cast("long").alias("id"))
    with pytest.raises(Exception, match="again"):
        sinks.save_table(broken, "swap2.t")
    assert spark.table("swap2.t").count() == 3 and tables_of(spark, "swap2") == {"t"}


PREDICTIONS = (
    "customer_id string, prediction_date date, "
    "predicted_target struct<value:double,lower_bound:double,upper_bound:double>"
)


def prediction_tables(spark, db, tables):
    sinks.ensure_schema(spark, db)
    for name, v in tables:
        rows = spark.createDataFrame([("a", dt.date(2011, 12, 1), (v, 1.0, 2.0))], PREDICTIONS)
        sinks.save_table(rows, f"{db}.{name}")


def test_append_latest_predictions(spark):
    def move():
        return sinks.append_latest(spark, "preds", "predictions_", "predicted_results", "2026-01-03")

    sinks.ensure_schema(spark, "preds")
    assert move() is None
    # Made within a second, perhaps: then the numbers decide, and ten is after nine.
    prediction_tables(spark, "preds", [("predictions_9", -5.0), ("predictions_10", None)])
    assert [move(), move(), move()] == ["predictions_10", "predictions_9", None]
    out = {(r.pred, r.pred_raw) for r in spark.table("preds.predicted_results").collect()}
    assert out == {(None, None), (0.0, -5.0)}


def test_append_latest_goes_by_time_of_creation(spark):
    prediction_tables(spark, "preds2", [("predictions_9", 1.0)])
    time.sleep(1.1)
    prediction_tables(spark, "preds2", [("predictions_5", 2.0)])
    got = sinks.append_latest(spark, "preds2", "predictions_", "out", "2026-01-03")
    assert got == "predictions_5" and spark.catalog.tableExists("preds2.predictions_9")


def test_append_latest_does_not_guess(spark, monkeypatch):
    prediction_tables(spark, "preds3", [("predictions_a", 1.0), ("predictions_b", 2.0)])
    monkeypatch.setattr(sinks, "_age", lambda *a: ("2026-01-01", ()))
    with pytest.raises(ValueError, match="predictions_a, predictions_b"):
        sinks.append_latest(spark, "preds3", "predictions_", "out", "2026-01-03")
    assert sum(not x.isTemporary for x in spark.catalog.listTables("preds3")) == 2


def test_csv_that_does_not_fit_is_an_error(spark, tmp_path):
    schema = "a int, b int"
    for name, text in {"word": "a,b\nx,1\n", "long": "a,b\n1,2,3\n", "order": "b,a\n7,8\n"}.items():
        write(tmp_path / name / "f.csv", text)
        glob = str(tmp_path / name / "*.csv")
        for read in (readers.read_csv_shards, readers.read_first_shard, readers.read_csv_typed):
            with pytest.raises(Exception):  # noqa: B017
                read(spark, glob, schema).collect()


def test_all_actions_see_the_same_json_lines(spark, tmp_path):
    write(tmp_path / "x.jsonl", '{"a": 1}\nnot json\n\n{"a": 2, "b": "x"}\n{"a": \n{"a": "z"}\n')
    df = readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int, b string")
    assert df.count() == len(df.collect()) == 2
    assert df.select("b").count() == len(df.select("b").collect()) == 2
    strict = readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int", drop_bad=False)
    for action in (strict.collect, strict.count):
        with pytest.raises(Exception, match="not a JSON line"):
            action()


CHAT = "timestamp timestamp_ntz, userEmail string, userMessage string, chatbotMessage string"
FEATS = "entity_id string, feature_timestamp timestamp_ntz, v int"


def days_of(spark, table):
    return {str(r.day): r["count"] for r in spark.table(table).groupBy("day").count().collect()}


def test_rerun_of_a_day_does_not_duplicate(spark):
    sinks.ensure_schema(spark, "daily")
    rows = [(D(2026, 1, 1, h), f"u{h}", "tion", "x") for h in range(3)]
    rows += [(D(2026, 1, 2, h), f"u{h}", "tion", "x") for h in range(2)]
    chat = spark.createDataFrame(rows, CHAT)
    scorer = keyword_scorer({"a": "tion"})
    for run in ("2026-01-01 20:00:00", "2026-01-02 20:00:00", "2026-01-02 20:00:00"):
        SC.daily_increment(chat, run, scorer, "daily.done")
    assert days_of(spark, "daily.done") == {"2026-01-01": 3, "2026-01-02": 2}


def test_a_rerun_without_rows_clears_its_day(spark):
    sinks.ensure_schema(spark, "daily2")
    chat = spark.createDataFrame([(D(2026, 1, d, 1), "u", "tion", "x") for d in (1, 2)], CHAT)
    scorer = keyword_scorer({"a": "tion"})
    for run in ("2026-01-01 20:00:00", "2026-01-02 20:00:00"):
        SC.daily_increment(chat, run, scorer, "daily2.done")
    SC.daily_increment(chat.limit(0), "2026-01-02 20:00:00", scorer, "daily2.done")
    assert days_of(spark, "daily2.done") == {"2026-01-01": 1}
    # A first run without rows makes an empty table.
    SC.daily_increment(chat.limit(0), "2026-01-02 20:00:00", scorer, "daily2.none")
    assert days_of(spark, "daily2.none") == {}


def test_two_days_in_one_run(spark):
    sinks.ensure_schema(spark, "daily3")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)

    def save(rows, days):
        df = spark.createDataFrame(rows, "t timestamp_ntz, v int")
        sinks.overwrite_days(df, "daily3.t", "t", days)

    save([(D(2026, 1, d), d) for d in (1, 2, 3)], ["2026-01-01", "2026-01-02", "2026-01-03"])
    # Day 2 changes, day 3 has nothing more, day 1 is not of this run.
    save([(D(2026, 1, 2, 5), 8), (D(2026, 1, 2, 6), 9), (D(2026, 1, 1), 7)], ["2026-01-02", "2026-01-03"])
    assert sorted(r.v for r in spark.table("daily3.t").collect()) == [1, 8, 9]
    assert {r[0] for r in spark.sql("SHOW PARTITIONS daily3.t").collect()} == {"day=2026-01-01", "day=2026-01-02"}
    assert spark.conf.get(mode) == before


def arrivals(spark, folder, schema):
    """A source folder whose files are the batches, and a stream over it."""

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    return arrive, stream


def test_stream_keeps_the_newest_version(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "view", "check"))
    arrive, stream = arrivals(spark, source, FEATS)

    def sync():
        SL.sync_once(stream(), "entity_id", "feature_timestamp", sink, check)
        view = SL.read_latest_view(spark, sink, "entity_id", "feature_timestamp")
        return {r.entity_id: r.v for r in view.collect()}

    with pytest.raises(FileNotFoundError):
        SL.read_latest_view(spark, sink, "entity_id", "feature_timestamp")
    arrive(("a", D(2024, 1, 2), 1), ("b", D(2024, 1, 1), 2), ("a", D(2024, 1, 1), 0), ("c", None, 4))
    assert sync() == {"a": 1, "b": 2}
    arrive(("a", D(2024, 1, 1, 12), 9), ("9999", D(2024, 1, 3), 5), ("b", D(2024, 1, 5), 6))
    assert sync() == {"a": 1, "b": 6, "9999": 5}
    assert sync() == {"a": 1, "b": 6, "9999": 5}


def test_a_batch_writes_what_it_touches(spark, tmp_path):
    """Of 20 batches, the first has 2,000 entities, the others one or two."""
    source, sink, check = (str(tmp_path / n) for n in ("in", "view", "check"))
    arrive, stream = arrivals(spark, source, FEATS)
    arrive(*[(f"e{k}", D(2023, 1, 1), k) for k in range(2000)])
    for k in range(1, 20):
        late = ("e5", D(2022, 1, 1), -k)
        arrive((f"e{k % 3}", D(2024, 1, 1) + dt.timedelta(hours=k), k), *[late] * (k % 2))
    SL.sync_once(stream(), "entity_id", "feature_timestamp", sink, check)
    log = spark.read.parquet(sink)
    written = {r.batch_id: r["count"] for r in log.groupBy("batch_id").count().collect()}
    assert written[0] == 2000 and sum(written.values()) == 2000 + 19 + 10
    size = {b: sum(f.stat().st_size for f in (tmp_path / "view" / f"batch_id={b}").glob("*.parquet")) for b in written}
    assert max(v for b, v in size.items() if b) < size[0] / 5
    view = SL.read_latest_view(spark, sink, "entity_id", "feature_timestamp").collect()
    got = {r.entity_id: r.v for r in view}
    assert len(view) == 2000 and [got[f"e{k}"] for k in (0, 1, 2, 5)] == [18, 19, 17, 5]


def test_stream_categorize_keeps_every_row(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    arrive, stream = arrivals(spark, source, CHAT)
    scorer = keyword_scorer({"音楽": "jazz"})

    def run():
        SC.stream_categorize(stream(), scorer, sink, check, once=True).awaitTermination()
        return sorted((r.userEmail, r.category) for r in SC.read_categories(spark, sink).collect())

    # One time and address, two messages; and one row that comes twice.
    arrive(
        (D(2026, 1, 5, 0, 0, 0, 123456), "a", "jazz", "x"),
        (D(2026, 1, 5, 0, 0, 0, 123456), "a", "jazz", "x"),
        (D(2026, 1, 5), "a", "other", "x"),
        (D(2026, 1, 5, 1), "b", "none", None),
        (None, "n", "jazz", "x"),
        (None, "n", "jazz", "x"),
    )
    first = [("a", "その他"), ("a", "音楽"), ("b", "その他"), ("n", "音楽")]
    assert run() == first
    # A repeat in a later batch, a row within the watermark, and two that are late and equal.
    arrive(
        (D(2026, 1, 5, 1), "b", "none", None),
        (D(2026, 1, 4, 12), "c", "jazz", "x"),
        (D(2026, 1, 1), "d", "jazz", "x"),
        (D(2026, 1, 1), "d", "jazz", "x"),
    )
    assert run() == sorted([*first, ("c", "音楽")])
    assert [r.userEmail for r in SC.read_late(spark, sink).collect()] == ["d", "d"]
    times = {r.timestamp for r in SC.read_categories(spark, sink).where("userEmail = 'a'").collect()}
    assert times == {D(2026, 1, 5), D(2026, 1, 5, 0, 0, 0, 123456)}
    arrive((D(2026, 2, 1), "e", "jazz", "x"))
    run()
    # The watermark has passed all but the last row.
    state = spark.read.format("statestore").load(check)
    assert state.count() <= 1
    arrive((D(2026, 1, 5, 1), "b", "none", None))
    run()
    assert sorted(r.userEmail for r in SC.read_late(spark, sink).collect()) == ["b", "d", "d"]


def test_shared_dir_is_below_the_checkpoint_folder_or_the_warehouse(spark, tmp_path):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert a != b and a.startswith(base) and b.startswith(base)
    frozen = freeze(spark.range(5).withColumn("u", F.rand()), "r")
    assert frozen.collect() == frozen.collect()


def test_block_sample_opens_only_the_drawn_files(spark, tmp_path):
    folder = tmp_path / "t"
    spark.range(4000).repartition(40).withColumn("part", F.spark_partition_id()).write.parquet(str(folder))
    drawn = sample_blocks(spark, str(folder), 0.25, seed=7)
    rows = sorted(map(tuple, drawn.collect()))
    used = {f.rpartition("/")[2] for f in drawn.select("_metadata.file_name").distinct().toPandas()["file_name"]}
    assert 3 <= len(used) <= 18 and len({p for _, p in rows}) == len(used)
    assert len(rows) == spark.read.parquet(str(folder)).where(F.col("part").isin(*{p for _, p in rows})).count()
    # Files that are not drawn are broken now: nothing may open them.
    for f in folder.glob("*.parquet"):
        if f.name not in used:
            f.write_bytes(b"x" * f.stat().st_size)
            (folder / f".{f.name}.crc").unlink(missing_ok=True)
    again = spark.read.schema("id long, part int").parquet(str(folder)).schema
    assert sorted(map(tuple, sample_blocks(spark, str(folder), 0.25, seed=7, schema=again).collect())) == rows
    assert sorted(map(tuple, drawn.collect())) == rows
    other = sample_blocks(spark, str(folder), 0.25, seed=8, schema=again).select("_metadata.file_name")
    with pytest.raises(Exception):  # noqa: B017
        other.where("id >= 0").collect()
