import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return row.select(column.alias("out")).first()["out"]


def test_clip_low_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "v double")
    assert [r[0] for r in df.select(S.clip_low("v")).collect()] == [0.0, 2.0, None]


@pytest.mark.parametrize(
    ("text", "path", "expected"),
    [
        ('{"a": {"score": 0.25}}', "$.a.score", "0.25"),
        ('{"a": {"score": "x"}}', "$.a.score", "x"),
        ('{"a": {"score": "[1]"}}', "$.a.score", "[1]"),
        ('{"a": {"score": [1]}}', "$.a.score", None),
        ('{"a": {"score": {"b": 1}}}', "$.a.score", None),
        ('{"a": {"score": true}}', "$.a.score", "true"),
        ('{"a": {"score": null}}', "$.a.score", None),
        ('{"b": 1}', "$.a.score", None),
        ("no json", "$.a.score", None),
    ],
)
def test_json_value_gives_scalars_only(spark, text, path, expected):
    df = spark.createDataFrame([(text,)], "t string").select(S.parse_json_safe("t").alias("v"))
    assert df.select(S.json_value("v", path)).first()[0] == expected


def test_json_double_strict_and_lenient(spark):
    df = spark.createDataFrame([('{"a": "x"}',)], "t string").select(
        S.parse_json_safe("t").alias("v")
    )
    assert df.select(S.json_double("v", "$.a", strict=False)).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(S.json_double("v", "$.a")).collect()


def test_json_block_is_greedy_and_null_without_match(spark):
    df = spark.createDataFrame([('x {"a": {}} y {b} z',), ("none",), (None,)], "t string")
    out = [r[0] for r in df.select(S.json_block("t")).collect()]
    assert out == ['{"a": {}} y {b}', None, None]


def test_safe_ratio_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(S.safe_ratio("a", "b")).collect()] == [None, 1.5, None]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("French (Paris)", "French"),
        ("Northern France, probably", "France"),
        ("probably western Asia", "Asia"),
        ("Northernland", "land"),
        ("Upper Central Europe", "Europe"),
        ("Italian, Venice", "Italian"),
    ],
)
def test_normalize_culture(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(S.normalize_culture("c")).first()[0] == clean


def test_century_weekday_and_paths(spark):
    df = spark.createDataFrame(
        [(1900, dt.datetime(2024, 1, 7, 5), "http://x/y/0.jpg")],
        "y int, t timestamp_ntz, u string",
    )
    row = df.select(
        S.century_of("y"), S.day_of_week("t"), S.hour_of_day("t"), S.last_path_segment("u"),
        S.month_key("t"),
    ).first()
    assert tuple(row) == (20.0, 1, 5, "0.jpg", "2024-01")


def test_to_whole_rounds(spark):
    df = spark.createDataFrame([(2.5,), (2.4,), (-1.5,)], "v double")
    assert [r[0] for r in df.select(S.to_whole("v")).collect()] == [3, 2, -2]


def test_template_fills_markers_inside_texts_too(spark):
    df = spark.createDataFrame([("hi __b__", "yo"), (None, "yo")], "u string, v string")
    out = df.select(S.fill_template("A:__a__ B:__b__", {"__a__": "u", "__b__": "v"})).collect()
    assert [r[0] for r in out] == ["A:hi yo B:yo", None]


def test_run_day_uses_the_zone(spark):
    df = spark.createDataFrame([("2026-01-02 14:59:59",), ("2026-01-02 15:00:00",)], "t string")
    out = df.select(S.run_day(F.col("t"), "Asia/Tokyo")).collect()
    assert [r[0] for r in out] == [dt.date(2026, 1, 1), dt.date(2026, 1, 2)]


def test_words_of_null_and_blank(spark):
    df = spark.createDataFrame([(None,), ("  ",), (" a  b\n",)], "t string")
    assert [r[0] for r in df.select(S.words("t")).collect()] == [[], [], ["a", "b"]]


def test_unit_draw_is_repeatable_and_in_range(spark):
    draws = [r[0] for r in spark.range(500).select(S.unit_draw("id", F.lit(1))).collect()]
    again = [r[0] for r in spark.range(500).repartition(7).orderBy("id").select(
        S.unit_draw("id", F.lit(1))).collect()]
    assert draws == again and 0 <= min(draws) and max(draws) < 1 and 0.4 < sum(draws) / 500 < 0.6


def test_hash_keeps_the_place_of_null(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    assert df.select(S.stable_hash("x", "y").alias("h")).distinct().count() == 3
