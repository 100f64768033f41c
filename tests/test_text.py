import datetime as dt
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import artworks as A
from tidemark.operators import chat as H
from tidemark.operators import evaluation as V
from tidemark.operators import scheduled as J

D = dt.datetime

PAIRS = [
    ("the cat sat on the mat", "the cat sat on the mat"),
    ("the cat", "the the the"),
    ("a b c d e f", "a b c x e f g h"),
    ("a b", ""),
    ("", "a"),
    (None, None),
    ("one two three four five six seven", "two three four"),
    ("x", "x"),
]


def grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def overlap(ref, hyp, n):
    return sum((grams(ref, n) & grams(hyp, n)).values())


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(i, r, h) for i, (r, h) in enumerate(PAIRS)], "i int, r string, h string")


def test_rouge_1_equals_formula(pairs):
    got = {r.i: r for r in V.rouge_1(pairs, ["i"], "r", "h").collect()}
    for i, (ref, hyp) in enumerate(PAIRS):
        ref, hyp = (ref or "").split(), (hyp or "").split()
        m = overlap(ref, hyp, 1)
        assert got[i].rouge_1_precision == round(m / len(hyp) if hyp else 0.0, 6)
        assert got[i].rouge_1_recall == round(m / len(ref) if ref else 0.0, 6)


def test_rows_that_share_an_id_are_scored_apart(spark):
    df = spark.createDataFrame([(1, "a b", "a b"), (1, "a b", "a b"), (1, "a b", "x")], "i int, r string, h string")
    assert sorted(r.rouge_1 for r in V.rouge_1(df, ["i"], "r", "h").collect()) == [0.0, 1.0, 1.0]
    assert V.bleu(df, ["i"], "r", "h").count() == 3


def test_bleu_equals_formula(pairs):
    got = {r.i: r.bleu for r in V.bleu(pairs, ["i"], "r", "h").collect()}
    for i, (ref, hyp) in enumerate(PAIRS):
        ref, hyp = (ref or "").split(), (hyp or "").split()
        m = overlap(ref, hyp, 1)
        want = 0.0
        if m:
            logs = [math.log(m / len(hyp))]
            for n in (2, 3, 4):
                total = max(len(hyp) - n + 1, 0)
                logs.append(math.log((overlap(ref, hyp, n) + 1) / (total + 1)))
            brevity = 1 - len(ref) / len(hyp) if len(hyp) < len(ref) else 0.0
            want = math.exp(sum(logs) / 4 + brevity)
        assert got[i] == pytest.approx(want, abs=2e-6)


def test_reshape_aggregates_skips_plain_columns(spark):
    schema = "aggregationMetric string, note string, bleu struct<score:double>, rouge_1 struct<score:double>"
    df = spark.createDataFrame(
        [("AVERAGE", "n", (0.5,), (0.25,)), ("STANDARD_DEVIATION", "n", (0.1,), None)], schema
    )
    got = {tuple(r) for r in V.reshape_aggregates(df).collect()}
    assert got == {("bleu", 0.5, 0.1), ("rouge_1", 0.25, None)}


def test_reshape_evaluations_text_and_struct(spark):
    results = "array<map<string,struct<score:double>>>"
    text = spark.createDataFrame(
        [('{"prompt": "p", "response": "r", "x": 1}', [{"a": (0.5,)}, {"b": (None,)}, {"a": (0.7,)}])],
        f"jsonInstance string, evaluationResults {results}",
    )
    assert tuple(V.reshape_evaluations(text, ["a", "b"]).first()) == ("p", "r", 0.7, None)
    struct = spark.createDataFrame(
        [(("p", "r"), [{"a": (0.5,)}])],
        f"jsonInstance struct<prompt:string,response:string>, evaluationResults {results}",
    )
    assert tuple(V.reshape_evaluations(struct, ["a"]).first()) == ("p", "r", 0.5)


def test_compare_models(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.2), (3, 0.1)], "i int, m double")
    b = spark.createDataFrame([(1, 0.4), (2, 0.2), (4, 0.1)], "i int, m double")
    out = V.compare_models(a, b, ["i"], ["m"])
    assert {(r.i, r.m_winner) for r in out.collect()} == {(1, "a"), (2, "tie")}
    assert V.win_counts(out, ["m"]).first().a_wins == 1


CHAT = "timestamp timestamp_ntz, userEmail string, userMessage string, chatbotMessage string"


def test_categorize_first_keyword_wins_else_other(spark):
    at = dt.datetime(2026, 1, 1)
    rows = [(at, "a", "jazz film", "x"), (at, "b", "a FILM", "x"), (at, "c", "none", "x")]
    scorer = H.keyword_scorer({"音楽": "jazz", "映画": "film"})
    out = H.categorize(spark.createDataFrame(rows, CHAT), scorer)
    assert {r.userEmail: r.category for r in out.collect()} == {"a": "音楽", "b": "映画", "c": "その他"}


def test_daily_rows_at_the_border_of_the_day(spark):
    rows = [
        (dt.datetime(2026, 1, 2), "in", "", ""),
        (dt.datetime(2026, 1, 2, 23, 59, 59), "in", "", ""),
        (dt.datetime(2026, 1, 3), "out", "", ""),
        (dt.datetime(2026, 1, 1, 23, 59, 59), "out", "", ""),
    ]
    df = spark.createDataFrame(rows, CHAT)
    assert [r.userEmail for r in H.daily_rows(df, "2026-01-02 15:00:00").collect()] == ["in"] * 2


def test_join_back_hides_repeats(spark):
    at = dt.datetime(2026, 1, 1)
    chat = spark.createDataFrame([(at, "a", "u", "b")] * 2, CHAT)
    cats = spark.createDataFrame([(at, "a", "x")] * 2, "timestamp timestamp_ntz, userEmail string, category string")
    assert H.join_back(chat, cats).count() == 1


def test_parse_results_keeps_readable_objects_only(spark):
    rows = [("u1", 'Sure: {"landscape": {"score": 0.9}} ok'), ("u2", "nothing"), ("u3", "{broken"),
            ("u4", None), ("u5", "{a} and {b}")]
    out = A.parse_results(spark.createDataFrame(rows, "uri string, result string"))
    assert [r.uri for r in out.select("uri").collect()] == ["u1"]


def test_no_table_of_the_enriched_results_is_sent_whole(spark, tmp_path):
    """Small files of long texts: what unfolds is not held by the driver."""

    def stored(name, cols):
        keys = spark.range(300).withColumn("uri", F.concat(F.lit("http://i/"), F.col("id").cast("string")))
        keys.selectExpr(*cols).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    long = "repeat('long text ', 1000)"
    files = stored("files", ["uri", f"{long} AS note"])
    images = stored("images", ["uri AS gcs_url", "id AS object_id", f"{long} AS title"])
    names = ["title", "department", "artist_display_name", "artist_nationality", "medium", "classification"]
    years = ["1900 AS object_begin_date", "1901 AS object_end_date"]
    texts = [f"{long} AS {n}" for n in names]
    objects = stored("objects", ["id AS object_id", "'a (b)' AS culture", *years, *texts])
    scores = """concat('{"love": {"score": 0.', id % 10, ', "reason": "', repeat('why ', 2000), '"}}')"""
    results = stored("results", ["if(id = 7, NULL, if(id = 8, 'http://i/9', uri)) AS uri",
                                 f"if(id = 6, 'cut {{', {scores}) AS result"])
    name = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "100k")
        rows = A.enrich_results(results, A.star_join(files, images, objects)).select("object_id", "love").collect()
    finally:
        spark.conf.set(name, before)
    expected = [(9 if i == 8 else i, i % 10 / 10) for i in range(300) if i not in (6, 7)]
    assert sorted(tuple(r) for r in rows) == sorted(expected)


def test_conditional_counts_leave_out_small_groups(spark):
    df = spark.createDataFrame([("a", 0.9)] * 10 + [("b", 0.9)] * 9 + [(None, 0.9)] * 10, "c string, x double")
    out = A.conditional_counts(df, ["c"], ["x"], 0.9).collect()
    assert [tuple(r) for r in out] == [("a", 10, 10)]


def test_score_objects(spark):
    files = spark.createDataFrame([("u", b"abc")], "uri string, content binary")
    out = A.score_objects(files, A.length_scorer(["x", "y"])).first()
    assert out.result == '{"x": {"score": 0.3}, "y": {"score": 0.4}}'


def test_prompt_has_every_category():
    assert all(c in H.PROMPT for c in H.CATEGORIES) and H.OTHER in H.PROMPT


def test_scheduled_sql_equals_the_dataframe_form(spark):
    chat = spark.createDataFrame(
        [
            (D(2026, 1, 2, h), f"u{h}", m, "yes")
            for h, m in enumerate(["a", None, "it's __chatbotMessage__", "d"])
        ]
        + [(D(2026, 1, 1, 23, 59), "u8", "b", "no"), (D(2026, 1, 3), "u9", "c", "no")],
        "timestamp timestamp_ntz, userEmail string, userMessage string, chatbotMessage string",
    )
    run = "2026-01-02 20:00:00"
    want = H.build_prompt(H.daily_rows(chat, run)).collect()
    got = J.scheduled_prompts(chat, run)
    # A query holds the variables as they were when it was made.
    other = J.scheduled_prompts(chat, "2026-01-01 20:00:00", "x", "UTC")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want)) and len(want) == 4
    assert [r.prompt for r in other.collect()] == []
    assert J.scheduled_prompts(chat, "2026-01-04 01:00:00", "x", "UTC").first().prompt == "x"


def test_hostile_values_stay_values(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("precious")
    evil = ["'; DROP TABLE precious; --", "' OR '1' = '1", "{chat} :word", '"""', "\\'"]
    rows = [(f"u{k}", w) for k, w in enumerate(evil)]
    chat = spark.createDataFrame(rows, "userEmail string, userMessage string")
    for user, word in rows:
        assert [r.userEmail for r in J.messages_of(chat, user, word).collect()] == [user]
        assert J.messages_of(chat, word, user).collect() == []
    timed = chat.selectExpr("TIMESTAMP_NTZ'2026-01-02 01:00:00' AS timestamp", "*", "'bot' AS chatbotMessage")
    for word in evil:
        got = J.scheduled_prompts(timed, "2026-01-02 20:00:00", word + "__userMessage__")
        assert {r.prompt for r in got.collect()} == {word + w for w in evil}
    assert spark.table("precious").count() == 3
