"""Rows that every operator must take: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

LONG = " ".join(f"word{i % 997} x{i}" for i in range(20_000))
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from here " * 6

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, row string, kept string, n_words string, score string, bad string, digest string, "
    "fp string, label string, length string, start string, data string, host string"
)

TEXTS = [
    (1, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, LONG, "fr", "b"),
    (6, " \t\n ", "fr", "b"),
    (7, "été ça où 東京 \U0001f600 ünï", "fr", "b"),
    (None, PROSE, "en", "a"),
    (None, None, None, None),
    (8, "one", None, "b"),
    (8, "one", None, "b"),
    (9, "line a b c\n" * 40, "en", "a"),
]


def documents(spark, texts=TEXTS):
    rows = [
        (i, t, lang, source, None if t is None else len(t), 7, *["clash"] * 12)
        for i, t, lang, source in texts
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return documents(spark).limit(0)
