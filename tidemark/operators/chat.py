"""Chat categorisation: prompts, scoring, join-back and the daily increment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators.cleaning import filter_run_day

# The categories, and the one for everything else.
CATEGORIES = [
    "音楽",
    "映画",
    "温泉",
    "グルメ",
    "キャンプ",
    "読書",
    "ゲーム",
    "スポーツ",
    "アウトドア",
    "ショッピング",
]
OTHER = "その他"
# The markers the template is filled at.
USER_MARK = "__userMessage__"
BOT_MARK = "__chatbotMessage__"
# Fixed value: time zone of the daily run.
RUN_ZONE = "Asia/Tokyo"

PROMPT = (
    "Pick the category that fits this conversation best and answer in JSON as "
    '{"category": "..."}.\n'
    + "".join(f"- {c}\n" for c in CATEGORIES)
    + f"If none of them fits, answer {OTHER}.\n\n"
    + f"User: {USER_MARK}\nAssistant: {BOT_MARK}\n"
)

Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def build_prompt(df: DataFrame, template: str = PROMPT) -> DataFrame:
    """Add ``prompt``. A user text that holds the second marker is filled as well."""
    marks = {USER_MARK: "userMessage", BOT_MARK: "chatbotMessage"}
    return df.withColumn("prompt", S.fill_template(template, marks))


def keyword_scorer(keywords: dict[str, str], column: str = "prompt") -> Scorer:
    """Scorer without a model: first category whose keyword occurs in ``column``."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = batch[column].fillna("").str.lower()
            found = pd.Series(OTHER, index=batch.index)
            for category, word in reversed(keywords.items()):
                found = found.mask(text.str.contains(word, regex=False), category)
            yield batch.assign(result='{"category": "' + found + '"}').drop(columns=[column])

    return score


def categorize(df: DataFrame, scorer: Scorer) -> DataFrame:
    """(timestamp, userEmail, category) of each chat row.

    ``scorer`` maps frames of (timestamp, userEmail, prompt) to frames with
    ``result``, a JSON text, in place of the prompt. Arrow batches go through it
    where the rows are.
    """
    rows = build_prompt(df).select("timestamp", "userEmail", "prompt")
    schema = T.StructType(
        [rows.schema["timestamp"], rows.schema["userEmail"], T.StructField("result", T.StringType())]
    )
    scored = rows.mapInPandas(scorer, schema)
    category = S.json_value(S.parse_json_safe("result"), "$.category")
    return scored.select("timestamp", "userEmail", category.alias("category"))


def daily_rows(df: DataFrame, run_ts: str, tz: str = RUN_ZONE) -> DataFrame:
    """Chat rows of the day before the run."""
    return filter_run_day(df, "timestamp", run_ts, tz)


def run_day_of(run_ts: str, tz: str = RUN_ZONE) -> str:
    """The day that ``daily_rows`` picks, for a run at a UTC wall time."""
    run = dt.datetime.fromisoformat(run_ts).replace(tzinfo=dt.timezone.utc)
    return (run.astimezone(ZoneInfo(tz)).date() - dt.timedelta(days=1)).isoformat()


def join_back(messages: DataFrame, categories: DataFrame) -> DataFrame:
    """Distinct messages with their category."""
    return (
        messages.join(categories, ["timestamp", "userEmail"])
        .select("timestamp", "userEmail", "userMessage", "chatbotMessage", "category")
        .distinct()
    )
