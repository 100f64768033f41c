"""The scheduled chat job as SQL text, with session variables and named parameters.

Values enter as parameters or variables, never as text of the query, so that a value
with quotes in it stays a value. A query holds what its variables were when it was made.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.chat import BOT_MARK, PROMPT, RUN_ZONE, USER_MARK


def set_variable(spark: SparkSession, name: str, kind: str, value: str, args: Mapping[str, Any]) -> None:
    """Declare a variable of the session and give it the value of a SQL expression."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind}")
    spark.sql(f"SET VARIABLE {name} = {value}", args=dict(args))


#: The day before a run, on the calendar of a zone; the run is a UTC wall time.
RUN_DAY = "date_sub(to_date(convert_timezone('UTC', :zone, CAST(:run_time AS TIMESTAMP_NTZ))), 1)"

PROMPTS = """
SELECT
  *,
  replace(replace(prompt_template, :user_mark, userMessage), :bot_mark, chatbotMessage) AS prompt
FROM {chat}
WHERE timestamp >= run_day AND timestamp < date_add(run_day, 1)
"""


def scheduled_prompts(
    chat: DataFrame, run_time: str, template: str = PROMPT, zone: str = RUN_ZONE
) -> DataFrame:
    """The chat rows of the day before the run with their prompts.

    The bounds on the stored time are a half-open range, so that files can be skipped.
    """
    spark = chat.sparkSession
    set_variable(spark, "prompt_template", "STRING", ":template", {"template": template})
    set_variable(spark, "run_day", "DATE", RUN_DAY, {"zone": zone, "run_time": run_time})
    marks = {"user_mark": USER_MARK, "bot_mark": BOT_MARK}
    return spark.sql(PROMPTS, args=marks, chat=chat)


MESSAGES = """
SELECT * FROM {chat} WHERE userEmail = :user AND contains(lower(userMessage), lower(:word))
"""


def messages_of(chat: DataFrame, user: str, word: str) -> DataFrame:
    """A user's messages that hold a word, by a parametrised query."""
    return chat.sparkSession.sql(MESSAGES, args={"user": user, "word": word}, chat=chat)
