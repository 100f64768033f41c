"""Chat prompts, categories and the daily increment; text metrics over chat pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import chat as H
from tidemark.operators import evaluation as V
from tidemark.operators import scheduled as J
from tidemark.plans.adapters import CATEGORIZED, CHAT, KEYWORDS, RUN_TS, Tables, database
from tidemark.plans.registry import query, with_ctes
from tidemark.streaming import categorize as SC

SCORER = H.keyword_scorer(KEYWORDS)
TEMPLATE_SQL = H.PROMPT.replace("'", "''")


@query(
    "build_prompt",
    with_ctes(
        CHAT,
        select=f"""
SELECT conv_id, turn, replace(replace('{TEMPLATE_SQL}', '{H.USER_MARK}', "userMessage"),
               '{H.BOT_MARK}', "chatbotMessage") AS prompt
FROM chat""",
    ),
)
def _(t: Tables):
    return H.build_prompt(t.chat()).select("conv_id", "turn", "prompt")


@query("categorize", with_ctes(CATEGORIZED, select="SELECT * FROM categorized"))
def _(t: Tables):
    return H.categorize(t.chat(), SCORER)


RUN_DAY = """
WHERE "timestamp" >= TIMESTAMP '2026-01-02' AND "timestamp" < TIMESTAMP '2026-01-03'"""


@query(
    "filter_run_day",
    with_ctes(CHAT, select=f'SELECT "timestamp", "userEmail", "userMessage" FROM chat {RUN_DAY}'),
)
def _(t: Tables):
    """The run is at 05:00 on January 3 in Tokyo, so the day is January 2."""
    return H.daily_rows(t.chat(), RUN_TS).select("timestamp", "userEmail", "userMessage")


@query(
    "daily_increment", with_ctes(CATEGORIZED, select=f"SELECT * FROM categorized {RUN_DAY}")
)
def _(t: Tables):
    """Written to a table by the job, which runs twice, and read back."""
    target = f"{database(t)}.categorized"
    for _run in range(2):
        SC.daily_increment(t.chat(), RUN_TS, SCORER, target)
    return t.spark.table(target).drop("day")


@query(
    "scheduled_prompts",
    with_ctes(
        CHAT,
        select=f"""
SELECT conv_id, turn, "timestamp", replace(replace('{TEMPLATE_SQL}', '{H.USER_MARK}', "userMessage"),
  '{H.BOT_MARK}', "chatbotMessage") AS prompt
FROM chat {RUN_DAY}""",
    ),
)
def _(t: Tables):
    """The scheduled job's SQL, with a session variable for the template and one for the day."""
    rows = J.scheduled_prompts(t.chat(), RUN_TS)
    return rows.select("conv_id", "turn", "timestamp", "prompt")


@query(
    "parametrised_search",
    with_ctes(
        CHAT,
        select="""
SELECT conv_id, turn, "timestamp" FROM chat
WHERE "userEmail" = 'user7@example.com' AND contains(lower("userMessage"), 'en')""",
    ),
)
def _(t: Tables):
    found = J.messages_of(t.chat(), "user7@example.com", "EN")
    return found.select("conv_id", "turn", "timestamp")


@query(
    "join_using_distinct",
    with_ctes(
        CATEGORIZED,
        select="""
SELECT DISTINCT "timestamp", "userEmail", "userMessage", "chatbotMessage", category
FROM chat JOIN categorized USING ("timestamp", "userEmail")""",
    ),
)
def _(t: Tables):
    return H.join_back(t.chat(), H.categorize(t.chat(), SCORER))


IDS = ["conv_id", "turn"]

TOKENS = r"""
toks AS (
  SELECT conv_id, turn,
    list_filter(string_split_regex(coalesce("userMessage", ''), '\s+'), lambda w: w <> '') AS r,
    list_filter(string_split_regex(coalesce("chatbotMessage", ''), '\s+'), lambda w: w <> '') AS h
  FROM chat)
"""


def match_sql(n: int, name: str) -> str:
    def grams(side: str) -> str:
        return f"""
    SELECT conv_id, turn, gram, count(*) AS k FROM (
      SELECT conv_id, turn, unnest(list_transform(range(1, len({side}) - {n - 2}),
        lambda i: array_to_string(list_slice({side}, i, i + {n - 1}), ' '))) AS gram FROM toks)
    GROUP BY conv_id, turn, gram"""

    return f"""
{name} AS (
  SELECT conv_id, turn, sum(least(x.k, y.k))::DOUBLE AS m FROM ({grams('r')}) x
  JOIN ({grams('h')}) y USING (conv_id, turn, gram) GROUP BY conv_id, turn)"""


@query(
    "rouge_1",
    with_ctes(
        CHAT,
        TOKENS,
        match_sql(1, "hits"),
        select="""
SELECT conv_id, turn,
  round(coalesce(coalesce(m, 0) / nullif(len(h), 0), 0), 6) AS rouge_1_precision,
  round(coalesce(coalesce(m, 0) / nullif(len(r), 0), 0), 6) AS rouge_1_recall,
  round(coalesce(2 * coalesce(m, 0) / nullif(len(h) + len(r), 0), 0), 6) AS rouge_1
FROM toks LEFT JOIN hits USING (conv_id, turn)""",
    ),
)
def _(t: Tables):
    return V.rouge_1(t.chat(), IDS, "userMessage", "chatbotMessage")


@query(
    "bleu",
    with_ctes(
        CHAT,
        TOKENS,
        *[match_sql(n, f"h{n}") for n in range(1, 5)],
        select="""
SELECT conv_id, turn, round(CASE WHEN coalesce(h1.m, 0) = 0 THEN 0 ELSE
  exp((ln(h1.m / len(h)) + ln((coalesce(h2.m, 0) + 1) / (greatest(len(h) - 1, 0) + 1))
     + ln((coalesce(h3.m, 0) + 1) / (greatest(len(h) - 2, 0) + 1))
     + ln((coalesce(h4.m, 0) + 1) / (greatest(len(h) - 3, 0) + 1))) / 4
   + CASE WHEN len(h) < len(r) THEN 1 - len(r) / len(h) ELSE 0 END) END, 6)::DOUBLE AS bleu
FROM toks LEFT JOIN h1 USING (conv_id, turn) LEFT JOIN h2 USING (conv_id, turn)
LEFT JOIN h3 USING (conv_id, turn) LEFT JOIN h4 USING (conv_id, turn)""",
    ),
)
def _(t: Tables):
    return V.bleu(t.chat(), IDS, "userMessage", "chatbotMessage")


PAIRED = """
pair AS (
  SELECT a.conv_id, a.turn,
    list_filter(string_split_regex(a."userMessage", '\\s+'), lambda w: w <> '') AS r,
    list_filter(string_split_regex(a."chatbotMessage", '\\s+'), lambda w: w <> '') AS x,
    list_filter(string_split_regex(b."chatbotMessage", '\\s+'), lambda w: w <> '') AS y
  FROM chat a JOIN chat b ON b.conv_id = a.conv_id + 1 AND b.turn = a.turn)
"""


def side_sql(side: str) -> str:
    def count(col: str) -> str:
        return f"""(SELECT conv_id, turn, w, count(*) AS k FROM
      (SELECT conv_id, turn, unnest({col}) AS w FROM pair) GROUP BY ALL)"""

    return f"""
s{side} AS (
  SELECT conv_id, turn, round(coalesce(2 * coalesce(m, 0) / nullif(len(r) + len({side}), 0), 0), 6)
         AS score
  FROM pair LEFT JOIN (
    SELECT conv_id, turn, sum(least(p.k, q.k))::DOUBLE AS m
    FROM {count('r')} p JOIN {count(side)} q USING (conv_id, turn, w)
    GROUP BY conv_id, turn) USING (conv_id, turn))"""


def response_sets(t: Tables):
    """The reply of a turn, and the reply to the same turn of the next conversation."""
    chat = t.chat()
    a = V.rouge_1(chat, IDS, "userMessage", "chatbotMessage").select(*IDS, "rouge_1")
    other = chat.select((F.col("conv_id") - 1).alias("conv_id"), "turn", F.col("chatbotMessage").alias("other"))
    b = V.rouge_1(chat.join(other, IDS), IDS, "userMessage", "other").select(*IDS, "rouge_1")
    return a, b


@query(
    "compare_models",
    with_ctes(
        CHAT,
        PAIRED,
        side_sql("x"),
        side_sql("y"),
        select="""
SELECT conv_id, turn, sx.score AS rouge_1_a, sy.score AS rouge_1_b,
  CASE WHEN sx.score > sy.score THEN 'a' WHEN sy.score > sx.score THEN 'b' ELSE 'tie' END
    AS rouge_1_winner
FROM sx JOIN sy USING (conv_id, turn)""",
    ),
)
def _(t: Tables):
    return V.compare_models(*response_sets(t), IDS, ["rouge_1"])


@query(
    "win_counts",
    with_ctes(
        CHAT,
        PAIRED,
        side_sql("x"),
        side_sql("y"),
        select="""
SELECT 'rouge_1' AS metric, count(*) FILTER (sx.score > sy.score) AS a_wins,
  count(*) FILTER (sy.score > sx.score) AS b_wins, count(*) FILTER (sx.score = sy.score) AS ties,
  round(avg(sx.score), 6) AS a_mean, round(avg(sy.score), 6) AS b_mean
FROM sx JOIN sy USING (conv_id, turn)""",
    ),
)
def _(t: Tables):
    return V.win_counts(V.compare_models(*response_sets(t), IDS, ["rouge_1"]), ["rouge_1"])


@query(
    "mean_std_metrics",
    """
SELECT 'quality' AS metric, round(avg(quality), 6) AS average,
       round(stddev_samp(quality), 6) AS std_dev FROM labels
UNION ALL
SELECT 'toxic', round(avg(toxic), 6), round(stddev_samp(toxic), 6) FROM labels""",
)
def _(t: Tables):
    return V.mean_std_metrics(t.raw("labels"), ["quality", "toxic"])


@query(
    "reshape_aggregates",
    """
SELECT 'n_chars' AS metric, round(avg(n_chars), 6) AS average,
       round(stddev_samp(n_chars), 6) AS std_dev FROM documents
UNION ALL
SELECT 'n_words', round(avg(n), 6), round(stddev_samp(n), 6)
FROM (SELECT len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS n
      FROM documents)""",
)
def _(t: Tables):
    """Statistics as JSON result rows, read back and turned into a table."""
    from tidemark.functions.scalars import words

    texts = t.raw("documents").select("n_chars", F.size(words("text")).alias("n_words"))
    rows = V.aggregate_metrics(texts, ["n_chars", "n_words"])
    schema = "aggregationMetric string, n_chars struct<score:double>, n_words struct<score:double>"
    lines = rows.select(F.to_json(F.struct("*")).alias("line"))
    return V.reshape_aggregates(lines.select(F.from_json("line", schema).alias("r")).select("r.*"))


@query(
    "reshape_evaluations",
    with_ctes(
        CHAT,
        select="""
SELECT conv_id, turn, "userMessage" AS prompt, "chatbotMessage" AS response,
  (length("userMessage") % 10) / 10 AS fluency_v1,
  CASE WHEN conv_id % 3 <> 0 THEN (length("chatbotMessage") % 10) / 10 END AS coherence_v1
FROM chat""",
    ),
)
def _(t: Tables):
    def entry(name, score):
        return F.create_map(F.lit(name), F.struct(score.alias("score")))

    tenth = lambda c: (F.length(c) % 10) / F.lit(10)
    coherence = F.when(F.col("conv_id") % 3 != 0, tenth("chatbotMessage"))
    rows = t.chat().select(
        *IDS,
        F.to_json(
            F.struct(F.col("userMessage").alias("prompt"), F.col("chatbotMessage").alias("response"))
        ).alias("jsonInstance"),
        F.array(
            entry("fluency_v1", tenth("userMessage")), entry("coherence_v1", coherence)
        ).alias("evaluationResults"),
    )
    return V.reshape_evaluations(rows, ["fluency_v1", "coherence_v1"])
