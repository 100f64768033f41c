"""How filters on a corpus interact: every order of them, enumerated by a recursive CTE.

Each document is reduced to a mask, one bit per filter that it fails, and documents are
counted per (part, mask): the mask cells, at most 32 for each part. The enumeration then
works on the cells alone. A recursive CTE starts with the empty prefix of every part; each
level appends every letter that the prefix has not used, joins the part's cells and carries
the bits applied so far, and emits the metrics of that step. Prefixes of full length are
the orders.

Filters, by what fails them: A, fewer than 100 words; B, under 80 % distinct words; C, over
10 % of the characters in ``A-Z``; D, one of ``#$%&*|``; E, the text of a smaller id in the
whole table.

Skew: equal rows are counted together before each shuffle, so that a repeated id, or none,
is a few rows, and the join that finds the first copy is on (text, id), so that a text which
a third of all rows share is spread over its ids. Only the SHA-256 of a text is shuffled.

Defined results: a null text is empty, which has no words and fails A only (and E as a copy
of another empty text); a null or empty part is the empty string; a row without id is neither
a copy of another row nor the first of any, and has no label; rows that repeat an id are
each counted, and none is a copy of the other; a document with several labels is good or
toxic if one of them says so; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, let, saved

LETTERS = "ABCDE"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Prefixes of one part, the empty one among them: 1 + 5 + 20 + 60 + 120 + 120.
PREFIXES = 326
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def failures(text: Column) -> Column:
    """The bits of A to D that a text fails; E needs the whole table."""
    words = F.array_remove(F.split(text, SPACE + "+", -1), "")
    few_or_repeated = let(
        words,
        lambda w: F.when(F.size(w) < 100, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(w)) < 80 * F.size(w), 2).otherwise(0),
    )
    # Without capitals a text is as long as before: what is missing are the capitals.
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return (
        few_or_repeated
        + F.when(100 * capitals.cast("long") > 10 * F.length(text), 4).otherwise(0)
        + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)
    ).cast("int")


def mask_cells(
    docs: DataFrame,
    labels: DataFrame,
    part: str = "lang",
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(part, mask, docs, good, toxic): documents and labelled documents per failure mask."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = saved(
        docs.select(
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            F.col(doc_id).alias("id"),
            F.unhex(F.sha2(content, 256)).alias("digest"),
            failures(content).alias("failed"),
        ),
        "failures",
    )
    first = (
        rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("copy", F.lit(0)).filter("id IS NOT NULL")
    )
    copy = F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("copy", F.lit(16)))
    masks = (
        rows.groupBy("digest", "id", "part", "failed")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(first, ["digest", "id"], "left")
        .groupBy("id", "part", (F.col("failed") + copy).alias("mask"))
        .agg(F.sum("n").alias("n"))
    )
    marked = labels.groupBy(F.col(doc_id).alias("id")).agg(
        F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic")
    )

    def where(flag: str) -> Column:
        return F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).alias(flag)

    return (
        masks.join(marked, "id", "left")
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("docs"), where("good"), where("toxic"))
    )


#: Each level of ``walk`` has the prefixes of one length; ``steps`` has a struct per letter.
ORDERS = """
WITH RECURSIVE walk (part, prefix, applied, steps) AS (
  SELECT part, '', 0, CAST(array() AS ARRAY<STRUCT<step: INT, kept: BIGINT, removed: BIGINT,
    redundant: BIGINT, unique_fails: BIGINT, good_lost: BIGINT, toxic_lost: BIGINT>>)
  FROM {parts}
  UNION ALL
  SELECT part, concat(prefix, letter), applied | bit, concat(steps, array(aggregate(
    cells,
    named_struct('step', length(prefix) + 1, 'kept', 0L, 'removed', 0L, 'redundant', 0L,
      'unique_fails', 0L, 'good_lost', 0L, 'toxic_lost', 0L),
    (s, c) -> named_struct(
      'step', s.step,
      'kept', s.kept + if(c.mask & (applied | bit) = 0, c.docs, 0L),
      'removed', s.removed + if(c.mask & bit <> 0 AND c.mask & applied = 0, c.docs, 0L),
      'redundant', s.redundant + if(c.mask & bit <> 0 AND c.mask & applied <> 0, c.docs, 0L),
      'unique_fails', s.unique_fails + if(c.mask = bit, c.docs, 0L),
      'good_lost', s.good_lost + if(c.mask & bit <> 0 AND c.mask & applied = 0, c.good, 0L),
      'toxic_lost', s.toxic_lost + if(c.mask & bit <> 0 AND c.mask & applied = 0, c.toxic, 0L)))))
  FROM (
    SELECT part, prefix, applied, steps, cells, letter, shiftleft(1, ascii(letter) - 65) AS bit
    FROM walk JOIN {parts} USING (part)
    LATERAL VIEW explode(filter(split(:letters, ''), x -> instr(prefix, x) = 0)) AS letter
  )
)
SELECT part, prefix AS filter_order, step.*
FROM walk LATERAL VIEW explode(steps) AS step
WHERE length(prefix) = length(:letters)
"""


def all_orders(cells: DataFrame) -> DataFrame:
    """The metrics of each (part, filter_order, step), from mask cells.

    A part has ``PREFIXES`` rows of recursion. Spark's own limit on these is raised in the
    session where there are more than some 3,000 parts.
    """
    parts = saved(
        cells.groupBy("part").agg(
            F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells")
        ),
        "mask-cells",
    )
    spark = cells.sparkSession
    limit, needed = int(spark.conf.get(ROW_LIMIT)), PREFIXES * parts.count()
    if 0 <= limit <= needed:
        spark.conf.set(ROW_LIMIT, str(needed + 1))
    steps = saved(spark.sql(ORDERS, args={"letters": LETTERS}, parts=parts), "orders")
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    shapley = steps.groupBy("part", letter.alias("letter")).agg(F.sum("removed").alias("shapley"))
    return steps.withColumn("letter", letter).join(shapley, ["part", "letter"]).drop("letter")


def audited(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step."""
    return all_orders(mask_cells(docs, labels, part))
