"""Quality rules whose failures are judged host by host, with DataFrame functions only.

Each text is measured in one expression. Failures are counted per host before
any shuffle; a host's rate is shrunk towards an empirical beta prior, and a host
whose shrunk rate is over ``host_limit`` is bad. A document goes if it fails a
hard rule, or if its host is bad and it fails a soft rule itself, so that a
clean document stays wherever it was found.

Defined results: a null or empty text has no word and fails (too short); rows
without a host are judged by the hard rules alone and count for no host; rows
that repeat are judged alike; an empty table gives an empty table; other columns
pass through ``judge`` and ``kept`` unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, let, saved

WINDOW = 3
MIN_WORDS = 50
#: Share of words in repeated windows, percent.
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: A bad host has more than this share of failing documents, after shrinking.
HOST_LIMIT = 0.5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words in the windows of ``width`` that occur twice or more in the array.

    Windows are hashed and sorted with their place in the low bits; only windows
    whose hash has a twin are then compared as text. n log n in the words.
    """

    def gram(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(width)]

    def neighbours(of: Column, k: Column, test) -> Column:
        return F.coalesce(test(F.get(of, k - 1)), F.lit(False)) | F.coalesce(
            test(F.get(of, k + 1)), F.lit(False)
        )

    def places(mask: Column) -> Column:
        high = F.bitwise_not(mask)
        hashed = F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(words) - width),
                lambda i: F.xxhash64(*gram(i)).bitwiseAND(high).bitwiseOR(i.cast("long")),
            )
        )
        return let(
            hashed,
            lambda sorted_: F.transform(
                F.filter(
                    sorted_,
                    lambda x, k: neighbours(
                        sorted_, k, lambda y: x.bitwiseXOR(y).bitwiseAND(high) == 0
                    ),
                ),
                lambda x: x.bitwiseAND(mask).cast("int"),
            ),
        )

    def certain(candidates: Column) -> Column:
        return let(
            F.sort_array(
                F.transform(
                    candidates,
                    lambda i: F.struct(F.concat_ws(" ", *gram(i)).alias("g"), i.alias("i")),
                )
            ),
            lambda grams: F.sort_array(
                F.transform(
                    F.filter(
                        grams, lambda x, k: neighbours(grams, k, lambda y: x["g"] == y["g"])
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    mask = (F.pow(F.lit(2.0), F.length(F.bin(F.size(words)))) - 1).cast("long")
    covered = F.aggregate(
        certain(let(mask, places)),
        F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")),
        lambda s, x: F.struct(
            (s["n"] + F.least(F.lit(width), x - s["last"])).alias("n"), x.alias("last")
        ),
        lambda s: s["n"],
    )
    return F.when(F.size(words) <= width, F.lit(0)).otherwise(covered)


def measured(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """(row, host, measures): each input row as a struct beside its measures."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n", -1), lambda x: x.rlike(r"[^ \x09-\x0D]"))

    def count(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(host).cast("string").alias("host"),
        F.length(F.regexp_replace(content, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(content) - F.length(F.translate(content, SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("lines"),
        let(F.array_remove(F.split(content, SPACE + "+", -1), ""), count).alias("words"),
    )
    return rows.select("row", "host", "word_chars", "n_symbols", "lines.*", "words.*")


def base_failed() -> Column:
    """The hard rules: too short, or mostly repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def soft_failed() -> Column:
    """Rules that decide only at a bad host: symbols, repeated lines, odd word lengths."""
    return (
        (10 * F.col("n_symbols") > F.col("n_words"))
        | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
        | (F.col("word_chars") < 3 * F.col("n_words"))
        | (F.col("word_chars") > 10 * F.col("n_words"))
    )


def host_verdicts(rows: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, n_failed, rate, bad) with the rate shrunk to the prior of all hosts.

    The beta prior has the mean rate m of all documents and, by the method of
    moments, the strength m(1-m)/v - 1 (at least 1) for the variance v of the
    hosts' own rates. Without variance every host has the rate m.
    """
    hosts = saved(
        rows.filter("host IS NOT NULL")
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.count_if(base_failed() | soft_failed()).alias("n_failed"),
        ),
        "hosts",
    )
    own = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(F.sum("n_failed").alias("f"), F.sum("n_docs").alias("n")).select(
        (F.col("f") / F.col("n")).alias("m")
    )
    spread = hosts.agg(F.avg(own * own).alias("q"), F.avg(own).alias("p"))
    m, q, p = total.scalar(), spread.select("q").scalar(), spread.select("p").scalar()
    m_, v = F.col("m"), F.col("v")
    return (
        hosts.withColumn("m", m)
        .withColumn("v", q - 2 * p * m + m * m)
        .withColumn("strength", F.greatest(F.lit(1.0), F.try_divide(m_ * (1 - m_), v) - 1))
        .withColumn(
            "rate",
            F.when(v <= 1e-12, m_).otherwise(
                (F.col("n_failed") + m_ * F.col("strength")) / (F.col("n_docs") + F.col("strength"))
            ),
        )
        .select("host", "n_docs", "n_failed", "rate", (F.col("rate") > host_limit).alias("bad"))
    )


def judged(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rows`` with base_failed and kept; the hosts are joined by Spark's own choice."""
    return (
        rows.join(hosts.select("host", "bad"), "host", "left")
        .withColumn("base_failed", base_failed())
        .withColumn(
            "kept",
            ~F.col("base_failed") & ~(F.coalesce("bad", F.lit(False)) & soft_failed()),
        )
    )


def kept(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep.

    Rows are written once with their measures, so that texts are measured once; the
    count per host reads the measures alone, and no text is shuffled.
    """
    rows = saved(measured(docs, text, host), "measured")
    return judged(rows, host_verdicts(rows)).filter("kept").select("row.*")
