"""Text metrics, metric tables and model comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S

# Names of the statistics in aggregated result files.
STATISTICS = {"AVERAGE": "average", "STANDARD_DEVIATION": "std_dev"}
MAX_ORDER = 4


def _grams(tokens: Column, order: int, side: str) -> Column:
    """All runs of ``order`` tokens as (order, gram, side)."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (order - 1))
    runs = F.transform(
        starts,
        lambda i: F.struct(
            F.lit(order).alias("order"),
            F.array_join(F.slice(tokens, i, F.lit(order)), " ").alias("gram"),
            F.lit(side).alias("side"),
        ),
    )
    none = F.array().cast("array<struct<order:int,gram:string,side:string>>")
    return F.when(F.size(tokens) >= order, runs).otherwise(none)


def _overlaps(df: DataFrame, id_cols: list[str], ref: str, hyp: str, max_order: int) -> DataFrame:
    """Per row: token counts of both texts and the clipped matches ``m1`` to ``m<max_order>``.

    Rows are placed by key once; counting grams and adding them up per row then
    needs no further shuffle. A number of its own keeps rows apart that share a key.
    """
    sides = [(ref, "r"), (hyp, "h")]
    tokens = df.select(
        *id_cols,
        F.monotonically_increasing_id().alias("_row"),
        *[S.words(c).alias(f"_{s}") for c, s in sides],
    ).repartition(*[F.col(c) for c in id_cols])
    id_cols = [*id_cols, "_row"]
    marked = F.concat(
        *[_grams(F.col(f"_{s}"), n, s) for _, s in sides for n in range(1, max_order + 1)]
    )
    exploded = tokens.select(
        *id_cols,
        F.size("_r").alias("_nr"),
        F.size("_h").alias("_nh"),
        F.explode_outer(marked).alias("_g"),
    )
    counted = exploded.groupBy(*id_cols, "_nr", "_nh", "_g.order", "_g.gram").agg(
        F.least(F.count_if(F.col("_g.side") == "r"), F.count_if(F.col("_g.side") == "h")).alias("m")
    )
    matches = [
        F.coalesce(F.sum(F.when(F.col("order") == n, F.col("m"))), F.lit(0)).alias(f"m{n}")
        for n in range(1, max_order + 1)
    ]
    return counted.groupBy(*id_cols, "_nr", "_nh").agg(*matches)


def rouge_1(df: DataFrame, id_cols: list[str], ref: str, hyp: str) -> DataFrame:
    """Unigram precision, recall and F1 of ``hyp`` against ``ref`` per row key.

    Tokens are split at white space and matched as written; counts are clipped.
    An empty side scores 0.
    """
    both = _overlaps(df, id_cols, ref, hyp, 1)
    m, nr, nh = (F.col(c).cast("double") for c in ("m1", "_nr", "_nh"))
    zero = F.lit(0.0)
    return both.select(
        *id_cols,
        F.round(F.coalesce(F.try_divide(m, nh), zero), 6).alias("rouge_1_precision"),
        F.round(F.coalesce(F.try_divide(m, nr), zero), 6).alias("rouge_1_recall"),
        F.round(F.coalesce(F.try_divide(2 * m, nr + nh), zero), 6).alias("rouge_1"),
    )


def bleu(df: DataFrame, id_cols: list[str], ref: str, hyp: str) -> DataFrame:
    """BLEU-4 per row key: clipped precisions of orders 1 to 4 and the brevity penalty.

    Orders above 1 are smoothed by adding one match and one gram. Without a
    common token the score is 0.
    """
    both = _overlaps(df, id_cols, ref, hyp, MAX_ORDER)
    nr, nh = F.col("_nr").cast("double"), F.col("_nh").cast("double")
    logs = [F.log(F.try_divide(F.col("m1").cast("double"), nh))]
    for n in range(2, MAX_ORDER + 1):
        grams = F.greatest(nh - (n - 1), F.lit(0.0))
        logs.append(F.log((F.col(f"m{n}") + 1) / (grams + 1)))
    mean = reduce(lambda a, b: a + b, logs) / MAX_ORDER
    brevity = F.when(nh < nr, 1 - nr / nh).otherwise(0.0)
    score = F.when(F.col("m1") > 0, F.exp(mean + brevity)).otherwise(0.0)
    return both.select(*id_cols, F.round(score, 6).alias("bleu"))


def aggregate_metrics(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Two rows, ``AVERAGE`` and ``STANDARD_DEVIATION``, with a ``{score}`` struct per metric."""
    folds = {"AVERAGE": F.avg, "STANDARD_DEVIATION": F.stddev_samp}
    rows = [
        F.struct(
            F.lit(name).alias("aggregationMetric"),
            *[F.struct(F.round(fold(m), 6).alias("score")).alias(m) for m in metrics],
        )
        for name, fold in folds.items()
    ]
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def mean_std_metrics(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, average, std_dev)."""
    return reshape_aggregates(aggregate_metrics(df, metrics))


def reshape_aggregates(df: DataFrame, name: str = "aggregationMetric") -> DataFrame:
    """One row per metric, one column per statistic, from one struct column per metric.

    Columns that are no struct with a ``score`` are skipped.
    """
    metrics = [
        f.name
        for f in df.schema.fields
        if f.name != name and isinstance(f.dataType, T.StructType) and "score" in f.dataType.names
    ]
    scores = df.select(name, *[F.col(f"{m}.score").cast("double").alias(m) for m in metrics])
    return (
        scores.unpivot(name, metrics, "metric", "score")
        .groupBy("metric")
        .pivot(name, list(STATISTICS))
        .agg(F.first("score", ignorenulls=True))
        .withColumnsRenamed(STATISTICS)
    )


def reshape_evaluations(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Prompt, response and one column per metric from the nested result rows.

    ``jsonInstance`` may be JSON text or a struct. A metric without a score is
    NULL; of several entries the last counts. Each row is reshaped in place.
    """
    if isinstance(df.schema["jsonInstance"].dataType, T.StringType):
        parsed = F.from_json("jsonInstance", "prompt string, response string")
    else:
        parsed = F.col("jsonInstance")

    def last_score(metric: str) -> Column:
        scores = F.transform(
            "evaluationResults", lambda r: F.try_element_at(r, F.lit(metric))["score"]
        )
        known = F.filter(scores, lambda s: s.isNotNull())
        return F.try_element_at(known, F.lit(-1)).alias(metric)

    return df.withColumn("_i", parsed).select(
        *[c for c in df.columns if c not in ("jsonInstance", "evaluationResults")],
        F.col("_i.prompt").alias("prompt"),
        F.col("_i.response").alias("response"),
        *[last_score(m) for m in metrics],
    )


def compare_models(a: DataFrame, b: DataFrame, on: list[str], metrics: list[str]) -> DataFrame:
    """Scores of two response sets over the same prompts, and who is better."""
    pair = a.select(*on, *[F.col(m).alias(f"{m}_a") for m in metrics]).join(
        b.select(*on, *[F.col(m).alias(f"{m}_b") for m in metrics]), on
    )
    for m in metrics:
        x, y = F.col(f"{m}_a"), F.col(f"{m}_b")
        winner = F.when(x > y, "a").when(y > x, "b").when(x == y, "tie")
        pair = pair.withColumn(f"{m}_winner", winner)
    return pair


def win_counts(compared: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, a_wins, b_wins, ties, a_mean, b_mean)."""
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.count_if(F.col(f"{m}_winner") == "a").alias("a_wins"),
            F.count_if(F.col(f"{m}_winner") == "b").alias("b_wins"),
            F.count_if(F.col(f"{m}_winner") == "tie").alias("ties"),
            F.round(F.avg(f"{m}_a"), 6).alias("a_mean"),
            F.round(F.avg(f"{m}_b"), 6).alias("b_mean"),
        )
        for m in metrics
    ]
    return compared.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))
