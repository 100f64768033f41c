"""Regression and classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import scan_before


def _error(y: str, yhat: str) -> Column:
    return F.col(y).cast("double") - F.col(yhat).cast("double")


def _rmse(y: str, yhat: str) -> Column:
    return F.round(F.sqrt(F.avg(_error(y, yhat) * _error(y, yhat))), 6)


def rmse(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        _rmse(y, yhat).alias("rmse"), F.count(_error(y, yhat)).alias("n")
    )


def rmse_of(df: DataFrame, y: str, forecasts: dict[str, str], by: list[str]) -> DataFrame:
    """The error of several forecasts, as columns named by ``forecasts``, in one aggregate."""
    return df.groupBy(*by).agg(*[_rmse(y, c).alias(name) for name, c in forecasts.items()])


def fold_summary(scores: DataFrame, cols: list[str], fold: str = "fold") -> DataFrame:
    """Scores per fold and, as fold ``mean``, their means."""
    # Both the folds and the total come from one reading.
    return scores.groupingSets([[fold], []], fold).agg(
        *[F.round(F.avg(c), 6).alias(f"_{c}") for c in cols], F.grouping(fold).alias("_all")
    ).select(
        F.when(F.col("_all") == 1, "mean").otherwise(F.col(fold)).alias(fold),
        *[F.col(f"_{c}").alias(c) for c in cols],
    )


def importance_topn(df: DataFrame, n: int = 20) -> DataFrame:
    return (
        df.groupBy("feature")
        .agg(F.round(F.avg("importance"), 6).alias("mean"))
        .orderBy(F.desc("mean"), F.asc("feature"))
        .limit(n)
    )


def binary_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.5
) -> DataFrame:
    """Precision, recall, accuracy, F1, log loss and ROC AUC from 0/1 labels and scores.

    The area counts, per distinct score, the negatives below it; equal scores
    count half. Scores are collapsed to their distinct values first.
    """
    per_score = (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) != 1).alias("neg"),
        )
    )
    ranked = scan_before(per_score, "s", "neg", "_neg_below")
    hit = F.col("s") >= threshold
    clipped = F.greatest(F.least(F.col("s"), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -(F.col("pos") * F.log(clipped) + F.col("neg") * F.log(1 - clipped))
    sums = ranked.agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("q"),
        F.sum(loss).alias("loss"),
        F.sum(F.col("pos") * (F.col("_neg_below") + F.col("neg") / 2)).alias("wins"),
    )
    tp, fp, p, q = (F.col(c).cast("double") for c in ("tp", "fp", "p", "q"))
    return sums.select(
        F.round(F.try_divide(tp, tp + fp), 6).alias("precision"),
        F.round(F.try_divide(tp, p), 6).alias("recall"),
        F.round(F.try_divide(tp + q - fp, p + q), 6).alias("accuracy"),
        F.round(F.try_divide(2 * tp, p + tp + fp), 6).alias("f1_score"),
        F.round(F.try_divide(F.col("loss"), p + q), 6).alias("log_loss"),
        F.round(F.try_divide(F.col("wins"), p * q), 6).alias("roc_auc"),
    )
