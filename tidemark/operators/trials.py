"""Parameter trials: grids, the best and the non-dominated trials."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import scan_before


def parameter_grid(studies: DataFrame, spec: dict[str, Sequence[float]]) -> DataFrame:
    """Every combination of the listed values, for each study row."""
    return reduce(
        lambda df, item: df.withColumn(
            item[0], F.explode(F.array(*[F.lit(float(v)) for v in item[1]]))
        ),
        spec.items(),
        studies,
    )


def best_trials(trials: DataFrame, study: str, order: list[str], metric: str = "cost") -> DataFrame:
    """The cheapest trial per study; ties go to the smaller ``order`` columns."""
    whole = F.struct(*trials.columns)
    rank = F.struct(metric, *order)
    return trials.groupBy(study).agg(F.min_by(whole, rank).alias("_b")).select("_b.*")


def pareto_front(df: DataFrame, minimise: str, maximise: str) -> DataFrame:
    """Rows no other row beats: none as cheap and better, or cheaper and as good.

    Only the best value per distinct cost can stay, and only if it beats every
    cheaper cost; that running maximum is scanned in ranges of the cost. NULL or
    NaN objectives never stay.
    """
    valid = df.where(
        F.col(minimise).isNotNull()
        & F.col(maximise).isNotNull()
        & ~F.isnan(minimise)
        & ~F.isnan(maximise)
    )
    best = valid.groupBy(minimise).agg(F.max(maximise).alias("_best"))
    front = (
        scan_before(best, minimise, "_best", "_cheaper", how="max")
        .where(F.col("_cheaper").isNull() | (F.col("_best") > F.col("_cheaper")))
        .select(minimise, F.col("_best").alias(maximise))
    )
    return valid.join(front, [minimise, maximise], "left_semi")
