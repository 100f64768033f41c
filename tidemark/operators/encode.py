"""Encoders, scalers and repeatable splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators.ordered import scan_before


def one_hot(cats: list[str], nums: list[str], out: str = "features") -> Pipeline:
    """Vector of indicator slots, then the numeric columns; an unseen level is all zeros.

    The slots of a column follow the text order of the levels seen in the fit.
    """
    indexed = [f"{c}_index" for c in cats]
    slots = [f"{c}_slots" for c in cats]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=cats,
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            # The dropped last slot is the one the indexer keeps for unseen levels.
            OneHotEncoder(inputCols=indexed, outputCols=slots, dropLast=True),
            VectorAssembler(inputCols=slots + nums, outputCol=out, handleInvalid="keep"),
        ]
    )


def vector_slots(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Non-zero entries of a vector column as rows (keys, slot, value)."""
    values = F.posexplode(vector_to_array(vector)).alias("slot", "value")
    return df.select(*keys, values).where(F.col("value") != 0)


def fitted_levels(df: DataFrame, column: str) -> list:
    """Levels that a fitted indexer has for a column, numbers in the order of numbers."""
    indexer = StringIndexer(inputCol=column, outputCol="_i", handleInvalid="skip")
    labels = indexer.fit(df).labelsArray[0]
    if isinstance(df.schema[column].dataType, T.NumericType):
        return sorted(labels, key=float)
    return sorted(labels)


def dummies(df: DataFrame, levels: dict[str, Sequence], drop_first: bool = True) -> DataFrame:
    """Replace each category by 0/1 columns ``<name>_<level>`` for its given levels.

    The first level of each gets no column, unless ``drop_first`` is off.
    """
    marks = [
        F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in levels.items()
        for v in list(values)[1 if drop_first else 0 :]
    ]
    return df.select(*[c for c in df.columns if c not in levels], *marks)


def ordinal_levels(train: DataFrame, column: str) -> DataFrame:
    """(level, code): rank of each level of the training rows, from 0."""
    levels = (
        train.select(F.col(column).alias("level")).where("level IS NOT NULL").distinct()
    ).withColumn("_one", F.lit(1).cast("bigint"))
    return scan_before(levels, "level", "_one", "code").drop("_one")


def ordinal_encode(train: DataFrame, apply: DataFrame, column: str, out: str) -> DataFrame:
    """Add the training rank of ``column``; -1 for levels unseen in ``train``."""
    codes = ordinal_levels(train, column).select(
        F.col("level").alias(column), F.col("code").alias(out)
    )
    return apply.join(codes, column, "left").fillna(-1, [out])


def standardize(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation, in place; a constant column becomes 0."""
    fit = (df if fit_on is None else fit_on).agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in cols],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in cols],
        )
    )
    moments = df.withColumn("_m", fit.scalar())
    scaled = {
        c: F.when(F.col(f"_m.{c}_std") == 0, F.col(c) - F.col(f"_m.{c}_mean")).otherwise(
            (F.col(c) - F.col(f"_m.{c}_mean")) / F.col(f"_m.{c}_std")
        )
        for c in cols
    }
    return moments.withColumns(scaled).drop("_m")


def split_random(
    df: DataFrame, weights: dict[str, float], keys: list[str], seed: int = 42, out: str = "data_type"
) -> DataFrame:
    """Label rows by a hash of their key: the same split on every read and partitioning."""
    draw = S.unit_draw(*keys, F.lit(seed))
    total, below = sum(weights.values()), 0.0
    label, names = None, list(weights)
    for name in names[:-1]:
        below += weights[name]
        hit = draw < round(below / total, 6)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    last = F.lit(names[-1])
    return df.withColumn(out, last if label is None else label.otherwise(last))


def head_tail_split(
    df: DataFrame, order: list[str], ratio: float = 0.9, out: str = "part"
) -> DataFrame:
    """Label the first ``int(n * ratio)`` rows by the unique ``order`` as train, the rest as predict.

    Only the keys are put in order, to find the one at the cut; the rows are then
    labelled where they are, without a sort or a shuffle.
    """
    key = F.struct(*order)
    keys = df.select(key.alias("k"), F.lit(1).cast("bigint").alias("one"))
    placed = scan_before(keys, "k", "one", "before")
    cut = placed.agg(F.floor(F.count(F.lit(1)) * F.lit(ratio))).scalar()
    edge = placed.where(F.col("before") == cut).select("k").scalar()
    return df.withColumn(
        out, F.when(F.coalesce(key >= edge, F.lit(False)), "predict").otherwise("train")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight ``n / (k * n_c)`` per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(F.sum("n") / F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", size / F.col("n"))


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    # One row per class.
    return df.join(F.broadcast(weights), label)
