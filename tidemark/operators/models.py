"""Model fitting, search and scoring on Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import clip_lower
from tidemark.operators.encode import one_hot, with_class_weights
from tidemark.operators.metrics import rmse_of
from tidemark.session import freeze


def regressor_stages(
    cats: list[str], nums: list[str], label: str, valid: str | None = None, **params: Any
) -> Pipeline:
    """Encoders and boosted trees in one pipeline, so that they are saved together.

    Defaults: squared loss, depth 6, step 0.1, up to 100 rounds. Each round draws
    rows and each split draws columns with ``subsamplingRate`` and
    ``featureSubsetStrategy``. ``valid`` names a boolean column that marks the rows
    used for early stopping.
    """
    trees = GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="prediction",
        **{"maxDepth": 6, "stepSize": 0.1, "maxIter": 100, "seed": 42, **params},
    )
    if valid:
        trees.setValidationIndicatorCol(valid)
    encoders = one_hot(cats, nums) if cats else VectorAssembler(inputCols=nums, outputCol="features")
    return Pipeline(stages=[encoders, trees])


def train_regressor(
    train: DataFrame,
    valid: DataFrame | None,
    cats: list[str],
    nums: list[str],
    label: str,
    **params: Any,
) -> PipelineModel:
    if valid is None:
        return regressor_stages(cats, nums, label, **params).fit(train)
    marked = train.withColumn("_valid", F.lit(False)).unionByName(
        valid.withColumn("_valid", F.lit(True))
    )
    return regressor_stages(cats, nums, label, valid="_valid", **params).fit(marked)


def feature_importance(
    model: PipelineModel, scored: DataFrame, nums: list[str], vector: str = "features"
) -> list[tuple[str, float]]:
    """(feature, importance): numeric columns by name, the slots of a category added up."""
    values = model.stages[-1].featureImportances.toArray()
    attrs = scored.schema[vector].metadata["ml_attr"]["attrs"]
    totals: dict[str, float] = {}
    for a in (a for group in attrs.values() for a in group):
        name = a["name"] if a["name"] in nums else a["name"].split("_slots_")[0]
        totals[name] = totals.get(name, 0.0) + float(values[a["idx"]])
    return sorted(totals.items())


def search_settings(
    n: int,
    step: tuple[float, float] = (0.001, 0.1),
    leaves: tuple[int, int] = (10, 100),
    seed: int = 42,
) -> list[dict[str, Any]]:
    """``n`` repeatable settings: step size log-uniform, tree size as a depth.

    Boosted trees here are bounded by depth, so a number of leaves becomes the
    depth that has room for it.
    """
    draw = random.Random(seed)
    return [
        {
            "stepSize": step[0] * (step[1] / step[0]) ** draw.random(),
            "maxDepth": math.ceil(math.log2(draw.randint(*leaves))),
        }
        for _ in range(n)
    ]


def cross_validate(
    rows: DataFrame,
    cats: list[str],
    nums: list[str],
    label: str,
    baseline: str,
    save_to: str | None = None,
    together: int = 4,
    **params: Any,
) -> tuple[DataFrame, DataFrame]:
    """Fit each fold on its ``train`` rows and score its ``valid`` rows.

    ``rows`` come from ``time_series_folds``. Every fold has encoders of its own;
    with ``save_to`` the encoders and trees of each fold are saved in a folder
    below it. Folds are fitted ``together`` at a time. Returns (fold, rmse_prev,
    rmse), where ``rmse_prev`` is the error of the ``baseline`` column, and
    (fold, feature, importance).
    """
    spark, rows = rows.sparkSession, freeze(rows, "folds")
    folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect())

    def fit(fold: str) -> tuple[tuple, list[tuple]]:
        train = rows.where((F.col("fold") == fold) & (F.col("role") == "train"))
        valid = rows.where((F.col("fold") == fold) & (F.col("role") == "valid"))
        model = train_regressor(train, valid, cats, nums, label, **params)
        if save_to:
            save_model(model, f"{save_to}/{fold}")
        scored = model.transform(valid)
        errors = rmse_of(scored, label, {"prev": baseline, "model": "prediction"}, []).first()
        importance = [(fold, f, v) for f, v in feature_importance(model, scored, nums)]
        return (fold, errors["prev"], errors["model"]), importance

    with ThreadPoolExecutor(together) as pool:
        results = list(pool.map(fit, folds))
    return (
        spark.createDataFrame([s for s, _ in results], "fold string, rmse_prev double, rmse double"),
        spark.createDataFrame(
            [i for _, each in results for i in each],
            "fold string, feature string, importance double",
        ),
    )


def param_sweep(
    train: DataFrame,
    test: DataFrame,
    cats: list[str],
    nums: list[str],
    label: str,
    grid: Sequence[dict[str, Any]],
    together: int = 8,
    valid: DataFrame | None = None,
) -> DataFrame:
    """One fit per setting, ``together`` at a time; (trial, settings, rmse on ``test``), best first.

    With ``valid``, each fit ends when its error there no longer falls. Only the scores,
    one number per trial, come back to the driver.
    """
    evaluator = RegressionEvaluator(labelCol=label, metricName="rmse")
    encoders = one_hot(cats, nums).fit(train)
    rows = train.withColumn("_valid", F.lit(False))
    if valid is not None:
        rows = rows.unionByName(valid.withColumn("_valid", F.lit(True)))
    # The encoded rows are read once per boosting round of every trial.
    fit_rows = encoders.transform(rows).select(label, "features", "_valid").persist()
    test_rows = encoders.transform(test).select(label, "features").persist()

    def score(trial: int) -> tuple[int, str, float]:
        params = grid[trial - 1]
        trees = GBTRegressor(featuresCol="features", labelCol=label, seed=42, **params)
        if valid is not None:
            trees.setValidationIndicatorCol("_valid")
        rmse = float(evaluator.evaluate(trees.fit(fit_rows).transform(test_rows)))
        return trial, str(params), rmse

    with ThreadPoolExecutor(together) as pool:
        scores = list(pool.map(score, range(1, len(grid) + 1)))
    fit_rows.unpersist()
    test_rows.unpersist()
    spark = train.sparkSession
    return spark.createDataFrame(scores, "trial int, settings string, rmse double").orderBy("rmse")


def train_classifier(
    train: DataFrame,
    label: str,
    positive: str,
    cats: list[str],
    nums: list[str],
    reg_params: Sequence[float] = (0.0, 0.0001, 0.0003, 0.001, 0.003, 0.01, 0.03, 0.1, 0.3, 1.0),
    elastic_nets: Sequence[float] = (0.0, 0.5, 1.0),
    eval_fraction: float = 0.2,
    seed: int = 42,
) -> PipelineModel:
    """Class-weighted logistic regression, searched on a held-out fraction: 30 settings of the
    penalty's size and mix by default."""
    rows = with_class_weights(train, label, "_weight").withColumn(
        "_y", (F.col(label) == positive).cast("double")
    )
    encoders = one_hot(cats, nums).fit(rows)
    fit = LogisticRegression(featuresCol="features", labelCol="_y", weightCol="_weight", maxIter=50)
    grid = (
        ParamGridBuilder()
        .addGrid(fit.regParam, list(reg_params))
        .addGrid(fit.elasticNetParam, list(elastic_nets))
        .build()
    )
    search = TrainValidationSplit(
        estimator=fit,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol="_y"),
        trainRatio=1 - eval_fraction,
        seed=seed,
        parallelism=8,
    )
    encoded = encoders.transform(rows).select("features", "_y", "_weight").persist()
    best = search.fit(encoded).bestModel
    encoded.unpersist()
    return PipelineModel(stages=[*encoders.stages, best])


def class_scores(model: Transformer, df: DataFrame, label: str, positive: str) -> DataFrame:
    """0/1 label and score of the positive class, ready for ``binary_metrics``."""
    scored = model.transform(df)
    return scored.select(
        (F.col(label) == positive).cast("int").alias("label"),
        vector_to_array("probability")[1].alias("score"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_score(
    df: DataFrame, model: PipelineModel | str, keys: list[str], prediction_date: str
) -> DataFrame:
    """Scored rows: keys, date, predicted amount, and the amount with negatives set to 0."""
    fitted = load_model(model) if isinstance(model, str) else model
    scored = fitted.transform(df).select(
        *keys,
        F.lit(prediction_date).cast("date").alias("prediction_date"),
        F.col("prediction").alias("predicted_amount"),
    )
    return clip_lower(scored, "predicted_amount", "predicted_amount_clipped")


def rf_importance(
    df: DataFrame, inputs: Sequence[str], target: str, trees: int = 100, seed: int = 42
) -> DataFrame:
    """Importance of the input columns for the target in a random forest, highest first.

    Text is read as numbers. A value that is no number is an error that names its column.
    """
    used = [*inputs, target]
    if not inputs or set(used) - set(df.columns):
        raise ValueError(f"need {target} and input columns, have {df.columns}")
    plain = df.select(*[F.col(f"`{c}`").try_cast("double").alias(f"c{i}") for i, c in enumerate(used)])
    checks = plain.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in plain.columns],
    ).first()
    broken = [name for name, c in zip(used, plain.columns, strict=True) if checks[c]]
    if broken:
        raise ValueError(f"not a number in: {', '.join(broken)}")
    if checks["rows"] < 2:
        raise ValueError("a forest needs two rows or more")
    rows = VectorAssembler(inputCols=plain.columns[:-1], outputCol="x").transform(plain)
    forest = RandomForestRegressor(
        featuresCol="x", labelCol=plain.columns[-1], numTrees=trees, seed=seed
    ).fit(rows)
    result = [(n, float(v)) for n, v in zip(inputs, forest.featureImportances.toArray(), strict=True)]
    return df.sparkSession.createDataFrame(result, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


__all__ = [
    "batch_score",
    "class_scores",
    "cross_validate",
    "feature_importance",
    "load_model",
    "param_sweep",
    "regressor_stages",
    "rf_importance",
    "save_model",
    "search_settings",
    "train_classifier",
    "train_regressor",
]
