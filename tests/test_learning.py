import pytest
from pyspark.sql import functions as F

from tidemark.operators import encode as E
from tidemark.operators import metrics, models
from tidemark.operators import trials as R


def test_one_hot_unseen_level_is_all_zeros(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    model = E.one_hot(["c"], ["x"]).fit(train)
    rows = model.transform(spark.createDataFrame([("b", 5.0), ("new", 6.0)], "c string, x double"))
    assert [list(r.features.toArray()) for r in rows.collect()] == [[0, 1, 5], [0, 0, 6]]


def test_dummies_drop_the_smallest_number(spark):
    df = spark.createDataFrame([(2,), (10,), (None,)], "h int")
    levels = {"h": E.fitted_levels(df, "h")}
    assert levels == {"h": ["2", "10"]}
    out = E.dummies(df, levels)
    assert out.columns == ["h_10"] and [r[0] for r in out.collect()] == [0, 1, 0]


def test_ordinal_encode_unseen_and_null(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    apply = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    out = {r.c: r.code for r in E.ordinal_encode(train, apply, "c", "code").collect()}
    assert out == {"a": 0, "b": 1, "z": -1, None: -1}


def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "x double, k double")
    assert {tuple(r) for r in E.standardize(df, ["x", "k"]).collect()} == {(-1.0, 0.0), (1.0, 0.0)}


def test_split_is_stable_and_near_its_weights(spark):
    df = spark.range(4000)
    weights = {"train": 0.8, "valid": 0.1, "test": 0.1}
    a = {r.id: r.part for r in E.split_random(df, weights, ["id"], out="part").collect()}
    b = {r.id: r.part for r in E.split_random(df.repartition(13), weights, ["id"], out="part").collect()}
    assert a == b
    assert abs(sum(v == "train" for v in a.values()) / 4000 - 0.8) < 0.03


def test_class_weights(spark):
    df = spark.createDataFrame([("x",)] * 3 + [("y",)], "l string")
    assert {r.l: r.weight for r in E.class_weights(df, "l").collect()} == {"x": 4 / 6, "y": 2.0}


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "y double, p double")
    assert metrics.rmse(df, "y", "p").first().rmse == round(2.5**0.5, 6)


def test_grid(spark):
    one = spark.createDataFrame([(1,)], "study int")
    grid = R.parameter_grid(one, {"t": [18, 20, 22, 24, 26, 28, 30], "w": [1, 2]})
    assert [r.t for r in grid.where("w = 1").orderBy("t").collect()] == [18, 20, 22, 24, 26, 28, 30]
    assert grid.count() == 14


def test_rf_importance_sums_to_one_and_guards(spark):
    cols = "`param.t` string, `param.w` string, `metric.cost` string"
    inputs, target = ["param.t", "param.w"], "metric.cost"
    rows = [("24", "5", "99"), ("25", "6", "105"), ("23", "4", "103")]

    def run(data, names=inputs):
        return models.rf_importance(spark.createDataFrame(data, cols), names, target, trees=5)

    out = run(rows).collect()
    assert {r.feature for r in out} == set(inputs)
    assert abs(sum(r.importance for r in out) - 1) < 1e-9
    with pytest.raises(ValueError, match="not a number in: param.t$"):
        run([*rows, ("x", "1", "2")])
    with pytest.raises(ValueError, match="not a number in: metric.cost$"):
        run([*rows, ("1", "1", None)])
    with pytest.raises(ValueError, match="two rows"):
        run(rows[:1])
    with pytest.raises(ValueError, match="input columns"):
        run(rows, [])
    with pytest.raises(ValueError, match="input columns"):
        run(rows, ["param.z"])


def test_regressor_beats_the_mean_and_survives_saving(spark, tmp_path):
    rows = spark.range(300).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"),
        (F.col("id") % 10).cast("double").alias("x"),
    )
    rows = rows.withColumn("y", F.col("x") * 3 + F.when(F.col("c") == "a", 5.0).otherwise(0.0) - 4)
    model = models.train_regressor(rows, None, ["c"], ["x"], "y", maxIter=5, maxDepth=4)
    path = str(tmp_path / "model")
    models.save_model(model, path)
    scored = models.load_model(path).transform(rows)
    spread = rows.agg(F.stddev_pop("y")).first()[0]
    assert metrics.rmse(scored, "y", "prediction").first().rmse < spread / 2
    out = models.batch_score(rows, path, ["x"], "2011-12-01")
    assert out.where("predicted_amount_clipped < 0").count() == 0
    assert out.where("predicted_amount < 0").count() > 0


def test_classifier_separates(spark):
    rows = spark.range(400).select(
        (F.col("id") % 20).cast("double").alias("x"),
        F.when(F.col("id") % 3 == 0, "p").otherwise("q").alias("c"),
    ).withColumn("label", F.when(F.col("x") > 12, "yes").otherwise("no"))
    model = models.train_classifier(rows, "label", "yes", ["c"], ["x"], (0.01,), (0.0,))
    scored = models.class_scores(model, rows, "label", "yes")
    assert metrics.binary_metrics(scored, "label", "score").first().roc_auc > 0.95


def test_cross_validate_beats_the_baseline(spark, tmp_path):
    rows = spark.range(600).select(
        F.concat(F.lit("fold"), (F.col("id") % 2).cast("string")).alias("fold"),
        F.when(F.col("id") % 3 == 0, "valid").otherwise("train").alias("role"),
        F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("c"),
        (F.col("id") % 11).cast("double").alias("x"),
    )
    rows = rows.withColumns({"y": F.col("x") * 2 + 1, "prev": F.lit(0.0)})
    scores, importance = models.cross_validate(
        rows, ["c"], ["x"], "y", "prev", save_to=str(tmp_path), maxIter=4, maxDepth=4
    )
    assert models.load_model(str(tmp_path / "fold1")).transform(rows).count() == 600
    assert [r.rmse < r.rmse_prev for r in scores.collect()] == [True, True]
    assert {r.feature for r in importance.collect()} == {"c", "x"}
    top = metrics.importance_topn(importance, 1).first()
    assert top.feature == "x" and top["mean"] > 0.9


def test_search_settings_are_repeatable_and_in_range():
    a = models.search_settings(20)
    assert a == models.search_settings(20)
    assert all(0.001 <= s["stepSize"] <= 0.1 and 4 <= s["maxDepth"] <= 7 for s in a)
