"""Encoders, splits, metrics, model fitting, parameter trials."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import customers as U
from tidemark.operators import encode as E
from tidemark.operators import boosting, metrics, models
from tidemark.operators import trials as R
from tidemark.operators.cleaning import exclude_placeholder, prepare_trips
from tidemark.plans.adapters import (
    CENSUS,
    DATES,
    FEATURES_CTE,
    FOLDS,
    PREPARED,
    PREPARED_IDS,
    SPLITS,
    TRIPS,
    Tables,
    draw_sql,
)
from tidemark.plans.registry import query, with_ctes
from tidemark.plans.retail import NUMERIC, folds_sql
from tidemark.session import freeze, shared_dir

CATS = ["payment_type", "day_of_week", "hour_of_day"]
NUMS = ["passenger_count", "trip_distance"]
ROUNDS = 100


def trip_rows(t: Tables):
    """Prepared trips that keep their id, categories as text."""
    rows = prepare_trips(t.trips(), keys=["event_id"])
    return rows.withColumns({c: F.col(c).cast("string") for c in CATS})


ROWS = """
rows_ AS (
  SELECT * REPLACE (day_of_week::VARCHAR AS day_of_week, hour_of_day::VARCHAR AS hour_of_day)
  FROM prepared_ids),
train AS (SELECT * FROM rows_ WHERE hour_of_day <> '23' AND day_of_week <> '7')
"""


def slots_sql() -> str:
    parts, offset = [], "0"
    for c in CATS:
        levels = f"(SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS k FROM (SELECT DISTINCT {c} FROM train))"
        parts.append(
            f"SELECT event_id, ({offset} + k)::INTEGER AS slot, 1.0::DOUBLE AS value "
            f"FROM rows_ JOIN {levels} ON {c} = v"
        )
        offset += f" + (SELECT count(DISTINCT {c}) FROM train)"
    for i, c in enumerate(NUMS):
        parts.append(
            f"SELECT event_id, ({offset} + {i})::INTEGER AS slot, {c}::DOUBLE AS value "
            f"FROM rows_ WHERE {c} <> 0"
        )
    return " UNION ALL ".join(parts)


@query("one_hot_ignore_unknown", with_ctes(PREPARED, PREPARED_IDS, ROWS, select=slots_sql()))
def _(t: Tables):
    """Fitted without Saturdays and the last hour, which are then unseen levels."""
    rows = trip_rows(t)
    train = rows.where("hour_of_day <> '23' AND day_of_week <> '7'")
    encoded = E.one_hot(CATS, NUMS).fit(train).transform(rows)
    return E.vector_slots(encoded, ["event_id"], "features")


TYPES = ["click", "error", "purchase", "signup", "view"]


def dummies_sql() -> str:
    levels = {"payment_type": TYPES, "day_of_week": range(1, 8)}
    return ", ".join(
        f"({c} = {v!r})::INTEGER AS {c}_{v}" for c, vs in levels.items() for v in list(vs)[1:]
    )


@query(
    "dummies_drop_first",
    with_ctes(PREPARED, select=f"SELECT pickup_datetime, hour_of_day, {dummies_sql()} FROM prepared"),
)
def _(t: Tables):
    rows = prepare_trips(t.trips()).select(
        "pickup_datetime", "payment_type", "day_of_week", "hour_of_day"
    )
    return E.dummies(rows, {"payment_type": TYPES, "day_of_week": range(1, 8)})


@query(
    "ordinal_encode",
    with_ctes(
        FEATURES_CTE,
        """
levels AS (
  SELECT country_mode, dense_rank() OVER (ORDER BY country_mode) - 1 AS code
  FROM (SELECT DISTINCT country_mode FROM all_features WHERE prediction_date = DATE '1998-03-01'
          AND record_cnt > 4 AND country_mode IS NOT NULL))
""",
        select="""
SELECT customer_id, prediction_date, country_mode, coalesce(code, -1) AS country_code
FROM all_features LEFT JOIN levels USING (country_mode)""",
    ),
)
def _(t: Tables):
    """Fitted on the busy customers of the first date only, so that some levels are unseen."""
    rows = U.customer_features(t.clean(), DATES)
    train = rows.where((F.col("prediction_date") == DATES[0]) & (F.col("record_cnt") > 4))
    out = E.ordinal_encode(train, rows, "country_mode", "country_code")
    return out.select(*U.KEYS, "country_mode", "country_code")


@query(
    "standardize",
    with_ctes(
        PREPARED,
    PREPARED_IDS,
        select="""
SELECT pickup_datetime,
  round((passenger_count - avg(passenger_count) OVER ()) / stddev_pop(passenger_count) OVER (), 6)
    AS passenger_count,
  round((trip_distance - avg(trip_distance) OVER ()) / stddev_pop(trip_distance) OVER (), 6)
    AS trip_distance
FROM prepared""",
    ),
)
def _(t: Tables):
    rows = prepare_trips(t.trips()).select("pickup_datetime", *NUMS)
    return E.standardize(rows, NUMS).withColumns({c: F.round(c, 6) for c in NUMS})


SPLIT = f"""
split AS (
  SELECT *, CASE WHEN {draw_sql("person_id", "42")} < 0.8 THEN 'train' ELSE 'test' END AS data_type
  FROM census WHERE workclass NOT LIKE '%?%' AND occupation NOT LIKE '%?%')
"""


def census_split(t: Tables):
    rows = exclude_placeholder(t.census(), ["workclass", "occupation"])
    return E.split_random(rows, {"train": 0.8, "test": 0.2}, ["person_id"])


@query(
    "exclude_placeholder",
    with_ctes(
        CENSUS,
        select="SELECT * FROM census WHERE workclass NOT LIKE '%?%' AND occupation NOT LIKE '%?%'",
    ),
)
def _(t: Tables):
    return exclude_placeholder(t.census(), ["workclass", "occupation"])


@query("split_random", with_ctes(CENSUS, SPLIT, select="SELECT person_id, data_type FROM split"))
def _(t: Tables):
    return census_split(t).select("person_id", "data_type")


@query(
    "split_three_ways",
    with_ctes(
        TRIPS,
        select=f"""
SELECT event_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'valid' ELSE 'test' END AS part
FROM (SELECT event_id, {draw_sql("event_id", "42")} AS u FROM trips)""",
    ),
)
def _(t: Tables):
    weights = {"train": 0.8, "valid": 0.1, "test": 0.1}
    return E.split_random(t.trips().select("event_id"), weights, ["event_id"], out="part")


@query(
    "head_tail_split",
    """
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
         <= floor((SELECT count(*) FROM orders) * 0.9) THEN 'train' ELSE 'predict' END AS part
FROM orders""",
)
def _(t: Tables):
    rows = t.raw("orders").select("o_orderdate", "o_orderkey")
    return E.head_tail_split(rows, ["o_orderdate", "o_orderkey"], 0.9).drop("o_orderdate")


@query(
    "class_weights",
    with_ctes(
        CENSUS,
        select="""
SELECT income_bracket, count(*) AS n,
  (SELECT count(*) FROM census)::DOUBLE / (SELECT count(DISTINCT income_bracket) FROM census)
    / count(*) AS weight
FROM census GROUP BY income_bracket""",
    ),
)
def _(t: Tables):
    return E.class_weights(t.census(), "income_bracket")


def metrics_sql(source: str) -> str:
    return f"""
SELECT round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(p, 0), 6) AS recall,
  round((tp + q - fp) / (p + q), 6) AS accuracy, round(2 * tp / (p + tp + fp), 6) AS f1_score,
  round(loss / (p + q), 6) AS log_loss, round((ranks - p * (p + 1) / 2) / (p * q), 6) AS roc_auc
FROM (
  SELECT (count(*) FILTER (s >= 0.5 AND y = 1))::DOUBLE AS tp,
    (count(*) FILTER (s >= 0.5 AND y = 0))::DOUBLE AS fp,
    (count(*) FILTER (y = 1))::DOUBLE AS p, (count(*) FILTER (y = 0))::DOUBLE AS q,
    -sum(CASE WHEN y = 1 THEN ln(c) ELSE ln(1 - c) END) AS loss,
    sum(r) FILTER (y = 1) AS ranks
  FROM (
    SELECT y, s, greatest(least(s, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE) AS c,
      rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r
    FROM ({source})))"""


@query(
    "binary_metrics",
    metrics_sql(
        "SELECT quality AS y, (n_chars % 100) / 100 AS s FROM labels JOIN documents USING (doc_id)"
    ),
)
def _(t: Tables):
    rows = t.raw("labels").join(t.raw("documents").select("doc_id", "n_chars"), "doc_id")
    return metrics.binary_metrics(
        rows.select("quality", ((F.col("n_chars") % 100) / 100).alias("s")), "quality", "s"
    )


@query(
    "evaluate_classifier",
    with_ctes(
        CENSUS,
        SPLIT,
        select=metrics_sql(
            "SELECT (income_bracket = ' >50K')::INTEGER AS y, (person_id * 37 % 1000) / 1000 AS s "
            "FROM split WHERE data_type = 'test'"
        ),
    ),
)
def _(t: Tables):
    """Metrics of given scores on the test rows."""
    test = census_split(t).where("data_type = 'test'")
    given = test.select(
        (F.col("income_bracket") == " >50K").cast("int").alias("label"),
        (F.col("person_id") * 37 % 1000 / 1000).alias("score"),
    )
    return metrics.binary_metrics(given, "label", "score")


CENSUS_CATS = ["workclass", "education", "marital_status", "occupation"]
CENSUS_NUMS = ["age", "hours_per_week"]


@query("train_classifier")
def _(t: Tables):
    rows = census_split(t).drop("person_id")
    train, test = (rows.where(f"data_type = '{k}'").drop("data_type") for k in ("train", "test"))
    model = models.train_classifier(train, "income_bracket", " >50K", CENSUS_CATS, CENSUS_NUMS)
    scored = models.class_scores(model, test, "income_bracket", " >50K")
    return metrics.binary_metrics(scored, "label", "score")


def trip_parts(t: Tables):
    """The first nine tenths of the trips by time, split 80/10/10; the last tenth is left to predict."""
    rows = E.head_tail_split(trip_rows(t), ["pickup_datetime", "event_id"], 0.9)
    head = rows.where("part = 'train'").drop("part")
    weights = {"train": 0.8, "valid": 0.1, "test": 0.1}
    return E.split_random(head, weights, ["event_id"])


PARTS_SQL = f"""
parts AS (
  SELECT event_id, {draw_sql("event_id", "42")} AS u FROM (
    SELECT *, row_number() OVER (ORDER BY pickup_datetime, event_id) AS k FROM prepared_ids)
  WHERE k <= floor((SELECT count(*) FROM prepared_ids) * 0.9))"""


@query(
    "train_regressor",
    with_ctes(
        TRIPS,
        PREPARED_IDS,
        PARTS_SQL,
        select="""
SELECT CASE WHEN u < 0.9 THEN 'valid' ELSE 'test' END AS data_type, count(*) AS n, true AS has_error
FROM parts WHERE u >= 0.8 GROUP BY 1""",
    ),
)
def _(t: Tables):
    """Trees stopped early on the validation rows, applied there and to the test rows: the rows
    of each part, and that their error is a number. The error itself no SQL can know."""
    rows = trip_parts(t).persist()
    train, valid = (rows.where(f"data_type = '{k}'") for k in ("train", "valid"))
    model = models.train_regressor(
        train, valid, CATS, NUMS, "tip_amount", subsamplingRate=0.8, featureSubsetStrategy="0.8"
    )
    rows.unpersist()
    scored = model.transform(trip_parts(t).where("data_type <> 'train'"))
    errors = metrics.rmse(scored, "tip_amount", "prediction", ["data_type"])
    return errors.select("data_type", "n", is_number("rmse").alias("has_error"))


def is_number(c: str):
    """A finite value that is not negative."""
    value = F.col(c)
    return F.coalesce((value >= 0) & (value < float("inf")), F.lit(False))


def in_dates(part: str) -> str:
    return f"prediction_date IN ({', '.join(f"DATE '{d}'" for d in SPLITS[part])})"


@query(
    "train_leafwise",
    with_ctes(
        FEATURES_CTE,
        select=f"""
SELECT CASE WHEN {in_dates("TEST")} THEN 'TEST' ELSE 'VALIDATE' END AS data_type, count(*) AS cnt,
  round(sqrt(avg(power(target - coalesce(prev_month_amount, 0), 2))), 6) AS rmse_prev, true AS better
FROM labelled LEFT JOIN last_month USING (customer_id, prediction_date)
WHERE NOT {in_dates("TRAIN")} GROUP BY 1""",
    ),
)
def _(t: Tables):
    """Leaf-wise trees on the customers' features, stopped early: is their error below that of
    last month's amount on the dates they have not seen?"""
    rows = freeze(U.training_set(t.clean(), DATES, baseline_days=30), "customers")
    train, valid = (rows.where(in_dates(part)) for part in ("TRAIN", "VALIDATE"))
    settings = boosting.Settings(
        rounds=10, leaves=15, row_fraction=0.8, row_every=5, column_fraction=0.9, l2=1.0, patience=3
    )
    model = boosting.fit_boosted(train, valid, NUMERIC, "target", settings)
    part = F.when(F.expr(in_dates("TEST")), "TEST").otherwise("VALIDATE")
    scored = model.transform(rows.where(f"NOT {in_dates('TRAIN')}")).withColumn("data_type", part)
    errors = metrics.rmse_of(
        scored, "target", {"rmse_prev": "prev_month_amount", "rmse": "prediction"}, ["data_type"]
    )
    sizes = scored.groupBy("data_type").agg(F.count(F.lit(1)).alias("cnt"))
    better = (F.col("rmse") < F.col("rmse_prev")).alias("better")
    return errors.join(sizes, "data_type").select("data_type", "cnt", "rmse_prev", better)


@query("param_sweep")
def _(t: Tables):
    """The depths of the sweep and 20 drawn settings; each fit stops early on the validation rows."""
    rows = freeze(trip_parts(t), "sweep")
    train, valid, test = (rows.where(f"data_type = '{k}'") for k in ("train", "valid", "test"))
    grid = [{"maxDepth": d, "maxIter": ROUNDS} for d in (3, 6, 9)]
    grid += [{**s, "maxIter": ROUNDS} for s in models.search_settings(20)]
    return models.param_sweep(train, test, CATS, NUMS, "tip_amount", grid, valid=valid)


def fold_models(t: Tables):
    """(scores, importances) of the models of all folds, which are saved below the shared folder."""
    tx = t.clean()
    rows = U.baseline_join(U.concat_folds(tx, DATES), U.previous_amount(tx, DATES))
    return models.cross_validate(
        U.time_series_folds(rows, FOLDS),
        ["country_mode"],
        NUMERIC,
        "target",
        "prev_month_amount",
        save_to=shared_dir(t.spark, "folds"),
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        maxIter=ROUNDS,
    )


@query(
    "cross_validate",
    with_ctes(
        FEATURES_CTE,
        folds_sql(),
        """
naive AS (
  SELECT fold, round(sqrt(avg(power(target - coalesce(prev_month_amount, 0), 2))), 6) AS rmse_prev
  FROM all_features JOIN next_month USING (customer_id, prediction_date)
  JOIN folds USING (prediction_date)
  LEFT JOIN last_month USING (customer_id, prediction_date)
  WHERE role = 'valid' AND target IS NOT NULL GROUP BY fold)""",
        select="""
SELECT fold, rmse_prev, true AS has_error FROM naive
UNION ALL SELECT 'mean', round(avg(rmse_prev), 6), true FROM naive""",
    ),
)
def _(t: Tables):
    """Per fold and on average: the error of last month's amount, and that the model has one."""
    scores = metrics.fold_summary(fold_models(t)[0], ["rmse_prev", "rmse"])
    return scores.select("fold", "rmse_prev", is_number("rmse").alias("has_error"))


@query(
    "model_importance",
    f"SELECT unnest({['country_mode', *NUMERIC]}) AS feature, true AS is_share",
)
def _(t: Tables):
    """Importances of the folds' models, averaged: all columns are there, with a share of 1."""
    found = metrics.importance_topn(fold_models(t)[1], 20)
    return found.select("feature", (is_number("mean") & (F.col("mean") <= 1)).alias("is_share"))


@query(
    "batch_score",
    with_ctes(
        FEATURES_CTE,
        select=f"""
SELECT customer_id, prediction_date, true AS clip_holds
FROM all_features WHERE prediction_date = DATE '{DATES[-1]}'""",
    ),
)
def _(t: Tables):
    """Fitted on the training dates, saved, loaded, and applied to the last date: a row per
    customer, whose clipped amount is the amount or 0."""
    rows = U.training_set(t.clean(), DATES)
    train = rows.where(F.col("prediction_date") < DATES[-1])
    model = models.train_regressor(train, None, ["country_mode"], NUMERIC, "target", maxIter=ROUNDS)
    path = shared_dir(t.spark, "model")
    models.save_model(model, path)
    features = U.customer_features(t.clean(), DATES[-1:])
    scored = models.batch_score(features, path, ["customer_id"], DATES[-1])
    amount, clipped = F.col("predicted_amount"), F.col("predicted_amount_clipped")
    holds = is_number("predicted_amount_clipped") & (clipped == F.when(amount < 0, 0.0).otherwise(amount))
    return scored.select("customer_id", "prediction_date", holds.alias("clip_holds"))


# ---- trials ----

DISCOUNTS = [0.0, 0.02, 0.04, 0.06, 0.08, 0.1]
QUANTITIES = [1, 10, 50]


@query(
    "parameter_grid",
    f"""
SELECT p_partkey, p_retailprice, d AS discount, q AS quantity
FROM part, (VALUES {", ".join(f"({v}::DOUBLE)" for v in DISCOUNTS)}) AS a(d),
  (VALUES {", ".join(f"({v}::DOUBLE)" for v in QUANTITIES)}) AS b(q)""",
)
def _(t: Tables):
    """Every part at each discount and quantity."""
    parts = t.raw("part").select("p_partkey", "p_retailprice")
    return R.parameter_grid(parts, {"discount": DISCOUNTS, "quantity": QUANTITIES})


@query(
    "best_trials",
    """
SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS rn FROM lineitem)
WHERE rn = 1""",
)
def _(t: Tables):
    """The cheapest line of each part."""
    lines = t.raw("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return R.best_trials(lines, "l_partkey", ["l_orderkey", "l_linenumber"], "l_extendedprice")


@query(
    "pareto_front",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM (
  SELECT *, max(l_quantity) OVER (ORDER BY l_extendedprice
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_to FROM lineitem) a
WHERE l_quantity = up_to AND NOT EXISTS (
  SELECT 1 FROM lineitem b
  WHERE b.l_extendedprice < a.l_extendedprice AND b.l_quantity = a.l_quantity)""",
)
def _(t: Tables):
    """Lines that no other line beats in price and quantity together."""
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return R.pareto_front(lines, "l_extendedprice", "l_quantity")


PRICE_INPUTS = ["l_quantity", "l_discount", "l_tax", "l_partkey"]


@query(
    "rf_importance",
    f"SELECT unnest({PRICE_INPUTS}) AS feature, true AS is_share, true AS sums_to_1 FROM range(1)",
)
def _(t: Tables):
    """What the price of a line depends on: a share of each input, together 1."""
    found = models.rf_importance(t.raw("lineitem"), PRICE_INPUTS, "l_extendedprice")
    total = F.sum("importance").over(Window.partitionBy())
    return found.select(
        "feature",
        is_number("importance").alias("is_share"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_1"),
    )
