"""Customer features, targets, folds and baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cleaning as C
from tidemark.operators import customers as U
from tidemark.operators import metrics, profile
from tidemark.plans.adapters import (
    ACTIVITY_COLUMNS,
    ANCHORS,
    BASE_COLUMNS,
    CLEAN,
    DATES,
    FEATURES_CTE,
    FOLDS,
    LINES,
    SPLITS,
    Tables,
    dates_sql,
)
from tidemark.plans.registry import query, with_ctes

LINE = 'customer_id, prediction_date, invoice, stock_code, "date", purchase_amount::DOUBLE AS purchase_amount'


def amount():
    return F.col("purchase_amount").cast("double").alias("purchase_amount")


@query(
    "clean_transactions",
    with_ctes(
        CLEAN, select='SELECT * REPLACE (purchase_amount::DOUBLE AS purchase_amount) FROM clean'
    ),
)
def _(t: Tables):
    return t.clean().withColumn("purchase_amount", F.col("purchase_amount").cast("double"))


@query(
    "anomaly_rows",
    with_ctes(
        LINES,
        select="""
SELECT unnest(['cancelled', 'negative_quantity', 'negative_price', 'quantity_below_one', 'any']) AS kind,
  unnest([count(*) FILTER (invoice LIKE '%C%'),
          count(*) FILTER (invoice NOT LIKE '%C%' AND quantity < 0),
          count(*) FILTER (price < 0),
          count(*) FILTER (quantity < 1),
          count(*) FILTER (invoice LIKE '%C%' OR price < 0 OR quantity < 0)]) AS n
FROM lines""",
    ),
)
def _(t: Tables):
    return C.anomaly_counts(t.lines())


@query(
    "cancelled_rows", with_ctes(LINES, select="SELECT * FROM lines WHERE invoice LIKE '%C%'")
)
def _(t: Tables):
    return C.anomaly_rows(t.lines(), "cancelled")


@query(
    "date_series",
    """
SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate),
                              INTERVAL 1 MONTH))::DATE AS prediction_date
FROM orders""",
)
def _(t: Tables):
    return U.month_starts(t.raw("orders"), "o_orderdate")


@query("make_anchors", with_ctes(ANCHORS, select="SELECT * FROM anchors"))
def _(t: Tables):
    return U.make_anchors(t.clean(), DATES)


@query("lookback_join", with_ctes(FEATURES_CTE, select=f"SELECT {LINE} FROM window_lines"))
def _(t: Tables):
    tx = t.clean()
    joined = U.lookback_join(U.make_anchors(tx, DATES), tx, 90)
    return joined.select(*U.KEYS, "invoice", "stock_code", "date", amount())


@query(
    "forward_join",
    with_ctes(
        ANCHORS,
        select=f"""
SELECT a.customer_id, a.prediction_date, {LINE.split("prediction_date, ")[1]}
FROM anchors a LEFT JOIN clean c ON a.customer_id = c.customer_id
 AND c."date" >= a.prediction_date AND c."date" < a.prediction_date + 30""",
    ),
)
def _(t: Tables):
    tx = t.clean()
    joined = U.forward_join(U.make_anchors(tx, DATES), tx, 30)
    return joined.select(*U.KEYS, "invoice", "stock_code", "date", amount())


@query(
    "invoice_summary",
    with_ctes(
        CLEAN,
        select="""
SELECT customer_id, invoice, min("date") AS "date", sum(purchase_amount)::DOUBLE AS invoice_amount
FROM clean GROUP BY customer_id, invoice""",
    ),
)
def _(t: Tables):
    out = U.invoice_summary(t.clean())
    return out.withColumn("invoice_amount", F.col("invoice_amount").cast("double"))


@query(
    "date_summary",
    with_ctes(
        CLEAN,
        select="""
SELECT customer_id, "date", sum(purchase_amount)::DOUBLE AS date_amount
FROM clean GROUP BY customer_id, "date\"""",
    ),
)
def _(t: Tables):
    out = U.date_summary(t.clean())
    return out.withColumn("date_amount", F.col("date_amount").cast("double"))


@query("base_features", with_ctes(FEATURES_CTE, select=f"SELECT {BASE_COLUMNS} FROM facts"))
def _(t: Tables):
    return U.base_features(U.lookback_lines(t.clean(), DATES, 90))


@query("activity_features", with_ctes(FEATURES_CTE, select=f"SELECT {ACTIVITY_COLUMNS} FROM facts"))
def _(t: Tables):
    return U.activity_features(U.lookback_lines(t.clean(), DATES, 90))


@query("invoice_amount_stats", with_ctes(FEATURES_CTE, select="SELECT * FROM spread_invoice"))
def _(t: Tables):
    summary = U.invoice_summary(t.clean())
    return U.second_level_stats(summary, "invoice_amount", "purchase_amount_by_invoice", DATES)


@query("date_amount_stats", with_ctes(FEATURES_CTE, select="SELECT * FROM spread_date"))
def _(t: Tables):
    summary = U.date_summary(t.clean())
    return U.second_level_stats(summary, "date_amount", "purchase_amount_by_date", DATES)


@query("assemble_features", with_ctes(FEATURES_CTE, select="SELECT * FROM all_features"))
def _(t: Tables):
    tx = t.clean()
    joined = U.lookback_lines(tx, DATES, 90)
    by = "purchase_amount_by_"
    return U.assemble(
        U.base_features(joined),
        U.activity_features(joined),
        U.second_level_stats(U.invoice_summary(tx), "invoice_amount", f"{by}invoice", DATES),
        U.second_level_stats(U.date_summary(tx), "date_amount", f"{by}date", DATES),
    )


@query("customer_features", with_ctes(FEATURES_CTE, select="SELECT * FROM all_features"))
def _(t: Tables):
    return U.customer_features(t.clean(), DATES)


@query(
    "mode_tie_last",
    with_ctes(
        LINES,
        select="""
SELECT customer_id, first(country ORDER BY n DESC, last_seen DESC, country DESC) AS country_mode
FROM (SELECT customer_id, country, count(*) AS n, max(invoice_date) AS last_seen
      FROM lines WHERE country IS NOT NULL GROUP BY customer_id, country)
GROUP BY customer_id""",
    ),
)
def _(t: Tables):
    return U.mode_of(t.lines(), ["customer_id"], "country", "invoice_date", "country_mode")


@query(
    "approx_mode",
    with_ctes(
        FEATURES_CTE,
        select="""
SELECT customer_id, prediction_date, max(n) AS estimate, max(n) AS lines_of_mode
FROM (SELECT customer_id, prediction_date, country, count(*) AS n FROM window_lines
      WHERE country IS NOT NULL GROUP BY customer_id, prediction_date, country)
GROUP BY customer_id, prediction_date""",
    ),
)
def _(t: Tables):
    """The estimate, and how many lines the estimated mode really has: as many as the true one."""
    tx = t.clean()
    found = U.approx_mode(U.daily_sketches(tx, "country"), DATES)
    counts = U.lookback_lines(tx, DATES).groupBy(*U.KEYS, F.col("country").alias("mode"))
    exact = counts.agg(F.count(F.lit(1)).alias("lines_of_mode"))
    joined = found.withColumnRenamed("n", "estimate").join(exact, [*U.KEYS, "mode"])
    return joined.select(*U.KEYS, "estimate", "lines_of_mode")


@query("target_sum", with_ctes(FEATURES_CTE, select="SELECT * FROM next_month"))
def _(t: Tables):
    tx = t.clean()
    return U.target_sum(U.make_anchors(tx, DATES), tx, DATES)


@query("attach_target", with_ctes(FEATURES_CTE, select="SELECT * FROM labelled"))
def _(t: Tables):
    return U.training_set(t.clean(), DATES)


@query(
    "attach_target_inner",
    with_ctes(
        FEATURES_CTE,
        select="""
SELECT f.*, t.target FROM all_features f JOIN next_month t USING (customer_id, prediction_date)
WHERE t.target IS NOT NULL""",
    ),
)
def _(t: Tables):
    return U.concat_folds(t.clean(), DATES)


@query(
    "split_label",
    with_ctes(
        FEATURES_CTE,
        select="""
SELECT customer_id, prediction_date, target,
  CASE WHEN prediction_date <= DATE '1998-08-01' THEN 'TRAIN'
       WHEN prediction_date <= DATE '1998-10-01' THEN 'VALIDATE'
       WHEN prediction_date = DATE '1998-11-01' THEN 'TEST' END AS split_label
FROM labelled""",
    ),
)
def _(t: Tables):
    rows = U.training_set(t.clean(), DATES).select(*U.KEYS, "target")
    return C.split_label(rows, "prediction_date", SPLITS)


@query(
    "pandas_target_variant",
    with_ctes(
        CLEAN,
        dates_sql(DATES),
        select="""
SELECT customer_id, prediction_date, sum(purchase_amount)::DOUBLE AS target
FROM clean CROSS JOIN dates
WHERE "timestamp" >= prediction_date::TIMESTAMP
  AND "timestamp" <= (prediction_date + 29)::TIMESTAMP
GROUP BY ALL""",
    ),
)
def _(t: Tables):
    """The target half of the timestamp window: up to midnight of its last day."""
    lines = U.forward_lines(t.clean(), DATES, 30, window="timestamp")
    return lines.groupBy(*U.KEYS).agg(F.sum("purchase_amount").cast("double").alias("target"))


def midnight_sql(days: int) -> str:
    return f"""
cut AS (
  SELECT customer_id, prediction_date, c.* EXCLUDE (customer_id)
  FROM clean c CROSS JOIN dates
  WHERE "timestamp" >= (prediction_date - {days})::TIMESTAMP
    AND "timestamp" <= (prediction_date - 1)::TIMESTAMP),
per_invoice AS (
  SELECT customer_id, prediction_date, invoice, sum(purchase_amount) AS amount
  FROM cut GROUP BY ALL)"""


@query(
    "pandas_window_variant",
    with_ctes(
        CLEAN,
        dates_sql(DATES),
        midnight_sql(90),
        select="""
SELECT customer_id, prediction_date, record_cnt, purchase_amount_sum,
       purchase_amount_by_invoice_min, purchase_amount_by_invoice_max,
       purchase_amount_by_invoice_mean
FROM (SELECT customer_id, prediction_date, count(invoice) AS record_cnt,
             sum(purchase_amount)::DOUBLE AS purchase_amount_sum
      FROM cut GROUP BY ALL)
JOIN (SELECT customer_id, prediction_date, min(amount)::DOUBLE AS purchase_amount_by_invoice_min,
             max(amount)::DOUBLE AS purchase_amount_by_invoice_max,
             sum(amount)::DOUBLE / count(*) AS purchase_amount_by_invoice_mean
      FROM per_invoice GROUP BY ALL) USING (customer_id, prediction_date)""",
    ),
)
def _(t: Tables):
    out = U.customer_features(t.clean(), DATES, window="timestamp")
    stats = [f"purchase_amount_by_invoice_{k}" for k in ("min", "max", "mean")]
    return out.select(*U.KEYS, "record_cnt", "purchase_amount_sum", *stats)


@query("previous_amount", with_ctes(FEATURES_CTE, select="SELECT * FROM last_month"))
def _(t: Tables):
    return U.previous_amount(t.clean(), DATES)


@query(
    "baseline_join",
    with_ctes(
        FEATURES_CTE,
        select="""
SELECT customer_id, prediction_date, target, coalesce(prev_month_amount, 0) AS prev_month_amount
FROM labelled LEFT JOIN last_month USING (customer_id, prediction_date)""",
    ),
)
def _(t: Tables):
    tx = t.clean()
    rows = U.training_set(tx, DATES).select(*U.KEYS, "target")
    return U.baseline_join(rows, U.previous_amount(tx, DATES))


MERGED_SQL = ",\n".join(
    f"""w{d} AS (
  SELECT customer_id, count(*) AS record_cnt_in_{d}d,
         count(DISTINCT stock_code) AS stock_nunique_in_{d}d,
         sum(purchase_amount)::DOUBLE AS purchase_amount_sum_in_{d}d
  FROM clean WHERE "date" < DATE '1998-11-01' AND "date" >= DATE '1998-11-01' - {d}
  GROUP BY customer_id)"""
    for d in (30, 60, 90)
)


@query(
    "outer_merge_windows",
    with_ctes(
        CLEAN,
        MERGED_SQL,
        select="""
SELECT * FROM w30 FULL JOIN w60 USING (customer_id) FULL JOIN w90 USING (customer_id)""",
    ),
)
def _(t: Tables):
    tx = t.clean()
    kept = [*U.KEYS, "record_cnt", "stock_nunique", "purchase_amount_sum"]
    parts = {
        d: U.activity_features(U.lookback_lines(tx, DATES[-1:], d)).select(*kept)
        for d in (30, 60, 90)
    }
    return U.merge_windows(parts)


@query(
    "rename_suffix",
    with_ctes(
        FEATURES_CTE,
        select="""
SELECT customer_id, prediction_date AS prediction_date_in_30d,
       prev_month_amount AS prev_month_amount_in_30d
FROM last_month""",
    ),
)
def _(t: Tables):
    return C.add_suffix(U.previous_amount(t.clean(), DATES), ["customer_id"], "_in_30d")


def folds_sql() -> str:
    rows = ", ".join(
        f"('{fold}', '{role}', DATE '{d}')"
        for fold, roles in FOLDS.items()
        for role, dates in roles.items()
        for d in dates
    )
    return f"folds AS (SELECT * FROM (VALUES {rows}) AS v(fold, role, prediction_date))"


@query(
    "time_series_folds",
    with_ctes(
        FEATURES_CTE,
        folds_sql(),
        select="""
SELECT customer_id, prediction_date, record_cnt, target, fold, role
FROM labelled JOIN folds USING (prediction_date)""",
    ),
)
def _(t: Tables):
    rows = U.training_set(t.clean(), DATES).select(*U.KEYS, "record_cnt", "target")
    return U.time_series_folds(rows, FOLDS)


@query(
    "concat_folds",
    with_ctes(
        FEATURES_CTE,
        select="""
SELECT f.*, t.target FROM all_features f JOIN next_month t USING (customer_id, prediction_date)
WHERE t.target IS NOT NULL""",
    ),
)
def _(t: Tables):
    return U.concat_folds(t.clean(), DATES)


def valid_folds(t: Tables):
    """Validation rows of every fold with two naive forecasts."""
    kept = [*U.KEYS, "purchase_amount_sum", "target", "prev_month_amount"]
    rows = U.training_set(t.clean(), DATES, baseline_days=30).select(*kept)
    folds = U.time_series_folds(rows, FOLDS).where("role = 'valid'")
    return folds.withColumn("third", F.col("purchase_amount_sum") / 3)


VALID_SQL = """
valid AS (
  SELECT fold, target, coalesce(prev_month_amount, 0) AS prev, purchase_amount_sum / 3 AS third
  FROM labelled JOIN folds USING (prediction_date)
  LEFT JOIN last_month USING (customer_id, prediction_date) WHERE role = 'valid'),
scores AS (
  SELECT fold, round(sqrt(avg((target - prev) * (target - prev))), 6) AS rmse_prev,
         round(sqrt(avg((target - third) * (target - third))), 6) AS rmse
  FROM valid GROUP BY fold)
"""


@query(
    "fold_rmse",
    with_ctes(
        FEATURES_CTE,
        folds_sql(),
        VALID_SQL,
        select="""
SELECT fold, rmse_prev AS rmse, n FROM scores JOIN
 (SELECT fold, count(*) AS n FROM valid GROUP BY fold) USING (fold)""",
    ),
)
def _(t: Tables):
    return metrics.rmse(valid_folds(t), "target", "prev_month_amount", ["fold"])


@query(
    "fold_summary",
    with_ctes(
        FEATURES_CTE,
        folds_sql(),
        VALID_SQL,
        select="""
SELECT fold, rmse_prev, rmse FROM scores UNION ALL
SELECT 'mean', round(avg(rmse_prev), 6), round(avg(rmse), 6) FROM scores""",
    ),
)
def _(t: Tables):
    forecasts = {"rmse_prev": "prev_month_amount", "rmse": "third"}
    scores = metrics.rmse_of(valid_folds(t), "target", forecasts, ["fold"])
    return metrics.fold_summary(scores, list(forecasts))


NUMERIC = [
    "country_nunique",
    "elapsed_days_from_first",
    "elapsed_days_from_last",
    "record_cnt",
    "invoice_nunique",
    "stock_nunique",
    "timestamp_nunique",
    "date_nunique",
    "purchase_amount_sum",
    *[
        f"purchase_amount_by_{g}_{k}" for g in ("invoice", "date") for k in ("min", "max", "mean")
    ],
]


def corr_rows(group: str = "") -> str:
    lead = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, corr({c}, target) AS c FROM rows_{tail}" for c in NUMERIC
    )


@query(
    "target_correlation",
    with_ctes(
        FEATURES_CTE,
        "rows_ AS (SELECT * FROM labelled)",
        f"corrs AS (SELECT feature, round(c, 6) AS corr FROM ({corr_rows()}))",
        select="""
(SELECT feature, corr, 'top' AS part FROM corrs ORDER BY corr DESC, feature LIMIT 10)
UNION ALL
(SELECT feature, corr, 'bottom' AS part FROM corrs ORDER BY corr, feature DESC LIMIT 10)""",
    ),
)
def _(t: Tables):
    return profile.target_correlation(U.training_set(t.clean(), DATES), "target", NUMERIC, 10)


@query(
    "importance_topn",
    with_ctes(
        FEATURES_CTE,
        folds_sql(),
        "rows_ AS (SELECT * FROM labelled JOIN folds USING (prediction_date) WHERE role = 'train')",
        f"corrs AS ({corr_rows('fold')})",
        select="""
SELECT feature, round(avg(abs(c)), 6) AS mean FROM corrs
GROUP BY feature ORDER BY mean DESC, feature LIMIT 20""",
    ),
)
def _(t: Tables):
    """Importance here is the absolute correlation with the target, per fold."""
    rows = U.time_series_folds(U.training_set(t.clean(), DATES), FOLDS).where("role = 'train'")
    wide = rows.groupBy("fold").agg(*[F.abs(F.corr(c, "target")).alias(c) for c in NUMERIC])
    return metrics.importance_topn(wide.unpivot("fold", NUMERIC, "feature", "importance"), 20)


@query(
    "star_except",
    with_ctes(
        FEATURES_CTE,
        select=f"SELECT * EXCLUDE (customer_id, prediction_date) FROM (SELECT {ACTIVITY_COLUMNS} FROM facts)",
    ),
)
def _(t: Tables):
    return C.star_except(U.activity_features(U.lookback_lines(t.clean(), DATES, 90)), *U.KEYS)


@query(
    "project_predictions",
    """
SELECT o_custkey::VARCHAR AS customer_id, o_orderdate::DATE AS prediction_date,
       TIMESTAMP '2026-01-02 20:00:00' AS job_run_at,
       CASE WHEN v IS NULL THEN NULL WHEN v < 0 THEN 0 ELSE v END AS pred, v AS pred_raw,
       v - 1000 AS pred_lower, v + 1000 AS pred_upper
FROM (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice - 150000 END AS v FROM orders)""",
)
def _(t: Tables):
    from tidemark.sources.sinks import project_predictions

    return project_predictions(predictions(t), "2026-01-02 20:00:00")


def predictions(t: Tables):
    v = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice") - 150000)
    return t.raw("orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.to_date("o_orderdate").alias("prediction_date"),
        F.struct(
            v.alias("value"), (v - 1000).alias("lower_bound"), (v + 1000).alias("upper_bound")
        ).alias("predicted_target"),
    )


@query(
    "clip_lower",
    """
SELECT o_custkey::VARCHAR AS customer_id, v AS predicted_amount,
       CASE WHEN v IS NULL THEN NULL WHEN v < 0 THEN 0 ELSE v END AS predicted_amount_clipped
FROM (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice - 150000 END AS v FROM orders)""",
)
def _(t: Tables):
    rows = predictions(t).select(
        "customer_id", F.col("predicted_target.value").alias("predicted_amount")
    )
    return C.clip_lower(rows, "predicted_amount", "predicted_amount_clipped")


@query("preview")
def _(t: Tables):
    return predictions(t).limit(20)
