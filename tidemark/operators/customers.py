"""Customer features around prediction dates.

The prediction dates are a short list given by the caller, so a line is sent to
the dates it counts for by a generator inside its own row. There is no cross
join, and the grouped aggregates combine before the shuffle, which keeps a
customer with very many lines from loading one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.cleaning import add_suffix

KEYS = ["customer_id", "prediction_date"]


def month_starts(df: DataFrame, date_col: str) -> DataFrame:
    """One row per month from the first to the last month of ``date_col``, both included."""
    span = df.agg(
        F.trunc(F.min(date_col), "month").alias("a"), F.trunc(F.max(date_col), "month").alias("b")
    )
    return span.select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("prediction_date")
    )


def make_anchors(tx: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Customer and prediction date pairs with a purchase before that date."""
    earlier = F.col("timestamp") < F.lit(max(dates)).cast("timestamp_ntz")
    first = tx.where(earlier).groupBy("customer_id").agg(F.min("date").alias("_first"))
    later = F.filter(S.dates_array(dates), lambda p: p > F.col("_first"))
    return first.select("customer_id", F.explode(later).alias("prediction_date"))


def _between(df: DataFrame, dates: Sequence[str], low: int, high: int) -> DataFrame:
    """The rows that any window [p + low days, p + high days) of the dates can hold.

    Plain literals, on the stored time where ``df`` has it, so that the bound reaches the scan.
    """

    def midnight(date: str, shift: int) -> Column:
        day = dt.date.fromisoformat(date) + dt.timedelta(days=shift)
        return F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")

    at = F.col("timestamp" if "timestamp" in df.columns else "date").cast("timestamp_ntz")
    return df.where((at >= midnight(min(dates), low)) & (at < midnight(max(dates), high)))


def _window_dates(dates: Sequence[str], low: int, high: int, date: Column) -> Column:
    """The dates p with ``date`` on the days [p + low, p + high)."""
    return F.filter(
        S.dates_array(dates),
        lambda p: (date >= F.date_add(p, low)) & (date < F.date_add(p, high)),
    )


def _midnight_dates(dates: Sequence[str], low: int, high: int, ts: Column) -> Column:
    """Window from 00:00 of day ``low`` to 00:00 of day ``high``, both included: of the last
    day all later lines are lost."""
    return F.filter(
        S.dates_array(dates),
        lambda p: (ts >= F.date_add(p, low).cast("timestamp_ntz"))
        & (ts <= F.date_add(p, high).cast("timestamp_ntz")),
    )


def lookback_lines(
    tx: DataFrame, dates: Sequence[str], days: int = 90, window: str = "date"
) -> DataFrame:
    """Each line once per prediction date whose look-back window holds it.

    ``window="timestamp"`` compares the time with midnight of the last day.
    """
    if window == "timestamp":
        hit = _midnight_dates(dates, -days, -1, F.col("timestamp"))
    else:
        hit = _window_dates(dates, -days, 0, F.col("date"))
    return _between(tx, dates, -days, 0).withColumn("prediction_date", F.explode(hit))


def forward_lines(
    tx: DataFrame, dates: Sequence[str], days: int = 30, window: str = "date"
) -> DataFrame:
    """Each line once per prediction date whose target window holds it.

    ``window="timestamp"`` compares the time with midnight of the last day.
    """
    if window == "timestamp":
        hit = _midnight_dates(dates, 0, days - 1, F.col("timestamp"))
    else:
        hit = _window_dates(dates, 0, days, F.col("date"))
    return _between(tx, dates, 0, days).withColumn("prediction_date", F.explode(hit))


def _range_join(
    anchors: DataFrame, tx: DataFrame, low: int, high: int, how: str = "inner"
) -> DataFrame:
    """Anchors with events of the same customer on days [p + low, p + high).

    Both sides also meet on a time slot as wide as the window, so that a customer
    with very many events is spread over the slots, and the rule for skewed joins
    can split what is still too large. A window touches two slots at most. For an
    inner join the anchor goes to both; for a left join the event does, so that an
    anchor stands in one slot and an anchor without events gives one row.
    """
    width = high - low
    slot = lambda day: F.floor(day / F.lit(width))
    first = slot(F.unix_date("prediction_date") + low)
    own = slot(F.unix_date("date"))
    if how == "inner":
        last = slot(F.unix_date("prediction_date") + (high - 1))
        left = anchors.withColumn("_slot", F.explode(F.sequence(first, last)))
        right = tx.withColumn("_slot", own)
    else:
        left = anchors.withColumn("_slot", first)
        right = tx.withColumn("_slot", F.explode(F.array(own, own - 1)))
    left, right = left.alias("a"), right.alias("t")
    hit = (
        (F.col("a.customer_id") == F.col("t.customer_id"))
        & (F.col("a._slot") == F.col("t._slot"))
        & (F.col("t.date") >= F.date_add("a.prediction_date", low))
        & (F.col("t.date") < F.date_add("a.prediction_date", high))
    )
    rest = [F.col(f"t.{c}").alias(c) for c in tx.columns if c != "customer_id"]
    return left.join(right, hit, how).select(
        *[F.col(f"a.{c}").alias(c) for c in anchors.columns], *rest
    )


def lookback_join(anchors: DataFrame, tx: DataFrame, days: int = 90) -> DataFrame:
    """Inner join of any anchors to the customer's lines of the ``days`` days before."""
    return _range_join(anchors, tx, -days, 0)


def forward_join(anchors: DataFrame, tx: DataFrame, days: int = 30) -> DataFrame:
    """Left join of any anchors to the customer's lines of the next ``days`` days."""
    return _range_join(anchors, tx, 0, days, "left")


def invoice_summary(tx: DataFrame) -> DataFrame:
    return tx.groupBy("customer_id", "invoice").agg(
        F.min("date").alias("date"), F.sum("purchase_amount").alias("invoice_amount")
    )


def date_summary(tx: DataFrame) -> DataFrame:
    return tx.groupBy("customer_id", "date").agg(F.sum("purchase_amount").alias("date_amount"))


def mode_of(df: DataFrame, keys: list[str], column: str, tie: str, out: str) -> DataFrame:
    """Most frequent non-NULL value per key; ties go to the larger ``tie``, then value."""
    per_value = (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys, column)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(tie).alias("_tie"))
    )
    return per_value.groupBy(*keys).agg(F.max_by(column, F.struct("_n", "_tie", column)).alias(out))


def daily_sketches(tx: DataFrame, column: str, items: int = 100) -> DataFrame:
    """(customer_id, date, sketch): frequent values of a customer's day, of a fixed size.

    They can be stored and merged for any window later, without the lines.
    """
    return (
        tx.where(F.col(column).isNotNull())
        .groupBy("customer_id", "date")
        .agg(F.call_function("approx_top_k_accumulate", F.col(column), F.lit(items)).alias("sketch"))
    )


def approx_mode(
    sketches: DataFrame, dates: Sequence[str], days: int = 90, items: int = 100
) -> DataFrame:
    """(keys, mode, n): the most frequent value of each look-back window, from daily sketches.

    Days, not lines, are sent to the dates they count for, and the sketches combine before
    the shuffle. ``n`` is at least the true count of ``mode``. While a window has at most
    three quarters of ``items`` distinct values, both are exact but for ties.
    """
    merged = F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(items))
    best = F.call_function("approx_top_k_estimate", F.col("_all"), F.lit(1))[0]
    return (
        lookback_lines(sketches, dates, days)
        .groupBy(*KEYS)
        .agg(merged.alias("_all"))
        .select(*KEYS, best["item"].alias("mode"), best["count"].alias("n"))
    )


def base_features(joined: DataFrame) -> DataFrame:
    """Country mode and count, days since the first and last line of the window."""
    per_country = joined.groupBy(*KEYS, "country").agg(
        F.count(F.lit(1)).alias("_n"), F.min("date").alias("_min"), F.max("date").alias("_max")
    )
    rank = F.when(F.col("country").isNotNull(), F.struct("_n", "_max", "country"))
    return per_country.groupBy(*KEYS).agg(
        F.max_by("country", rank).alias("country_mode"),
        F.count("country").alias("country_nunique"),
        F.datediff("prediction_date", F.min("_min")).alias("elapsed_days_from_first"),
        F.datediff("prediction_date", F.max("_max")).alias("elapsed_days_from_last"),
    )


def activity_features(joined: DataFrame) -> DataFrame:
    """Line count, distinct counts and amount of the window."""
    return joined.groupBy(*KEYS).agg(
        F.count("invoice").alias("record_cnt"),
        F.countDistinct("invoice").alias("invoice_nunique"),
        F.countDistinct("stock_code").alias("stock_nunique"),
        F.countDistinct("timestamp").alias("timestamp_nunique"),
        F.countDistinct("date").alias("date_nunique"),
        F.sum("purchase_amount").cast("double").alias("purchase_amount_sum"),
    )


def second_level_stats(
    summary: DataFrame, amount: str, prefix: str, dates: Sequence[str], days: int = 90
) -> DataFrame:
    """Min, max and mean of per-invoice or per-date sums inside the window."""
    return (
        lookback_lines(summary, dates, days)
        .groupBy(*KEYS)
        .agg(
            F.min(amount).cast("double").alias(f"{prefix}_min"),
            F.max(amount).cast("double").alias(f"{prefix}_max"),
            S.mean_of(F.sum(amount), F.count(amount)).alias(f"{prefix}_mean"),
        )
    )


def assemble(base: DataFrame, *parts: DataFrame, on: Sequence[str] = KEYS) -> DataFrame:
    """Left joins on ``on``; each part holds one row per key."""
    return reduce(lambda left, right: left.join(right, list(on), "left"), parts, base)


KINDS = ["country", "invoice", "stock_code", "timestamp", "date"]


def _per_value(
    tx: DataFrame, dates: Sequence[str], days: int, window: str, sums: dict[str, tuple[int, int]]
) -> DataFrame:
    """(keys, kind, value, n, amount, first, last): one reading of the lines.

    A line counts under its country, invoice, stock code, time and date for each
    prediction date whose look-back window holds it, and under the name of each of
    ``sums`` for the dates whose window [p + low, p + high) of days holds it.
    """

    def dates_of(low: int, high: int) -> Column:
        if window == "timestamp":
            return _midnight_dates(dates, low, high - 1, F.col("timestamp"))
        return _window_dates(dates, low, high, F.col("date"))

    def marks(hit: Column, role: str) -> Column:
        return F.transform(
            hit, lambda p: F.struct(p.alias("prediction_date"), F.lit(role).alias("role"))
        )

    def cell(kind: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), value.cast("string").alias("value"))

    hits = F.concat(
        marks(dates_of(-days, 0), "back"), *[marks(dates_of(*w), name) for name, w in sums.items()]
    )
    low = min(-days, *(w[0] for w in sums.values()), 0)
    high = max(0, 0, *(w[1] for w in sums.values()))
    marked = _between(tx, dates, low, high).select(
        "customer_id", "date", "purchase_amount", *KINDS[:-1], F.inline(hits)
    )
    each = F.when(
        F.col("role") == "back", F.array(*[cell(F.lit(k), F.col(k)) for k in KINDS])
    ).otherwise(F.array(cell(F.col("role"), F.lit(None))))
    return (
        marked.select(*KEYS, F.col("date").alias("_day"), "purchase_amount", F.inline(each))
        .groupBy(*KEYS, "kind", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("purchase_amount").alias("amount"),
            F.min("_day").alias("first"),
            F.max("_day").alias("last"),
        )
    )


def customer_features(
    tx: DataFrame,
    dates: Sequence[str],
    days: int = 90,
    window: str = "date",
    sums: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """All feature columns, and the amounts of further windows, in one reading of the lines.

    One aggregate per counted value feeds all distinct counts, the mode, the elapsed
    days, the per-date statistics and the amounts of ``sums``, which are NULL without
    a purchase. The per-invoice statistics take a second, smaller aggregate, because
    an invoice counts as a whole from its first day on; with ``window="timestamp"``
    the lines are cut first instead.
    """
    sums = sums or {}
    per_value = _per_value(tx, dates, days, window, sums)

    def of(kind: str, c: Column) -> Column:
        return F.when((F.col("kind") == kind) & F.col("value").isNotNull(), c)

    def nunique(kind: str) -> Column:
        return F.count(of(kind, F.col("value")))

    def stats(kind: str) -> list[Column]:
        amount, prefix = of(kind, F.col("amount")), f"purchase_amount_by_{kind}"
        return [
            F.min(amount).cast("double").alias(f"{prefix}_min"),
            F.max(amount).cast("double").alias(f"{prefix}_max"),
            S.mean_of(F.sum(amount), F.count(amount)).alias(f"{prefix}_mean"),
        ]

    back = F.col("kind").isin(KINDS)
    cut_lines_first = window == "timestamp"
    main = per_value.groupBy(*KEYS).agg(
        F.max_by("value", of("country", F.struct("n", "last", "value"))).alias("country_mode"),
        nunique("country").alias("country_nunique"),
        F.datediff("prediction_date", F.min(F.when(back, F.col("first")))).alias(
            "elapsed_days_from_first"
        ),
        F.datediff("prediction_date", F.max(F.when(back, F.col("last")))).alias(
            "elapsed_days_from_last"
        ),
        F.coalesce(F.sum(of("invoice", F.col("n"))), F.lit(0)).alias("record_cnt"),
        nunique("invoice").alias("invoice_nunique"),
        nunique("stock_code").alias("stock_nunique"),
        nunique("timestamp").alias("timestamp_nunique"),
        nunique("date").alias("date_nunique"),
        F.sum(of("date", F.col("amount"))).cast("double").alias("purchase_amount_sum"),
        *stats("date"),
        *(stats("invoice") if cut_lines_first else []),
        *[
            F.sum(F.when(F.col("kind") == name, F.col("amount"))).cast("double").alias(name)
            for name in sums
        ],
        F.count_if(back).alias("_back"),
    )
    # A customer with lines in other windows alone has no features.
    main = main.where("_back > 0").drop("_back")
    if cut_lines_first:
        return main
    invoices = second_level_stats(
        invoice_summary(tx), "invoice_amount", "purchase_amount_by_invoice", dates, days
    )
    out = assemble(main, invoices)
    return out.select(*[c for c in out.columns if c not in sums], *sums)


def target_sum(anchors: DataFrame, tx: DataFrame, dates: Sequence[str], days: int = 30) -> DataFrame:
    """Amount of the next ``days`` days per anchor, NULL without a purchase."""
    sums = (
        forward_lines(tx, dates, days)
        .groupBy(*KEYS)
        .agg(F.sum("purchase_amount").cast("double").alias("target"))
    )
    return anchors.join(sums, KEYS, "left")


def attach_target(
    features: DataFrame, target: DataFrame, how: str = "left", fill: float | None = 0.0
) -> DataFrame:
    """Add ``target``; ``how="inner"`` keeps only customers with a purchase."""
    out = features.join(target, KEYS, how)
    return out if fill is None else out.fillna(fill, ["target"])


def previous_amount(tx: DataFrame, dates: Sequence[str], days: int = 30) -> DataFrame:
    """Amount of the ``days`` days before: the naive forecast."""
    return (
        lookback_lines(tx, dates, days)
        .groupBy(*KEYS)
        .agg(F.sum("purchase_amount").cast("double").alias("prev_month_amount"))
    )


def baseline_join(valid: DataFrame, previous: DataFrame) -> DataFrame:
    return valid.join(previous, KEYS, "left").fillna(0.0, ["prev_month_amount"])


def merge_windows(parts: dict[int, DataFrame], key: str = "customer_id") -> DataFrame:
    """Full outer join of the features of several window lengths, one row per customer."""
    named = [
        add_suffix(df.drop("prediction_date"), [key], f"_in_{days}d") for days, df in parts.items()
    ]
    return reduce(lambda left, right: left.join(right, key, "full"), named)


def time_series_folds(df: DataFrame, folds: dict[str, dict[str, list[str]]]) -> DataFrame:
    """Each row once per fold that lists its date: adds ``fold`` and ``role``."""
    by_date: dict[str, list[tuple[str, str]]] = {}
    for fold, roles in folds.items():
        for role, dates in roles.items():
            for d in dates:
                by_date.setdefault(d, []).append((fold, role))
    places = F.create_map(
        *[
            c
            for d, marks in by_date.items()
            for c in (
                F.lit(d).cast("date"),
                F.array(*[F.struct(F.lit(f).alias("fold"), F.lit(r).alias("role")) for f, r in marks]),
            )
        ]
    )
    marked = df.withColumn("_place", F.explode(F.try_element_at(places, F.col("prediction_date"))))
    return marked.select(*df.columns, "_place.fold", "_place.role")


def concat_folds(
    tx: DataFrame, dates: Sequence[str], feature_days: int = 90, target_days: int = 30
) -> DataFrame:
    """Stacked data sets of several dates from one plan; customers without a target are left out."""
    rows = customer_features(tx, dates, feature_days, sums={"target": (0, target_days)})
    return rows.where(F.col("target").isNotNull())


def training_set(
    tx: DataFrame,
    dates: Sequence[str],
    feature_days: int = 90,
    target_days: int = 30,
    baseline_days: int | None = None,
) -> DataFrame:
    """Features with the forward target, 0 where the customer buys nothing.

    ``baseline_days`` adds ``prev_month_amount``, the naive forecast of ``baseline_join``.
    """
    sums = {"target": (0, target_days)}
    if baseline_days:
        sums["prev_month_amount"] = (-baseline_days, 0)
    return customer_features(tx, dates, feature_days, sums=sums).fillna(0.0, list(sums))
