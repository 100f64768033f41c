"""Table profiling: counts, frequencies, distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators.ordered import scan_before


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, total) for every column, in one pass."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    return wide.unpivot("_rows", df.columns, "column_name", "nulls").select(
        "column_name", "nulls", F.col("_rows").alias("total")
    )


#: Types whose text tells their values apart; a time with a zone goes as a number.
_PLAIN = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column, distinct non-NULL values).

    Each row gives one narrow cell per column, which combine before the shuffle; no copy
    of the row is made for each column. Columns that text does not tell apart (binary and
    nested ones) are counted by Spark's own distinct count.
    """
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns])
        return wide.unpivot([], df.columns, "column_name", "distinct_values")
    plain = [f.name for f in df.schema if isinstance(f.dataType, _PLAIN)]
    names = df.sparkSession.createDataFrame([(c,) for c in plain], "column_name string")

    def text(c: str) -> Column:
        value, kind = F.col(f"`{c}`"), df.schema[c].dataType
        if isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = value + F.lit(0)  # zero has two signs, and is one value
        return value.cast("string")

    rest = [c for c in df.columns if c not in plain]
    wide = df.agg(*[F.countDistinct(f"`{c}`").alias(c) for c in rest]) if rest else None
    if not plain:
        return wide.unpivot([], [f"`{c}`" for c in rest], "column_name", "distinct_values")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in plain])
    counts = (
        df.select(F.inline(cells))
        .where("value IS NOT NULL")
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )
    out = names.join(counts, "column_name", "left").fillna(0, ["distinct_values"])
    if rest:
        out = out.unionByName(
            wide.unpivot([], [f"`{c}`" for c in rest], "column_name", "distinct_values")
        )
    return out


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    out = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )
    return out if n is None else out.limit(n)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, distinct values, and the most frequent value of a text
    column or the moments and quartiles of a numeric one.

    The quartiles are exact and interpolated. They come from the sorted frequency
    table, scanned in ranges, so that no task holds all values of a column.
    """
    numeric = {c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)}
    # One reading of the table: a row per value and column, as number or as text.
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col(c) if c in numeric else F.lit(None)).cast("double").alias("num"),
                (F.lit(None) if c in numeric else F.col(c)).cast("string").alias("txt"),
            )
            for c in columns
        ]
    )
    freq = (
        df.select(F.inline(cells))
        .groupBy("column_name", "num", "txt")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("num").isNotNull() | F.col("txt").isNotNull())
        .withColumn("_key", F.struct("column_name", "num", "txt"))
    )
    # All columns stand in one order, column by column; a value's place in its own
    # column is its place there less that of the column's first value.
    ranked = scan_before(freq, "_key", "n", "_before")
    # One row per column.
    sizes = ranked.groupBy(F.col("column_name").alias("_name")).agg(
        F.sum("n").alias("size"),
        F.min("_before").alias("first"),
        (F.sum(F.col("num") * F.col("n")) / F.sum("n")).alias("_mean"),
    )
    rows = ranked.join(F.broadcast(sizes), F.col("column_name") == F.col("_name"))
    below = F.col("_before") - F.col("first")
    is_num = F.col("num").isNotNull()

    def at(rank: Column) -> Column:
        held = is_num & (below <= rank) & (rank < below + F.col("n"))
        return F.max(F.when(held, F.col("num")))

    def quantile(q: float) -> Column:
        spot = F.lit(q) * (F.col("size") - 1)
        low, high = at(F.floor(spot)), at(F.ceil(spot))
        end = F.lit(q) * (F.max("size") - 1)
        return low + (high - low) * (end - F.floor(end))

    gap = F.col("num") - F.col("_mean")
    text = F.col("txt").isNotNull()
    out = rows.groupBy("column_name").agg(
        F.sum("n").alias("cnt"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.max_by("txt", F.when(text, F.struct("n", "txt"))).alias("top"),
        F.max(F.when(text, F.col("n"))).alias("freq"),
        F.round(F.max(F.when(is_num, F.col("_mean"))), 6).alias("mean"),
        F.round(F.sqrt(F.try_divide(F.sum(F.col("n") * gap * gap), F.sum("n") - 1)), 6).alias("std"),
        F.min("num").alias("min"),
        *[F.round(quantile(q), 6).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)],
        F.max("num").alias("max"),
    )
    # Columns without any value have a row too.
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return (
        names.join(out, "column_name", "left")
        .fillna(0, ["cnt", "distinct_values"])
        .select("column_name", *_STATS)
    )


_STATS = ["cnt", "distinct_values", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max"]


def monthly_counts(df: DataFrame, ts: str) -> DataFrame:
    month = S.month_key(ts).alias("month")
    return df.groupBy(month).agg(F.count(F.lit(1)).alias("n")).orderBy("month")


def monthly_rollup(df: DataFrame, ts: str = "invoice_date") -> DataFrame:
    """Distinct invoices, items and customers, and the amount, per month.

    A line counts once under its invoice, item and customer, as narrow cells that combine
    before the shuffle; the amounts ride with the invoices.
    """
    amount = S.money(F.col("price") * F.col("quantity"))
    kinds = ["invoice", "stock_code", "customer_id"]

    def cell(kind: str) -> Column:
        paid = F.col("_amount") if kind == "invoice" else F.lit(None).cast(S.MONEY)
        return F.struct(
            F.lit(kind).alias("kind"), F.col(kind).cast("string").alias("value"), paid.alias("amount")
        )

    cells = (
        df.select(S.month_key(ts).alias("invoice_month"), *kinds, amount.alias("_amount"))
        .select("invoice_month", F.inline(F.array(*map(cell, kinds))))
        .groupBy("invoice_month", "kind", "value")
        .agg(F.sum("amount").alias("amount"), F.count("amount").alias("n"))
    )
    known = F.col("value").isNotNull()
    return (
        cells.groupBy("invoice_month")
        .agg(
            *[F.count_if(known & (F.col("kind") == k)).alias(f"{k}_nunique") for k in kinds],
            F.sum("amount").cast("double").alias("purchase_amount_sum"),
            S.mean_of(F.sum("amount"), F.sum("n")).alias("purchase_amount_mean"),
        )
        .orderBy("invoice_month")
    )


def distinct_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Distinct values of each column per key, under the column's own name."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.countDistinct(c).alias(c) for c in columns])
    )


def nunique_histogram(df: DataFrame, key: str, column: str) -> DataFrame:
    """How many keys have 0, 1, 2, ... distinct values."""
    return (
        distinct_per_key(df, key, [column])
        .groupBy(F.col(column).alias("distinct_values"))
        .agg(F.count(F.lit(1)).alias("n_keys"))
    )


def keys_with_many(df: DataFrame, key: str, column: str) -> DataFrame:
    """Keys with more than one distinct value, most first."""
    return (
        distinct_per_key(df, key, [column])
        .where(F.col(column) > 1)
        .select(key, F.col(column).alias("distinct_values"))
        .orderBy(F.desc("distinct_values"), F.asc(key))
    )


def breakdown(df: DataFrame, key: str, column: str) -> DataFrame:
    """Frequency of each value inside every key that has more than one."""
    per_value = (
        df.where(F.col(key).isNotNull() & F.col(column).isNotNull())
        .groupBy(key, column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    many = per_value.groupBy(key).agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").drop("_k")
    return per_value.join(many, key, "left_semi")


def pairs(df: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    return df.where(condition).select(*columns).distinct()


def consistency(df: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Per key, distinct values of two columns and whether the counts agree."""
    return distinct_per_key(df, key, [left, right]).select(
        key,
        F.col(left).alias("n_left"),
        F.col(right).alias("n_right"),
        (F.col(left) == F.col(right)).alias("agree"),
    )


def time_range(df: DataFrame, ts: str, key: str) -> DataFrame:
    return df.agg(
        F.min(ts).alias("first_time"),
        F.max(ts).alias("last_time"),
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(key).alias("n_keys"),
    )


def target_correlation(df: DataFrame, target: str, columns: list[str], n: int = 10) -> DataFrame:
    """Pearson correlation with the target: the ``n`` highest and ``n`` lowest columns."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"), F.round(F.corr(c, target), 6).alias("corr")
            )
            for c in columns
        ]
    )

    def first(sign: int) -> Column:
        # NULL is the lowest; equal values go by name, and backwards at the bottom.
        def compare(a: Column, b: Column) -> Column:
            x, y = (F.coalesce(v["corr"], F.lit(float("-inf"))) for v in (a, b))
            one = F.when(x > y, -sign).when(x < y, sign)
            return one.when(a["feature"] < b["feature"], -sign).when(
                a["feature"] > b["feature"], sign
            ).otherwise(0)

        return F.slice(F.array_sort("cells", compare), 1, n)

    def marked(part: str, sign: int) -> Column:
        return F.transform(
            first(sign), lambda x: F.struct(x["feature"], x["corr"], F.lit(part).alias("part"))
        )

    # One row holds all correlations, so that the table is read once.
    wide = df.agg(cells.alias("cells"))
    return wide.select(F.inline(F.concat(marked("top", 1), marked("bottom", -1))))


def top_bottom(df: DataFrame, column: str, tie: str, n: int) -> DataFrame:
    """Head and tail of the descending order, marked ``top`` and ``bottom``."""
    head = df.orderBy(F.col(column).desc_nulls_last(), F.col(tie)).limit(n)
    tail = df.orderBy(F.col(column).asc_nulls_first(), F.col(tie).desc()).limit(n)
    return head.withColumn("part", F.lit("top")).unionByName(
        tail.withColumn("part", F.lit("bottom"))
    )


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
