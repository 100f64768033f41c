"""Profiling queries over the retail lines and the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cleaning as C
from tidemark.operators import profile as P
from tidemark.plans.adapters import LINES, Tables
from tidemark.plans.registry import query, with_ctes

COLS = ["customer_id", "invoice", "stock_code", "quantity", "price", "invoice_date", "country"]


def per_column(select: str) -> str:
    return " UNION ALL ".join(select.format(c=c) for c in COLS)


@query(
    "null_counts",
    with_ctes(
        LINES,
        select=per_column(
            "SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS total FROM lines"
        ),
    ),
)
def _(t: Tables):
    return P.null_counts(t.lines())


@query(
    "distinct_counts",
    with_ctes(
        LINES,
        select=per_column(
            "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM lines"
        ),
    ),
)
def _(t: Tables):
    return P.distinct_counts(t.lines())


def numeric_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS column_name, count({c}) AS cnt, count(DISTINCT {c}) AS distinct_values,
       NULL::VARCHAR AS top, NULL::BIGINT AS freq, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, min({c}) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max
FROM lines"""


def text_sql(c: str) -> str:
    nulls = ", ".join(
        f"NULL::DOUBLE AS {k}" for k in ("mean", "std", "min", "p25", "p50", "p75", "max")
    )
    return f"""
SELECT '{c}' AS column_name, sum(n)::BIGINT AS cnt, count(*) AS distinct_values,
       first({c} ORDER BY n DESC, {c} DESC) AS top, max(n) AS freq, {nulls}
FROM (SELECT {c}, count(*) AS n FROM lines WHERE {c} IS NOT NULL GROUP BY {c})"""


@query(
    "describe_column",
    with_ctes(
        LINES,
        select=" UNION ALL ".join(
            [text_sql("invoice"), text_sql("country"), numeric_sql("quantity"), numeric_sql("price")]
        ),
    ),
)
def _(t: Tables):
    return P.describe(t.lines(), ["invoice", "country", "quantity", "price"])


@query(
    "value_counts",
    with_ctes(LINES, select="SELECT country, count(*) AS n FROM lines GROUP BY country"),
)
def _(t: Tables):
    return P.value_counts(t.lines(), "country")


@query(
    "monthly_counts",
    with_ctes(
        LINES,
        select="SELECT strftime(invoice_date, '%Y-%m') AS month, count(*) AS n FROM lines GROUP BY 1",
    ),
)
def _(t: Tables):
    return P.monthly_counts(t.lines(), "invoice_date")


@query(
    "monthly_rollup",
    with_ctes(
        LINES,
        select="""
SELECT strftime(invoice_date, '%Y-%m') AS invoice_month,
       count(DISTINCT invoice) AS invoice_nunique, count(DISTINCT stock_code) AS stock_code_nunique,
       count(DISTINCT customer_id) AS customer_id_nunique,
       sum((price * quantity)::DECIMAL(18,4))::DOUBLE AS purchase_amount_sum,
       sum((price * quantity)::DECIMAL(18,4))::DOUBLE / count(*) AS purchase_amount_mean
FROM lines GROUP BY 1""",
    ),
)
def _(t: Tables):
    return P.monthly_rollup(t.lines())


@query(
    "nunique_histogram",
    """
SELECT distinct_values, count(*) AS n_keys
FROM (SELECT p_brand, count(DISTINCT p_name) AS distinct_values FROM part GROUP BY p_brand)
GROUP BY distinct_values""",
)
def _(t: Tables):
    return P.nunique_histogram(t.raw("part"), "p_brand", "p_name")


@query(
    "keys_with_many",
    with_ctes(
        LINES,
        select="""
SELECT customer_id, count(DISTINCT country) AS distinct_values FROM lines
WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(DISTINCT country) > 1""",
    ),
)
def _(t: Tables):
    return P.keys_with_many(t.lines(), "customer_id", "country")


@query(
    "multi_key_breakdown",
    with_ctes(
        LINES,
        select="""
SELECT customer_id, country, count(*) AS n FROM lines
WHERE customer_id IN (SELECT customer_id FROM lines GROUP BY customer_id
                      HAVING count(DISTINCT country) > 1)
GROUP BY customer_id, country""",
    ),
)
def _(t: Tables):
    return P.breakdown(t.lines(), "customer_id", "country")


@query(
    "pairs_for_key",
    with_ctes(
        LINES,
        select="SELECT DISTINCT invoice, invoice_date FROM lines WHERE invoice LIKE '%C%'",
    ),
)
def _(t: Tables):
    """All pairs of the cancelled invoices."""
    return P.pairs(t.lines(), F.col("invoice").contains("C"), ["invoice", "invoice_date"])


@query(
    "sample_consistency",
    with_ctes(
        LINES,
        select="""
SELECT customer_id, count(DISTINCT invoice) AS n_left, count(DISTINCT invoice_date) AS n_right,
       count(DISTINCT invoice) = count(DISTINCT invoice_date) AS agree
FROM lines WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    ),
)
def _(t: Tables):
    """The consistency check on every customer."""
    return P.consistency(t.lines(), "customer_id", "invoice", "invoice_date")


@query(
    "time_range",
    with_ctes(
        LINES,
        select="""
SELECT min(invoice_date) AS first_time, max(invoice_date) AS last_time, count(*) AS n_rows,
       count(DISTINCT customer_id) AS n_keys FROM lines""",
    ),
)
def _(t: Tables):
    return P.time_range(t.lines(), "invoice_date", "customer_id")


@query("row_count", "SELECT count(*) AS cnt FROM lineitem")
def _(t: Tables):
    return P.row_count(t.raw("lineitem"))


@query(
    "distinct_rows",
    with_ctes(LINES, select="SELECT DISTINCT customer_id, country FROM lines"),
)
def _(t: Tables):
    return t.lines().select("customer_id", "country").distinct()


@query(
    "top_bottom_n",
    """
(SELECT o_orderkey, o_totalprice, 'top' AS part FROM orders
 ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
UNION ALL
(SELECT o_orderkey, o_totalprice, 'bottom' AS part FROM orders
 ORDER BY o_totalprice, o_orderkey DESC LIMIT 10)""",
)
def _(t: Tables):
    rows = t.raw("orders").select("o_orderkey", "o_totalprice")
    return P.top_bottom(rows, "o_totalprice", "o_orderkey", 10)


@query(
    "top_n_recent",
    """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey LIMIT 5""",
)
def _(t: Tables):
    rows = t.raw("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return P.top_n(rows, [F.col("o_orderdate").desc_nulls_last(), F.asc("o_orderkey")], 5)


@query(
    "keyword_search",
    """
SELECT doc_id, source, lang, n_chars FROM documents WHERE lower(text) LIKE '%heon%'
ORDER BY doc_id DESC LIMIT 5""",
)
def _(t: Tables):
    out = ["doc_id", "source", "lang", "n_chars"]
    return C.keyword_search(t.raw("documents"), "text", "HEON", "doc_id", out)
