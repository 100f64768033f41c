"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from tests.oracle import compare, connect
from tidemark.plans.catalog import QUERIES
from tidemark.operators.chat import PROMPT
from tidemark.plans.adapters import KEYWORDS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_equals_sql(spark, con, name):
    verdict, detail = compare(QUERIES[name](spark, SF_DIR), con, QUERIES[name].sql)
    assert verdict == "ok", detail


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_contract_names():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_keywords_are_not_part_of_the_template():
    assert not [w for w in KEYWORDS.values() if w in PROMPT.lower()]


def test_sample_and_preview_sizes(spark):
    assert QUERIES["preview"](spark, SF_DIR).count() == 20
    assert 20 < QUERIES["sample_rows"](spark, SF_DIR).count() < 200


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["attach_target", "fold_summary", "time_series_folds", "forward_join", "concat_folds", "split_label"],
)
def test_lines_are_read_twice_at_most(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert 1 <= plan.count("l_orderkey#") and plan.count("Relation [l_orderkey") <= 2


@pytest.mark.parametrize(
    "name, column",
    [
        ("lookback_join", "o_orderdate"),
        ("attach_target", "o_orderdate"),
        ("make_anchors", "o_orderdate"),
        ("zone_stats", "ts"),
    ],
)
def test_time_bounds_reach_the_scan(spark, name, column):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    pushed = [p for p in plan.split("PushedFilters: ")[1:]]
    assert any(f"LessThan({column}," in p.split("]")[0] for p in pushed)
