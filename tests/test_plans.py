"""Physical-plan properties that matter at scale: pushdown, pruning, no pair-producing joins, no Python."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
HEAVY = ["drilldown", "monthly_avg", "median_by_outcode", "composite_score", "comparables_stats", "comparables_rows",
         "crime_by_group", "validate_sales", "load_sales", "period_findings", "price_growth", "growth_risk_volatility",
         "dq_checks", "assign_ids", "nearest_rank_quantiles", "extract_references", "unmatched_mentions"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_window_reaches_the_scan(spark):
    plan = _plan(E.queries()["drilldown"](spark, SF))
    orders = [l for l in plan.split("\n") if "orders.parquet" in l]
    assert orders and all("GreaterThanOrEqual(o_orderdate" in l for l in orders)
    assert all("o_orderstatus" not in l for l in orders)  # column pruning


@pytest.mark.parametrize("name", HEAVY)
def test_no_pairwise_joins_or_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
