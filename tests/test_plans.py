"""Plan shape: pruned scans, pushed filters, top-k without a global sort, no Python."""

import __spark_entry__ as entry
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_report_is_take_ordered(spark):
    plan = _plan(entry.queries()["token_liquidity_risk_top50"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan
    assert "Sort [" not in plan.split("TakeOrderedAndProject")[1].split("Exchange")[0]
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_no_python_in_any_plan(spark):
    for name in ["token_liquidity_risk_top50", "defi_protocol_risk_top50", "stablecoin_depeg_risk_top50",
                 "token_liquidity_risk_trends", "defi_protocol_risk_trends", "coerce_number",
                 "nested_pegged_usd", "nested_list_length", "dashboard_kpis"]:
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_newest_run_filter_reaches_scan(spark):
    plan = _plan(entry.queries()["stablecoin_depeg_risk_top50"](spark, SF_SMALL))
    assert "PushedFilters" in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 50
    assert df.columns[-2:] == ["liquidity_risk_score", "position"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
