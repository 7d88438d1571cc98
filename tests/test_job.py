"""The batch job end to end in a temporary folder."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import schemas as S
from tidemark.operators import quality
from tidemark.plans import fixtures as fx
from tidemark.plans.job import Layout, land_fixture_feeds, read_report, run_job
from tidemark.sources import landing, reports_io


def test_job_backfill_and_outputs(spark, tmp_path):
    layout = Layout(str(tmp_path / "job"))
    land_fixture_feeds(spark, SF_SMALL, layout)
    results = {r["target"]: r for r in run_job(spark, layout, runs="all").collect()}
    assert all(r["passed"] for r in results.values())
    assert results["token_liquidity_risk_top50"]["rows"] == 50
    token = read_report(spark, layout, "token_liquidity_risk_top50")
    assert token.columns[:3] == ["market_cap_rank", "id", "symbol"]
    kpi = spark.read.parquet(layout.mart("kpis")).first()
    assert (kpi["tracked_tokens"], kpi["tracked_protocols"]) == (50, 50)
    chart = spark.read.parquet(layout.mart("chart_token_risk")).collect()
    assert len(chart) == 20
    trend = read_report(spark, layout, "defi_protocol_risk_trends")
    assert trend.count() == results["defi_protocol_risk_trends"]["rows"] > 0

    from tidemark.functions.scorecard import PROTOCOL_CARD
    from tidemark.plans.job import register_views

    views = register_views(spark, layout)
    assert {"markets_latest", "protocols_snapshots", "token_liquidity_risk_top50"} <= set(views)
    top = spark.sql(f"select max({PROTOCOL_CARD.sql()}) as m from protocols_latest").first()["m"]
    assert top == spark.sql("select max(protocol_risk_score(tvl, change_1d, change_7d, audits)) as m "
                            "from protocols_latest").first()["m"]
    assert top == spark.sql("select max(protocol_risk_score) as m from defi_protocol_risk_top50").first()["m"]


def test_job_latest_only_single_run(spark, tmp_path):
    layout = Layout(str(tmp_path / "job"))
    stables = fx.stablecoins_raw(spark, SF_SMALL)
    for feed in ("markets", "protocols"):
        raw = fx.RAW_BUILDERS[feed](spark, SF_SMALL)
        newest = raw.where(F.col(S.STAMP) == raw.select(F.max(S.STAMP)).scalar())
        landing.land_records(newest, layout.raw(feed), *fx.ENDPOINTS[feed], F.col(S.STAMP))
    landing.land_records(stables, layout.raw("stablecoins"), *fx.ENDPOINTS["stablecoins"], F.col(S.STAMP))
    with pytest.raises(ValueError, match="holds 1 run"):
        run_job(spark, layout)
    results = run_job(spark, layout, skip_trends_if_single=True).collect()
    assert {r["target"] for r in results} == {"markets", "protocols", "stablecoins", "token_liquidity_risk_top50",
                                              "defi_protocol_risk_top50", "stablecoin_depeg_risk_top50"}
    stale = layout.report("defi_protocol_risk_trends")
    spark.range(1).write.parquet(stale)
    run_job(spark, layout, skip_trends_if_single=True)
    assert not Path(stale).exists()  # a skipped report leaves none of an earlier run behind


def test_quality_failures_are_all_reported(spark, tmp_path):
    path = str(tmp_path / "rep")
    reports_io.write_report(spark.createDataFrame([(1, None)], "a int, liquidity_risk_score int"), path)
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    res = quality.quality_suite(
        spark, [quality.TableTarget("empty", str(tmp_path / "empty")),
                quality.TableTarget("gone", str(tmp_path / "gone"))],
        [quality.ReportTarget("nulls", path, "liquidity_risk_score"),
         quality.ReportTarget("noscore", path, "protocol_risk_score")])
    with pytest.raises(quality.QualityCheckFailed) as err:
        quality.assert_passed(res)
    for word in ("empty", "gone", "nulls", "noscore"):
        assert word in str(err.value)


def test_missing_landing_is_reported(spark, tmp_path):
    from tidemark.plans.job import normalize_feed

    with pytest.raises(FileNotFoundError, match="no run was landed"):
        normalize_feed(spark, Layout(str(tmp_path / "nothing")), "markets")


def test_cli_run(spark, tmp_path):
    from tidemark import cli

    layout = Layout(str(tmp_path / "job"))
    land_fixture_feeds(spark, SF_SMALL, layout)
    assert cli.main(["run", "--root", layout.root, "--runs", "all", "--no-marts"]) == 0
    assert read_report(spark, layout, "stablecoin_depeg_risk_top50").count() == 50


def test_latest_table_is_the_run_just_processed(spark, tmp_path):
    from tidemark.plans.job import normalize_feed, read_latest

    layout = Layout(str(tmp_path / "job"))
    raw = fx.protocols_raw(spark, SF_SMALL)
    stamps = sorted(r[0] for r in raw.select(S.STAMP).distinct().collect())
    landing.land_records(raw, layout.raw("protocols"), *fx.ENDPOINTS["protocols"], F.col(S.STAMP))
    normalize_feed(spark, layout, "protocols", runs="all")
    assert {r[0] for r in read_latest(spark, layout, "protocols").select(S.STAMP).distinct().collect()} == {stamps[-1]}
    # Re-land an older run under a new, newest stamp: the latest table follows the processed run.
    newer = "29990101T000000Z"
    landing.land_records(raw.where(F.col(S.STAMP) == stamps[0]).drop(S.STAMP), layout.raw("protocols"),
                         *fx.ENDPOINTS["protocols"], newer)
    normalize_feed(spark, layout, "protocols")
    assert {r[0] for r in read_latest(spark, layout, "protocols").select(S.STAMP).distinct().collect()} == {newer}


def test_trend_file_is_globally_sorted(spark, tmp_path):
    import csv
    import glob
    import math

    from tidemark.operators.trends import PROTOCOL_TREND_ORDER

    layout = Layout(str(tmp_path / "job"))
    land_fixture_feeds(spark, SF_SMALL, layout)
    run_job(spark, layout, runs="all", with_marts=False)
    rows = []
    for part in sorted(glob.glob(f"{layout.report('defi_protocol_risk_trends')}/part-*.csv")):
        with open(part, newline="") as fh:
            rows.extend(csv.DictReader(fh))
    assert len(rows) > 100

    def key(r):
        out = []
        for col, direction in PROTOCOL_TREND_ORDER:
            v = r[col]
            if v == "":
                out.append((1, 0))           # NULLs last in both directions
                continue
            try:
                x = float(v)
            except ValueError:
                out.append((0, v))
                continue
            out.append((0, -x if direction == "desc" else x))
        return out

    keys = [key(r) for r in rows]
    assert keys == sorted(keys)
    assert not any(math.isnan(float(r["tvl_change_pct"])) for r in rows if r["tvl_change_pct"])


def test_together_runs_all_and_raises_first_failure(spark):
    from tidemark.plans.job import together

    assert together([lambda: spark.range(10).count(), lambda: spark.range(5).count()]) == [10, 5]
    ran = []

    def boom():
        raise ValueError("step failed")

    with pytest.raises(ValueError, match="step failed"):
        together([boom, lambda: ran.append(spark.range(3).count())])
    assert ran == [3]   # the other action still completed


def test_quality_checks_run_once(spark, tmp_path):
    """The job returns the rows it checked: reading them again starts no scan."""
    layout = Layout(str(tmp_path / "job"))
    land_fixture_feeds(spark, SF_SMALL, layout)
    results = run_job(spark, layout, runs="all", with_marts=False)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert results.count() == 14 and "FileScan" not in plan
    assert spark.read.parquet(layout.staging("defi_protocol_risk_trends")).count() > 0


def test_empty_newest_run_stops_the_job(spark, tmp_path):
    from tidemark.plans.job import normalize_feed

    layout = Layout(str(tmp_path / "job"))
    rows = spark.createDataFrame([("1", "a")], "id string, name string")
    landing.land_records(rows, layout.raw("protocols"), "s", "e", "20240101T000000Z")
    landing.land_records(rows.limit(0), layout.raw("protocols"), "s", "e", "20240102T000000Z")
    for runs in ("latest", "all"):
        with pytest.raises(ValueError, match="20240102T000000Z, holds no record"):
            normalize_feed(spark, layout, "protocols", runs=runs)


def test_quality_on_empty_outputs(spark, tmp_path):
    import os

    from tidemark.sources import reports_io

    reports_io.write_report(spark.createDataFrame([], "name string, liquidity_risk_score int"),
                            str(tmp_path / "empty_report"), single_file=True)
    spark.createDataFrame([], "a int").write.parquet(str(tmp_path / "empty_table"))
    os.makedirs(tmp_path / "bare_table")
    os.makedirs(tmp_path / "bare_report")
    res = {r["target"]: r for r in quality.quality_suite(
        spark, [quality.TableTarget("empty_table", str(tmp_path / "empty_table")),
                quality.TableTarget("bare_table", str(tmp_path / "bare_table"))],
        [quality.ReportTarget("empty_report", str(tmp_path / "empty_report"), "liquidity_risk_score"),
         quality.ReportTarget("bare_report", str(tmp_path / "bare_report"), "liquidity_risk_score")]).collect()}
    assert set(res) == {"empty_table", "bare_table", "empty_report", "bare_report"}
    assert all(not r["passed"] and r["rows"] in (0, None) for r in res.values())
    assert res["bare_table"]["rows"] == 0 and res["bare_report"]["rows"] == 0
