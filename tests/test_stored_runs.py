"""Clustered runs, pinned runs, field drift and the step ledger."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import schemas as S
from tidemark.operators.drift import feed_drift
from tidemark.operators.trends import compare_snapshots
from tidemark.plans import catalog, fixtures as fx, job
from tidemark.plans.job import Layout, land_fixture_feeds, run_job
from tidemark.sources import landing, snapshots
from tidemark.sources.clustered import clustered_runs, read_clustered, write_clustered


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_runs_join_without_an_exchange(spark, tmp_path):
    root = str(tmp_path / "runs")
    latest, previous = catalog.newest_two(spark, SF_SMALL, "protocols")
    for stamp, run in (("20240101T000000Z", previous), ("20240102T000000Z", latest)):
        write_clustered(run, root, stamp, S.ID_TEXT, 4)
        write_clustered(run, root, stamp, S.ID_TEXT, 4)  # again: replaced
    assert clustered_runs(spark, root) == ["20240101T000000Z", "20240102T000000Z"]
    before = {t.name for t in spark.catalog.listTables()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = [read_clustered(spark, root, run) for run in clustered_runs(spark, root)]
        joined = compare_snapshots(stored[1].select(S.ID_TEXT, "name", "tvl"), stored[0].select(S.ID_TEXT, "name", "tvl"), S.ID_TEXT)
        plan = _plan(joined)
        counted = _plan(stored[1].groupBy(S.ID_TEXT).count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Exchange" not in counted
    want = compare_snapshots(latest.select(S.ID_TEXT, "name", "tvl"), previous.select(S.ID_TEXT, "name", "tvl"), S.ID_TEXT)
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert {t.name for t in spark.catalog.listTables()} == before  # nothing is left in the catalog
    with pytest.raises(FileNotFoundError):
        read_clustered(spark, root, "20300101T000000Z")


def test_a_run_that_lands_between_choice_and_read(spark, tmp_path):
    root = str(tmp_path / "snap")

    def land(*stamps):
        rows = [(f"n{k}", stamp) for stamp in stamps for k in range(3)]
        snapshots.write_snapshots(spark.createDataFrame(rows, f"name string, {S.STAMP} string"), root)
    land("20240101T000000Z", "20240102T000000Z")
    version = snapshots.pin_runs(spark, root)
    land("20240103T000000Z")
    assert snapshots.pinned_runs(spark, root, version) == ["20240101T000000Z", "20240102T000000Z"]
    assert snapshots.newest_runs(spark, root) == ["20240102T000000Z", "20240103T000000Z"]
    assert snapshots.pinned_runs(spark, root, snapshots.pin_runs(spark, root)) == ["20240102T000000Z", "20240103T000000Z"]
    table = snapshots.read_snapshots(spark, root, spark.createDataFrame([], f"name string, {S.STAMP} string").schema)
    assert table.count() == 9  # the versions are no rows of the table
    with pytest.raises(FileNotFoundError):
        snapshots.pinned_runs(spark, root, "none")


def test_field_drift(spark, tmp_path):
    root = str(tmp_path / "raw")
    for stamp, schema in (("20240101T000000Z", "id string, name string, old int"), ("20240102T000000Z", "id string, tvl string, added int")):
        landing.land_records(spark.createDataFrame([("1", "a", 1), ("2", None, None)], schema), root, "s", "e", stamp)
    found = sorted(map(tuple, feed_drift(spark, root, "protocols").collect()))
    assert found == [("added", "new", 1), ("added", "unknown", 1), ("name", "vanished", 0), ("old", "vanished", 0), ("tvl", "new", 1)]
    one = str(tmp_path / "one")
    landing.land_records(spark.createDataFrame([("1", 1)], "id string, x int"), one, "s", "e", "20240101T000000Z")
    assert [tuple(r) for r in feed_drift(spark, one, "protocols").collect()] == [("x", "unknown", 1)]


def _reports(spark, layout):
    return {name: sorted(map(tuple, job.read_report(spark, layout, name).collect()), key=repr) for name in job.REPORT_SCHEMAS}


def test_a_rerun_goes_on_where_the_job_stopped(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path / "job"))
    land_fixture_feeds(spark, SF_SMALL, layout)
    ran = []
    normalize, write, marts = job.normalize_feed, job.reports_io.write_report, job.build_marts
    monkeypatch.setattr(job, "normalize_feed", lambda s, l, f, r="latest": (ran.append(f), normalize(s, l, f, r)))
    broken = {"defi_protocol_risk_trends"}

    def write_report(df, path, **more):
        name = path.rsplit("/", 1)[1]
        if name in broken:
            raise RuntimeError("an executor is lost")
        ran.append(name)
        write(df, path, **more)
    monkeypatch.setattr(job.reports_io, "write_report", write_report)
    with pytest.raises(RuntimeError):
        run_job(spark, layout, runs="all")
    assert sorted(ran) == sorted([*job.FEEDS, *job.RANKED, "token_liquidity_risk_trends"])
    ran.clear()
    broken.clear()
    results = run_job(spark, layout, runs="all", resume=True)
    assert ran == ["defi_protocol_risk_trends"] and results.where("not passed").count() == 0
    resumed = _reports(spark, layout)
    # A feed that is landed again is normalised again, with what is made of it; the others stay.
    ran.clear()
    raw = fx.protocols_raw(spark, SF_SMALL)
    newest = raw.agg(F.max(S.STAMP)).first()[0]
    landing.land_records(raw.where(F.col(S.STAMP) == newest), layout.raw("protocols"), *fx.ENDPOINTS["protocols"], F.col(S.STAMP))
    run_job(spark, layout, runs="all", resume=True)
    assert sorted(ran) == ["defi_protocol_risk_top50", "defi_protocol_risk_trends", "protocols"]
    ran.clear()
    run_job(spark, layout, runs="all")
    assert len(ran) == 8 and _reports(spark, layout) == resumed
