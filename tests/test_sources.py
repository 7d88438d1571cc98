"""Landing, envelope reader, normalisers, snapshot tables, report files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.normalize import normalize_markets, normalize_protocols, normalize_stablecoins
from tidemark.sources import landing, reports_io, snapshots


def _envelope(path, records, stamp, nested=None):
    data = {nested: records} if nested else records
    doc = {"source": "src", "endpoint": "ep", "ingested_at_utc": stamp, "record_count": len(records), "data": data}
    path.write_text(json.dumps(doc, indent=2))


def test_envelope_reader_markets(spark, tmp_path):
    _envelope(tmp_path / "m_20240101T000000Z.json", [
        {"id": "btc", "symbol": "btc", "current_price": 42000.5, "market_cap": "8.2e11", "market_cap_rank": 1,
         "last_updated": "2024-01-01T10:00:00.000Z", "unknown_field": 1},
        {"id": "x", "market_cap": "n/a", "market_cap_rank": "2.5"},
    ], "20240101T000000Z")
    rows = normalize_markets(landing.read_envelopes(spark, str(tmp_path), "markets")).orderBy("id").collect()
    assert [r["id"] for r in rows] == ["btc", "x"]
    btc, x = rows
    assert btc["market_cap"] == 8.2e11 and btc["market_cap_rank"] == 1 and btc["current_price"] == 42000.5
    assert btc["source_file"] == "src" and btc["ingested_at_utc"] == "20240101T000000Z"
    assert str(btc["last_updated"]) == "2024-01-01 10:00:00"
    assert x["market_cap"] is None and x["market_cap_rank"] is None and x["high_24h"] is None
    out = normalize_markets(landing.read_envelopes(spark, str(tmp_path), "markets"))
    assert [f.name for f in out.schema.fields] == [f.name for f in S.MARKETS.fields]


def test_envelope_reader_stablecoins(spark, tmp_path):
    _envelope(tmp_path / "s.json", [
        {"id": "1", "name": "A", "pegType": "peggedUSD", "price": 0.99, "circulating": {"peggedUSD": 5.5},
         "circulatingPrevDay": {"peggedUSD": "9"}, "circulatingPrevWeek": {"peggedEUR": 3},
         "circulatingPrevMonth": 7, "chains": ["x", "y"]},
        {"id": "oops", "name": "B", "chains": "[1]"},
        {"id": 3, "name": "C", "chains": []},
    ], "20240101T000000Z", nested="peggedAssets")
    rows = {r["name"]: r for r in normalize_stablecoins(
        landing.read_envelopes(spark, str(tmp_path), "stablecoins")).collect()}
    a, b, c = rows["A"], rows["B"], rows["C"]
    assert (a["id"], a["circulating_usd"], a["circulatingPrevDay_usd"], a["circulatingPrevWeek_usd"],
            a["circulatingPrevMonth_usd"], a["chain_count"]) == (1.0, 5.5, 9.0, None, None, 2)
    assert b["id"] is None and b["chain_count"] is None
    assert c["chain_count"] == 0
    manifest = landing.envelope_manifest(spark, str(tmp_path), "stablecoins").collect()
    assert manifest[0]["record_count"] == 3


def test_envelope_without_list(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"source": "s", "endpoint": "e", "ingested_at_utc": "20240101T000000Z",
                                                 "record_count": 0, "data": {}}))
    assert landing.read_envelopes(spark, str(tmp_path), "stablecoins").count() == 0
    assert landing.envelope_manifest(spark, str(tmp_path), "stablecoins").first()["record_count"] == 0


def test_landing_replaces_same_stamp(spark, tmp_path):
    root = str(tmp_path / "raw")
    recs = spark.createDataFrame([("p1", "10"), ("p2", "x")], "id string, tvl string")
    landing.land_records(recs, root, "defillama", "protocols", "20240101T000000Z")
    landing.land_records(recs.limit(1), root, "defillama", "protocols", "20240102T000000Z")
    landing.land_records(recs, root, "defillama", "protocols", "20240102T000000Z")  # re-run replaces
    landed = landing.read_landed(spark, root, "protocols")
    counts = {r[S.STAMP]: r["record_count"] for r in landing.landed_runs(spark, root).collect()}
    assert counts == {"20240101T000000Z": 2, "20240102T000000Z": 2}
    newest = landing.newest_run(landed)
    assert newest.count() == 2
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({S.STAMP}" in plan
    listed = landing.read_newest_landed(spark, root, "protocols")
    assert listed.count() == 2
    assert "InMemoryFileIndex(1 paths)" in listed._jdf.queryExecution().executedPlan().toString()
    prot = normalize_protocols(newest).collect()
    assert sorted((r["id"], r["tvl"]) for r in prot if r["tvl"] is not None) == [(None, 10.0)]


def test_runs_without_records(spark, tmp_path):
    root = str(tmp_path / "raw")
    recs = spark.createDataFrame([("p1", "10"), ("p2", "x")], "id string, tvl string")
    landing.land_records(recs, root, "s", "e", "20240101T000000Z")
    landing.land_records(recs.limit(0), root, "s", "e", "20240102T000000Z")
    assert landing.newest_landed_run(spark, root) == ("20240102T000000Z", 0)
    assert landing.read_newest_landed(spark, root, "protocols").count() == 0
    landing.land_records(recs.limit(0), root, "s", "e", "20240101T000000Z")  # an empty run replaces rows, too
    assert landing.read_landed(spark, root, "protocols").count() == 0
    assert {r["record_count"] for r in landing.landed_runs(spark, root).collect()} == {0}
    landing.land_records(recs, root, "s", "e", "20240102T000000Z")
    assert landing.newest_landed_run(spark, root) == ("20240102T000000Z", 2)


def test_snapshots_and_newest_two(spark, tmp_path):
    root = str(tmp_path / "snap")
    df = spark.createDataFrame([("a", 1.0, "20240101T000000Z"), ("a", 2.0, "20240102T120000Z"),
                                ("b", 3.0, "20240102T120000Z")], f"id string, v double, {S.STAMP} string")
    snapshots.write_snapshots(df.where(F.col(S.STAMP) == "20240101T000000Z"), root)
    table = snapshots.read_snapshots(spark, root, df.schema)
    with pytest.raises(ValueError):
        snapshots.newest_runs(spark, root, 2)
    snapshots.write_snapshots(df.where(F.col(S.STAMP) != "20240101T000000Z"), root)
    snapshots.write_snapshots(df.where(F.col(S.STAMP) != "20240101T000000Z"), root)  # idempotent
    table = snapshots.read_snapshots(spark, root, df.schema)
    assert snapshots.newest_runs(spark, root, 2) == ["20240101T000000Z", "20240102T120000Z"]
    latest = snapshots.pick_snapshot(table, "20240102T120000Z")
    assert latest.count() == 2
    assert {r["ingestion_date"] for r in latest.collect()} == {"2024-01-02"}
    assert "PartitionFilters: [isnotnull(snapshot_ts" in latest._jdf.queryExecution().executedPlan().toString()
    l2, p2 = snapshots.newest_two_in_plan(df)
    assert l2.count() == 2 and p2.count() == 1
    one, _ = snapshots.newest_two_in_plan(df.where(F.col(S.STAMP) == "20240101T000000Z"))
    with pytest.raises(Exception, match="two runs are needed"):
        one.collect()


def test_bad_stamp_fails_the_write(spark, tmp_path):
    df = spark.createDataFrame([("a", "garbage")], f"id string, {S.STAMP} string")
    with pytest.raises(Exception, match="unparseable run stamp"):
        snapshots.write_snapshots(df, str(tmp_path / "snap"))


def test_report_round_trip(spark, tmp_path):
    path = str(tmp_path / "rep")
    df = spark.createDataFrame([("a", 1.5, None, float("inf"), -0.0), ("b", None, "", 2.0, 0.1 + 0.2)],
                               "name string, x double, s string, y double, z double")
    reports_io.write_report(df, path, single_file=True)
    back = reports_io.read_report(spark, path, "name string, x double, s string, y double, z double")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [
        ("a", 1.5, None, float("inf"), -0.0), ("b", None, None, 2.0, 0.1 + 0.2)]
    with pytest.raises(reports_io.ReportMissing):
        reports_io.read_report(spark, str(tmp_path / "nope"))


def test_newest_runs_of_one_day_and_several(spark, tmp_path):
    root = str(tmp_path / "snap")
    stamps = ["20240101T000000Z", "20240102T000000Z", "20240102T110000Z", "20240102T120000Z"]
    df = spark.createDataFrame([("a", s) for s in stamps], f"id string, {S.STAMP} string")
    snapshots.write_snapshots(df, root)
    assert [snapshots.newest_runs(spark, root, n) for n in (1, 2, 4)] == [stamps[-1:], stamps[-2:], stamps]


def test_sized_conf():
    from tidemark.session import sized_conf

    conf = sized_conf(10 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 81920
    assert int(sized_conf(10, 8)["spark.sql.shuffle.partitions"]) == 16


def test_staged_sorted_report(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 97).alias("k"), F.col("id"))
    path, stage = str(tmp_path / "rep"), str(tmp_path / "stage")
    reports_io.write_report(df, path, order=[F.desc("k"), F.asc("id")], stage=stage)
    back = reports_io.read_report(spark, path, "k long, id long")
    assert back.count() == 1000
    assert spark.read.parquet(stage).count() == 1000


def test_backfill_write_rebalances(spark, tmp_path):
    root = str(tmp_path / "snap")
    df = spark.range(4000).select(F.col("id").cast("string").alias("id"),
                                  F.concat(F.lit("2024010"), (F.col("id") % 3 + 1).cast("string"),
                                           F.lit("T000000Z")).alias(S.STAMP)).repartition(8)
    snapshots.write_snapshots(df, root, many_runs=True)
    table = snapshots.read_snapshots(spark, root, df.schema)
    assert table.count() == 4000
    files = spark.read.format("binaryFile").load(root).groupBy("snapshot_ts").count().collect()
    assert len(files) == 3 and all(r["count"] < 8 for r in files)


def test_read_runs_by_path(spark, tmp_path):
    root = str(tmp_path / "snap")
    df = spark.createDataFrame([("a", 1.0, "20240101T000000Z"), ("b", 2.0, "20240102T120000Z"),
                                ("c", 3.0, "20240103T000000Z")], f"id string, v double, {S.STAMP} string")
    snapshots.write_snapshots(df, root)
    two = snapshots.read_runs(spark, root, df.schema, ["20240102T120000Z", "20240103T000000Z"])
    assert sorted((r["id"], r["snapshot_ts"], r["ingestion_date"]) for r in two.collect()) == [
        ("b", "20240102T120000Z", "2024-01-02"), ("c", "20240103T000000Z", "2024-01-03")]
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(2 paths)" in plan


def test_read_landed_run(spark, tmp_path):
    root = str(tmp_path / "raw")
    recs = spark.createDataFrame([("p1", "10"), ("p2", "x")], "id string, tvl string")
    landing.land_records(recs, root, "s", "e", "20240101T000000Z")
    landing.land_records(recs.limit(1), root, "s", "e", "20240102T000000Z")
    stamp, records = landing.newest_landed_run(spark, root)
    assert records == 1
    run = landing.read_landed_run(spark, root, "protocols", stamp)
    assert stamp == "20240102T000000Z" and run.count() == 1
    assert run.first()[S.STAMP] == stamp
    with pytest.raises(FileNotFoundError, match="no run was landed"):
        landing.newest_landed_run(spark, str(tmp_path / "none"))


def test_no_snapshot_table_yet(spark, tmp_path):
    with pytest.raises(ValueError, match="holds 0 run"):
        snapshots.newest_runs(spark, str(tmp_path / "none"), 2)


def test_normalisers_accept_typed_input(spark):
    from conftest import SF_SMALL
    from tidemark.plans import fixtures as fx

    markets = fx.fx_markets(spark, SF_SMALL)
    cols = [c for c in markets.columns]
    again = normalize_markets(markets).select(*cols)
    assert again.exceptAll(markets).count() == 0 and markets.exceptAll(again).count() == 0
    protocols = fx.fx_protocols(spark, SF_SMALL)
    back = normalize_protocols(protocols).select(*protocols.columns)
    assert back.exceptAll(protocols).count() == 0


def test_big_integral_values_keep_precision(spark):
    from tidemark.operators.normalize import conform

    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big, big)], "market_cap_rank bigint, listedAt bigint")
    assert normalize_markets(df).first()["market_cap_rank"] == big
    assert conform(df, "protocols").first()["listedAt"] == big


def _runs_of(spark, root):
    return sorted((r[S.STAMP], r["source"], r["endpoint"], r["record_count"]) for r in landing.landed_runs(spark, root).collect())


def test_a_landing_touches_its_own_runs_only(spark, tmp_path):
    root = str(tmp_path / "raw")
    one = spark.createDataFrame([("p1", "10"), ("p2", "x"), ("p3", "y")], "id string, tvl string")
    many = spark.createDataFrame([("a", "20240102T000000Z"), ("b", "20240102T000000Z"), ("c", "20240103T000000Z")], f"id string, {S.STAMP} string")
    landing.land_records(one, root, "srcA", "epA", "20240101T000000Z")
    landing.land_records(many, root, "srcB", "epB", F.col(S.STAMP))
    landing.land_records(many.where("id = 'c'"), root, "srcC", "epC", F.col(S.STAMP))
    assert _runs_of(spark, root) == [("20240101T000000Z", "srcA", "epA", 3), ("20240102T000000Z", "srcB", "epB", 2), ("20240103T000000Z", "srcC", "epC", 1)]
    landed = landing.read_landed(spark, root, "protocols").collect()
    assert sorted((r.id, r.source) for r in landed) == [("a", "srcB"), ("b", "srcB"), ("c", "srcC"), ("p1", "srcA"), ("p2", "srcA"), ("p3", "srcA")]


def test_records_are_counted_while_they_are_written(spark, tmp_path, monkeypatch):
    """Nothing of a landing is read to count it."""
    root = str(tmp_path / "raw")
    read = []
    monkeypatch.setattr(type(spark.read), "text", lambda *a, **b: read.append(a))
    monkeypatch.setattr(type(spark.read), "json", lambda *a, **b: read.append(a))
    rows = spark.range(5000).select(F.col("id").cast("string"), F.format_string("2024%04dT000000Z", 1 + F.col("id") % 700).alias(S.STAMP))
    landing.land_records(rows, root, "s", "e", F.col(S.STAMP))
    monkeypatch.undo()
    assert not read
    assert [(n, k) for _, _, _, n in _runs_of(spark, root) for k in [n]] == [(8, 8)] * 100 + [(7, 7)] * 600


@pytest.mark.parametrize("stamp", ["20240101T000000Z", None])
def test_readers_see_the_old_run_until_the_new_one_is_published(spark, tmp_path, monkeypatch, stamp):
    root = str(tmp_path / "raw")
    rows = spark.createDataFrame([("old1", "20240101T000000Z"), ("old2", "20240101T000000Z")], f"id string, {S.STAMP} string")
    landing.land_records(rows, root, "s", "e", F.col(S.STAMP))
    newer = rows.select(F.lit("new").alias("id"), S.STAMP)

    def lost(*args):
        raise RuntimeError("the driver is lost")
    monkeypatch.setattr(landing, "_publish", lost)
    with pytest.raises(RuntimeError):
        landing.land_records(newer.drop(S.STAMP) if stamp else newer, root, "s", "e", stamp or F.col(S.STAMP))
    assert len(list((tmp_path / "raw").glob("attempt=*/*/part-*"))) > 1  # its records are there
    assert sorted(r.id for r in landing.read_landed(spark, root, "protocols").collect()) == ["old1", "old2"]
    assert _runs_of(spark, root) == [("20240101T000000Z", "s", "e", 2)]
    monkeypatch.undo()
    landing.land_records(newer, root, "s", "e", F.col(S.STAMP))
    assert [r.id for r in landing.read_newest_landed(spark, root, "protocols").collect()] == ["new", "new"]


def test_superseded_folders_are_removed(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = spark.createDataFrame([("a", "20240101T000000Z"), ("b", "20240102T000000Z")], f"id string, {S.STAMP} string")
    landing.land_records(rows, root, "s", "e", F.col(S.STAMP))
    landing.land_records(rows.limit(1), root, "s", "e", F.col(S.STAMP))
    assert landing.remove_superseded(spark, root) == 0  # too young
    assert landing.remove_superseded(spark, root, dt.timedelta(0)) == 1
    assert sorted(r.id for r in landing.read_landed(spark, root, "protocols").collect()) == ["a", "b"]


def test_rows_without_a_stamp_fail_the_landing(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("b", "20240102T000000Z")], f"id string, {S.STAMP} string")
    with pytest.raises(ValueError, match="needs a run stamp"):
        landing.land_records(rows, str(tmp_path / "raw"), "s", "e", F.col(S.STAMP))
    with pytest.raises(FileNotFoundError):
        landing.read_landed(spark, str(tmp_path / "raw"), "protocols")
