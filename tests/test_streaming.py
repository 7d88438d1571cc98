"""Incremental normalisation: each landed run is processed once, across restarts."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import schemas as S
from tidemark.plans import fixtures as fx
from tidemark.sources import landing
from tidemark.streaming.incremental import catch_up


def test_catch_up_processes_new_runs_once(spark, tmp_path):
    raw, out, ckpt = (str(tmp_path / p) for p in ("raw", "out", "ckpt"))
    records = fx.protocols_raw(spark, SF_SMALL)
    stamps = sorted(r[0] for r in records.select(S.STAMP).distinct().collect())
    first, rest = stamps[:3], stamps[3:]
    landing.land_records(records.where(F.col(S.STAMP).isin(first)), raw, "defillama", "protocols", F.col(S.STAMP))
    catch_up(spark, raw, out, ckpt, "protocols")
    table = spark.read.schema(S.snapshot_schema(S.PROTOCOLS)).parquet(out)
    assert sorted(r[0] for r in table.select("snapshot_ts").distinct().collect()) == first
    catch_up(spark, raw, out, ckpt, "protocols")  # nothing new: no duplicates
    landing.land_records(records.where(F.col(S.STAMP).isin(rest)), raw, "defillama", "protocols", F.col(S.STAMP))
    catch_up(spark, raw, out, ckpt, "protocols")
    table = spark.read.schema(S.snapshot_schema(S.PROTOCOLS)).parquet(out)
    assert table.count() == records.count()
    assert table.select("name", "snapshot_ts").distinct().count() == records.count()


def test_cli_catch_up(spark, tmp_path):
    from tidemark import cli
    from tidemark.plans.job import Layout

    layout = Layout(str(tmp_path / "job"))
    records = fx.stablecoins_raw(spark, SF_SMALL)
    landing.land_records(records, layout.raw("stablecoins"), "defillama", "stablecoins", F.col(S.STAMP))
    assert cli.main(["catch-up", "--root", layout.root, "--feed", "stablecoins"]) == 0
    out = spark.read.schema(S.snapshot_schema(S.STABLECOINS)).parquet(layout.snapshots("stablecoins"))
    assert out.count() == records.count()


def test_run_landed_again_is_replaced(spark, tmp_path):
    raw, out, ckpt = (str(tmp_path / p) for p in ("raw", "out", "ckpt"))
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    landing.land_records(rows.limit(1), raw, "s", "e", "20240101T000000Z")
    catch_up(spark, raw, out, ckpt, "protocols")
    landing.land_records(rows, raw, "s", "e", "20240101T000000Z")
    catch_up(spark, raw, out, ckpt, "protocols")
    table = spark.read.schema(S.snapshot_schema(S.PROTOCOLS)).parquet(out)
    assert sorted(r["name"] for r in table.collect()) == ["a", "b"]
