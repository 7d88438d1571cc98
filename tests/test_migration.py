"""Tables written by the pandas-based tools can be read and reported on."""

import pandas as pd

from tidemark.operators import reports, trends
from tidemark.sources.snapshots import read_processed


def _markets(stamp, caps):
    return pd.DataFrame({
        "id": ["btc", "eth", "low"], "symbol": ["b", "e", "l"], "name": ["B", "E", "L"],
        "current_price": [1.0, 2.0, 3.0], "market_cap": caps, "market_cap_rank": [1, 2, 3],
        "total_volume": [50.0, 1.0, 0.5], "price_change_percentage_24h": [-11.0, 0.0, -6.0],
        "price_change_percentage_7d_in_currency": [-25.0, 0.0, -1.0],
        "circulating_supply": [1.0, 5.0, None], "total_supply": [10.0, 10.0, 10.0],
        "last_updated": pd.to_datetime(["2024-01-01T10:00:00Z", "bad", "2024-01-01T11:00:00Z"],
                                       errors="coerce", utc=True, format="ISO8601"),
        "ingested_at_utc": [stamp] * 3, "source_file": ["coingecko"] * 3,
    })


def test_pandas_tables(spark, tmp_path):
    latest = _markets("20240102T000000Z", [1000, 2000, 0])           # int64 column, as pandas writes it
    latest.to_parquet(tmp_path / "markets_latest.parquet", index=False)
    df = read_processed(spark, str(tmp_path / "markets_latest.parquet"), "markets")
    assert dict(df.dtypes)["market_cap"] == "double" and dict(df.dtypes)["last_updated"] == "timestamp"
    assert str(df.where("id = 'btc'").first()["last_updated"]) == "2024-01-01 10:00:00"
    top = {r["id"]: r["liquidity_risk_score"] for r in reports.token_liquidity_risk(df).collect()}
    assert top == {"btc": 50, "eth": 25, "low": 45}   # btc: ratio 0.05 gets 0, then 20 + 20 + 10

    snap = tmp_path / "snapshots"
    for stamp, caps in [("20240101T000000Z", [1000, 2000, 10]), ("20240102T000000Z", [1000, 2000, 0])]:
        part = snap / f"ingestion_date={stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}"
        part.mkdir(parents=True)
        _markets(stamp, caps).to_parquet(part / f"markets_{stamp}.parquet", index=False)
    history = read_processed(spark, str(snap), "markets")
    rows = {r["name_latest"]: r for r in trends.trends_from_history(
        history, trends.token_liquidity_risk_trends).collect()}
    assert rows["L"]["market_cap_change_pct"] == -100.0
    assert rows["B"]["risk_score_change"] == 0


def test_pandas_written_report(spark, tmp_path):
    from tidemark.sources.reports_io import read_report

    path = tmp_path / "trend"
    path.mkdir()
    pd.DataFrame({"name": ["a", "b", "c", "d"], "pct": [float("inf"), float("-inf"), None, 12.5]}).to_csv(
        path / "report.csv", index=False)
    (path / "spark.csv").write_text("name,pct\ne,Infinity\nf,-Infinity\n")
    back = {r["name"]: r["pct"] for r in read_report(spark, str(path), "name string, pct double").collect()}
    assert back == {"a": float("inf"), "b": float("-inf"), "c": None, "d": 12.5,
                    "e": float("inf"), "f": float("-inf")}


def test_pandas_protocols_with_lists(spark, tmp_path):
    pd.DataFrame({
        "id": [1.0, None], "name": ["A", "B"], "tvl": [0.0, 5e6], "change_1d": [-30.0, 0.0],
        "change_7d": [-50.0, 0.0], "audits": [2.0, None], "listedAt": [1700000000, 1700000001],
        "forkedFrom": [["Uniswap V2"], []], "ingested_at_utc": ["20240101T000000Z"] * 2,
    }).to_parquet(tmp_path / "protocols_latest.parquet", index=False)
    df = read_processed(spark, str(tmp_path / "protocols_latest.parquet"), "protocols")
    rows = {r["name"]: r for r in df.collect()}
    assert rows["A"]["forkedFrom"] == '["Uniswap V2"]' and rows["B"]["forkedFrom"] == "[]"
    assert rows["A"]["listedAt"] == 1700000000 and rows["B"]["id"] is None
    scores = {r["name"]: r["protocol_risk_score"] for r in reports.defi_protocol_risk(df).collect()}
    assert scores == {"A": 75, "B": 20}
