"""Golden rows: inputs consistent with published sample outputs, and the values
those outputs show (fixed values)."""

import math

from tidemark.operators import reports, trends

MARKET_SCHEMA = ("id string, symbol string, name string, current_price double, market_cap double, "
                 "market_cap_rank bigint, total_volume double, price_change_percentage_24h double, "
                 "price_change_percentage_7d_in_currency double, circulating_supply double, total_supply double, "
                 "ingested_at_utc string")


def test_token_rows_adi_and_ethgas(spark):
    rows = [("adi-token", "adi", "ADI", 6.01, 755215640.0, 81, 1398703.0, 2.14, 7.19, 1253.0, 10000.0, "s"),
            ("ethgas-2", "gwei", "ETHGas", 0.087257, 182018121.0, 175, 9747805.0, -0.15, -33.44, 2100.0, 10000.0, "s")]
    out = {r["name"]: r for r in reports.token_liquidity_risk(spark.createDataFrame(rows, MARKET_SCHEMA)).collect()}
    adi, eth = out["ADI"], out["ETHGas"]
    assert (adi["liquidity_risk_score"], adi["volume_to_market_cap_ratio"], adi["circulating_supply_ratio"]) == \
        (35, 0.0019, 0.1253)
    assert (eth["liquidity_risk_score"], eth["volume_to_market_cap_ratio"], eth["price_change_percentage_7d"]) == \
        (30, 0.0536, -33.44)


STABLE_SCHEMA = ("id double, name string, symbol string, pegType string, pegMechanism string, price double, "
                 "circulating_usd double, circulatingPrevDay_usd double, circulatingPrevWeek_usd double, "
                 "chain_count int")


def test_stablecoin_rows_hyperbeat_and_usp(spark):
    usp_circ = 8616596.67
    rows = [(1.0, "Hyperbeat USD", "beatUSD", "peggedUSD", "fiat-backed", None, 1711205.12,
             1711205.12 / (1 - 0.2159), 1711205.12 / 1.0808, 1),
            (2.0, "USP", "USP", "peggedUSD", "crypto-backed", 1.1065407586426241, usp_circ,
             usp_circ * (1 + 1e-6), usp_circ / (1 - 0.0024), 1)]
    out = {r["name"]: r for r in reports.stablecoin_depeg_risk(spark.createDataFrame(rows, STABLE_SCHEMA)).collect()}
    hb, usp = out["Hyperbeat USD"], out["USP"]
    assert (hb["depeg_risk_score"], hb["supply_change_1d_pct"], hb["supply_change_7d_pct"]) == (55, -21.59, 8.08)
    assert hb["absolute_depeg"] is None and hb["price"] is None
    assert (usp["depeg_risk_score"], usp["absolute_depeg"], usp["circulating_usd"]) == (45, 0.106541, 8616596.67)
    assert usp["supply_change_1d_pct"] == 0.0 and math.copysign(1.0, usp["supply_change_1d_pct"]) == -1.0
    assert usp["supply_change_7d_pct"] == -0.24


def test_token_trend_united_stables(spark):
    base = ("u", "u", "United Stables", 1.0, 1e9, 1, None, 0.0, 0.0, 5.0, 10.0)
    previous = spark.createDataFrame([base[:6] + (0.0215 * 1e9,) + base[7:] + ("20260709T134236Z",)], MARKET_SCHEMA)
    latest = spark.createDataFrame([base[:6] + (0.0215 * 1e9 * (1 - 0.7611661379467756),) + base[7:]
                                    + ("20260709T134358Z",)], MARKET_SCHEMA)
    row = trends.token_liquidity_risk_trends(latest, previous).first()
    assert (row["liquidity_risk_score_previous"], row["liquidity_risk_score_latest"], row["risk_score_change"]) == \
        (15, 25, 10)
    assert row["market_cap_change_pct"] == 0.0 and math.isclose(row["volume_change_pct"], -76.11661379467756)
    assert (row["volume_to_market_cap_ratio_previous"], row["volume_to_market_cap_ratio_latest"]) == (0.0215, 0.0051)


def test_protocol_trend_zero_tvl(spark):
    schema = ("id double, name string, symbol string, chain string, category string, tvl double, "
              "change_1d double, change_7d double, audits double, ingested_at_utc string")
    prev = spark.createDataFrame([(7.0, "WBROCK Staking", "-", "Multi-Chain", "Staking Pool", 0.0, -100.0, -100.0,
                                   0.0, "20260713T144923Z")], schema)
    last = spark.createDataFrame([(7.0, "WBROCK Staking", "-", "Multi-Chain", "Staking Pool", 0.0, -100.0, -100.0,
                                   0.0, "20260713T145110Z")], schema)
    row = trends.defi_protocol_risk_trends(last, prev).first()
    assert (row["protocol_risk_score_previous"], row["protocol_risk_score_latest"], row["risk_score_change"]) == \
        (85, 85, 0)
    assert row["tvl_change_pct"] is None
