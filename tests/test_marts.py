"""Dashboard marts and report ordering."""

from pyspark.sql import functions as F

from tidemark.operators import marts, reports


def _stable_report(spark, rows):
    return spark.createDataFrame(rows, "name string, symbol string, pegMechanism string, price double, "
                                       "absolute_depeg double, circulating_usd double, supply_change_1d_pct double, "
                                       "supply_change_7d_pct double, chain_count int, depeg_risk_score int")


def test_kpi_row(spark):
    token = spark.range(7).select(F.col("id").alias("x"))
    protocol = spark.range(3).select(F.col("id").alias("x"))
    stable = _stable_report(spark, [
        ("B", "bb", "m", 1.0, 0.0, 10.0, 0.0, 0.0, 1, 55),
        ("A", "aa", "m", 1.0, 0.0, 10.0, 0.0, 0.0, 1, 55),   # tie on score and supply: name decides
        ("C", "cc", "m", 1.0, 0.0, 99.0, 0.0, 0.0, 1, 40),
    ])
    row = marts.kpi_row(token, protocol, stable).first()
    assert (row["tracked_tokens"], row["tracked_protocols"], row["tracked_stablecoins"]) == (7, 3, 3)
    assert (row["top_stablecoin_symbol"], row["top_stablecoin_score"]) == ("aa", 55)


def test_kpi_row_empty_stablecoins(spark):
    empty = _stable_report(spark, [])
    row = marts.kpi_row(spark.range(0), spark.range(2), empty).first()
    assert (row["tracked_tokens"], row["tracked_protocols"], row["tracked_stablecoins"]) == (0, 2, 0)
    assert row["top_stablecoin_symbol"] is None and row["top_stablecoin_score"] is None


def test_chart_is_top20_in_ascending_bar_order(spark):
    rows = [(f"P{i:02d}", "-", "c", "k", float(i), 0.0, 0.0, 0.0, None, i % 30, "u") for i in range(45)]
    report = spark.createDataFrame(rows, "name string, symbol string, chain string, category string, tvl double, "
                                         "change_1d double, change_7d double, audits double, "
                                         "tvl_to_mcap_ratio double, protocol_risk_score int, url string")
    chart = marts.chart_table(report, "protocol_risk").collect()
    assert len(chart) == 20
    scores = [r["protocol_risk_score"] for r in chart]
    assert scores == sorted(scores)
    want = sorted(rows, key=lambda r: (-r[9], -r[4]))[:20]
    assert {r["name"] for r in chart} == {r[0] for r in want}
    assert list(chart[0].asDict()) == ["name", "protocol_risk_score", "chain", "category", "tvl", "change_1d",
                                       "change_7d"]


def test_ranked_report_ties_are_deterministic(spark):
    rows = [(f"t{i:03d}", "s", "n", 1.0, 100.0, 1, 0.0, 0.0, 0.0, 10.0, 10.0) for i in range(120)]
    markets = spark.createDataFrame(rows, "id string, symbol string, name string, current_price double, "
                                          "market_cap double, market_cap_rank bigint, total_volume double, "
                                          "price_change_percentage_24h double, "
                                          "price_change_percentage_7d_in_currency double, "
                                          "circulating_supply double, total_supply double").repartition(7)
    first = [r["id"] for r in reports.token_liquidity_risk(markets).collect()]
    again = [r["id"] for r in reports.token_liquidity_risk(markets.repartition(3)).collect()]
    assert first == again == [f"t{i:03d}" for i in range(50)]


def test_kpi_row_agrees_with_the_report_on_ties_and_nulls(spark):
    from tidemark.operators import marts, ranking
    from tidemark.operators.reports import STABLECOIN_RISK_ORDER
    from tidemark.plans.job import REPORT_SCHEMAS

    schema = REPORT_SCHEMAS["stablecoin_depeg_risk_top50"]
    cases = [
        [(None, "NULLNAME", "m", 1.0, 0.1, 5.0, 0.0, 0.0, 1, 90), ("a", "AAA", "m", 1.0, 0.1, 5.0, 0.0, 0.0, 1, 90)],
        [("a", "NOSUPPLY", "m", 1.0, 0.1, None, 0.0, 0.0, 1, 90), ("b", "BBB", "m", 1.0, 0.1, 5.0, 0.0, 0.0, 1, 90)],
        [("a", "NOSCORE", "m", 1.0, 0.1, 5.0, 0.0, 0.0, 1, None), ("b", "LOW", "m", 1.0, 0.1, 5.0, 0.0, 0.0, 1, 0)],
    ]
    for rows in cases:
        report = spark.createDataFrame(rows, schema)
        first = ranking.top_k(report, STABLECOIN_RISK_ORDER, 1).first()
        other = spark.createDataFrame([(1,)], "x int")
        assert marts.kpi_row(other, other, report).first()["top_stablecoin_symbol"] == first["symbol"]
