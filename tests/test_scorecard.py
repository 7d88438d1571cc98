"""Bands at, just below and just above every edge, plus NULL; golden rows."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scorecard as sc
from tidemark.operators import reports


def _points(spark, band, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {band.metric} double")
    return [r[0] for r in df.orderBy("i").select(band.column()).collect()]


def _below(x):
    return math.nextafter(x, -math.inf)


def _above(x):
    return math.nextafter(x, math.inf)


# (band, edge, points at edge, below, above) for each non-NULL rule edge
EDGES = [
    (sc.VOLUME_RATIO_BAND, 0.01, 15, 25, 15), (sc.VOLUME_RATIO_BAND, 0.03, 8, 15, 8),
    (sc.VOLUME_RATIO_BAND, 0.05, 0, 8, 0),
    (sc.PRICE_24H_BAND, -10.0, 20, 20, 10), (sc.PRICE_24H_BAND, -5.0, 10, 10, 0),
    (sc.PRICE_7D_BAND, -20.0, 20, 20, 10), (sc.PRICE_7D_BAND, -10.0, 10, 10, 0),
    (sc.CIRCULATING_BAND, 0.25, 0, 10, 0),
    (sc.TVL_BAND, 0.0, 25, 25, 20), (sc.TVL_BAND, 1_000_000.0, 10, 20, 10), (sc.TVL_BAND, 10_000_000.0, 0, 10, 0),
    (sc.TVL_1D_BAND, -20.0, 25, 25, 15), (sc.TVL_1D_BAND, -10.0, 15, 15, 8), (sc.TVL_1D_BAND, -5.0, 8, 8, 0),
    (sc.TVL_7D_BAND, -40.0, 25, 25, 15), (sc.TVL_7D_BAND, -20.0, 15, 15, 8), (sc.TVL_7D_BAND, -10.0, 8, 8, 0),
    (sc.AUDITS_BAND, 0.0, 10, 0, 0),
    (sc.DEPEG_BAND, 0.05, 40, 25, 40), (sc.DEPEG_BAND, 0.02, 25, 15, 25), (sc.DEPEG_BAND, 0.01, 15, 8, 15),
    (sc.DEPEG_BAND, 0.005, 8, 0, 8),
    (sc.SUPPLY_1D_BAND, -0.20, 20, 20, 12), (sc.SUPPLY_1D_BAND, -0.10, 12, 12, 6),
    (sc.SUPPLY_1D_BAND, -0.05, 6, 6, 0),
    (sc.SUPPLY_7D_BAND, -0.40, 20, 20, 12), (sc.SUPPLY_7D_BAND, -0.20, 12, 12, 6),
    (sc.SUPPLY_7D_BAND, -0.10, 6, 6, 0),
    (sc.CHAINS_BAND, 1.0, 5, 0, 0),
]
NULL_POINTS = {"volume_ratio_points": 25, "price_24h_points": 0, "price_7d_points": 0, "circulating_points": 10,
               "tvl_points": 25, "tvl_1d_points": 0, "tvl_7d_points": 0, "audits_points": 10, "depeg_points": 0,
               "supply_1d_points": 0, "supply_7d_points": 0, "chains_points": 5}


@pytest.mark.parametrize("band,edge,at,below,above", EDGES, ids=lambda x: getattr(x, "name", str(x)))
def test_band_edges(spark, band, edge, at, below, above):
    assert _points(spark, band, [edge, _below(edge), _above(edge)]) == [at, below, above]


@pytest.mark.parametrize("band", sorted({e[0] for e in EDGES}, key=lambda b: b.name), ids=lambda b: b.name)
def test_band_null(spark, band):
    assert _points(spark, band, [None]) == [NULL_POINTS[band.name]]


def test_missing_price_scores_below_hard_depeg(spark):
    df = spark.createDataFrame([(None, None), (0.5, 0.5)], "price double, absolute_depeg double")
    got = [r[0] for r in df.select(sc.DEPEG_GUARDED_BAND.column()).collect()]
    assert got == [30, 40]


def test_card_ranges():
    assert sc.LIQUIDITY_CARD.max_score() == 75
    assert sc.PROTOCOL_CARD.max_score() == 85
    assert sc.DEPEG_CARD.max_score() == 85


# Golden rows: displayed report values and the score they carry (fixed values).
def test_golden_token_rows(spark):
    rows = [  # id, market_cap, total_volume, change_24h, change_7d, circulating, total, expected score
        ("memecore", 1547763060.0, 13916190.0, -11.71, -22.18, 2453.0, 10000.0, 75),
        ("unibase", 175230795.0, 8365058.0, -12.09, -22.55, 2500.0, 10000.0, 48),
        ("lab", 261697668.0, 290264086.0, -57.72, -90.93, 3125.0, 10000.0, 40),
    ]
    df = spark.createDataFrame(rows, "id string, market_cap double, total_volume double, "
                                     "price_change_percentage_24h double, "
                                     "price_change_percentage_7d_in_currency double, circulating_supply double, "
                                     "total_supply double, want int")
    for r in reports.score_tokens(df).collect():
        assert r["liquidity_risk_score"] == r["want"], r["id"]


def test_golden_protocol_and_stablecoin_rows(spark):
    protocols = spark.createDataFrame(
        [("Bitzy", 0.0, -100.0, -100.0, 0.0, 85), ("Offshore", 29551.38, -58.06, -53.2, 0.0, 80),
         ("EagleFi", 0.0, -30.0, -50.0, 2.0, 75), ("Nerona", 5_000_000.0, -25.0, -45.0, None, 70)],
        "name string, tvl double, change_1d double, change_7d double, audits double, want int")
    for r in reports.score_protocols(protocols.withColumn("mcap", F.lit(None).cast("double"))).collect():
        assert r["protocol_risk_score"] == r["want"], r["name"]
    stables = spark.createDataFrame(
        [("ctUSD", None, 14277790.61, 23879350.0, 23879350.0, 1, 75),
         ("GRAI", 0.93, 100.0, 100.0, 115.0, 3, 46)],
        "symbol string, price double, circulating_usd double, circulatingPrevDay_usd double, "
        "circulatingPrevWeek_usd double, chain_count int, want int")
    for r in reports.score_stablecoins(stables).collect():
        assert r["depeg_risk_score"] == r["want"], r["symbol"]


def test_sql_rendering_matches_columns(spark):
    import random

    rng = random.Random(3)
    edges = [-40.0, -20.0, -10.0, -5.0, 0.0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.25, 1.0, 1e6, 1e7]
    pool = edges + [math.nextafter(e, math.inf) for e in edges] + [math.nextafter(e, -math.inf) for e in edges]
    cols = ["volume_to_market_cap_ratio", "price_change_percentage_24h", "price_change_percentage_7d_in_currency",
            "circulating_supply_ratio", "tvl", "change_1d", "change_7d", "audits", "absolute_depeg", "price",
            "supply_change_1d", "supply_change_7d", "chain_count"]
    rows = [tuple(rng.choice(pool + [None]) for _ in cols) for _ in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    df.createOrReplaceTempView("score_inputs")
    for card in (sc.LIQUIDITY_CARD, sc.PROTOCOL_CARD, sc.DEPEG_CARD):
        via_sql = spark.sql(f"select {card.sql()} as s from score_inputs").collect()
        via_cols = df.select(card.column().alias("s")).collect()
        assert via_sql == via_cols, card.name


def test_sql_functions_match_columns(spark):
    names = sc.register_sql_functions(spark)
    assert {"liquidity_risk_score", "protocol_risk_score", "depeg_risk_score", "tvl_points"} <= set(names)
    rows = [(-0.2, 0.009, None, 0.004, 1.0, 3.0), (0.0, 0.5, 2.0, 0.06, None, None), (None, None, 0.0, None, 0.97, 1.0)]
    df = spark.createDataFrame(rows, "change double, ratio double, audits double, depeg double, price double, "
                                     "chains double")
    df.createOrReplaceTempView("fn_inputs")
    got = spark.sql("""
        select protocol_risk_score(ratio * 1e8, change * 100, change * 200, audits) as p,
               depeg_risk_score(price, depeg, change, change, chains) as d,
               tvl_points(ratio * 1e8) as t
        from fn_inputs""").collect()
    cols = df.selectExpr("ratio * 1e8 as tvl", "change * 100 as change_1d", "change * 200 as change_7d", "audits",
                         "price", "depeg as absolute_depeg", "change as supply_change_1d",
                         "change as supply_change_7d", "chains as chain_count")
    want = cols.select(sc.PROTOCOL_CARD.column().alias("p"), sc.DEPEG_CARD.column().alias("d"),
                       sc.TVL_BAND.column().alias("t")).collect()
    assert got == want
    plan = spark.sql("select tvl_points(ratio) from fn_inputs")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
