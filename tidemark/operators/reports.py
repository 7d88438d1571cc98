"""Ranked risk reports over a "latest" table.

Each report is metrics → scorecard → not-null filter → rounded projection →
top-k. Metrics and bands use unrounded values; the ranking uses the *report*
columns (so a rounded TVL ranks as shown). Every report order ends with
tie-breakers over its output columns, so a limit is deterministic.

Plan shape: FileScan (pruned columns, pushed IS NOT NULL) → Project → TakeOrderedAndProject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arith import (
    abs_distance,
    both_positive_ratio,
    change_fraction,
    round_half_away,
    safe_ratio,
)
from tidemark.functions.scorecard import DEPEG_CARD, LIQUIDITY_CARD, PROTOCOL_CARD
from tidemark.operators.ranking import report_order, top_k

REPORT_LIMIT = 50

TOKEN_RISK_COLUMNS = [
    "market_cap_rank", "id", "symbol", "name", "current_price", "market_cap", "total_volume",
    "volume_to_market_cap_ratio", "price_change_percentage_24h", "price_change_percentage_7d",
    "circulating_supply_ratio", "liquidity_risk_score",
]
PROTOCOL_RISK_COLUMNS = [
    "name", "symbol", "chain", "category", "tvl", "change_1d", "change_7d", "audits",
    "tvl_to_mcap_ratio", "protocol_risk_score", "url",
]
STABLECOIN_RISK_COLUMNS = [
    "name", "symbol", "pegMechanism", "price", "absolute_depeg", "circulating_usd",
    "supply_change_1d_pct", "supply_change_7d_pct", "chain_count", "depeg_risk_score",
]


def _rest(columns: list[str], first: list[str]) -> list[str]:
    return first + [c for c in columns if c not in first]


TOKEN_RISK_ORDER = report_order(
    ["liquidity_risk_score", "market_cap"],
    _rest([c for c in TOKEN_RISK_COLUMNS if c not in ("liquidity_risk_score", "market_cap")], ["id"]))
PROTOCOL_RISK_ORDER = report_order(
    ["protocol_risk_score", "tvl"],
    _rest([c for c in PROTOCOL_RISK_COLUMNS if c not in ("protocol_risk_score", "tvl")], ["name"]))
STABLECOIN_RISK_ORDER = report_order(
    ["depeg_risk_score", "circulating_usd"],
    _rest([c for c in STABLECOIN_RISK_COLUMNS if c not in ("depeg_risk_score", "circulating_usd")], ["name"]))


# --- metrics (E1-E7) -------------------------------------------------------

def token_metrics(markets: DataFrame) -> DataFrame:
    return markets.withColumns({
        "volume_to_market_cap_ratio": safe_ratio("total_volume", "market_cap"),
        "circulating_supply_ratio": both_positive_ratio("circulating_supply", "total_supply"),
    })


def protocol_metrics(protocols: DataFrame) -> DataFrame:
    return protocols.withColumn("tvl_to_mcap_ratio", safe_ratio("tvl", "mcap"))


def stablecoin_metrics(stablecoins: DataFrame) -> DataFrame:
    return stablecoins.withColumns({
        "absolute_depeg": abs_distance("price", 1.0),
        "supply_change_1d": change_fraction("circulating_usd", "circulatingPrevDay_usd"),
        "supply_change_7d": change_fraction("circulating_usd", "circulatingPrevWeek_usd"),
    })


def pegged_usd_only(stablecoins: DataFrame) -> DataFrame:
    return stablecoins.where(F.col("pegType") == F.lit("peggedUSD"))


# --- scored frames (all rows, no filter) ------------------------------------

def score_tokens(markets: DataFrame, with_bands: bool = False) -> DataFrame:
    return LIQUIDITY_CARD.apply(token_metrics(markets), with_bands)


def score_protocols(protocols: DataFrame, with_bands: bool = False) -> DataFrame:
    return PROTOCOL_CARD.apply(protocol_metrics(protocols), with_bands)


def score_stablecoins(stablecoins: DataFrame, with_bands: bool = False) -> DataFrame:
    return DEPEG_CARD.apply(stablecoin_metrics(stablecoins), with_bands)


# --- reports (R1-R3) --------------------------------------------------------

def token_liquidity_risk(markets: DataFrame, limit: int | None = REPORT_LIMIT) -> DataFrame:
    out = (score_tokens(markets)
           .where(F.col("market_cap").isNotNull())
           .select(
               "market_cap_rank", "id", "symbol", "name", "current_price", "market_cap",
               "total_volume",
               round_half_away("volume_to_market_cap_ratio", 4).alias("volume_to_market_cap_ratio"),
               round_half_away("price_change_percentage_24h", 2).alias("price_change_percentage_24h"),
               round_half_away("price_change_percentage_7d_in_currency", 2).alias("price_change_percentage_7d"),
               round_half_away("circulating_supply_ratio", 4).alias("circulating_supply_ratio"),
               "liquidity_risk_score"))
    return top_k(out, TOKEN_RISK_ORDER, limit)


def defi_protocol_risk(protocols: DataFrame, limit: int | None = REPORT_LIMIT) -> DataFrame:
    out = (score_protocols(protocols)
           .where(F.col("tvl").isNotNull())
           .select(
               "name", "symbol", "chain", "category",
               round_half_away("tvl", 2).alias("tvl"),
               round_half_away("change_1d", 2).alias("change_1d"),
               round_half_away("change_7d", 2).alias("change_7d"),
               "audits",
               round_half_away("tvl_to_mcap_ratio", 4).alias("tvl_to_mcap_ratio"),
               "protocol_risk_score", "url"))
    return top_k(out, PROTOCOL_RISK_ORDER, limit)


def stablecoin_depeg_risk(stablecoins: DataFrame, limit: int | None = REPORT_LIMIT) -> DataFrame:
    out = (score_stablecoins(pegged_usd_only(stablecoins))
           .where(F.col("circulating_usd").isNotNull())
           .select(
               "name", "symbol", "pegMechanism", "price",
               round_half_away("absolute_depeg", 6).alias("absolute_depeg"),
               round_half_away("circulating_usd", 2).alias("circulating_usd"),
               round_half_away(F.col("supply_change_1d") * 100, 2).alias("supply_change_1d_pct"),
               round_half_away(F.col("supply_change_7d") * 100, 2).alias("supply_change_7d_pct"),
               "chain_count", "depeg_risk_score"))
    return top_k(out, STABLECOIN_RISK_ORDER, limit)
