"""Dashboard marts: the tables a dashboard renders, computed by Spark.

* ``kpi_row`` (D1): tracked counts of the three ranked reports and the highest
  depeg risk (symbol, score) — one aggregate over the tagged union of the three
  reports, no joins, one job.
* ``chart_*`` (D2-D6): top 20 in report order, re-sorted ascending by the
  charted value (bar order), with the hover columns.

Reports read back from CSV have no order, so every mart re-states it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import Order, ascending_by, top_k
from tidemark.operators.reports import (
    PROTOCOL_RISK_ORDER,
    STABLECOIN_RISK_ORDER,
    TOKEN_RISK_ORDER,
)
from tidemark.operators.trends import PROTOCOL_TREND_ORDER, TOKEN_TREND_ORDER

CHART_ROWS = 20

# Chart definitions (report order, charted value, label, hover columns).
CHARTS: dict[str, tuple[Order, str, str, list[str]]] = {
    "token_risk": (TOKEN_RISK_ORDER, "liquidity_risk_score", "symbol",
                   ["name", "market_cap", "total_volume", "volume_to_market_cap_ratio"]),
    "token_trends": (TOKEN_TREND_ORDER, "risk_score_change", "symbol_latest",
                     ["name_latest", "liquidity_risk_score_previous", "liquidity_risk_score_latest",
                      "market_cap_change_pct", "volume_change_pct"]),
    "protocol_risk": (PROTOCOL_RISK_ORDER, "protocol_risk_score", "name",
                      ["chain", "category", "tvl", "change_1d", "change_7d"]),
    "protocol_trends": (PROTOCOL_TREND_ORDER, "risk_score_change", "name_latest",
                        ["chain_latest", "category_latest", "protocol_risk_score_previous",
                         "protocol_risk_score_latest", "tvl_previous", "tvl_latest", "tvl_change_pct"]),
    "stablecoin_risk": (STABLECOIN_RISK_ORDER, "depeg_risk_score", "symbol",
                        ["name", "price", "absolute_depeg", "circulating_usd",
                         "supply_change_1d_pct", "supply_change_7d_pct"]),
}


def chart_table(report: DataFrame, chart: str, n: int = CHART_ROWS) -> DataFrame:
    """Top ``n`` rows of ``report`` in report order, in ascending bar order."""
    order, value, label, hover = CHARTS[chart]
    top = top_k(report, order, n)
    cols = [label, value] + [c for c in hover if c not in (label, value)]
    # The remaining order keys break ties in bar order.
    rest = [c for c, _ in order if c != value]
    return ascending_by(top, value, rest).select(*cols)


def kpi_row(token_risk: DataFrame, protocol_risk: DataFrame, stablecoin_risk: DataFrame) -> DataFrame:
    """D1 + O8: one row; the top stablecoin is the first row in report order
    (NULL when the report is empty)."""
    tagged = (token_risk.select(F.lit("token").alias("_r"))
              .unionByName(protocol_risk.select(F.lit("protocol").alias("_r")))
              .unionByName(stablecoin_risk.select(
                  F.lit("stablecoin").alias("_r"), "symbol", "depeg_risk_score", "circulating_usd",
                  *[c for c, _ in STABLECOIN_RISK_ORDER if c not in ("symbol", "depeg_risk_score", "circulating_usd")]),
                  allowMissingColumns=True))
    # Report order as one sortable struct: descending keys negated, and NULLs after all values.
    rank_key = F.struct(*[part for n, (c, d) in enumerate(STABLECOIN_RISK_ORDER) for part in (
        F.col(c).isNull().alias(f"none{n}"), (-F.col(c) if d == "desc" else F.col(c)).alias(f"key{n}"))])
    is_stable = F.col("_r") == "stablecoin"
    return tagged.agg(
        F.count_if(F.col("_r") == "token").cast("long").alias("tracked_tokens"),
        F.count_if(F.col("_r") == "protocol").cast("long").alias("tracked_protocols"),
        F.count_if(is_stable).cast("long").alias("tracked_stablecoins"),
        F.min_by(F.when(is_stable, F.struct("symbol", "depeg_risk_score")),
                 F.when(is_stable, rank_key)).alias("_top"),
    ).select("tracked_tokens", "tracked_protocols", "tracked_stablecoins",
             F.col("_top.symbol").alias("top_stablecoin_symbol"),
             F.col("_top.depeg_risk_score").alias("top_stablecoin_score"))
