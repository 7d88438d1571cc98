"""Snapshot comparison: how risk moved between the two newest runs.

Each run is scored on its own, the two are joined on the record's id (rows without
one match nothing, duplicate ids multiply), overlapping columns get ``_latest`` /
``_previous`` suffixes, then score delta and percent changes are derived. The
result has no limit and no filter; it is returned unordered and sorted only at
the sink (``TOKEN_TREND_ORDER`` / ``PROTOCOL_TREND_ORDER``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.arith import guarded_pct_change, pct_change_ieee, round_half_away
from tidemark.operators.joins import keyed_join
from tidemark.operators.normalize import id_text
from tidemark.operators.ranking import report_order
from tidemark.functions.scorecard import PROTOCOL_CARD
from tidemark.operators.reports import score_tokens
from tidemark.sources.snapshots import newest_two_in_plan

SUFFIXES = ("_latest", "_previous")

# Output columns of the two trend reports, in order.
TOKEN_TREND_COLUMNS = [
    "symbol_latest", "name_latest", "liquidity_risk_score_previous", "liquidity_risk_score_latest",
    "risk_score_change", "market_cap_change_pct", "volume_change_pct",
    "volume_to_market_cap_ratio_previous", "volume_to_market_cap_ratio_latest",
    "ingested_at_utc_previous", "ingested_at_utc_latest",
]
PROTOCOL_TREND_COLUMNS = [
    "name_latest", "symbol_latest", "chain_latest", "category_latest",
    "protocol_risk_score_previous", "protocol_risk_score_latest", "risk_score_change",
    "tvl_previous", "tvl_latest", "tvl_change_pct", "change_1d_latest", "change_7d_latest",
    "audits_latest", "ingested_at_utc_previous", "ingested_at_utc_latest",
]
# End of fixed values.
TOKEN_TREND_ORDER = report_order(
    ["risk_score_change", "liquidity_risk_score_latest"],
    [c for c in TOKEN_TREND_COLUMNS if c not in ("risk_score_change", "liquidity_risk_score_latest")])
PROTOCOL_TREND_ORDER = report_order(
    ["risk_score_change", "protocol_risk_score_latest"],
    [c for c in PROTOCOL_TREND_COLUMNS if c not in ("risk_score_change", "protocol_risk_score_latest")])


def score_token_snapshot(markets: DataFrame) -> DataFrame:
    """One run scored; the ratio is rounded here, the score used the raw ratio."""
    return score_tokens(markets).select(
        "id", "symbol", "name", "market_cap", "total_volume",
        round_half_away("volume_to_market_cap_ratio", 4).alias("volume_to_market_cap_ratio"),
        "liquidity_risk_score", S.STAMP)


def score_protocol_snapshot(protocols: DataFrame) -> DataFrame:
    """One run scored; needs only the card's inputs (no market cap)."""
    return PROTOCOL_CARD.apply(protocols).select(
        (F.col(S.ID_TEXT) if S.ID_TEXT in protocols.columns else id_text(protocols)).alias(S.ID_TEXT), "name", "symbol", "chain", "category", "tvl", "change_1d", "change_7d", "audits",
        "protocol_risk_score", S.STAMP)


def compare_snapshots(latest: DataFrame, previous: DataFrame, key: str = "id",
                      suffixes: tuple[str, str] = SUFFIXES, nulls_meet: bool = False) -> DataFrame:
    """Join two runs on ``key``; columns present in both get the suffixes. ``nulls_meet``: see ``keyed_join``."""
    overlap = (set(latest.columns) & set(previous.columns)) - {key}
    l = latest.select(*[F.col(c).alias(c + suffixes[0]) if c in overlap else F.col(c) for c in latest.columns])
    p = previous.select(*[F.col(c).alias(c + suffixes[1]) if c in overlap else F.col(c) for c in previous.columns])
    return keyed_join(l, p, key, nulls_meet)


def token_liquidity_risk_trends(latest: DataFrame, previous: DataFrame) -> DataFrame:
    """R4 from two market runs (raw normalised rows)."""
    t = compare_snapshots(score_token_snapshot(latest), score_token_snapshot(previous))
    t = t.withColumns({
        "risk_score_change": F.col("liquidity_risk_score_latest") - F.col("liquidity_risk_score_previous"),
        "market_cap_change_pct": pct_change_ieee("market_cap_latest", "market_cap_previous"),
        "volume_change_pct": pct_change_ieee("total_volume_latest", "total_volume_previous"),
    })
    return t.select(*TOKEN_TREND_COLUMNS)


def defi_protocol_risk_trends(latest: DataFrame, previous: DataFrame) -> DataFrame:
    """R5 from two protocol runs."""
    t = compare_snapshots(score_protocol_snapshot(latest), score_protocol_snapshot(previous), S.ID_TEXT)
    t = t.withColumns({
        "risk_score_change": F.col("protocol_risk_score_latest") - F.col("protocol_risk_score_previous"),
        "tvl_change_pct": guarded_pct_change("tvl_latest", "tvl_previous"),
    })
    return t.select(*PROTOCOL_TREND_COLUMNS)


def trends_from_history(history: DataFrame, report, stamp: str = S.STAMP) -> DataFrame:
    """Apply ``report`` to the two newest runs found in ``history`` (chosen in-plan); running it
    fails where there are fewer than two."""
    latest, previous = newest_two_in_plan(history, stamp)
    return report(latest, previous)
