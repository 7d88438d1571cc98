"""Column expressions: coercion, guarded arithmetic, rounding, scorecards."""

from tidemark.functions.arith import (
    abs_distance,
    both_positive_ratio,
    change_fraction,
    guarded_pct_change,
    pct_change_ieee,
    round_half_away,
    safe_ratio,
)
from tidemark.functions.coerce import (
    format_stamp,
    json_field_number,
    json_list_length,
    parse_stamp,
    stamp_date,
    to_number,
    to_timestamp_loose,
    to_whole_number,
)
from tidemark.functions.scorecard import (
    DEPEG_CARD,
    LIQUIDITY_CARD,
    PROTOCOL_CARD,
    Band,
    Rule,
    ScoreCard,
)

__all__ = [
    "abs_distance", "both_positive_ratio", "change_fraction", "guarded_pct_change",
    "pct_change_ieee", "round_half_away", "safe_ratio", "format_stamp",
    "json_field_number", "json_list_length", "parse_stamp", "stamp_date", "to_number",
    "to_timestamp_loose", "to_whole_number", "DEPEG_CARD", "LIQUIDITY_CARD",
    "PROTOCOL_CARD", "Band", "Rule", "ScoreCard",
]
