"""Declarative threshold scorecards.

A ``Band`` turns one metric into points with a first-match list of rules; a NULL
metric falls through to 0 unless a rule names NULL explicitly. A ``ScoreCard``
sums its bands into one INT column. Bands read the *unrounded* metrics; rounding
belongs to the report projection.

The three cards are data, shared by the ranked and the trend reports.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``op`` is one of ``null``, ``<``, ``<=``, ``>=``, ``=``, ``null_or_<=``."""

    op: str
    bound: float | None
    points: int

    def sql_predicate(self, x: str) -> str:
        b = repr(self.bound)
        if self.op == "null":
            return f"{x} is null"
        if self.op == "null_or_<=":
            return f"({x} is null or {x} <= {b})"
        return f"{x} {self.op} {b}"

    def predicate(self, x: Column) -> Column:
        b = F.lit(self.bound) if self.bound is not None else None
        if self.op == "null":
            return x.isNull()
        if self.op == "<":
            return x < b
        if self.op == "<=":
            return x <= b
        if self.op == ">=":
            return x >= b
        if self.op == "=":
            return x == b
        if self.op == "null_or_<=":
            return x.isNull() | (x <= b)
        raise ValueError(f"unknown rule op {self.op!r}")


@dataclass(frozen=True)
class Band:
    name: str
    metric: str
    rules: tuple[Rule, ...]

    def column(self) -> Column:
        x = F.col(self.metric)
        expr = None
        for rule in self.rules:
            cond = rule.predicate(x)
            expr = F.when(cond, F.lit(rule.points)) if expr is None else expr.when(cond, F.lit(rule.points))
        return expr.otherwise(F.lit(0))

    def max_points(self) -> int:
        return max(r.points for r in self.rules)

    def sql(self) -> str:
        """The band as a SQL CASE expression (Spark SQL and DuckDB)."""
        whens = " ".join(f"when {r.sql_predicate(self.metric)} then {r.points}" for r in self.rules)
        return f"case {whens} else 0 end"


@dataclass(frozen=True)
class ScoreCard:
    name: str
    bands: tuple[Band, ...]

    def column(self) -> Column:
        total = None
        for band in self.bands:
            total = band.column() if total is None else total + band.column()
        return total

    def apply(self, df: DataFrame, with_bands: bool = False) -> DataFrame:
        cols = {self.name: self.column()}
        if with_bands:
            cols = {**{b.name: b.column() for b in self.bands}, **cols}
        return df.withColumns(cols)

    def sql(self) -> str:
        """The composite score as a SQL expression."""
        return " + ".join(f"({b.sql()})" for b in self.bands)

    def band(self, name: str) -> Band:
        for b in self.bands:
            if b.name == name:
                return b
        raise KeyError(name)

    def max_score(self) -> int:
        return sum(b.max_points() for b in self.bands)


def _r(op: str, bound: float | None, points: int) -> Rule:
    return Rule(op, None if bound is None else float(bound), points)


# ---------------------------------------------------------------------------
# Band thresholds and points, in rule order. They define the
# published scores and must not change.
# ---------------------------------------------------------------------------
# Token liquidity (0-75)
VOLUME_RATIO_BAND = Band("volume_ratio_points", "volume_to_market_cap_ratio", (
    _r("null", None, 25), _r("<", 0.01, 25), _r("<", 0.03, 15), _r("<", 0.05, 8)))
PRICE_24H_BAND = Band("price_24h_points", "price_change_percentage_24h", (
    _r("<=", -10, 20), _r("<=", -5, 10)))
PRICE_7D_BAND = Band("price_7d_points", "price_change_percentage_7d_in_currency", (
    _r("<=", -20, 20), _r("<=", -10, 10)))
CIRCULATING_BAND = Band("circulating_points", "circulating_supply_ratio", (
    _r("null", None, 10), _r("<", 0.25, 10)))

# Protocol health (0-85)
TVL_BAND = Band("tvl_points", "tvl", (
    _r("null_or_<=", 0, 25), _r("<", 1_000_000, 20), _r("<", 10_000_000, 10)))
TVL_1D_BAND = Band("tvl_1d_points", "change_1d", (
    _r("<=", -20, 25), _r("<=", -10, 15), _r("<=", -5, 8)))
TVL_7D_BAND = Band("tvl_7d_points", "change_7d", (
    _r("<=", -40, 25), _r("<=", -20, 15), _r("<=", -10, 8)))
AUDITS_BAND = Band("audits_points", "audits", (
    _r("null", None, 10), _r("=", 0, 10)))

# Stablecoin peg (0-85); the peg-distance band reads the price for its NULL rule.
DEPEG_BAND = Band("depeg_points", "absolute_depeg", (
    _r(">=", 0.05, 40), _r(">=", 0.02, 25), _r(">=", 0.01, 15), _r(">=", 0.005, 8)))
SUPPLY_1D_BAND = Band("supply_1d_points", "supply_change_1d", (
    _r("<=", -0.20, 20), _r("<=", -0.10, 12), _r("<=", -0.05, 6)))
SUPPLY_7D_BAND = Band("supply_7d_points", "supply_change_7d", (
    _r("<=", -0.40, 20), _r("<=", -0.20, 12), _r("<=", -0.10, 6)))
CHAINS_BAND = Band("chains_points", "chain_count", (
    _r("null", None, 5), _r("=", 1, 5)))
MISSING_PRICE_POINTS = 30
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PriceGuardedBand(Band):
    """A band whose first rule is "price is NULL → fixed points"."""

    guard: str = "price"
    guard_points: int = 0

    def column(self) -> Column:
        return F.when(F.col(self.guard).isNull(), F.lit(self.guard_points)).otherwise(super().column())

    def max_points(self) -> int:
        return max(super().max_points(), self.guard_points)

    def sql(self) -> str:
        return f"case when {self.guard} is null then {self.guard_points} else {super().sql()} end"


DEPEG_GUARDED_BAND = PriceGuardedBand(
    DEPEG_BAND.name, DEPEG_BAND.metric, DEPEG_BAND.rules, "price", MISSING_PRICE_POINTS)

LIQUIDITY_CARD = ScoreCard("liquidity_risk_score", (
    VOLUME_RATIO_BAND, PRICE_24H_BAND, PRICE_7D_BAND, CIRCULATING_BAND))
PROTOCOL_CARD = ScoreCard("protocol_risk_score", (
    TVL_BAND, TVL_1D_BAND, TVL_7D_BAND, AUDITS_BAND))
DEPEG_CARD = ScoreCard("depeg_risk_score", (
    DEPEG_GUARDED_BAND, SUPPLY_1D_BAND, SUPPLY_7D_BAND, CHAINS_BAND))

CARDS = {c.name: c for c in (LIQUIDITY_CARD, PROTOCOL_CARD, DEPEG_CARD)}


def _params(band: Band) -> list[str]:
    guard = getattr(band, "guard", None)
    return ([guard] if guard else []) + [band.metric]


def register_sql_functions(spark) -> list[str]:
    """Register every band and the three scores as temporary SQL functions, e.g.
    ``tvl_points(tvl)`` or ``protocol_risk_score(tvl, change_1d, change_7d, audits)``.

    They are SQL-bodied functions: the analyzer inlines them as the same CASE
    expressions the DataFrame API builds (no Python at run time)."""
    names = []
    bands = {b.name: b for card in CARDS.values() for b in card.bands}
    for band in bands.values():
        params = ", ".join(f"{p} DOUBLE" for p in _params(band))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {band.name}({params}) RETURNS INT RETURN {band.sql()}")
        names.append(band.name)
    for card in CARDS.values():
        ordered = list(dict.fromkeys(p for b in card.bands for p in _params(b)))
        params = ", ".join(f"{p} DOUBLE" for p in ordered)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {card.name}({params}) RETURNS INT RETURN {card.sql()}")
        names.append(card.name)
    return names
