"""Registered queries: name → Spark builder ``(spark, sf_dir) -> DataFrame``, with
the DuckDB statement that must return the same rows (``None`` when the result is
not expressible in SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import reports
from tidemark.operators.ranking import order_columns
from tidemark.plans import fixtures as fx
from tidemark.plans import oracle as sql
from tidemark.sources.landing import newest_run

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, fn, oracle, covers)
        return fn
    return deco


def latest_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fx_markets(spark, sf_dir, years=fx.newest_years(spark, sf_dir, "markets", 1))


def latest_protocols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fx_protocols(spark, sf_dir, years=fx.newest_years(spark, sf_dir, "protocols", 1))


def newest_two(spark: SparkSession, sf_dir: str, feed: str) -> tuple[DataFrame, DataFrame]:
    """The newest run and the one before it; raises where there are fewer than two."""
    build = fx.FEED_BUILDERS[feed]
    latest, previous = fx.newest_years(spark, sf_dir, feed, 2)
    return build(spark, sf_dir, years=[latest]), build(spark, sf_dir, years=[previous])


def latest_stablecoins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_run(fx.fx_stablecoins(spark, sf_dir))


def with_position(ranked: DataFrame, order: list) -> DataFrame:
    """Number the (few) rows of a ranked frame, so that their order is part of what is checked."""
    return ranked.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long"))


# --- ranked reports -----------------------------------------------------------

@register("token_liquidity_risk_top50", "R1 O1 P4 P5 P7 P8 E1 E2 E8 SC1",
          sql.with_adapters(sql.TOKEN_REPORT_ROWS + sql.numbered("token_report", sql.TOKEN_ORDER, 50)))
def q_token_liquidity_risk_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(reports.token_liquidity_risk(latest_markets(spark, sf_dir)), order_columns(reports.TOKEN_RISK_ORDER))


@register("defi_protocol_risk_top50", "R2 O2 P4 P7 P8 E3 E8 SC2",
          sql.with_adapters(sql.PROTOCOL_REPORT_ROWS + sql.numbered("protocol_report", sql.PROTOCOL_ORDER, 50)))
def q_defi_protocol_risk_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(reports.defi_protocol_risk(latest_protocols(spark, sf_dir)), order_columns(reports.PROTOCOL_RISK_ORDER))


@register("stablecoin_depeg_risk_top50", "R3 O3 P4 P5 P6 P7 P8 E4-E8 SC3",
          sql.with_adapters(sql.STABLE_REPORT_ROWS + sql.numbered("stable_report", sql.STABLE_ORDER, 50)))
def q_stablecoin_depeg_risk_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(reports.stablecoin_depeg_risk(latest_stablecoins(spark, sf_dir)), order_columns(reports.STABLECOIN_RISK_ORDER))


# --- helpers ------------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    from tidemark.session import scratch_path

    return scratch_path(spark, name)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")


# --- metrics (E1-E8) ------------------------------------------------------------

@register("ratio_volume_mcap", "E1",
          sql.with_adapters("select id, ingested_at_utc, case when market_cap > 0 then "
                            "total_volume / market_cap end as volume_to_market_cap_ratio from fx_markets"))
def q_ratio_volume_mcap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.token_metrics(fx.fx_markets(spark, sf_dir)).select(
        "id", "ingested_at_utc", "volume_to_market_cap_ratio")


@register("ratio_circulating", "E2",
          sql.with_adapters("select id, ingested_at_utc, case when circulating_supply > 0 and "
                            "total_supply > 0 then circulating_supply / total_supply end as circulating_supply_ratio "
                            "from fx_markets"))
def q_ratio_circulating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.token_metrics(fx.fx_markets(spark, sf_dir)).select(
        "id", "ingested_at_utc", "circulating_supply_ratio")


@register("ratio_tvl_mcap", "E3",
          sql.with_adapters("select name, ingested_at_utc, case when mcap > 0 then tvl / mcap end "
                            "as tvl_to_mcap_ratio from fx_protocols"))
def q_ratio_tvl_mcap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.protocol_metrics(fx.fx_protocols(spark, sf_dir)).select(
        "name", "ingested_at_utc", "tvl_to_mcap_ratio")


@register("peg_distance", "E4",
          sql.with_adapters("select name, abs(price - 1.0) as absolute_depeg from fx_stablecoins"))
def q_peg_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.stablecoin_metrics(fx.fx_stablecoins(spark, sf_dir)).select("name", "absolute_depeg")


@register("supply_changes", "E5 E6 E7",
          sql.with_adapters("m as (" + sql.STABLE_METRICS.format(src="fx_stablecoins") + ") "
                            "select name, supply_change_1d, supply_change_7d, "
                            "round(supply_change_1d * 100, 2) as supply_change_1d_pct, "
                            "round(supply_change_7d * 100, 2) as supply_change_7d_pct from m"))
def q_supply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.arith import round_half_away

    m = reports.stablecoin_metrics(fx.fx_stablecoins(spark, sf_dir))
    return m.select("name", "supply_change_1d", "supply_change_7d",
                    round_half_away(F.col("supply_change_1d") * 100, 2).alias("supply_change_1d_pct"),
                    round_half_away(F.col("supply_change_7d") * 100, 2).alias("supply_change_7d_pct"))


@register("rounding", "E8",
          sql.with_adapters("select name, ingested_at_utc, round(tvl, 2) as tvl_2, "
                            "round(change_1d / 7, 4) as change_1d_4, round(change_7d / 300000, 6) as change_7d_6, "
                            "round(mcap / 3, 2) as mcap_2, round(-change_1d / 1000, 2) as small_2 from fx_protocols"))
def q_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.arith import round_half_away as r

    p = fx.fx_protocols(spark, sf_dir)
    return p.select("name", "ingested_at_utc", r("tvl", 2).alias("tvl_2"),
                    r(F.col("change_1d") / 7, 4).alias("change_1d_4"),
                    r(F.col("change_7d") / 300000, 6).alias("change_7d_6"),
                    r(F.col("mcap") / 3, 2).alias("mcap_2"),
                    r(-F.col("change_1d") / 1000, 2).alias("small_2"))


# --- bands and scores (B1-B12, SC1-SC3) ---------------------------------------------

_BAND_QUERIES = {
    # query name: (card, band name, feed, key columns, SQL band, SQL metrics source)
    "band_volume_ratio": ("liquidity", "volume_ratio_points", "markets", ["id", "ingested_at_utc"], sql.B_VOLUME),
    "band_price_24h": ("liquidity", "price_24h_points", "markets", ["id", "ingested_at_utc"], sql.B_PRICE_24H),
    "band_price_7d": ("liquidity", "price_7d_points", "markets", ["id", "ingested_at_utc"], sql.B_PRICE_7D),
    "band_circulating": ("liquidity", "circulating_points", "markets", ["id", "ingested_at_utc"], sql.B_CIRC),
    "band_tvl": ("protocol", "tvl_points", "protocols", ["name", "ingested_at_utc"], sql.B_TVL),
    "band_tvl_1d": ("protocol", "tvl_1d_points", "protocols", ["name", "ingested_at_utc"], sql.B_TVL_1D),
    "band_tvl_7d": ("protocol", "tvl_7d_points", "protocols", ["name", "ingested_at_utc"], sql.B_TVL_7D),
    "band_audits": ("protocol", "audits_points", "protocols", ["name", "ingested_at_utc"], sql.B_AUDITS),
    "band_depeg": ("depeg", "depeg_points", "stablecoins", ["name"], sql.B_DEPEG),
    "band_supply_1d": ("depeg", "supply_1d_points", "stablecoins", ["name"], sql.B_SUPPLY_1D),
    "band_supply_7d": ("depeg", "supply_7d_points", "stablecoins", ["name"], sql.B_SUPPLY_7D),
    "band_chains": ("depeg", "chains_points", "stablecoins", ["name"], sql.B_CHAINS),
}
_BAND_IDS = {"band_volume_ratio": "B1", "band_price_24h": "B2", "band_price_7d": "B3", "band_circulating": "B4", "band_tvl": "B5", "band_tvl_1d": "B6", "band_tvl_7d": "B7", "band_audits": "B8", "band_depeg": "B9", "band_supply_1d": "B10", "band_supply_7d": "B11", "band_chains": "B12"}
_CARD_SPEC = {
    "liquidity": ("markets", reports.score_tokens, sql.TOKEN_METRICS, "fx_markets"),
    "protocol": ("protocols", reports.score_protocols, sql.PROTOCOL_METRICS, "fx_protocols"),
    "depeg": ("stablecoins", reports.score_stablecoins, sql.STABLE_METRICS, "fx_stablecoins"),
}


def _band_builder(card: str, band: str, keys: list[str]) -> Builder:
    feed, score, _, _ = _CARD_SPEC[card]

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return score(fx.FEED_BUILDERS[feed](spark, sf_dir), with_bands=True).select(*keys, band)
    build.__name__ = f"q_{band}"
    return build


for _name, (_card, _band, _feed, _keys, _sql_band) in _BAND_QUERIES.items():
    _metrics = _CARD_SPEC[_card][2].format(src=_CARD_SPEC[_card][3])
    register(_name, f"{_BAND_IDS[_name]} P4 ({_band})", sql.with_adapters(
        f"m as ({_metrics}) select {', '.join(_keys)}, {_sql_band} as {_band} from m"))(
        _band_builder(_card, _band, _keys))


def _score_builder(card: str, keys: list[str]) -> Builder:
    feed, score, _, _ = _CARD_SPEC[card]
    from tidemark.functions.scorecard import CARDS

    card_obj = {"liquidity": CARDS["liquidity_risk_score"], "protocol": CARDS["protocol_risk_score"],
                "depeg": CARDS["depeg_risk_score"]}[card]

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = score(fx.FEED_BUILDERS[feed](spark, sf_dir), with_bands=True)
        return scored.select(*keys, *[b.name for b in card_obj.bands], card_obj.name)
    return build


_SCORE_IDS = {"score_liquidity": "SC1 B1-B4", "score_protocol": "SC2 B5-B8", "score_depeg": "SC3 B9-B12"}

for _name, _card, _keys, _bands, _total, _score_sql in [
    ("score_liquidity", "liquidity", ["id", "ingested_at_utc"],
     [("volume_ratio_points", sql.B_VOLUME), ("price_24h_points", sql.B_PRICE_24H),
      ("price_7d_points", sql.B_PRICE_7D), ("circulating_points", sql.B_CIRC)],
     "liquidity_risk_score", sql.LIQUIDITY_SCORE),
    ("score_protocol", "protocol", ["name", "ingested_at_utc"],
     [("tvl_points", sql.B_TVL), ("tvl_1d_points", sql.B_TVL_1D), ("tvl_7d_points", sql.B_TVL_7D),
      ("audits_points", sql.B_AUDITS)],
     "protocol_risk_score", sql.PROTOCOL_SCORE),
    ("score_depeg", "depeg", ["name"],
     [("depeg_points", sql.B_DEPEG), ("supply_1d_points", sql.B_SUPPLY_1D),
      ("supply_7d_points", sql.B_SUPPLY_7D), ("chains_points", sql.B_CHAINS)],
     "depeg_risk_score", sql.DEPEG_SCORE),
]:
    _metrics = _CARD_SPEC[_card][2].format(src=_CARD_SPEC[_card][3])
    _band_sql = ", ".join(f"{s} as {n}" for n, s in _bands)
    register(_name, f"{_SCORE_IDS[_name]} ({_total} with bands)", sql.with_adapters(
        f"m as ({_metrics}) select {', '.join(_keys)}, {_band_sql}, {_score_sql} as {_total} from m"))(
        _score_builder(_card, _keys))


# --- filters (P6, P7) -------------------------------------------------------------

@register("filter_pegged_usd", "P6",
          sql.with_adapters("select name, pegType from fx_stablecoins where pegType = 'peggedUSD'"))
def q_filter_pegged_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pegged_usd_only(fx.fx_stablecoins(spark, sf_dir)).select("name", "pegType")


@register("filter_not_null", "P7",
          sql.with_adapters("select id, ingested_at_utc, market_cap from fx_markets "
                            "where market_cap is not null"))
def q_filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fx_markets(spark, sf_dir).where(F.col("market_cap").isNotNull()).select(
        "id", "ingested_at_utc", "market_cap")


# --- join and trends (J1, E9-E11, R4, R5) ---------------------------------------------

@register("join_snapshots_by_id", "J1",
          sql.with_adapters("""
pro_stamps as (select distinct ingested_at_utc as s from fx_protocols),
l as (select * from fx_protocols where ingested_at_utc = (select max(s) from pro_stamps)),
p as (select * from fx_protocols
      where ingested_at_utc = (select max(s) from pro_stamps where s < (select max(s) from pro_stamps)))
select l.id_text as id_text, l.name as name_latest, p.name as name_previous, l.tvl as tvl_latest, p.tvl as tvl_previous
from l join p on l.id_text = p.id_text"""))
def q_join_snapshots_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.trends import compare_snapshots

    latest, previous = newest_two(spark, sf_dir, "protocols")
    cols = ["id_text", "name", "tvl"]
    joined = compare_snapshots(latest.select(*cols), previous.select(*cols), "id_text")
    return joined.select("id_text", "name_latest", "name_previous", "tvl_latest", "tvl_previous")


_J1_BY_ID = REGISTRY["join_snapshots_by_id"].oracle


@register("join_stored_runs", "J1 S9 S12 (runs clustered by id, joined without a shuffle)", _J1_BY_ID)
def q_join_stored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.trends import compare_snapshots
    from tidemark.sources.clustered import clustered_runs, read_clustered, write_clustered

    root = _scratch(spark, "clustered-protocols")
    for year, run in zip(("latest", "previous"), newest_two(spark, sf_dir, "protocols")):
        write_clustered(run, root, "20240102T000000Z" if year == "latest" else "20240101T000000Z", "id_text", buckets=8)
    previous, latest = (read_clustered(spark, root, run).select("id_text", "name", "tvl") for run in clustered_runs(spark, root))
    return compare_snapshots(latest, previous, "id_text").select("id_text", "name_latest", "name_previous", "tvl_latest", "tvl_previous")


@register("field_drift", "P1 (fields outside the allow-list) Q1", sql.FIELD_DRIFT)
def q_field_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that the newest run of each feed has beside the allow-list, or gained or lost since the run before."""
    from tidemark import schemas as S
    from tidemark.operators.drift import feed_drift
    from tidemark.sources.landing import land_records

    out = None
    for feed, build in fx.RAW_BUILDERS.items():
        root = _scratch(spark, f"drift-{feed}")
        raw = build(spark, sf_dir)
        if feed == "stablecoins":  # one run only: the run before lacks the rows of a peg type and has a field more
            raw = raw.unionByName(raw.where(F.col("pegType") == "peggedUSD").withColumns(
                {S.STAMP: F.lit("20230101T000000Z"), "retired": F.lit("x")}), allowMissingColumns=True)
        # The source begins to send a field, in some records of the newest runs.
        raw = raw.withColumn("listing", F.when((F.col(S.STAMP) >= ("2024" if feed == "stablecoins" else "1998")) & F.col("name").endswith("7"), F.lit(7)))
        land_records(raw, root, *fx.ENDPOINTS[feed], F.col(S.STAMP))
        own = feed_drift(spark, root, feed).withColumn("feed", F.lit(feed))
        out = own if out is None else out.unionByName(own)
    return out.select("feed", "field", "change", "records")


@register("join_snapshots_null_safe", "J1 with rows without an id meeting each other",
          sql.with_adapters("""
pro_stamps as (select distinct ingested_at_utc as s from fx_protocols),
l as (select * from fx_protocols where ingested_at_utc = (select max(s) from pro_stamps)),
p as (select * from fx_protocols
      where ingested_at_utc = (select max(s) from pro_stamps where s < (select max(s) from pro_stamps)))
select l.id as id, l.name as name_latest, p.name as name_previous, l.tvl as tvl_latest, p.tvl as tvl_previous
from l join p on l.id is not distinct from p.id"""))
def q_join_snapshots_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.trends import compare_snapshots

    latest, previous = newest_two(spark, sf_dir, "protocols")
    cols = ["id", "name", "tvl"]
    return compare_snapshots(latest.select(*cols), previous.select(*cols), "id", nulls_meet=True).select(
        "id", "name_latest", "name_previous", "tvl_latest", "tvl_previous")


@register("token_liquidity_risk_trends", "R4 J1 E9 E10 P9 S10 S11",
          sql.with_adapters(sql.TOKEN_TRENDS + f" select {sql.TOKEN_TREND_SELECT} from token_trends"))
def q_token_liquidity_risk_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators import trends

    return trends.token_liquidity_risk_trends(*newest_two(spark, sf_dir, "markets"))


@register("defi_protocol_risk_trends", "R5 J1 E9 E11 P9 S10 S11",
          sql.with_adapters(sql.PROTOCOL_TRENDS + f" select {sql.PROTOCOL_TREND_SELECT} "
                            "from protocol_trends"))
def q_defi_protocol_risk_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators import trends

    return trends.defi_protocol_risk_trends(*newest_two(spark, sf_dir, "protocols"))


@register("trend_order", "O4 R4 R5", sql.TREND_ORDER)
def q_trend_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both trend reports as written: the place of every row in its report's order."""
    from tidemark.operators import trends
    from tidemark.operators.ranking import with_global_position

    out = None
    for name, order, score in (("token_liquidity_risk_trends", trends.TOKEN_TREND_ORDER, "liquidity_risk_score_latest"),
                               ("defi_protocol_risk_trends", trends.PROTOCOL_TREND_ORDER, "protocol_risk_score_latest")):
        placed = with_global_position(_report(spark, sf_dir, name), order_columns(order))
        own = placed.select(F.lit(name).alias("report"), "position", "name_latest", "risk_score_change", F.col(score).alias("score_latest"),
                            "ingested_at_utc_latest")
        out = own if out is None else out.unionByName(own)
    return out


@register("pct_change_unguarded", "E10",
          sql.with_adapters(sql.TOKEN_TRENDS + " select id, market_cap_change_pct, "
                            "volume_change_pct from token_trends"))
def q_pct_change_unguarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.arith import pct_change_ieee
    from tidemark.operators.trends import compare_snapshots

    latest, previous = newest_two(spark, sf_dir, "markets")
    cols = ["id", "market_cap", "total_volume"]
    t = compare_snapshots(latest.select(*cols), previous.select(*cols))
    return t.select("id",
                    pct_change_ieee("market_cap_latest", "market_cap_previous").alias("market_cap_change_pct"),
                    pct_change_ieee("total_volume_latest", "total_volume_previous").alias("volume_change_pct"))


@register("pct_change_guarded", "E11",
          sql.with_adapters(sql.PROTOCOL_TRENDS + " select name_latest, name_previous, "
                            "tvl_change_pct from protocol_trends"))
def q_pct_change_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.arith import guarded_pct_change
    from tidemark.operators.trends import compare_snapshots

    latest, previous = newest_two(spark, sf_dir, "protocols")
    cols = ["id_text", "name", "tvl"]
    t = compare_snapshots(latest.select(*cols), previous.select(*cols), "id_text")
    return t.select("name_latest", "name_previous",
                    guarded_pct_change("tvl_latest", "tvl_previous").alias("tvl_change_pct"))


# --- coercion (C1-C4, N1, N2) ----------------------------------------------------------

def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text of every shape the number coercion must handle, one per order."""
    o = _orders(spark, sf_dir)
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def s(x):
        return x.cast("string")

    shapes = [
        s(c), F.concat(F.lit(" "), s(c), F.lit(" ")), F.concat(s(c), F.lit("."), s(k % 100)),
        F.concat(s(c % 100), F.lit("e"), s(k % 5)), F.concat(F.lit("+"), s(c)), F.concat(F.lit("."), s(k % 1000)),
        F.concat(s(c), F.lit(".")), F.concat(s(c), F.lit("d")), F.col("o_orderpriority"), F.lit(""),
        F.lit("NaN"), F.when(c % 2 == 0, F.lit("inf")).otherwise(F.lit("-Infinity")),
        F.concat(F.lit("0x"), s(c % 100)), F.concat(F.lit("1_"), s(k % 1000)), F.concat(s(c), F.lit(",000")),
        F.concat(F.lit("-"), s(c), F.lit("."), s(k % 7), F.lit("E-2")),
    ]
    text = None
    for i, shape in enumerate(shapes):
        text = F.when(k % 16 == i, shape) if text is None else text.when(k % 16 == i, shape)
    return o.select("o_orderkey", text.alias("raw_text"))


@register("coerce_number", "C1", sql.COERCE_NUMBER)
def q_coerce_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.coerce import to_number

    return number_text(spark, sf_dir).withColumn("number", to_number("raw_text"))


@register("coerce_timestamp", "C2", sql.COERCE_TIMESTAMP)
def q_coerce_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.coerce import to_timestamp_loose

    o = _orders(spark, sf_dir)
    k = F.col("o_orderkey")
    text = (F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
            .when(k % 4 == 2, F.lit("not a date"))
            .otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T25:00:00Z"))))
    t = o.select("o_orderkey", text.alias("raw_text"))
    return t.select("o_orderkey", "raw_text",
                    F.date_format(to_timestamp_loose("raw_text"), "yyyy-MM-dd HH:mm:ss").alias("parsed_text"))


@register("stamp_partition_date", "C3 C4 S3",
          sql.with_adapters("select distinct ingested_at_utc, "
                            "strftime(strptime(ingested_at_utc, '%Y%m%dT%H%M%SZ'), '%Y-%m-%d') as ingestion_date, "
                            "strftime(strptime(ingested_at_utc, '%Y%m%dT%H%M%SZ'), '%Y%m%dT%H%M%SZ') as snapshot_ts "
                            "from fx_markets"))
def q_stamp_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.snapshots import with_snapshot_partitions

    return with_snapshot_partitions(fx.fx_markets(spark, sf_dir).select("ingested_at_utc").distinct())


@register("nested_pegged_usd", "N1",
          "select l_partkey as k, case when l_partkey % 5 in (0, 1) then sum(l_quantity) end as pegged_usd "
          "from lineitem group by l_partkey")
def q_nested_pegged_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.coerce import json_field_number

    base = fx.stablecoin_base(spark, sf_dir)
    k, q = F.col("k"), F.col("q").cast("string")
    text = (F.when(k % 5 == 0, F.concat(F.lit('{"peggedUSD": '), q, F.lit("}")))
            .when(k % 5 == 1, F.concat(F.lit('{"peggedUSD": "'), q, F.lit('"}')))
            .when(k % 5 == 2, F.concat(F.lit('{"peggedEUR": '), q, F.lit("}")))
            .when(k % 5 == 3, q)
            .otherwise(F.lit('{"peggedUSD": {"value": 1}}')))
    return base.select("k", json_field_number(F.parse_json(text), "peggedUSD").alias("pegged_usd"))


@register("nested_list_length", "N2",
          "select l_partkey as k, cast(case l_partkey % 4 when 0 then l_partkey % 6 when 1 then 0 end as int) "
          "as chain_count from lineitem group by l_partkey")
def q_nested_list_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.coerce import json_list_length

    base = fx.stablecoin_base(spark, sf_dir)
    k = F.col("k")
    text = (F.when(k % 4 == 0, F.to_json(F.array_repeat(F.lit("x"), (k % 6).cast("int"))))
            .when(k % 4 == 1, F.lit("[]"))
            .when(k % 4 == 2, F.lit('{"a": 1}'))
            .otherwise(F.lit('"[1, 2]"')))
    return base.select("k", json_list_length(F.parse_json(text)).cast("int").alias("chain_count"))


# --- landing and normalisation (S1-S7, P1-P3, R6-R8) ---------------------------------

def _land(spark: SparkSession, sf_dir: str, feed: str, root: str) -> None:
    from tidemark import schemas as S
    from tidemark.sources.landing import land_records

    source, endpoint = fx.ENDPOINTS[feed]
    land_records(fx.RAW_BUILDERS[feed](spark, sf_dir), root, source, endpoint, F.col(S.STAMP))


def _landing_root(spark: SparkSession, sf_dir: str, feed: str) -> str:
    root = _scratch(spark, f"landing-{feed}")
    _land(spark, sf_dir, feed, root)
    return root


def _landed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    from tidemark.sources.landing import read_landed

    return read_landed(spark, _landing_root(spark, sf_dir, feed), feed)


@register("normalize_markets", "R6 S1 P1 P2 C1 C2", sql.NORMALIZE_MARKETS)
def q_normalize_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.normalize import normalize_markets

    n = normalize_markets(_landed(spark, sf_dir, "markets"))
    return n.withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss"))


@register("normalize_protocols", "R7 S1 P1 P2 C1", sql.NORMALIZE_PROTOCOLS)
def q_normalize_protocols(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.normalize import normalize_protocols

    return normalize_protocols(_landed(spark, sf_dir, "protocols"))


@register("normalize_stablecoins", "R8 S1 P1-P3 N1 N2 C1", sql.NORMALIZE_STABLECOINS)
def q_normalize_stablecoins(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.normalize import normalize_stablecoins

    return normalize_stablecoins(_landed(spark, sf_dir, "stablecoins"))


# What numbers a feed's records within a run.
RECORD_NUMBERS = {"markets": ("id", 2), "protocols": ("name", 10), "stablecoins": ("name", 8)}


def _record_number(feed: str):
    name, start = RECORD_NUMBERS[feed]
    return F.substring(name, start, 20).cast("long")


def _all_feeds(read: Callable[[str], DataFrame]) -> DataFrame:
    """Every normalised row of the three feeds, with all columns, in one table."""
    from tidemark.operators.normalize import NORMALIZERS

    from tidemark.plans.job import together

    out = None
    frames = together([lambda f=feed: read(f) for feed in fx.RAW_BUILDERS])
    for feed, frame in zip(fx.RAW_BUILDERS, frames):
        rows = NORMALIZERS[feed](frame).withColumn("feed", F.lit(feed))
        if feed == "markets":
            rows = rows.withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss"))
        else:
            rows = rows.withColumnRenamed("id", "id_number")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


@register("normalize_paged", "S5 S6 S7 P3", sql.NORMALIZE_ALL)
def q_normalize_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three feeds landed in pages and read back record by record: whole rows."""
    from tidemark.sources.landing import PAGE_RECORDS, land_pages, read_pages

    def read(feed: str) -> DataFrame:
        root = _scratch(spark, f"pages-{feed}")
        page = F.floor(_record_number(feed) / PAGE_RECORDS)
        land_pages(fx.RAW_BUILDERS[feed](spark, sf_dir), root, feed, *fx.ENDPOINTS[feed], page, F.col("ingested_at_utc"))
        if feed == "stablecoins":  # a page that lacks its list
            spark.range(1).select(F.lit("defillama").alias("source"), F.struct(F.lit(1).alias("other")).alias("data")) \
                .write.mode("append").json(root)
        return read_pages(spark, root, feed)
    return _all_feeds(read)


@register("normalize_envelope", "S5 S6 S7 P3", sql.NORMALIZE_ALL)
def q_normalize_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three feeds landed as whole documents, one a run, and read back by many tasks: whole rows."""
    from tidemark.sources.documents import land_documents, read_documents

    def read(feed: str) -> DataFrame:
        root = _scratch(spark, f"documents-{feed}")
        land_documents(fx.RAW_BUILDERS[feed](spark, sf_dir), root, feed, *fx.ENDPOINTS[feed], _record_number(feed),
                       F.col("ingested_at_utc"), parts=4)
        return read_documents(spark, root, feed, in_parts=True)
    return _all_feeds(read)


@register("raw_manifest", "S1 S2 S3", sql.RAW_MANIFEST)
def q_raw_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.plans.job import together
    from tidemark.sources.landing import land_records, landed_runs

    feeds = ("markets", "protocols", "stablecoins")
    roots = together([lambda f=feed: _landing_root(spark, sf_dir, f) for feed in feeds])
    # One more run, without a record, and one landed twice.
    nothing = fx.markets_raw(spark, sf_dir).drop("ingested_at_utc").where("false")
    land_records(nothing, roots[0], *fx.ENDPOINTS["markets"], "20300101T000000Z")
    for _ in range(2):
        land_records(fx.stablecoins_raw(spark, sf_dir).drop("ingested_at_utc"), roots[2], *fx.ENDPOINTS["stablecoins"],
                     "20250101T000000Z")
    # Another source in the same root: two runs at once.
    copies = fx.markets_raw(spark, sf_dir).withColumn("ingested_at_utc", F.concat(F.substring("ingested_at_utc", 1, 4), F.lit("0615T120000Z")))
    land_records(copies, roots[0], "mirror", "copies", F.col("ingested_at_utc"))
    parts = [landed_runs(spark, root) for root in roots]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("latest_raw_selection", "S4", sql.LATEST_RAW_SELECTION)
def q_latest_raw_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.landing import read_newest_landed

    root = _landing_root(spark, sf_dir, "markets")
    return read_newest_landed(spark, root, "markets").select(
        "id", "symbol", "ingested_at_utc", "source", "endpoint")


# --- snapshot tables (S8-S12) ----------------------------------------------------------

@register("snapshot_write_read", "S8 S9 S12", sql.SNAPSHOT_WRITE_READ)
def q_snapshot_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources import snapshots

    markets = fx.fx_markets(spark, sf_dir)
    root = _scratch(spark, "snapshots-markets")
    snapshots.write_snapshots(markets, root)
    table = snapshots.read_snapshots(spark, root, markets.schema)
    return table.groupBy("ingestion_date", "snapshot_ts").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("market_cap_rank").cast("long").alias("rank_sum"))


@register("snapshot_newest_two", "S10 S11", sql.SNAPSHOT_NEWEST_TWO)
def q_snapshot_newest_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources import snapshots

    protocols = fx.fx_protocols(spark, sf_dir)
    root = _scratch(spark, "snapshots-protocols")
    snapshots.write_snapshots(protocols, root)
    newest = snapshots.newest_runs(spark, root, 2)
    snapshots.write_snapshots(protocols.where(F.col("ingested_at_utc") == newest[-1]), root)  # again: replaced
    both = snapshots.read_runs(spark, root, protocols.schema, newest)
    return both.groupBy("snapshot_ts").agg(
        F.count(F.lit(1)).alias("rows"), F.max("tvl").alias("tvl"), F.countDistinct("name").alias("names"))


# --- report files, quality, marts, job (S13-S15, Q1-Q4, D1-D7, L1) --------------------------

REPORT_NAMES = ["token_liquidity_risk_top50", "defi_protocol_risk_top50", "stablecoin_depeg_risk_top50",
                "token_liquidity_risk_trends", "defi_protocol_risk_trends"]


def _report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the five reports, built from the test-table feeds."""
    from tidemark.operators import trends

    if name == "token_liquidity_risk_top50":
        return reports.token_liquidity_risk(latest_markets(spark, sf_dir))
    if name == "defi_protocol_risk_top50":
        return reports.defi_protocol_risk(latest_protocols(spark, sf_dir))
    if name == "stablecoin_depeg_risk_top50":
        return reports.stablecoin_depeg_risk(latest_stablecoins(spark, sf_dir))
    if name == "token_liquidity_risk_trends":
        return trends.token_liquidity_risk_trends(*newest_two(spark, sf_dir, "markets"))
    if name == "defi_protocol_risk_trends":
        return trends.defi_protocol_risk_trends(*newest_two(spark, sf_dir, "protocols"))
    raise KeyError(name)


def _all_reports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: _report(spark, sf_dir, name) for name in REPORT_NAMES}


@register("report_preview", "S13 S14 S15 D7", sql.REPORT_PREVIEW)
def q_report_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.plans.job import REPORT_SCHEMAS
    from tidemark.sources import reports_io

    path = _scratch(spark, "report-token")
    name = "token_liquidity_risk_top50"
    report = reports.token_liquidity_risk(latest_markets(spark, sf_dir))
    reports_io.write_report(report, path, order=order_columns(reports.TOKEN_RISK_ORDER), single_file=True)
    back = reports_io.read_report(spark, path, REPORT_SCHEMAS[name])
    return reports_io.preview(back, reports.TOKEN_RISK_ORDER, 15)


@register("quality_checks", "Q1 Q2 Q3 Q4 A1 A2 A3", sql.QUALITY_CHECKS)
def q_quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators import quality
    from tidemark.sources import reports_io, snapshots

    from tidemark.plans.job import KEYS, together

    root = _scratch(spark, "quality")
    writes, tables = [], []
    for feed, frame in (("markets", latest_markets(spark, sf_dir)), ("protocols", latest_protocols(spark, sf_dir)),
                        ("stablecoins", latest_stablecoins(spark, sf_dir))):
        writes.append(lambda fr=frame, f=feed: snapshots.write_latest(fr, f"{root}/{f}"))
        tables.append(quality.TableTarget(feed, f"{root}/{feed}", KEYS[feed]))
    writes.append(lambda: snapshots.write_latest(fx.fx_markets(spark, sf_dir).limit(0), f"{root}/empty_table"))
    tables.append(quality.TableTarget("empty_table", f"{root}/empty_table"))

    score_cols = {"token_liquidity_risk_top50": "liquidity_risk_score",
                  "defi_protocol_risk_top50": "protocol_risk_score",
                  "stablecoin_depeg_risk_top50": "depeg_risk_score",
                  "token_liquidity_risk_trends": "risk_score_change",
                  "defi_protocol_risk_trends": "risk_score_change"}
    targets = []
    built = _all_reports(spark, sf_dir)
    for name, frame in built.items():
        writes.append(lambda fr=frame, n=name: reports_io.write_report(fr, f"{root}/{n}"))
        targets.append(quality.ReportTarget(name, f"{root}/{name}", score_cols[name]))
    token = built["token_liquidity_risk_top50"]
    writes.append(lambda: reports_io.write_report(token.drop("liquidity_risk_score"), f"{root}/no_score_column"))
    writes.append(lambda: reports_io.write_report(
        token.withColumn("liquidity_risk_score", F.lit(None).cast("int")),
        f"{root}/null_scores", order=order_columns(reports.TOKEN_RISK_ORDER)))
    together(writes)
    targets += [quality.ReportTarget("missing_report", f"{root}/never_written", "liquidity_risk_score"),
                quality.ReportTarget("no_score_column", f"{root}/no_score_column", "liquidity_risk_score"),
                quality.ReportTarget("null_scores", f"{root}/null_scores", "liquidity_risk_score")]
    return quality.quality_suite(spark, tables, targets).select("check", "target", "rows", "passed")


@register("dashboard_kpis", "D1 O8 A2", sql.DASHBOARD_KPIS)
def q_dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.marts import kpi_row

    return kpi_row(reports.token_liquidity_risk(latest_markets(spark, sf_dir)),
                   reports.defi_protocol_risk(latest_protocols(spark, sf_dir)),
                   reports.stablecoin_depeg_risk(latest_stablecoins(spark, sf_dir)))


def _chart_builder(chart: str, report: str) -> Builder:
    """The chart table with the place of every row in the order the mart gives."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tidemark.operators.marts import chart_table

        bars = chart_table(_report(spark, sf_dir, report), chart).withColumn("_at", F.monotonically_increasing_id())
        return with_position(bars, [F.col("_at")]).drop("_at")
    return build


for _chart, _report_name, _cover in [
    ("token_risk", "token_liquidity_risk_top50", "D2 O5 O7"),
    ("token_trends", "token_liquidity_risk_trends", "D3 O6 O7"),
    ("protocol_risk", "defi_protocol_risk_top50", "D4 O5 O7"),
    ("protocol_trends", "defi_protocol_risk_trends", "D5 O6 O7"),
    ("stablecoin_risk", "stablecoin_depeg_risk_top50", "D6 O5 O7"),
]:
    register(f"chart_{_chart}", _cover, sql.CHARTS[f"chart_{_chart}"])(_chart_builder(_chart, _report_name))


@register("batch_job", "L1 (all steps) O4 S8 S9 S13 Q1-Q4", sql.BATCH_JOB)
def q_batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.plans import job
    from tidemark.plans.job import Layout, land_fixture_feeds, run_job

    layout = Layout(_scratch(spark, "batch-job"))
    land_fixture_feeds(spark, sf_dir, layout)
    checks = run_job(spark, layout, runs="all").select("check", "target", "rows", "passed")
    contents = None
    for name, (*_, score) in job.RANKED.items():
        own = _contents(spark, layout, name, score, "name")
        contents = own if contents is None else contents.unionByName(own)
    for name in job.TRENDS:
        contents = contents.unionByName(_contents(spark, layout, name, "risk_score_change", "name_latest"))
    return checks.join(contents, "target", "left").select("check", "target", "rows", "passed", "score_sum", "names")


def _contents(spark: SparkSession, layout, name: str, score: str, label: str) -> DataFrame:
    """What a written report holds: the sum of its scores and its distinct names."""
    from tidemark.plans.job import read_report

    return read_report(spark, layout, name).agg(
        F.lit(name).alias("target"), F.sum(score).cast("long").alias("score_sum"), F.countDistinct(label).alias("names"))


@register("stream_normalize_protocols", "R7 via Structured Streaming (AvailableNow)", sql.NORMALIZE_PROTOCOLS)
def q_stream_normalize_protocols(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark import schemas as S
    from tidemark.streaming.incremental import catch_up

    root = _scratch(spark, "stream-protocols")
    for _ in range(2):  # the second time all runs are landed again
        _land(spark, sf_dir, "protocols", f"{root}/raw")
        catch_up(spark, f"{root}/raw", f"{root}/snapshots", f"{root}/checkpoint", "protocols")
    table = spark.read.schema(S.snapshot_schema(S.PROTOCOLS)).parquet(f"{root}/snapshots")
    return table.drop(*S.SNAPSHOT_PARTITIONS)
