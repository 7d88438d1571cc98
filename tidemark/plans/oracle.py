"""DuckDB SQL for verification: each registered query restated in plain SQL over
the same test tables. Rounding is spelled ``round`` (DuckDB's binary rounding,
which ``round_half_away`` reproduces); percent changes spell out IEEE results.
"""

from __future__ import annotations


def _nulls_last(order: str) -> str:
    """Add ``nulls last`` to each key of an order list."""
    return ", ".join(f"{key.strip()} nulls last" for key in order.split(","))


FX_MARKETS = """
select concat('c', k) as id, concat('s', k % 500) as symbol, concat('Token ', k) as name,
  mn / 100 as current_price,
  case when k % 13 = 0 then null when (k + y) % 17 = 0 then 0.0 else mx end as market_cap,
  case when k % 50 = 0 then null else cast(k as bigint) end as market_cap_rank,
  mn * (k % 12) / 100 as total_volume,
  cast((k * 7 + y * 3) % 41 - 25 as double) + 0.25 as price_change_percentage_24h,
  cast((k * 5 + y * 11) % 61 - 40 as double) + 0.5 as price_change_percentage_7d_in_currency,
  case when k % 9 = 0 then null else cast(k % 10 as double) end as circulating_supply,
  cast(10 + k % 7 as double) as total_supply,
  mx / 100 as high_24h, mn / 200 as low_24h, cast(k % 7 - 3 as double) + 0.5 as price_change_percentage_1h_in_currency,
  case when k % 3 = 0 then null else cast(k % 50 as double) end as max_supply, mx as ath,
  -cast(k % 90 as double) as ath_change_percentage, mn / 1000 as atl,
  concat(y, '0101T000000Z') as ingested_at_utc,
  k
from (select o_custkey as k, year(o_orderdate) as y, max(o_totalprice) as mx, min(o_totalprice) as mn
      from orders group by o_custkey, year(o_orderdate)) b
"""

FX_PROTOCOLS = """
select case when k % 97 = 0 then null else cast(k as double) end as id,
  concat('Protocol ', k) as name, case when k % 6 = 0 then '-' else concat('p', k) end as symbol,
  concat('chain', k % 5) as chain, concat('cat', k % 8) as category,
  case when k % 19 = 0 then null when (k + y) % 23 = 0 then 0.0
       else mx * (case k % 4 when 0 then 1 when 1 then 10 when 2 then 100 else 1000 end) end as tvl,
  cast((k * 11 + y * 5) % 61 - 35 as double) + 0.25 as change_1d,
  cast((k * 3 + y * 13) % 101 - 60 as double) + 0.5 as change_7d,
  case when k % 7 = 0 then null when k % 29 = 0 then 0.0 else q * 10000 end as mcap,
  case when k % 5 = 0 then null else cast(k % 3 as double) end as audits,
  concat('https://p', k, '.example.com') as url,
  cast(k % 9 - 4 as double) + 0.25 as change_1h,
  case when k % 6 = 0 then null else 9007199254740993 + k end as listedAt, cast(k % 1000 as double) as cmcId,
  concat('g', k) as gecko_id, case when k % 2 = 1 then concat('@p', k) end as twitter, concat('m', k % 3) as module,
  concat(y, '0101T000000Z') as ingested_at_utc,
  case when k % 97 = 0 then concat('parent#', k) else concat(k, '.0') end as id_text,
  k
from (select l_partkey as k, year(l_shipdate) as y, max(l_extendedprice) as mx, max(l_quantity) as q
      from lineitem group by l_partkey, year(l_shipdate)) b
"""

FX_STABLECOINS = """
select cast(k as double) as id, concat('Stable ', k) as name, concat('st', k) as symbol,
  case when k % 10 = 9 then 'peggedEUR' else 'peggedUSD' end as pegType,
  case when k % 3 = 0 then 'fiat-backed' else 'crypto-backed' end as pegMechanism,
  case when k % 11 = 0 then null else 1 + ((k * 37) % 401 - 200) / cast(2500 as double) end as price,
  case when k % 31 = 0 then null else q end as circulating_usd,
  case when k % 37 = 0 then 0.0 else q * (1 + cast(k % 40 - 10 as double) / 100) end as circulatingPrevDay_usd,
  q * (1 + cast(k % 100 - 20 as double) / 100) as circulatingPrevWeek_usd,
  case when k % 8 = 0 then null else cast(k % 5 as int) end as chain_count,
  case when k % 4 <> 0 then concat('sg', k) end as gecko_id,
  '20240101T000000Z' as ingested_at_utc,
  k
from (select l_partkey as k, sum(l_quantity) as q from lineitem group by l_partkey) b
"""

ADAPTERS = f"""
fx_markets as ({FX_MARKETS}),
fx_protocols as ({FX_PROTOCOLS}),
fx_stablecoins as ({FX_STABLECOINS}),
latest_markets as (select * from fx_markets where ingested_at_utc = (select max(ingested_at_utc) from fx_markets)),
latest_protocols as (select * from fx_protocols where ingested_at_utc = (select max(ingested_at_utc) from fx_protocols)),
latest_stablecoins as (select * from fx_stablecoins where ingested_at_utc = (select max(ingested_at_utc) from fx_stablecoins))
"""

# --- metrics, bands and scores ----------------------------------------------

TOKEN_METRICS = """
select *,
  case when market_cap > 0 then total_volume / market_cap else null end as volume_to_market_cap_ratio,
  case when circulating_supply > 0 and total_supply > 0 then circulating_supply / total_supply else null end
    as circulating_supply_ratio
from {src}
"""

# Thresholds and points of the bands, and the report orders below, stated here
# anew so that a wrong one in the library shows.
B_VOLUME = """case when volume_to_market_cap_ratio is null then 25 when volume_to_market_cap_ratio < 0.01 then 25
  when volume_to_market_cap_ratio < 0.03 then 15 when volume_to_market_cap_ratio < 0.05 then 8 else 0 end"""
B_PRICE_24H = "case when price_change_percentage_24h <= -10 then 20 when price_change_percentage_24h <= -5 then 10 else 0 end"
B_PRICE_7D = """case when price_change_percentage_7d_in_currency <= -20 then 20
  when price_change_percentage_7d_in_currency <= -10 then 10 else 0 end"""
B_CIRC = "case when circulating_supply_ratio is null then 10 when circulating_supply_ratio < 0.25 then 10 else 0 end"
LIQUIDITY_SCORE = f"({B_VOLUME}) + ({B_PRICE_24H}) + ({B_PRICE_7D}) + ({B_CIRC})"

PROTOCOL_METRICS = """
select *, case when mcap > 0 then tvl / mcap else null end as tvl_to_mcap_ratio from {src}
"""
B_TVL = "case when tvl is null or tvl <= 0 then 25 when tvl < 1000000 then 20 when tvl < 10000000 then 10 else 0 end"
B_TVL_1D = "case when change_1d <= -20 then 25 when change_1d <= -10 then 15 when change_1d <= -5 then 8 else 0 end"
B_TVL_7D = "case when change_7d <= -40 then 25 when change_7d <= -20 then 15 when change_7d <= -10 then 8 else 0 end"
B_AUDITS = "case when audits is null then 10 when audits = 0 then 10 else 0 end"
PROTOCOL_SCORE = f"({B_TVL}) + ({B_TVL_1D}) + ({B_TVL_7D}) + ({B_AUDITS})"

STABLE_METRICS = """
select *, abs(price - 1.0) as absolute_depeg,
  case when circulatingPrevDay_usd > 0 then (circulating_usd - circulatingPrevDay_usd) / circulatingPrevDay_usd
       else null end as supply_change_1d,
  case when circulatingPrevWeek_usd > 0 then (circulating_usd - circulatingPrevWeek_usd) / circulatingPrevWeek_usd
       else null end as supply_change_7d
from {src}
"""
B_DEPEG = """case when price is null then 30 when absolute_depeg >= cast(0.05 as double) then 40
  when absolute_depeg >= cast(0.02 as double) then 25 when absolute_depeg >= cast(0.01 as double) then 15
  when absolute_depeg >= cast(0.005 as double) then 8 else 0 end"""
B_SUPPLY_1D = """case when supply_change_1d <= cast(-0.2 as double) then 20 when supply_change_1d <= cast(-0.1 as double) then 12
  when supply_change_1d <= cast(-0.05 as double) then 6 else 0 end"""
B_SUPPLY_7D = """case when supply_change_7d <= cast(-0.4 as double) then 20 when supply_change_7d <= cast(-0.2 as double) then 12
  when supply_change_7d <= cast(-0.1 as double) then 6 else 0 end"""
B_CHAINS = "case when chain_count is null then 5 when chain_count = 1 then 5 else 0 end"
DEPEG_SCORE = f"({B_DEPEG}) + ({B_SUPPLY_1D}) + ({B_SUPPLY_7D}) + ({B_CHAINS})"


def _join(ctes: str, body: str) -> str:
    """Append ``body`` (more CTEs, or the final select) to a CTE list."""
    body = body.strip()
    return f"{ctes} {body}" if body.lower().startswith("select") else f"{ctes}, {body}"


def with_adapters(body: str) -> str:
    return "with " + _join(ADAPTERS, body)


# --- ranked reports ----------------------------------------------------------

TOKEN_REPORT_ROWS = """
token_scored as (select *, {score} as liquidity_risk_score from ({metrics}) m),
token_report as (
  select market_cap_rank, id, symbol, name, current_price, market_cap, total_volume,
    round(volume_to_market_cap_ratio, 4) as volume_to_market_cap_ratio,
    round(price_change_percentage_24h, 2) as price_change_percentage_24h,
    round(price_change_percentage_7d_in_currency, 2) as price_change_percentage_7d,
    round(circulating_supply_ratio, 4) as circulating_supply_ratio,
    liquidity_risk_score
  from token_scored where market_cap is not null)
""".format(score=LIQUIDITY_SCORE, metrics=TOKEN_METRICS.format(src="latest_markets"))
TOKEN_ORDER = _nulls_last("""liquidity_risk_score desc, market_cap desc, id, market_cap_rank, symbol, name, current_price,
  total_volume, volume_to_market_cap_ratio, price_change_percentage_24h, price_change_percentage_7d, circulating_supply_ratio""")

PROTOCOL_REPORT_ROWS = """
protocol_scored as (select *, {score} as protocol_risk_score from ({metrics}) m),
protocol_report as (
  select name, symbol, chain, category, round(tvl, 2) as tvl, round(change_1d, 2) as change_1d,
    round(change_7d, 2) as change_7d, audits, round(tvl_to_mcap_ratio, 4) as tvl_to_mcap_ratio,
    protocol_risk_score, url
  from protocol_scored where tvl is not null)
""".format(score=PROTOCOL_SCORE, metrics=PROTOCOL_METRICS.format(src="latest_protocols"))
PROTOCOL_ORDER = _nulls_last("""protocol_risk_score desc, tvl desc, name, symbol, chain, category, change_1d, change_7d,
  audits, tvl_to_mcap_ratio, url""")

STABLE_REPORT_ROWS = """
stable_scored as (select *, {score} as depeg_risk_score
                  from ({metrics}) m),
stable_report as (
  select name, symbol, pegMechanism, price, round(absolute_depeg, 6) as absolute_depeg,
    round(circulating_usd, 2) as circulating_usd,
    round(supply_change_1d * 100, 2) as supply_change_1d_pct,
    round(supply_change_7d * 100, 2) as supply_change_7d_pct,
    chain_count, depeg_risk_score
  from stable_scored where circulating_usd is not null)
""".format(score=DEPEG_SCORE,
           metrics=STABLE_METRICS.format(src="(select * from latest_stablecoins where pegType = 'peggedUSD')"))
STABLE_ORDER = _nulls_last("""depeg_risk_score desc, circulating_usd desc, name, symbol, pegMechanism, price, absolute_depeg,
  supply_change_1d_pct, supply_change_7d_pct, chain_count""")


# --- trends ------------------------------------------------------------------

def pct_ieee(l: str, p: str) -> str:
    return (f"case when {p} = 0 then (case when {l} > 0 then cast('inf' as double) "
            f"when {l} < 0 then cast('-inf' as double) end) else ({l} - {p}) / {p} * 100 end")


def pct_guarded(l: str, p: str) -> str:
    return f"case when {p} > 0 then ({l} - {p}) / {p} * 100 end"


TOKEN_TRENDS = """
tok_scored as (
  select id, symbol, name, market_cap, total_volume,
    round(volume_to_market_cap_ratio, 4) as volume_to_market_cap_ratio,
    {score} as liquidity_risk_score, ingested_at_utc
  from ({metrics}) m),
tok_stamps as (select distinct ingested_at_utc as s from fx_markets),
tok_l as (select * from tok_scored where ingested_at_utc = (select max(s) from tok_stamps)),
tok_p as (select * from tok_scored
          where ingested_at_utc = (select max(s) from tok_stamps where s < (select max(s) from tok_stamps))),
token_trends as (
  select l.symbol as symbol_latest, l.name as name_latest,
    p.liquidity_risk_score as liquidity_risk_score_previous,
    l.liquidity_risk_score as liquidity_risk_score_latest,
    l.liquidity_risk_score - p.liquidity_risk_score as risk_score_change,
    {mcap} as market_cap_change_pct,
    {vol} as volume_change_pct,
    p.volume_to_market_cap_ratio as volume_to_market_cap_ratio_previous,
    l.volume_to_market_cap_ratio as volume_to_market_cap_ratio_latest,
    p.ingested_at_utc as ingested_at_utc_previous, l.ingested_at_utc as ingested_at_utc_latest,
    l.id as id
  from tok_l l join tok_p p on l.id = p.id)
""".format(score=LIQUIDITY_SCORE, metrics=TOKEN_METRICS.format(src="fx_markets"),
           mcap=pct_ieee("l.market_cap", "p.market_cap"), vol=pct_ieee("l.total_volume", "p.total_volume"))
TOKEN_TREND_SELECT = """symbol_latest, name_latest, liquidity_risk_score_previous, liquidity_risk_score_latest,
  risk_score_change, market_cap_change_pct, volume_change_pct, volume_to_market_cap_ratio_previous,
  volume_to_market_cap_ratio_latest, ingested_at_utc_previous, ingested_at_utc_latest"""
TOKEN_TREND_ORDER = _nulls_last("""risk_score_change desc, liquidity_risk_score_latest desc, symbol_latest, name_latest,
  liquidity_risk_score_previous, market_cap_change_pct, volume_change_pct, volume_to_market_cap_ratio_previous,
  volume_to_market_cap_ratio_latest, ingested_at_utc_previous, ingested_at_utc_latest""")

PROTOCOL_TRENDS = """
pro_scored as (
  select id, id_text, name, symbol, chain, category, tvl, change_1d, change_7d, audits,
    {score} as protocol_risk_score, ingested_at_utc
  from fx_protocols),
pro_stamps as (select distinct ingested_at_utc as s from fx_protocols),
pro_l as (select * from pro_scored where ingested_at_utc = (select max(s) from pro_stamps)),
pro_p as (select * from pro_scored
          where ingested_at_utc = (select max(s) from pro_stamps where s < (select max(s) from pro_stamps))),
protocol_trends as (
  select l.name as name_latest, l.symbol as symbol_latest, l.chain as chain_latest, l.category as category_latest,
    p.protocol_risk_score as protocol_risk_score_previous, l.protocol_risk_score as protocol_risk_score_latest,
    l.protocol_risk_score - p.protocol_risk_score as risk_score_change,
    p.tvl as tvl_previous, l.tvl as tvl_latest, {tvl} as tvl_change_pct,
    l.change_1d as change_1d_latest, l.change_7d as change_7d_latest, l.audits as audits_latest,
    p.ingested_at_utc as ingested_at_utc_previous, l.ingested_at_utc as ingested_at_utc_latest,
    l.id as id, p.name as name_previous
  from pro_l l join pro_p p on l.id_text = p.id_text)
""".format(score=PROTOCOL_SCORE, tvl=pct_guarded("l.tvl", "p.tvl"))
PROTOCOL_TREND_SELECT = """name_latest, symbol_latest, chain_latest, category_latest, protocol_risk_score_previous,
  protocol_risk_score_latest, risk_score_change, tvl_previous, tvl_latest, tvl_change_pct, change_1d_latest,
  change_7d_latest, audits_latest, ingested_at_utc_previous, ingested_at_utc_latest"""
PROTOCOL_TREND_ORDER = _nulls_last("""risk_score_change desc, protocol_risk_score_latest desc, name_latest, symbol_latest,
  chain_latest, category_latest, protocol_risk_score_previous, tvl_previous, tvl_latest, tvl_change_pct, change_1d_latest,
  change_7d_latest, audits_latest, ingested_at_utc_previous, ingested_at_utc_latest""")

ALL_REPORTS = ",\n".join([TOKEN_REPORT_ROWS.strip(), PROTOCOL_REPORT_ROWS.strip(), STABLE_REPORT_ROWS.strip(),
                          TOKEN_TRENDS.strip(), PROTOCOL_TRENDS.strip()]) + ",\n" + """
token_top as (select * from token_report order by {t} limit 50),
protocol_top as (select * from protocol_report order by {p} limit 50),
stable_top as (select * from stable_report order by {s} limit 50)
""".format(t=TOKEN_ORDER, p=PROTOCOL_ORDER, s=STABLE_ORDER)


def with_reports(body: str) -> str:
    return with_adapters(_join(ALL_REPORTS.rstrip().rstrip(","), body))


# --- coercion fixtures ----------------------------------------------------------

NUMBER_TEXT = """
select o_orderkey, case o_orderkey % 16
    when 0 then cast(o_custkey as varchar)
    when 1 then concat(' ', cast(o_custkey as varchar), ' ')
    when 2 then concat(cast(o_custkey as varchar), '.', cast(o_orderkey % 100 as varchar))
    when 3 then concat(cast(o_custkey % 100 as varchar), 'e', cast(o_orderkey % 5 as varchar))
    when 4 then concat('+', cast(o_custkey as varchar))
    when 5 then concat('.', cast(o_orderkey % 1000 as varchar))
    when 6 then concat(cast(o_custkey as varchar), '.')
    when 7 then concat(cast(o_custkey as varchar), 'd')
    when 8 then o_orderpriority
    when 9 then ''
    when 10 then 'NaN'
    when 11 then case when o_custkey % 2 = 0 then 'inf' else '-Infinity' end
    when 12 then concat('0x', cast(o_custkey % 100 as varchar))
    when 13 then concat('1_', cast(o_orderkey % 1000 as varchar))
    when 14 then concat(cast(o_custkey as varchar), ',000')
    else concat('-', cast(o_custkey as varchar), '.', cast(o_orderkey % 7 as varchar), 'E-2')
  end as raw_text
from orders
"""
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"^\s*[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])\s*$"
COERCE_NUMBER = f"""
select o_orderkey, raw_text,
  case when regexp_full_match(raw_text, '{NUMBER_PATTERN}') then cast(trim(raw_text) as double)
       when regexp_full_match(raw_text, '{INFINITY_PATTERN}') then
         case when starts_with(trim(raw_text), '-') then cast('-inf' as double) else cast('inf' as double) end
  end as number
from ({NUMBER_TEXT}) t
"""

TIME_TEXT = """
select o_orderkey, case o_orderkey % 4
    when 0 then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
    when 1 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    when 2 then 'not a date'
    else concat(strftime(o_orderdate, '%Y-%m-%d'), 'T25:00:00Z')
  end as raw_text
from orders
"""
COERCE_TIMESTAMP = f"""
select o_orderkey, raw_text,
  strftime(coalesce(try_strptime(raw_text, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(raw_text, '%Y-%m-%d %H:%M:%S')),
           '%Y-%m-%d %H:%M:%S') as parsed_text
from ({TIME_TEXT}) t
"""


# --- landing, normalisation, snapshots, quality, marts ----------------------------

MARKETS_ROWS = ("""select id, symbol, name, current_price, market_cap, market_cap_rank, total_volume, high_24h,
  low_24h, price_change_percentage_24h, price_change_percentage_1h_in_currency,
  cast(null as double) as price_change_percentage_24h_in_currency, price_change_percentage_7d_in_currency,
  circulating_supply, total_supply, max_supply, ath, ath_change_percentage, atl,
  cast(null as double) as atl_change_percentage, ingested_at_utc,
  case when k % 25 = 0 then null
       else concat(substr(ingested_at_utc, 1, 4), '-', lpad(cast(k % 12 + 1 as varchar), 2, '0'), '-15 10:20:30')
  end as last_updated,
  'coingecko' as source_file
from fx_markets""")

PROTOCOLS_ROWS = ("""select id, name, cast(null as varchar) as address, symbol, url,
  cast(null as varchar) as description, chain, category, tvl, change_1h, change_1d, change_7d, mcap, listedAt, audits,
  cast(null as varchar) as audit_note, gecko_id, cmcId, twitter, cast(null as varchar) as forkedFrom, module,
  ingested_at_utc, id_text
from fx_protocols""")

STABLECOINS_ROWS = ("""select id, name, symbol, gecko_id, pegType, pegMechanism, price, circulating_usd, circulatingPrevDay_usd,
  circulatingPrevWeek_usd, cast(null as double) as circulatingPrevMonth_usd, chain_count, ingested_at_utc
from fx_stablecoins""")

NORMALIZE_MARKETS = with_adapters(MARKETS_ROWS)
NORMALIZE_PROTOCOLS = with_adapters(PROTOCOLS_ROWS)
NORMALIZE_STABLECOINS = with_adapters(STABLECOINS_ROWS)

# The three feeds in one table, every column of every row; ids that are numbers have a column of their own.
ALL_FEEDS_ROWS = f"""select 'markets' as feed, * from ({MARKETS_ROWS})
union all by name select 'protocols' as feed, * exclude (id), id as id_number from ({PROTOCOLS_ROWS})
union all by name select 'stablecoins' as feed, * exclude (id), id as id_number from ({STABLECOINS_ROWS})"""
NORMALIZE_ALL = with_adapters(f"select * from ({ALL_FEEDS_ROWS}) a")

RAW_MANIFEST = with_adapters("""select 'coingecko' as source, 'markets' as endpoint, ingested_at_utc, count(*) as record_count
  from fx_markets group by ingested_at_utc
union all
select 'mirror' as source, 'copies' as endpoint, concat(substr(ingested_at_utc, 1, 4), '0615T120000Z') as ingested_at_utc, count(*) as record_count
  from fx_markets group by ingested_at_utc
union all
select 'defillama' as source, 'protocols' as endpoint, ingested_at_utc, count(*) as record_count
  from fx_protocols group by ingested_at_utc
union all
select 'defillama' as source, 'stablecoins' as endpoint, ingested_at_utc, count(*) as record_count
  from fx_stablecoins group by ingested_at_utc
union all
select 'defillama' as source, 'stablecoins' as endpoint, '20250101T000000Z' as ingested_at_utc, count(*) as record_count
  from fx_stablecoins
union all
select 'coingecko' as source, 'markets' as endpoint, '20300101T000000Z' as ingested_at_utc, 0 as record_count""")

# The feeds are landed with one more field, in records whose name ends with 7: of runs from 1998 on, or of the stablecoins'
# only run of their own.
def _drift(feed: str) -> str:
    return f"""select '{feed}' as feed, 'listing' as field, change, n as records from
      (select count(*) as n from fx_{feed} where name like '%7' and ingested_at_utc = (select max(ingested_at_utc) from fx_{feed})) a
      cross join (select unnest(['unknown', 'new']) as change) c
      where n > 0 and (change = 'unknown' or not exists (select 1 from fx_{feed} where name like '%7' and ingested_at_utc >= '1998'
        and ingested_at_utc = (select max(ingested_at_utc) from fx_{feed} where ingested_at_utc < (select max(ingested_at_utc) from fx_{feed}))))"""


FIELD_DRIFT = with_adapters(_drift("markets") + " union all " + _drift("protocols") + " union all " + _drift("stablecoins")
                            + " union all select 'stablecoins' as feed, 'retired' as field, 'vanished' as change, 0 as records")

LATEST_RAW_SELECTION = with_adapters("""select id, symbol, ingested_at_utc, 'coingecko' as source, 'markets' as endpoint from latest_markets""")

SNAPSHOT_WRITE_READ = with_adapters("""select strftime(strptime(ingested_at_utc, '%Y%m%dT%H%M%SZ'), '%Y-%m-%d') as ingestion_date,
  ingested_at_utc as snapshot_ts, count(*) as rows, cast(sum(market_cap_rank) as bigint) as rank_sum
from fx_markets group by ingested_at_utc""")

SNAPSHOT_NEWEST_TWO = with_adapters("""select ingested_at_utc as snapshot_ts, count(*) as rows, max(tvl) as tvl, count(distinct name) as names from fx_protocols
where ingested_at_utc in (select distinct ingested_at_utc from fx_protocols order by 1 desc limit 2)
group by ingested_at_utc""")

REPORT_PREVIEW = with_reports(f"select * from token_report order by {TOKEN_ORDER} limit 15")


def _check_row(check: str, target: str, rows: str, passed: str) -> str:
    return f"select '{check}' as \"check\", '{target}' as target, cast({rows} as bigint) as rows, {passed} as passed"


def _key_rows(feed: str, key: str) -> list[str]:
    source = f"latest_{feed}"
    return [_check_row("ids_missing", feed, f"(select count(*) from {source} where {key} is null)", "true"),
            _check_row("ids_repeated", feed, f"(select coalesce(sum(n), 0) from (select count(*) as n from {source} "
                       f"where {key} is not null group by {key} having count(*) > 1) r)", "true")]


_OUTPUT_ROWS = [
    *_key_rows("markets", "id"), *_key_rows("protocols", "id_text"), *_key_rows("stablecoins", "id"),
    _check_row("table_not_empty", "markets", "(select count(*) from latest_markets)",
               "(select count(*) from latest_markets) > 0"),
    _check_row("table_not_empty", "protocols", "(select count(*) from latest_protocols)",
               "(select count(*) from latest_protocols) > 0"),
    _check_row("table_not_empty", "stablecoins", "(select count(*) from latest_stablecoins)",
               "(select count(*) from latest_stablecoins) > 0"),
    _check_row("report_valid", "token_liquidity_risk_top50", "(select count(*) from token_top)", "true"),
    _check_row("report_valid", "defi_protocol_risk_top50", "(select count(*) from protocol_top)", "true"),
    _check_row("report_valid", "stablecoin_depeg_risk_top50", "(select count(*) from stable_top)", "true"),
    _check_row("report_valid", "token_liquidity_risk_trends", "(select count(*) from token_trends)", "true"),
    _check_row("report_valid", "defi_protocol_risk_trends", "(select count(*) from protocol_trends)", "true"),
]
_CONTENTS = "\nunion all\n".join(
    f"select '{name}' as target, cast(sum({score}) as bigint) as score_sum, count(distinct {label}) as names from {source}"
    for name, score, label, source in [
        ("token_liquidity_risk_top50", "liquidity_risk_score", "name", "token_top"),
        ("defi_protocol_risk_top50", "protocol_risk_score", "name", "protocol_top"),
        ("stablecoin_depeg_risk_top50", "depeg_risk_score", "name", "stable_top"),
        ("token_liquidity_risk_trends", "risk_score_change", "name_latest", "token_trends"),
        ("defi_protocol_risk_trends", "risk_score_change", "name_latest", "protocol_trends")])
BATCH_JOB = with_reports("select \"check\", o.target, rows, passed, score_sum, names from (" + "\nunion all\n".join(_OUTPUT_ROWS)
                         + f") o left join ({_CONTENTS}) c on o.target = c.target")
QUALITY_CHECKS = with_reports("" + "\nunion all\n".join(_OUTPUT_ROWS + [
    _check_row("table_not_empty", "empty_table", "0", "false"),
    _check_row("report_valid", "missing_report", "null", "false"),
    _check_row("report_valid", "no_score_column", "null", "false"),
    _check_row("report_valid", "null_scores", "(select count(*) from token_top)", "false"),
]))

DASHBOARD_KPIS = with_reports(f"""select (select count(*) from token_top) as tracked_tokens,
  (select count(*) from protocol_top) as tracked_protocols,
  (select count(*) from stable_top) as tracked_stablecoins,
  (select symbol from stable_top order by {STABLE_ORDER} limit 1) as top_stablecoin_symbol,
  (select depeg_risk_score from stable_top order by {STABLE_ORDER} limit 1) as top_stablecoin_score""")

def _chart(columns: str, source: str, order: str, value: str) -> str:
    """The first 20 rows in report order, numbered in ascending order of the charted value (then the report's other keys)."""
    rest = [k.strip() for k in order.replace(" desc", "").split(",") if not k.strip().startswith(f"{value} ")]
    return with_reports(f"select {columns}, row_number() over (order by {value} nulls last, {', '.join(rest)}) as position "
                        f"from (select * from {source} order by {order} limit 20) t")


CHARTS = {
    "chart_token_risk": _chart("symbol, liquidity_risk_score, name, market_cap, total_volume, volume_to_market_cap_ratio",
                               "token_top", TOKEN_ORDER, "liquidity_risk_score"),
    "chart_token_trends": _chart("symbol_latest, risk_score_change, name_latest, liquidity_risk_score_previous, "
                                 "liquidity_risk_score_latest, market_cap_change_pct, volume_change_pct",
                                 "token_trends", TOKEN_TREND_ORDER, "risk_score_change"),
    "chart_protocol_risk": _chart("name, protocol_risk_score, chain, category, tvl, change_1d, change_7d",
                                  "protocol_top", PROTOCOL_ORDER, "protocol_risk_score"),
    "chart_protocol_trends": _chart("name_latest, risk_score_change, chain_latest, category_latest, "
                                    "protocol_risk_score_previous, protocol_risk_score_latest, tvl_previous, tvl_latest, "
                                    "tvl_change_pct", "protocol_trends", PROTOCOL_TREND_ORDER, "risk_score_change"),
    "chart_stablecoin_risk": _chart("symbol, depeg_risk_score, name, price, absolute_depeg, circulating_usd, "
                                    "supply_change_1d_pct, supply_change_7d_pct", "stable_top", STABLE_ORDER, "depeg_risk_score"),
}


TREND_ORDER = with_adapters(_join(TOKEN_TRENDS.rstrip() + ", " + PROTOCOL_TRENDS.strip(), f"""select 'token_liquidity_risk_trends' as report,
  row_number() over (order by {TOKEN_TREND_ORDER}) as position, name_latest, risk_score_change, liquidity_risk_score_latest as score_latest,
  ingested_at_utc_latest from token_trends
union all
select 'defi_protocol_risk_trends' as report, row_number() over (order by {PROTOCOL_TREND_ORDER}) as position, name_latest, risk_score_change,
  protocol_risk_score_latest as score_latest, ingested_at_utc_latest from protocol_trends"""))


def numbered(report: str, order: str, n: int) -> str:
    """The first ``n`` rows of a report with their position."""
    return f"select *, row_number() over (order by {order}) as position from {report} order by {order} limit {n}"
