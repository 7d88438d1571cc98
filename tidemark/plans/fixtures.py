"""Feed-shaped tables derived from the TPC-H-style test tables.

The test tables carry no market data, so the three feeds are derived from
``orders`` and ``lineitem`` by aggregation: their size grows with the inputs and
every scoring branch is reached (NULL and zero caps, NULL ids, NULL prices, two
peg types, NULL/zero previous supply). Keys are small integers, sums are over
integral values and everything else is max/min, so any engine computes the
same doubles.

``*_raw`` builders turn a feed back into raw records (numbers quoted on even
keys, nested supply objects, chain lists) for the landing round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _dbl(c: Column) -> Column:
    return c.cast("double")


def _yearly_stamp(y: Column) -> Column:
    return F.concat(_s(y), F.lit("0101T000000Z"))


def _of_years(df: DataFrame, day: str, years: list[int] | None) -> DataFrame:
    """Rows of the given years. The range reaches the scan, so other row groups are skipped."""
    if years is None:
        return df
    first, last = F.lit(f"{min(years)}-01-01").cast("date"), F.lit(f"{max(years) + 1}-01-01").cast("date")
    return df.where((F.col(day) >= first) & (F.col(day) < last) & F.year(day).isin(years))


def newest_years(spark: SparkSession, sf_dir: str, feed: str, n: int) -> list[int]:
    """The ``n`` newest runs (years) of a feed, newest first; raises where there are fewer."""
    table, day = {"markets": ("orders", "o_orderdate"), "protocols": ("lineitem", "l_shipdate")}[feed]
    years = _table(spark, sf_dir, table).where(F.col(day).isNotNull()).select(F.year(day).alias("y"))
    newest = years.agg(F.max("y").alias("y")).where("y is not null") if n == 1 else years.distinct().orderBy(F.desc("y")).limit(n)
    rows = newest.collect()
    if len(rows) < n:
        raise ValueError(f"{feed}: {n} runs are needed and {sf_dir} holds {len(rows)}")
    return [r.y for r in rows]


def market_base(spark: SparkSession, sf_dir: str, years: list[int] | None = None) -> DataFrame:
    orders = _of_years(_table(spark, sf_dir, "orders"), "o_orderdate", years)
    return (orders.groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"))
            .agg(F.max("o_totalprice").alias("mx"), F.min("o_totalprice").alias("mn")))


def fx_markets(spark: SparkSession, sf_dir: str, keep_key: bool = False,
               years: list[int] | None = None) -> DataFrame:
    """One market snapshot per order year (of ``years``, if given): ~customers × years rows."""
    k, y, mx, mn = F.col("k"), F.col("y"), F.col("mx"), F.col("mn")
    cols = [
        F.concat(F.lit("c"), _s(k)).alias("id"),
        F.concat(F.lit("s"), _s(k % 500)).alias("symbol"),
        F.concat(F.lit("Token "), _s(k)).alias("name"),
        (mn / 100).alias("current_price"),
        F.when(k % 13 == 0, F.lit(None).cast("double"))
         .when((k + y) % 17 == 0, F.lit(0.0)).otherwise(mx).alias("market_cap"),
        F.when(k % 50 != 0, k.cast("bigint")).alias("market_cap_rank"),
        (mn * (k % 12) / 100).alias("total_volume"),
        (_dbl((k * 7 + y * 3) % 41 - 25) + 0.25).alias("price_change_percentage_24h"),
        (_dbl((k * 5 + y * 11) % 61 - 40) + 0.5).alias("price_change_percentage_7d_in_currency"),
        F.when(k % 9 == 0, F.lit(None).cast("double")).otherwise(_dbl(k % 10)).alias("circulating_supply"),
        _dbl(10 + k % 7).alias("total_supply"),
        (mx / 100).alias("high_24h"), (mn / 200).alias("low_24h"),
        (_dbl(k % 7 - 3) + 0.5).alias("price_change_percentage_1h_in_currency"),
        F.when(k % 3 != 0, _dbl(k % 50)).alias("max_supply"), mx.alias("ath"),
        (-_dbl(k % 90)).alias("ath_change_percentage"), (mn / 1000).alias("atl"),
        _yearly_stamp(y).alias(S.STAMP),
    ]
    if keep_key:
        cols.append(k.alias("k"))
    return market_base(spark, sf_dir, years).select(*cols)


def protocol_base(spark: SparkSession, sf_dir: str, years: list[int] | None = None) -> DataFrame:
    lineitem = _of_years(_table(spark, sf_dir, "lineitem"), "l_shipdate", years)
    return (lineitem.groupBy(F.col("l_partkey").alias("k"), F.year("l_shipdate").alias("y"))
            .agg(F.max("l_extendedprice").alias("mx"), F.max("l_quantity").alias("q")))


def fx_protocols(spark: SparkSession, sf_dir: str, keep_key: bool = False,
                 years: list[int] | None = None) -> DataFrame:
    """One protocol snapshot per ship year (of ``years``, if given); every 97th id is no number."""
    k, y, mx, q = F.col("k"), F.col("y"), F.col("mx"), F.col("q")
    scale = (F.when(k % 4 == 0, F.lit(1)).when(k % 4 == 1, F.lit(10))
             .when(k % 4 == 2, F.lit(100)).otherwise(F.lit(1000)))
    cols = [
        F.when(k % 97 == 0, F.lit(None).cast("double")).otherwise(_dbl(k)).alias("id"),
        F.concat(F.lit("Protocol "), _s(k)).alias("name"),
        F.when(k % 6 == 0, F.lit("-")).otherwise(F.concat(F.lit("p"), _s(k))).alias("symbol"),
        F.concat(F.lit("chain"), _s(k % 5)).alias("chain"),
        F.concat(F.lit("cat"), _s(k % 8)).alias("category"),
        F.when(k % 19 == 0, F.lit(None).cast("double"))
         .when((k + y) % 23 == 0, F.lit(0.0)).otherwise(mx * scale).alias("tvl"),
        (_dbl((k * 11 + y * 5) % 61 - 35) + 0.25).alias("change_1d"),
        (_dbl((k * 3 + y * 13) % 101 - 60) + 0.5).alias("change_7d"),
        F.when(k % 7 == 0, F.lit(None).cast("double"))
         .when(k % 29 == 0, F.lit(0.0)).otherwise(q * 10000).alias("mcap"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(_dbl(k % 3)).alias("audits"),
        F.concat(F.lit("https://p"), _s(k), F.lit(".example.com")).alias("url"),
        (_dbl(k % 9 - 4) + 0.25).alias("change_1h"),
        F.when(k % 6 != 0, F.lit(9007199254740993) + k).alias("listedAt"), _dbl(k % 1000).alias("cmcId"),
        F.concat(F.lit("g"), _s(k)).alias("gecko_id"), F.when(k % 2 == 1, F.concat(F.lit("@p"), _s(k))).alias("twitter"),
        F.concat(F.lit("m"), _s(k % 3)).alias("module"),
        _yearly_stamp(y).alias(S.STAMP),
        F.when(k % 97 == 0, F.concat(F.lit("parent#"), _s(k))).otherwise(_s(_dbl(k))).alias(S.ID_TEXT),
    ]
    if keep_key:
        cols.append(k.alias("k"))
    return protocol_base(spark, sf_dir, years).select(*cols)


def stablecoin_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    return lineitem.groupBy(F.col("l_partkey").alias("k")).agg(F.sum("l_quantity").alias("q"))


def fx_stablecoins(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    """One stablecoin snapshot: one row per part."""
    k, q = F.col("k"), F.col("q")
    cols = [
        _dbl(k).alias("id"),
        F.concat(F.lit("Stable "), _s(k)).alias("name"),
        F.concat(F.lit("st"), _s(k)).alias("symbol"),
        F.when(k % 10 == 9, F.lit("peggedEUR")).otherwise(F.lit("peggedUSD")).alias("pegType"),
        F.when(k % 3 == 0, F.lit("fiat-backed")).otherwise(F.lit("crypto-backed")).alias("pegMechanism"),
        F.when(k % 11 == 0, F.lit(None).cast("double"))
         .otherwise(1 + _dbl((k * 37) % 401 - 200) / F.lit(2500.0)).alias("price"),
        F.when(k % 31 == 0, F.lit(None).cast("double")).otherwise(q).alias("circulating_usd"),
        F.when(k % 37 == 0, F.lit(0.0))
         .otherwise(q * (1 + _dbl(k % 40 - 10) / 100)).alias("circulatingPrevDay_usd"),
        (q * (1 + _dbl(k % 100 - 20) / 100)).alias("circulatingPrevWeek_usd"),
        F.when(k % 8 == 0, F.lit(None).cast("int")).otherwise((k % 5).cast("int")).alias("chain_count"),
        F.when(k % 4 != 0, F.concat(F.lit("sg"), _s(k))).alias("gecko_id"),
        F.lit("20240101T000000Z").alias(S.STAMP),
    ]
    if keep_key:
        cols.append(k.alias("k"))
    return stablecoin_base(spark, sf_dir).select(*cols)


# --- raw records for the landing round trip ---------------------------------

def _json_number(x: Column, quoted: Column) -> Column:
    """A number as VARIANT: its text (a JSON string) on ``quoted`` rows, a JSON
    number otherwise. Built by casts, without parsing JSON text."""
    return (F.when(x.isNull(), F.lit(None).cast("variant"))
            .when(quoted, x.cast("string").cast("variant"))
            .otherwise(x.cast("variant")))


def markets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw market records (+ ``last_updated`` text) and the run stamp."""
    fx = fx_markets(spark, sf_dir, keep_key=True)
    even = F.col("k") % 2 == 0
    numeric = ["current_price", "market_cap", "total_volume", "high_24h", "low_24h", "price_change_percentage_24h",
               "price_change_percentage_1h_in_currency", "price_change_percentage_7d_in_currency",
               "circulating_supply", "total_supply", "max_supply", "ath", "ath_change_percentage", "atl"]
    # A rank that is no whole number becomes NULL.
    rank = F.when(F.col("market_cap_rank").isNull(), _json_number(_dbl(F.col("k")) + 0.5, even)) \
        .otherwise(_json_number(F.col("market_cap_rank"), even))
    last_updated = F.concat(F.substring(S.STAMP, 1, 4), F.lit("-"),
                            F.lpad(_s(F.col("k") % 12 + 1), 2, "0"), F.lit("-15T10:20:30.000Z"))
    return fx.select(
        "id", "symbol", "name",
        *[_json_number(F.col(c), even).alias(c) for c in numeric], rank.alias("market_cap_rank"),
        F.when(F.col("k") % 25 == 0, F.lit("not a time")).otherwise(last_updated).alias("last_updated"),
        S.STAMP,
    )


def protocols_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fx_protocols(spark, sf_dir, keep_key=True)
    even = F.col("k") % 2 == 0
    # A non-numeric id text coerces to NULL, like the adapter's NULL ids.
    raw_id = F.when(F.col("id").isNull(), F.concat(F.lit("parent#"), _s(F.col("k"))).cast("variant")) \
        .otherwise(_json_number(F.col("id"), even))
    return fx.select(
        raw_id.alias("id"), "name", "symbol", "url", "chain", "category", "gecko_id", "twitter", "module",
        *[_json_number(F.col(c), even).alias(c) for c in
          ["tvl", "change_1h", "change_1d", "change_7d", "mcap", "audits", "listedAt", "cmcId"]],
        S.STAMP,
    )


def stablecoins_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fx_stablecoins(spark, sf_dir, keep_key=True)
    even = F.col("k") % 2 == 0

    def pegged(c: str) -> Column:
        return F.when(F.col(c).isNull(), F.lit(None).cast("variant")) \
            .otherwise(F.to_variant_object(F.struct(F.col(c).alias("peggedUSD"))))

    names = F.transform(F.array_repeat(F.lit(0), F.coalesce(F.col("chain_count"), F.lit(0))),
                        lambda x, i: F.concat(F.lit("chain"), _s(i)))
    chains = F.when(F.col("chain_count").isNull(), F.lit(None).cast("variant")).otherwise(names.cast("variant"))
    return fx.select(
        _json_number(F.col("id"), even).alias("id"), "name", "symbol", "gecko_id", "pegType", "pegMechanism",
        _json_number(F.col("price"), even).alias("price"),
        pegged("circulating_usd").alias("circulating"),
        pegged("circulatingPrevDay_usd").alias("circulatingPrevDay"),
        pegged("circulatingPrevWeek_usd").alias("circulatingPrevWeek"),
        chains.alias("chains"),
        S.STAMP,
    )


FEED_BUILDERS = {"markets": fx_markets, "protocols": fx_protocols, "stablecoins": fx_stablecoins}
RAW_BUILDERS = {"markets": markets_raw, "protocols": protocols_raw, "stablecoins": stablecoins_raw}
ENDPOINTS = {
    "markets": ("coingecko", "markets"),
    "protocols": ("defillama", "protocols"),
    "stablecoins": ("defillama", "stablecoins"),
}
