"""Schemas of the three feeds: raw landing (all text) and normalised (typed).

Raw record fields are read as STRING: a number, a quoted number, an object or a
list all arrive as their JSON text and are coerced afterwards. Fields that hold
nested values are read as VARIANT so that a list can be told apart from a string
that merely looks like one.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column allow-lists and numeric column lists of each feed, in the
# order the feeds define them. They must stay equal to the source feeds.
# ---------------------------------------------------------------------------
MARKET_COLUMNS = [
    "id", "symbol", "name", "current_price", "market_cap", "market_cap_rank",
    "total_volume", "high_24h", "low_24h", "price_change_percentage_24h",
    "price_change_percentage_1h_in_currency", "price_change_percentage_24h_in_currency",
    "price_change_percentage_7d_in_currency", "circulating_supply", "total_supply",
    "max_supply", "ath", "ath_change_percentage", "atl", "atl_change_percentage",
    "last_updated",
]
MARKET_NUMERIC = [
    "current_price", "market_cap", "market_cap_rank", "total_volume", "high_24h",
    "low_24h", "price_change_percentage_24h", "price_change_percentage_1h_in_currency",
    "price_change_percentage_24h_in_currency", "price_change_percentage_7d_in_currency",
    "circulating_supply", "total_supply", "max_supply", "ath", "ath_change_percentage",
    "atl", "atl_change_percentage",
]
PROTOCOL_COLUMNS = [
    "id", "name", "address", "symbol", "url", "description", "chain", "category",
    "tvl", "change_1h", "change_1d", "change_7d", "mcap", "listedAt", "audits",
    "audit_note", "gecko_id", "cmcId", "twitter", "forkedFrom", "module",
]
PROTOCOL_NUMERIC = [
    "id", "tvl", "change_1h", "change_1d", "change_7d", "mcap", "listedAt", "audits", "cmcId",
]
STABLECOIN_COLUMNS = [
    "id", "name", "symbol", "gecko_id", "pegType", "pegMechanism", "price",
    "circulating", "circulatingPrevDay", "circulatingPrevWeek", "circulatingPrevMonth",
    "chains",
]
STABLECOIN_SUPPLY = [
    "circulating", "circulatingPrevDay", "circulatingPrevWeek", "circulatingPrevMonth",
]
STABLECOIN_NUMERIC = [
    "id", "price", "circulating_usd", "circulatingPrevDay_usd", "circulatingPrevWeek_usd",
    "circulatingPrevMonth_usd", "chain_count",
]
DEFAULT_SOURCE = "coingecko"
STAMP = "ingested_at_utc"
# Integral numeric columns (kept as whole numbers); every other numeric is DOUBLE.
BIGINT_COLUMNS = {"market_cap_rank", "listedAt"}
INT_COLUMNS = {"chain_count"}
STABLECOIN_OUT = [
    "id", "name", "symbol", "gecko_id", "pegType", "pegMechanism", "price", STAMP,
    "circulating_usd", "circulatingPrevDay_usd", "circulatingPrevWeek_usd",
    "circulatingPrevMonth_usd", "chain_count",
]
# ---------------------------------------------------------------------------

# Envelope fields carried beside every landed record.
ENVELOPE_FIELDS = ["source", "endpoint", STAMP]
# A protocol's id as text: its number, or the raw text where that is no number.
ID_TEXT = "id_text"

# Nested fields read as VARIANT.
VARIANT_FIELDS = set(STABLECOIN_SUPPLY) | {"chains"}


def _raw_struct(columns: list[str]) -> T.StructType:
    return T.StructType([
        T.StructField(c, T.VariantType() if c in VARIANT_FIELDS else T.StringType(), True)
        for c in columns
    ])


RAW_MARKETS = _raw_struct(MARKET_COLUMNS)
RAW_PROTOCOLS = _raw_struct(PROTOCOL_COLUMNS)
RAW_STABLECOINS = _raw_struct(STABLECOIN_COLUMNS)


def landed_schema(record: T.StructType) -> T.StructType:
    """Schema of the line-delimited landing: record fields + envelope; the stamp is
    the partition column and comes last."""
    return T.StructType(
        list(record.fields)
        + [T.StructField("source", T.StringType(), True),
           T.StructField("endpoint", T.StringType(), True),
           T.StructField(STAMP, T.StringType(), True)]
    )


def envelope_schema(record: T.StructType, nested_key: str | None = None) -> T.StructType:
    """Schema of one envelope document.

    ``data`` is a list of records, or (``nested_key`` given) an object holding the
    list under that key.
    """
    data = T.ArrayType(record, True)
    if nested_key:
        data = T.StructType([T.StructField(nested_key, data, True)])
    return T.StructType([
        T.StructField("source", T.StringType(), True),
        T.StructField("endpoint", T.StringType(), True),
        T.StructField(STAMP, T.StringType(), True),
        T.StructField("record_count", T.LongType(), True),
        T.StructField("data", data, True),
    ])


def _typed(name: str, numeric: set[str]) -> T.DataType:
    if name in BIGINT_COLUMNS:
        return T.LongType()
    if name in INT_COLUMNS:
        return T.IntegerType()
    if name in numeric:
        return T.DoubleType()
    return T.StringType()


MARKETS = T.StructType(
    [T.StructField(c, T.TimestampType() if c == "last_updated" else _typed(c, set(MARKET_NUMERIC)), True)
     for c in MARKET_COLUMNS]
    + [T.StructField(STAMP, T.StringType(), True), T.StructField("source_file", T.StringType(), True)]
)

PROTOCOLS = T.StructType(
    [T.StructField(c, _typed(c, set(PROTOCOL_NUMERIC)), True) for c in PROTOCOL_COLUMNS]
    + [T.StructField(STAMP, T.StringType(), True), T.StructField(ID_TEXT, T.StringType(), True)]
)

STABLECOINS = T.StructType(
    [T.StructField(c, _typed(c, set(STABLECOIN_NUMERIC)), True) for c in STABLECOIN_OUT]
)

# Snapshot tables add two partition columns.
SNAPSHOT_PARTITIONS = ["ingestion_date", "snapshot_ts"]


def snapshot_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        list(schema.fields)
        + [T.StructField(p, T.StringType(), True) for p in SNAPSHOT_PARTITIONS]
    )


FEEDS = {
    "markets": {"raw": RAW_MARKETS, "typed": MARKETS, "nested_key": None},
    "protocols": {"raw": RAW_PROTOCOLS, "typed": PROTOCOLS, "nested_key": None},
    "stablecoins": {"raw": RAW_STABLECOINS, "typed": STABLECOINS, "nested_key": "peggedAssets"},
}
