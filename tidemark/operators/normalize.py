"""Normalisers: landed raw records → typed tables.

Each is a single projection (map-only, no shuffle): allow-listed columns in feed
order, numbers coerced (bad → NULL), timestamps parsed per row, nested supply
objects and chain lists reduced to numbers, lineage columns carried along. A
column missing from the input becomes a typed NULL, so the output schema never
depends on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.coerce import (
    json_field_number,
    json_list_length,
    to_number,
    to_timestamp_loose,
    to_whole_number,
)


def _field(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast("string")


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _typed(df: DataFrame, name: str, target: T.DataType) -> Column:
    raw = _field(df, name)
    have = df.schema[name].dataType if name in df.columns else T.StringType()
    if isinstance(target, (T.LongType, T.IntegerType)) and isinstance(have, _INTEGRAL):
        out = raw.try_cast(target)          # already whole numbers: no detour through text
    elif isinstance(target, T.LongType):
        out = to_whole_number(raw, "bigint")
    elif isinstance(target, T.IntegerType):
        out = to_whole_number(raw, "int")
    elif isinstance(target, T.DoubleType):
        out = to_number(raw)
    elif isinstance(target, T.TimestampType):
        out = to_timestamp_loose(raw)
    else:
        if isinstance(have, T.StringType):
            out = raw
        elif isinstance(have, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            out = F.to_json(raw)            # nested values are kept as JSON text
        else:
            out = raw.cast("string")
    return out.cast(target).alias(name)


def _as_variant(df: DataFrame, name: str) -> Column:
    """Nested raw value as VARIANT (text input is parsed; non-JSON text → NULL)."""
    if name not in df.columns:
        return F.lit(None).cast("variant")
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.VariantType):
        return F.col(name)
    if isinstance(dtype, T.StringType):
        return F.try_parse_json(F.col(name))
    return F.try_parse_json(F.to_json(F.col(name)))


def normalize_markets(landed: DataFrame) -> DataFrame:
    target = {f.name: f.dataType for f in S.MARKETS.fields}
    cols = [_typed(landed, c, target[c]) for c in S.MARKET_COLUMNS]
    cols.append(_field(landed, S.STAMP).alias(S.STAMP))
    cols.append(F.coalesce(_field(landed, "source"), F.lit(S.DEFAULT_SOURCE)).alias("source_file"))
    return landed.select(*cols)


def normalize_protocols(landed: DataFrame) -> DataFrame:
    target = {f.name: f.dataType for f in S.PROTOCOLS.fields}
    cols = [_typed(landed, c, target[c]) for c in S.PROTOCOL_COLUMNS]
    cols.append(_field(landed, S.STAMP).alias(S.STAMP))
    cols.append(id_text(landed).alias(S.ID_TEXT))
    return landed.select(*cols)


def id_text(df: DataFrame) -> Column:
    """The id as text: its number where it is one (so 7, 7.0 and "7" agree), the trimmed raw text
    otherwise (or what the column already holds, in typed input); NULL where there is none. Whole
    numbers of 16 or more digits keep all of them, which a double doesn't."""
    raw = _field(df, "id").cast("string")
    large = r"^\s*\+?(-?)0*([1-9]\d{15,})(?:\.0*)?\s*$"
    digits = F.when(raw.rlike(large), F.concat(F.regexp_extract(raw, large, 1), F.regexp_extract(raw, large, 2)))
    return F.coalesce(digits, to_number(raw).cast("string"), F.nullif(F.trim(raw), F.lit("")), _field(df, S.ID_TEXT))


def normalize_stablecoins(landed: DataFrame) -> DataFrame:
    target = {f.name: f.dataType for f in S.STABLECOINS.fields}
    scalars = ["id", "name", "symbol", "gecko_id", "pegType", "pegMechanism", "price"]
    cols = [_typed(landed, c, target[c]) for c in scalars]
    cols.append(_field(landed, S.STAMP).alias(S.STAMP))
    for c in S.STABLECOIN_SUPPLY:
        cols.append(json_field_number(_as_variant(landed, c), "peggedUSD").alias(f"{c}_usd"))
    cols.append(json_list_length(_as_variant(landed, "chains")).cast("int").alias("chain_count"))
    return landed.select(*cols)


NORMALIZERS = {
    "markets": normalize_markets,
    "protocols": normalize_protocols,
    "stablecoins": normalize_stablecoins,
}


def conform(df: DataFrame, feed: str) -> DataFrame:
    """Map an already processed table (e.g. parquet written by pandas) onto the
    feed's fixed schema: missing columns become typed NULLs, integral or text
    numbers are coerced like raw values, epoch-nanosecond timestamps (how such
    files store them) become TIMESTAMP, extra columns are dropped."""
    target = S.FEEDS[feed]["typed"]
    cols = []
    for field in target.fields:
        name, want = field.name, field.dataType
        if name == S.ID_TEXT and name not in df.columns:
            cols.append(id_text(df).alias(name))
            continue
        if name not in df.columns:
            cols.append(F.lit(None).cast(want).alias(name))
            continue
        have = df.schema[name].dataType
        c = F.col(name)
        if isinstance(want, T.TimestampType) and isinstance(have, (T.LongType, T.IntegerType)):
            out = F.timestamp_micros(F.floor(c / 1000))
        elif isinstance(want, T.TimestampType) and isinstance(have, T.StringType):
            out = to_timestamp_loose(c)
        elif isinstance(want, (T.LongType, T.IntegerType)) and isinstance(have, _INTEGRAL):
            out = c.try_cast(want)
        elif isinstance(want, T.LongType):
            out = to_whole_number(c, "bigint")
        elif isinstance(want, T.IntegerType):
            out = to_whole_number(c, "int")
        elif isinstance(want, T.DoubleType):
            out = c if isinstance(have, T.DoubleType) else to_number(c)
        elif isinstance(want, T.StringType) and isinstance(have, (T.ArrayType, T.StructType, T.MapType)):
            out = F.to_json(c)          # nested values are kept as JSON text, as in the landing
        elif isinstance(want, T.StringType) and not isinstance(have, T.StringType):
            out = c.cast("string")
        else:
            out = c.try_cast(want)
        cols.append(out.cast(want).alias(name))
    return df.select(*cols)
