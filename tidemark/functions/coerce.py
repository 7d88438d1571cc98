"""Coercion of raw text into typed values — JVM expressions only, no UDFs.

A raw value is "a number" when its text is a plain decimal literal (optionally
signed, with exponent, surrounded by white space) or an infinity word; anything
else — empty text, words, ``5d``, ``0x10``, ``1_000``, ``1,000``, ``NaN`` — becomes
NULL. A plain ``try_cast`` is not enough: Spark accepts ``5d``/``5f`` and turns
``NaN`` into a NaN double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number text and the compact run-stamp format.
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?(inf|infinity)\s*$"
STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
DATE_FORMAT = "yyyy-MM-dd"

_SPACE = " \t\n\r\f\u000b"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text → DOUBLE, NULL when the text is not a number (never NaN)."""
    c = _col(c).cast("string")
    trimmed = F.btrim(c, F.lit(_SPACE))
    return (
        F.when(c.rlike(NUMBER_PATTERN), trimmed.try_cast("double"))
        .when(c.rlike(INFINITY_PATTERN),
              F.when(trimmed.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )


INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


def to_whole_number(c: Column | str, type_name: str = "bigint") -> Column:
    """Text → integral type; NULL for non-numbers, fractions and out-of-range values.
    Integer literals are parsed as integers (exact beyond 2^53); other number text
    goes through DOUBLE and must be integral."""
    text = _col(c).cast("string")
    n = to_number(text)
    via_double = F.when(F.abs(n) < F.lit(2.0 ** 63), F.when(n == F.floor(n), n.try_cast(type_name)))
    exact = F.btrim(text, F.lit(_SPACE)).try_cast(type_name)
    return F.when(text.rlike(INTEGER_PATTERN), exact).otherwise(via_double)


def to_timestamp_loose(c: Column | str) -> Column:
    """Text → TIMESTAMP with Spark's ISO-8601 rules; unparseable → NULL."""
    return F.try_to_timestamp(_col(c).cast("string"))


def parse_stamp(c: Column | str) -> Column:
    """Compact run stamp ``20240101T000000Z`` → TIMESTAMP (UTC)."""
    return F.try_to_timestamp(_col(c), F.lit(STAMP_FORMAT))


def format_stamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), STAMP_FORMAT)


def stamp_date(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_FORMAT)


def run_stamp_literal(when=None) -> str:
    """The stamp of a run started now (or at ``when``), formatted in UTC."""
    import datetime as _dt

    moment = when or _dt.datetime.now(_dt.timezone.utc)
    return moment.astimezone(_dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def json_field_number(v: Column | str, field: str) -> Column:
    """``v`` (VARIANT) is an object → its ``field`` coerced to DOUBLE; otherwise NULL."""
    text = F.try_variant_get(_col(v), f"$.{field}", "string")
    return to_number(text)


def json_list_length(v: Column | str) -> Column:
    """``v`` (VARIANT) is a list → its length (0 for ``[]``); otherwise NULL."""
    return F.array_size(F.try_variant_get(_col(v), "$", "array<variant>"))
