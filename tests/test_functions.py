"""Expression-level behaviour: coercion, nested JSON, guarded arithmetic, rounding."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import arith, coerce


def _eval(spark, values, expr_fn, in_type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {in_type}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("v"))).collect()]


NUMBERS = [("12.5", 12.5), (" 5 ", 5.0), ("1e3", 1000.0), ("+7", 7.0), (".5", 0.5), ("5.", 5.0),
           ("-3.25E-2", -0.0325), ("007", 7.0), ("123456789012345678901234567890", 1.2345678901234568e29),
           ("", None), ("abc", None), ("parent#1", None), ("5d", None), ("5f", None), ("0x10", None),
           ("1_000", None), ("1,000", None), ("NaN", None), ("nan", None), (None, None), ("true", None),
           ("inf", math.inf), ("Infinity", math.inf), ("-inf", -math.inf), (" -INFINITY ", -math.inf),
           ("\u0660", None), ("\u0663.5", None), ("\u20035", None)]  # non-ASCII digits / space: not numbers


def test_to_number(spark):
    got = _eval(spark, [t for t, _ in NUMBERS], coerce.to_number)
    for (text, want), value in zip(NUMBERS, got):
        assert value == want, text


def test_to_number_never_nan(spark):
    got = _eval(spark, ["NaN", "-nan", "1e400", "-1e400"], coerce.to_number)
    assert got[:2] == [None, None]
    assert got[2:] == [math.inf, -math.inf]


def test_to_whole_number(spark):
    got = _eval(spark, ["3", "3.0", "3.5", "1e19", "x", None], lambda c: coerce.to_whole_number(c))
    assert got == [3, 3, None, None, None, None]


def test_timestamps(spark):
    got = _eval(spark, ["2024-01-15T10:20:30.000Z", "2024-01-15 10:20:30", "junk", None],
                lambda c: F.date_format(coerce.to_timestamp_loose(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2024-01-15 10:20:30", "2024-01-15 10:20:30", None, None]


def test_stamp_round_trip(spark):
    got = _eval(spark, ["20260709T134236Z", "garbage"],
                lambda c: F.concat_ws("|", coerce.stamp_date(coerce.parse_stamp(c)),
                                      coerce.format_stamp(coerce.parse_stamp(c))))
    assert got == ["2026-07-09|20260709T134236Z", ""]


def test_json_field_number(spark):
    docs = ['{"peggedUSD": 5.5}', '{"peggedUSD": "9"}', '{"peggedEUR": 3}', "7", "null",
            '{"peggedUSD": {"a": 1}}', '{"peggedUSD": "abc"}', None]
    got = _eval(spark, docs, lambda c: coerce.json_field_number(F.try_parse_json(c), "peggedUSD"))
    assert got == [5.5, 9.0, None, None, None, None, None, None]


def test_json_list_length(spark):
    docs = ['["a","b"]', "[]", '{"a":1}', '"zz"', '"[1]"', None]
    got = _eval(spark, docs, lambda c: coerce.json_list_length(F.try_parse_json(c)))
    assert got == [2, 0, None, None, None, None]


def _pairs(spark, pairs, fn):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a double, b double")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("a"), F.col("b"))).collect()]


def test_pct_change_ieee(spark):
    got = _pairs(spark, [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (2.0, 1.0), (None, 1.0), (1.0, None)],
                 arith.pct_change_ieee)
    assert got == [math.inf, -math.inf, None, 100.0, None, None]


def test_guarded_pct_change(spark):
    got = _pairs(spark, [(1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (1.0, -2.0), (1.0, None)], arith.guarded_pct_change)
    assert got == [None, None, 50.0, None, None]


def test_safe_ratios(spark):
    assert _pairs(spark, [(1.0, 0.0), (1.0, -1.0), (1.0, 4.0), (None, 2.0)], arith.safe_ratio) == \
        [None, None, 0.25, None]
    assert _pairs(spark, [(0.0, 4.0), (1.0, 4.0), (1.0, 0.0)], arith.both_positive_ratio) == [None, 0.25, None]
    assert _pairs(spark, [(9.0, 10.0), (1.0, 0.0)], arith.change_fraction) == [-0.1, None]


@pytest.mark.parametrize("value,digits,want", [
    (2.675, 2, 2.68), (1.005, 2, 1.0), (0.125, 2, 0.13), (-0.125, 2, -0.13), (0.5, 0, 1.0), (-0.5, 0, -1.0),
    (2.5, 0, 3.0), (123.456789, 4, 123.4568), (0.0000005, 6, 0.000001), (1e300, 2, 1e300),
])
def test_round_half_away(spark, value, digits, want):
    got = _eval(spark, [value], lambda c: arith.round_half_away(c, digits), in_type="double")[0]
    assert got == want


def test_round_keeps_sign_of_zero(spark):
    got = _eval(spark, [-0.001], lambda c: arith.round_half_away(c, 2), in_type="double")[0]
    assert got == 0.0 and math.copysign(1.0, got) == -1.0


def test_round_matches_duckdb(spark):
    duckdb = pytest.importorskip("duckdb")
    import numpy as np

    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(-10**6, 10**6, 3000) / 1000.0 + 0.0005,
                           rng.normal(0, 1e5, 3000), rng.integers(-10**5, 10**5, 3000) / 200.0])
    con = duckdb.connect()
    rows = con.execute("select round(x, 2), round(x, 4) from (select unnest(?::double[]) as x) t",
                       [vals.tolist()]).fetchall()
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, v double")
    got = df.orderBy("i").select(arith.round_half_away("v", 2), arith.round_half_away("v", 4)).collect()
    assert [tuple(r) for r in got] == rows


def test_whole_number_exact_for_big_integers(spark):
    big = 2 ** 53 + 1
    got = _eval(spark, [str(big), f" {big} ", "+7", "9.0", "1e3", "99999999999999999999"],
                lambda c: coerce.to_whole_number(c))
    assert got == [big, big, 7, 9, 1000, None]


def test_run_stamp_literal():
    import datetime as dt

    moment = dt.datetime(2026, 7, 9, 15, 42, 36, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert coerce.run_stamp_literal(moment) == "20260709T134236Z"     # always rendered in UTC
    assert len(coerce.run_stamp_literal()) == 16


def test_no_change_rate_or_ratio_is_nan(spark):
    from pyspark.sql import functions as F
    from tidemark.functions import arith

    inf = float("inf")
    df = spark.createDataFrame([(inf, inf), (inf, 1.0), (1.0, inf), (-inf, inf)], "a double, b double")
    forms = [arith.pct_change_ieee, arith.guarded_pct_change, arith.change_fraction, arith.safe_ratio, arith.both_positive_ratio]
    row = df.agg(*[F.count_if(F.isnan(f("a", "b"))).alias(f.__name__) for f in forms]).first()
    assert set(row) == {0}
