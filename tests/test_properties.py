"""Property tests: coercion and rounding over generated inputs (one Spark job per batch)."""

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import arith, coerce

# ASCII digits and white space only, as in the library's pattern (Java regex).
_NUMBER = re.compile(r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*", re.ASCII)
_INF = re.compile(r"\s*([+-]?)(inf|infinity)\s*", re.IGNORECASE | re.ASCII)


def expected_number(text):
    """The coercion rule, stated independently in Python. Non-ASCII digits
    (which Python's ``float`` would accept) are not numbers."""
    if text is None:
        return None
    if _NUMBER.fullmatch(text):
        return float(text.strip())
    m = _INF.fullmatch(text)
    if m:
        return -math.inf if m.group(1) == "-" else math.inf
    return None


number_like = st.one_of(
    st.text(alphabet="0123456789+-.eE _,xdfNaInity\t", max_size=12),
    st.from_regex(r"\s?[+-]?\d{1,6}(\.\d{0,4})?([eE][+-]?\d{1,3})?\s?", fullmatch=True),
    st.floats(allow_nan=True, allow_infinity=True).map(repr),
    st.none(),
)


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(number_like, min_size=100, max_size=300))
def test_to_number_matches_rule(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(coerce.to_number("t")).collect()]
    for text, value in zip(texts, got):
        want = expected_number(text)
        assert value == want or (value is not None and want is not None and math.isclose(value, want)), text
        assert value is None or not math.isnan(value)


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=100, max_size=300),
       st.sampled_from([2, 4, 6]))
def test_round_matches_duckdb_on_generated(spark, values, digits):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    want = [r[0] for r in con.execute(
        f"select round(x, {digits}) from (select unnest(?::double[]) as x, generate_subscripts(?::double[], 1) as i) "
        "order by i", [values, values]).fetchall()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(arith.round_half_away("v", digits)).collect()]
    for v, a, b in zip(values, got, want):
        assert a == b and math.copysign(1, a) == math.copysign(1, b), v
