"""Guarded arithmetic and rounding as native column expressions.

Spark runs in ANSI mode, where ``x / 0.0`` raises; every division here is guarded
so it can only run on a non-zero divisor. ``pct_change_ieee`` reproduces IEEE
results explicitly (x/0 → ±inf, 0/0 → NULL), because a NaN must never reach an
output table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POS_INF = float("inf")
NEG_INF = float("-inf")
_EXACT_INTEGER = 2.0 ** 52


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(n: Column | str, d: Column | str) -> Column:
    """n / d when d > 0, else NULL."""
    n, d = _col(n), _col(d)
    return F.when(d > 0, _no_nan(n / d))


def both_positive_ratio(n: Column | str, d: Column | str) -> Column:
    """n / d when both are > 0, else NULL."""
    n, d = _col(n), _col(d)
    return F.when((n > 0) & (d > 0), _no_nan(n / d))


def change_fraction(current: Column | str, previous: Column | str) -> Column:
    """(current - previous) / previous when previous > 0, else NULL."""
    c, p = _col(current), _col(previous)
    return F.when(p > 0, _no_nan((c - p) / p))


def _no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def guarded_pct_change(latest: Column | str, previous: Column | str) -> Column:
    """Percent change, NULL unless previous > 0 and never NaN (inf → inf is NULL)."""
    l, p = _col(latest), _col(previous)
    return F.when(p > 0, _no_nan((l - p) / p * 100))


def pct_change_ieee(latest: Column | str, previous: Column | str) -> Column:
    """Percent change with IEEE semantics: x/0 → ±inf, 0/0 and inf → inf → NULL, NULL in → NULL."""
    l, p = _col(latest), _col(previous)
    return (
        F.when(p == 0, F.when(l > 0, F.lit(POS_INF)).when(l < 0, F.lit(NEG_INF)))
        .otherwise(_no_nan((l - p) / p * 100))
    )


def abs_distance(c: Column | str, target: float) -> Column:
    return F.abs(_col(c) - F.lit(float(target)))


def round_half_away(c: Column | str, digits: int) -> Column:
    """Round a DOUBLE to ``digits`` decimals the binary way: round(x * 10^d) / 10^d,
    halves away from zero, sign of zero kept.

    ``F.round`` rounds the *decimal text* of the double (1.005 → 1.01) and drops
    the sign of zero; this form works on the binary value (1.005 → 1.0), which is
    what the report definitions produce. When the scaled value overflows the input
    is returned unchanged.
    """
    x = _col(c)
    m = float(10 ** digits)
    a = x * F.lit(m)
    aa = F.abs(a)
    whole = F.floor(aa).cast("double")
    rounded_abs = F.when(aa - whole >= 0.5, whole + 1.0).otherwise(whole)
    rounded = F.when(aa >= F.lit(_EXACT_INTEGER), a).otherwise(F.signum(a) * rounded_abs)
    out = rounded / F.lit(m)
    return F.when(F.isnan(out) | (F.abs(out) == F.lit(POS_INF)), x).otherwise(out)
