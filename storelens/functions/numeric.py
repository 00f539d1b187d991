"""Exact ratios and means with half-up (away from zero) rounding.

Rounding a binary double at a decimal digit is ambiguous: 1.005 is stored as
1.00499999..., and engines disagree on which side it falls.  The helpers
below keep the operands as integers (counts, or money in cents) and round the
exact rational ``factor * num / den`` with integral division, so every engine
that rounds half away from zero gets the same digits.  The result is a
double, as in the source dialect (BigQuery FLOAT64).

All of it is built from JVM-side expressions (``div``, ``abs``, ``when``):
no Python UDF in the hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def cents(money, scale: int = 2) -> Column:
    """Decimal money (``scale`` fraction digits) as an integral bigint of its
    smallest unit; exact because the decimal has exactly ``scale`` digits."""
    return (_c(money) * (10 ** scale)).cast("bigint")


_LOW_BITS = 20


def wide_sum(units) -> Column:
    """SUM of a bigint as decimal(38,0) that no number of rows overflows.

    The values' high and low parts are summed apart, each as a primitive bigint
    (partial sums stay in generated code; the low parts alone would need 2^43 rows
    to overflow), and put together once per group.
    """
    u = _c(units).cast("bigint")
    high = F.sum(F.shiftright(u, _LOW_BITS)).cast("decimal(38,0)")
    low = F.sum(u.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    return (high * F.lit(1 << _LOW_BITS).cast("decimal(10,0)") + low.cast("decimal(20,0)")).cast("decimal(38,0)")


def money_sum(money, scale: int = 2) -> Column:
    """SUM of decimal money in minor units (cents), as decimal(38,0); exact."""
    return wide_sum(cents(money, scale))


def from_cents(units, scale: int = 2) -> Column:
    """Minor units back to ``decimal(38, scale)`` money (exact)."""
    return (_c(units).cast("decimal(38,0)") / (10 ** scale)).cast(f"decimal(38,{scale})")


def half_up_ratio(num, den, scale: int, factor: int = 1, on_zero: str = "null",
                  as_decimal: bool = False) -> Column:
    """round_half_up(factor * num / den, scale) for integral ``num``/``den``
    (``den`` >= 0).

    NULL if either side is NULL.  A zero ``den`` gives NULL
    (``on_zero="null"``, MySQL) or fails the query (``on_zero="error"``,
    BigQuery / ANSI).  The result is a double, or an exact
    ``decimal(38, scale)`` with ``as_decimal``.
    """
    # decimal(38,0): sums and their multiples stay exact far beyond 64 bits; only
    # the rounded quotient has to fit a bigint
    n, d = _c(num).cast("decimal(38,0)"), _c(den).cast("decimal(38,0)")
    p = 10 ** scale
    scaled = (F.abs(n) * F.lit(2 * p * factor).cast("decimal(18,0)")).cast("decimal(38,0)") + d
    q = F.call_function("div", scaled.cast("decimal(38,0)"), (d + d).cast("decimal(38,0)"))
    signed = F.when(n < 0, -q).otherwise(q)
    value = (signed.cast(f"decimal(38,{scale})") / p).cast(f"decimal(38,{scale})") \
        if as_decimal else signed.cast("double") / p
    if on_zero == "error":
        return F.when(d == 0, F.raise_error(F.lit("[DIVIDE_BY_ZERO] Division by zero"))
                      .cast("double" if not as_decimal else f"decimal(38,{scale})")
                      ).otherwise(value)
    return F.when(d != 0, value)


def exact_mean(total, count, scale: int, unit_scale: int = 0,
               as_decimal: bool = False) -> Column:
    """Mean ``total / count`` rounded half-up to ``scale`` digits.

    ``total`` is an integral sum expressed in units of ``10**-unit_scale``
    (e.g. cents with ``unit_scale=2``).  NULL when ``count`` is 0, like AVG
    over no rows.
    """
    d = (_c(count).cast("decimal(38,0)") * F.lit(10 ** unit_scale).cast("decimal(18,0)")).cast("decimal(38,0)")
    return half_up_ratio(total, d, scale, as_decimal=as_decimal)


def percent(num, den, scale: int, on_zero: str = "null") -> Column:
    """round_half_up(100 * num / den, scale)."""
    return half_up_ratio(num, den, scale, factor=100, on_zero=on_zero)
