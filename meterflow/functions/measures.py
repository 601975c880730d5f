"""Exact volume arithmetic.

Volumes are summed as integers of 10^-scale kL (scale 4 by default: the
feeds carry at most 4 decimals). Integer sums are order independent, so the
same input always gives bit-identical totals whatever the partitioning, and
they stay on Spark's fast long-aggregation path (a decimal(28,4) sum would
fall back to BigDecimal arithmetic).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCALE = 4


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Volumes below this many kL are summed as longs, larger ones as decimals.
LARGE = 1e9


def to_units(x: Column | str, scale: int = DEFAULT_SCALE) -> Column:
    """Volume -> whole number of 10^-scale units (bigint); NULL where it doesn't fit.

    ``rint`` (a plain double op, no BigDecimal per row) is exact for inputs
    with at most ``scale`` decimals. For sums over data that may hold anything
    use ``exact_sum_units``; ``volume_fault`` names what neither can take.
    """
    return F.rint(_c(x).cast("double") * float(10**scale)).try_cast("long")


def volume_fault(x: Column | str, scale: int = DEFAULT_SCALE) -> Column:
    """Why a volume isn't summed as it stands, else NULL.

    ``missing`` (NULL), ``not_finite`` (NaN or infinite) and ``too_large`` stay
    out of sums; ``rounded`` has more than ``scale`` decimals and is summed to
    the nearest unit. Every volume is summed or has a fault that is counted
    (``rejected_readings``, the quality rules).
    """
    v = _c(x).cast("double")
    u = v * float(10**scale)
    return (F.when(v.isNull(), "missing")
            .when(F.isnan(v) | (F.abs(v) == float("inf")), "not_finite")
            .when(v.try_cast(f"decimal(38,{scale})").isNull(), "too_large")
            # A double of up to LARGE is nearer to its decimals than this.
            .when((F.abs(v) < LARGE) & (F.abs(u - F.rint(u)) > F.abs(u) * 1e-12 + 1e-9), "rounded"))


def exact_sum_units(x: Column | str, scale: int = DEFAULT_SCALE, when: Column | None = None) -> Column:
    """Aggregate: exact sum of volumes in 10^-scale units, as decimal(38,0); NULL if there is none.

    Usual volumes are summed as longs; larger ones, which would overflow, as
    decimals. With ``when``, rows where it isn't true count 0.
    """
    v = _c(x).cast("double")
    small, large = F.abs(v) < LARGE, F.abs(v) >= LARGE
    units = to_units(v, scale)
    wide = (v.try_cast(f"decimal(38,{scale})") * F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast("decimal(38,0)")
    usual, rest = F.when(small, units), F.when(large, wide)
    if when is not None:
        usual, rest = F.when(when, usual).otherwise(F.lit(0).cast("long")), F.when(when, rest)
    total = F.sum(usual).cast("decimal(38,0)")
    return F.coalesce(total + F.coalesce(F.sum(rest).cast("decimal(38,0)"), F.lit(0)), F.sum(rest)).cast("decimal(38,0)")


def units_to_volume(u: Column | str, scale: int = DEFAULT_SCALE) -> Column:
    """Whole 10^-scale units -> kL as double, rounded once, whatever their size."""
    c = _c(u)
    wide = c.cast("decimal(38,0)")
    exact = (wide * F.lit(Decimal(1).scaleb(-scale))).cast("double")
    return F.when(F.abs(wide) <= F.lit(2**53), c.cast("double") / float(10**scale)).otherwise(exact)


def half_up_quotient(num: Column | str, den: Column | str) -> Column:
    """Integer nearest to num / den, halves away from zero, for integral
    num and den (decimal(38,0) arithmetic, exact); NULL when den is 0 or NULL.

    (2|n| + d) - pmod(2|n| + d, 2d) is an exact multiple of 2d, so the
    decimal division below has an integral, exact result.
    """
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    a = F.abs(n) * F.lit(2) + d
    b = d * F.lit(2)
    q = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    return F.when(d > 0, F.when(n < 0, -q).otherwise(q))


def exact_ratio(num: Column | str, den: Column | str, decimals: int, pow10: int = 0) -> Column:
    """round(num * 10^pow10 / den, decimals) computed exactly, as double.

    num and den are integers (e.g. unit sums and counts); ``pow10`` moves the
    decimal point (2 for a percentage, -4 for a sum kept in 10^-4 units).
    Rounding is half away from zero on the exact rational value, so every
    engine that does the same integer arithmetic gets the same double.
    """
    k = decimals + pow10
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    if k >= 0:
        q = half_up_quotient(n * F.lit(10**k).cast("decimal(38,0)"), d)
    else:
        q = half_up_quotient(n, d * F.lit(10 ** (-k)).cast("decimal(38,0)"))
    return q.cast("double") / float(10**decimals)


def ratio(num: Column | str, den: Column | str, decimals: int | None = None) -> Column:
    """num / den as double; NULL when den is 0 or NULL (never raises under ANSI).

    With ``decimals`` and integral inputs use ``exact_ratio`` instead.
    """
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.round(r, decimals) if decimals is not None else r


def pct(num: Column | str, den: Column | str, decimals: int | None = None) -> Column:
    """100 * num / den; NULL on zero denominator."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double")) * 100.0
    return F.round(r, decimals) if decimals is not None else r


def exact_mean(x: Column | str, decimals: int | None = None, scale: int = 6) -> Column:
    """Aggregate: mean of the finite values (NULL, NaN and infinities are skipped).

    Without ``decimals``: a plain ``avg``. With it: values are taken as whole
    10^-scale units (exact for inputs with at most ``scale`` decimals),
    summed as integers and divided with ``exact_ratio``, so the rounded mean
    is exact and independent of summation order. The unit sum must stay
    below 2^63 (``scale`` 4 for volumes, 6 for percentages).
    """
    v = finite(x)
    if decimals is None:
        return F.avg(v)
    # Sum and count are of the same rows.
    units = F.rint(v * float(10**scale)).try_cast("long")
    return exact_ratio(F.sum(units), F.count(units), decimals, -scale)


def finite(x: Column | str) -> Column:
    """The value as double; NULL for NaN and infinities."""
    v = _c(x).cast("double")
    return F.when(F.abs(v) < float("inf"), v)
