"""Numeric helpers with engine-independent results.

ANSI mode stays on: ratios go through ``try_divide`` (NULL instead of an error),
and rounding goes through DECIMAL so half-up is applied to the decimal value,
not to the nearest binary double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(col, digits: int) -> Column:
    """ROUND(x, digits) half away from zero on the decimal value of ``x``, as DOUBLE.

    A finite value beyond DECIMAL(38,12) has no such digits and stays as it is;
    NaN and the infinities become NULL.
    """
    c = _c(col)
    return F.coalesce(F.round(c.try_cast("decimal(38,12)"), digits).cast("double"), F.when(is_finite(c), c))


def round6(col) -> Column:
    """Six-digit rounding used on averages, deviations and correlations, whose
    last bits depend on summation order."""
    return round_half_up(col, 6)


def pct(num, den, digits: int = 2) -> Column:
    """ROUND(num::numeric / den * 100, digits) with exact decimal arithmetic.

    The quotient keeps 18 decimals, so half-up at ``digits`` is decided on the
    true ratio for any realistic count. NULL when ``den`` is 0.
    """
    n = (_c(num).cast("decimal(20,0)") * F.lit(100)).cast("decimal(38,18)")
    d = _c(den).cast("decimal(20,0)")
    return F.round(F.try_divide(n, d), digits).cast("double")


def is_finite(col) -> Column:
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c) & (c != F.lit(float("inf"))) & (c != F.lit(float("-inf")))


def clamp(col, lo, hi) -> Column:
    """Keep a reading within its bounds (``least(greatest(x, lo), hi)``)."""
    return F.least(F.greatest(_c(col), _c(lo)), _c(hi))


def corr_from_moments(n, sx, sy, sxx, syy, sxy) -> Column:
    """Pearson correlation from co-moment sums; NULL when either side is constant.

    Used where the pairs are summarised before they are formed (see
    ``operators.timeseries.sensor_correlation``).
    """
    n, sx, sy, sxx, syy, sxy = map(_c, (n, sx, sy, sxx, syy, sxy))
    cov = n * sxy - sx * sy
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    den = F.sqrt(F.when((vx > 0) & (vy > 0), vx * vy))
    return F.try_divide(cov, den)


__all__ = ["round_half_up", "round6", "pct", "is_finite", "clamp", "corr_from_moments"]
