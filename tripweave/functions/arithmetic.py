"""Ratios that turn a zero divisor into NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column | str, whole: Column | str, digits: int | None = None) -> Column:
    """``part / whole``, NULL where the divisor is zero, rounded half-up if asked."""
    quotient = F.try_divide(_col(part), _col(whole))
    return quotient if digits is None else F.round(quotient, digits)


def percent(part: Column | str, whole: Column | str, digits: int | None = 2) -> Column:
    """``part`` as a percentage of ``whole``."""
    share = ratio(part, whole) * 100
    return share if digits is None else F.round(share, digits)


def percent_change(now: Column | str, base: Column | str) -> Column:
    """Relative change from ``base`` to ``now`` in percent, two decimals."""
    return percent(_col(now) - _col(base), base)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
