"""Boolean flags, bins and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Delay threshold (minutes, strict >) and distance bins (miles, [lo, hi))
# ---------------------------------------------------------------------------
DELAY_THRESHOLD_MIN = 15
DISTANCE_BINS = [(0, 500, "short_haul"), (500, 1500, "medium_haul"), (1500, None, "long_haul")]
LONG_DISTANCE_MILES = 1500  # IS_LONG_DISTANCE uses a strict >
EVENING_FROM_HOUR = 18


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_gt(c: str | Column, threshold: float) -> Column:
    """``c > threshold`` with null read as false."""
    return F.coalesce(_col(c) > F.lit(threshold), F.lit(False))


def flag_eq(c: str | Column, value) -> Column:
    """``c == value`` with null read as false."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))


def as_int(c: str | Column) -> Column:
    """Boolean (or 0/1) as int 0/1, null as 0."""
    return F.coalesce(_col(c).cast("int"), F.lit(0))


def distance_category(c: str | Column) -> Column:
    """short/medium/long haul on [0,500), [500,1500), [1500,inf); negative or null -> null."""
    d = _col(c)
    expr = None
    for lo, hi, label in DISTANCE_BINS:
        cond = d >= lo if hi is None else ((d >= lo) & (d < hi))
        expr = (F.when if expr is None else expr.when)(cond, F.lit(label))
    return expr


def rate(flag: str | Column, digits: int = 4) -> Column:
    """Share of rows where ``flag`` is set, over all rows of the group, rounded."""
    return F.round(F.sum(as_int(flag)) / F.count(F.lit(1)), digits)
