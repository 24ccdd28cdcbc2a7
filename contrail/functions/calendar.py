"""Calendar and clock features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Day parts (inclusive hour ranges), peak hours, weekend days, seasons
# ---------------------------------------------------------------------------
DAYPARTS = [(0, 5, "Night"), (6, 11, "Morning"), (12, 17, "Afternoon"), (18, 23, "Evening")]
PEAK_HOURS = [(6, 9), (16, 19)]
WEEKEND_DAYS = [6, 7]  # DAY_OF_WEEK with 1 = Monday
SEASONS = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Fall", 10: "Fall", 11: "Fall",
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def daypart(hour: str | Column) -> Column:
    """Night / Morning / Afternoon / Evening; null for a null or out-of-range hour."""
    h = _col(hour)
    expr = None
    for lo, hi, label in DAYPARTS:
        expr = (F.when if expr is None else expr.when)(h.between(lo, hi), F.lit(label))
    return expr


def is_peak_hour(hour: str | Column) -> Column:
    h = _col(hour)
    cond = None
    for lo, hi in PEAK_HOURS:
        part = h.between(lo, hi)
        cond = part if cond is None else (cond | part)
    return F.coalesce(cond, F.lit(False))


def is_weekend(day_of_week: str | Column) -> Column:
    return F.coalesce(_col(day_of_week).isin(WEEKEND_DAYS), F.lit(False))


def season(month: str | Column) -> Column:
    m = _col(month)
    expr = None
    for k, label in SEASONS.items():
        expr = (F.when if expr is None else expr.when)(m == k, F.lit(label))
    return expr


def flight_date(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """Calendar date from parts; an impossible date (Feb 31) gives null, not an error."""
    text = F.concat_ws("-", _col(year).cast("string"), _col(month).cast("string"), _col(day).cast("string"))
    return F.try_to_date(text, "yyyy-M-d")


def date_from_numbers(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """``flight_date`` of integer parts, by arithmetic: no text is made and parsed, and no exception thrown, per row."""
    y, m, d = _col(year).cast("int"), _col(month).cast("int"), _col(day).cast("int")
    four = y.between(1000, 9999) | y.between(-9999, -1000)  # years of four digits, as in the text
    date = F.when(four & m.between(1, 12) & d.between(1, 31), F.date_add(F.make_date(y, m, F.lit(1)), d - 1))
    return F.when(F.month(date) == m, date)  # day 31 of a shorter month is a day of the next one


def iso_year(d: str | Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(d)).cast("int")


def iso_week(d: str | Column) -> Column:
    return F.weekofyear(_col(d)).cast("int")
