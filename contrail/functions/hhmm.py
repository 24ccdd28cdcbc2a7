"""HHMM clock-time helpers (0000-2359, with 2400 used as a midnight code)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail.functions.text import HHMM_PATTERN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(c: str | Column, width: int) -> Column:
    """Left-pad with zeros to ``width`` like ``str.zfill``.

    Never shortens (``lpad`` would cut '12345' to '1234') and keeps a leading
    sign in front of the zeros ('-5' -> '-005'). Null stays null.
    """
    s = _col(c).cast("string")
    signed = s.startswith("-") | s.startswith("+")
    return (
        F.when(F.length(s) >= width, s)
        .when(signed, F.concat(F.substring(s, 1, 1), F.lpad(F.substring(s, 2, width), width - 1, "0")))
        .otherwise(F.lpad(s, width, "0"))
    )


def hhmm_normalise(c: str | Column) -> Column:
    """Coerce to a number (bad text -> null), map 2400 to 0 (same day), make it an int."""
    v = _col(c).try_cast("double")
    v = F.nanvl(v, F.lit(None).cast("double"))
    v = F.when(v == 2400, F.lit(0.0)).otherwise(v)
    return v.try_cast("int")


def hhmm_string(c: str | Column) -> Column:
    """Four-character HHMM text of an integer time ('5' -> '0005', '-5' -> '-005',
    longer values unchanged); null stays null."""
    return zfill(_col(c).cast("int"), 4)


def is_hhmm(c: str | Column) -> Column:
    """True when the text is a valid 24-hour HHMM clock time."""
    return _col(c).rlike(HHMM_PATTERN)


def hour_from_hhmm(c: str | Column, default: int | None = None) -> Column:
    """Hour 0-23 of an HHMM value given as text or number, else null (or ``default``).

    Strips a trailing '.0' (a float written as text), pads to four characters,
    requires exactly four digits and an hour of 0-23.
    """
    # After zero-padding, "exactly four digits" means "at most four digits" before
    # padding, and the first two padded digits are the value divided by 100.
    s = _col(c).cast("string")
    s = F.when(s.contains("."), F.regexp_replace(s, r"\.0+$", "")).otherwise(s)  # only few texts need the pattern
    hour = F.when(s.rlike(r"^\d{0,4}$"), F.coalesce(s.try_cast("int"), F.lit(0)) / 100).cast("int")
    hour = F.when(hour <= 23, hour)
    if default is not None:
        hour = F.coalesce(hour, F.lit(int(default)))
    return hour
