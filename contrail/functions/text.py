"""Text screening helpers (junk characters, blanks, digit-only codes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Patterns of the data-quality checks
# ---------------------------------------------------------------------------
# Valid 24-hour clock time, HHMM.
HHMM_PATTERN = r"^([01][0-9]|2[0-3])[0-5][0-9]$"
# ASCII control characters.
CONTROL_CHARS_PATTERN = r"[\x00-\x1F\x7F]"
# One character outside letters, digits, white space, '-', '.', '/'.
# (?U) makes \s Unicode-aware, so a no-break space counts as white space.
SPECIAL_CHAR_PATTERN = r"(?U)[^a-zA-Z0-9\s\-\./]"
# At least one ASCII digit.
DIGIT_PATTERN = "[0-9]"
# A code made of digits only.
DIGITS_ONLY_PATTERN = r"^\d+$"
# Empty or white space only.
BLANK_PATTERN = r"(?U)^\s*$"
# More than this many special characters marks a value as junk.
MAX_SPECIAL_CHARS = 5


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_control_chars(c: str | Column) -> Column:
    return _col(c).cast("string").rlike(CONTROL_CHARS_PATTERN)


def special_char_count(c: str | Column) -> Column:
    return F.regexp_count(_col(c).cast("string"), F.lit(SPECIAL_CHAR_PATTERN))


def is_digits_only(c: str | Column) -> Column:
    return _col(c).cast("string").rlike(DIGITS_ONLY_PATTERN)


def is_blank(c: str | Column) -> Column:
    return _col(c).cast("string").rlike(BLANK_PATTERN)


# SQL-text forms of the same screens, for reports that build many expressions at
# once (one JVM call per expression instead of one per Column operation).
def sql_ident(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def sql_regex(pattern: str) -> str:
    """A raw SQL string literal holding ``pattern``."""
    assert "'" not in pattern
    return f"r'{pattern}'"


def control_chars_sql(c: str) -> str:
    return f"CAST({sql_ident(c)} AS STRING) RLIKE {sql_regex(CONTROL_CHARS_PATTERN)}"


def special_char_count_sql(c: str) -> str:
    return f"regexp_count(CAST({sql_ident(c)} AS STRING), {sql_regex(SPECIAL_CHAR_PATTERN)})"


def digits_only_sql(c: str) -> str:
    return f"CAST({sql_ident(c)} AS STRING) RLIKE {sql_regex(DIGITS_ONLY_PATTERN)}"


def blank_sql(c: str) -> str:
    return f"CAST({sql_ident(c)} AS STRING) RLIKE {sql_regex(BLANK_PATTERN)}"


def hhmm_sql(c: str) -> str:
    return f"{sql_ident(c)} RLIKE {sql_regex(HHMM_PATTERN)}"
