"""Cleaning transforms (C1, D1-D11). Each is ``DataFrame -> DataFrame``.

All rewrites are single ``withColumns`` projections, so a chain of them fuses
into one whole-stage-codegen step with the scan; only the airport-code filter
joins, and it joins a broadcast key set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.hhmm import hhmm_normalise, hhmm_string
from contrail.functions.text import DIGIT_PATTERN
from contrail.operators.joins import DEFAULT_BROADCAST_ROWS, lookup_join, semi_join
from contrail.sources.files import lookup_keys

STR_SUFFIX = "_STR"


def clean_times(df: DataFrame, cols: Sequence[str] = S.TIME_COLS) -> DataFrame:
    """Coerce HHMM columns to int (bad text -> null), 2400 -> 0, and add a
    zero-padded four-character ``<col>_STR`` twin."""
    present = [c for c in cols if c in df.columns]
    out = df.withColumns({c: hhmm_normalise(c) for c in present})
    return out.withColumns({c + STR_SUFFIX: hhmm_string(c) for c in present})


def null_when_cancelled(df: DataFrame, cols: Sequence[str] = S.NA_WHEN_CANCELLED,
                        cancelled: str = "CANCELLED") -> DataFrame:
    """Set the not-applicable columns (and their existing ``_STR`` twins) to
    null on cancelled flights. WHEELS_OFF and the scheduled times are kept."""
    is_cancelled = F.coalesce(F.col(cancelled) == 1, F.lit(False))
    targets = [c for c in cols if c in df.columns]
    targets += [c + STR_SUFFIX for c in cols if c + STR_SUFFIX in df.columns]
    return df.withColumns({c: F.when(~is_cancelled, F.col(c)) for c in targets})


def codes_as_text(df: DataFrame, cols: Sequence[str] = S.CODE_COLS) -> DataFrame:
    """Code columns as strings (null stays null)."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols if c in df.columns})


def fill_cancellation_reason(df: DataFrame, reason: str = "CANCELLATION_REASON",
                             cancelled: str = "CANCELLED", not_cancelled: str = "NC") -> DataFrame:
    """Reason 'NC' for every flight not cancelled and for missing reasons."""
    return df.withColumn(
        reason,
        F.when(F.col(cancelled) == 0, F.lit(not_cancelled))
        .otherwise(F.coalesce(F.col(reason), F.lit(not_cancelled))),
    )


def clean_delay_causes(df: DataFrame, cols: Sequence[str] = S.DELAY_CAUSE_COLS) -> DataFrame:
    """Blank / 'ND' / non-numeric / missing -> 0, then whole minutes (int,
    truncated toward zero)."""
    exprs = {}
    for c in cols:
        if c not in df.columns:
            continue
        # Text without a digit (blank, 'ND', 'NaN', 'Infinity') gives 0. It is not cast: each failing cast raises and
        # catches a Java exception, which costs more than all other rules of the row.
        raw = F.col(c).cast("string")
        text = F.when(raw.rlike(DIGIT_PATTERN), raw)
        v = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
        exprs[c] = F.coalesce(v.try_cast("int"), F.lit(0))
    return df.withColumns(exprs)


def keep_valid_airports(df: DataFrame, airports: DataFrame, origin: str = "ORIGIN_AIRPORT",
                        destination: str = "DESTINATION_AIRPORT", key: str = "IATA_CODE",
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Keep rows whose origin AND destination codes are in the airport lookup
    (two semi joins against the broadcast key set; null codes are dropped)."""
    keys = lookup_keys(airports, key)
    out = semi_join(df, origin, keys, key, max_broadcast_rows=max_broadcast_rows)
    return semi_join(out, destination, keys, key, max_broadcast_rows=max_broadcast_rows)


def flag_valid_airports(df: DataFrame, airports: DataFrame, name: str = "keep", origin: str = "ORIGIN_AIRPORT",
                        destination: str = "DESTINATION_AIRPORT", key: str = "IATA_CODE",
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """C1 as a flag: all rows, with whether ``keep_valid_airports`` keeps them (one pass, no filter)."""
    out = df
    for i, col in enumerate((origin, destination)):
        keys = lookup_keys(airports, key).select(F.col(key).alias(col), F.lit(True).alias(f"__ok{i}"))
        out = lookup_join(out, keys, [col], "left", max_broadcast_rows)
    ok = F.coalesce(F.col("__ok0"), F.lit(False)) & F.coalesce(F.col("__ok1"), F.lit(False))
    return out.withColumn(name, ok).drop("__ok0", "__ok1")


def patch_coordinates(df: DataFrame, patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES,
                      roles: Sequence[str] = ("ORIGIN", "DESTINATION")) -> DataFrame:
    """Overwrite LAT/LON for the listed airport codes, on both roles,
    unconditionally (a literal map lookup; no join)."""
    if not patches:
        return df
    lat_map = F.create_map(*[x for code, (lat, _) in patches.items() for x in (F.lit(code), F.lit(float(lat)))])
    lon_map = F.create_map(*[x for code, (_, lon) in patches.items() for x in (F.lit(code), F.lit(float(lon)))])
    exprs = {}
    for role in roles:
        code = F.col(f"{role}_AIRPORT")
        hit = code.isin(list(patches))
        exprs[f"{role}_LAT"] = F.when(hit, F.try_element_at(lat_map, code)).otherwise(F.col(f"{role}_LAT"))
        exprs[f"{role}_LON"] = F.when(hit, F.try_element_at(lon_map, code)).otherwise(F.col(f"{role}_LON"))
    return df.withColumns(exprs)


def clean_rows(raw: DataFrame) -> DataFrame:
    """The row-level rules alone, all rows kept: times, cancelled N/A, codes, cancellation reason, delay causes."""
    return (raw.transform(clean_times).transform(null_when_cancelled).transform(codes_as_text)
            .transform(fill_cancellation_reason).transform(clean_delay_causes))


def clean_flights(raw: DataFrame, airports: DataFrame,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Row-level cleaning and the airport-code filter (which reads no cleaned value, so their order is free)."""
    return keep_valid_airports(clean_rows(raw), airports, max_broadcast_rows=max_broadcast_rows)
