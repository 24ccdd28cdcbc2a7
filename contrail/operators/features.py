"""Derived features (E1-E18) and per-group utilisation counts (H1-H3).

Scalar features are one projection. The three group counts are computed as
partial aggregations and joined back with the skew-safe helper instead of
window functions: a window over a hot key (one tail number or one airport-hour
holding a large share of rows) would put that whole group into a single task.
Day and ISO-week counts per tail number share one join back, because a day
always lies inside one ISO week.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.functions.calendar import (
    date_from_numbers, daypart, flight_date, is_peak_hour, is_weekend, iso_week, iso_year, season,
)
from contrail.functions.flags import (
    DELAY_THRESHOLD_MIN, EVENING_FROM_HOUR, LONG_DISTANCE_MILES, distance_category, flag_eq, flag_gt,
)
from contrail.functions.hhmm import hour_from_hhmm
from contrail.operators.joins import (
    DEFAULT_GROUP_BROADCAST_ROWS, DEFAULT_MAX_HOT_GROUPS, join_group_values,
)

PER_DAY = "FLIGHTS_PER_TAIL_NUMBER_PER_DAY"
PER_WEEK = "FLIGHTS_PER_TAIL_NUMBER_PER_WEEK"
CONGESTION = "ORIGIN_CONGESTION"


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def add_scalar_features(df: DataFrame) -> DataFrame:
    """E1-E15 in one projection; a missing optional input gives the documented default."""
    hhmm_src = "SCHEDULED_DEPARTURE_STR" if "SCHEDULED_DEPARTURE_STR" in df.columns else "SCHEDULED_DEPARTURE"
    parts = ("YEAR", "MONTH", "DAY")
    whole = _has(df, *parts) and all(isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType)) for c in parts)
    date = (date_from_numbers(*parts) if whole else flight_date(*parts) if _has(df, *parts)
            else F.lit(None).cast("date"))
    # Hour and date first, so every later feature reads the computed column.
    df = df.withColumns({"DEPARTURE_HOUR": hour_from_hhmm(hhmm_src), "FLIGHT_DATE": date})
    hour = F.col("DEPARTURE_HOUR")
    null_str = F.lit(None).cast("string")
    exprs = {
        "ROUTE": F.concat_ws("-", F.col("ORIGIN_AIRPORT").cast("string"),
                             F.col("DESTINATION_AIRPORT").cast("string")),
        "DAYPART": daypart(hour),
        "IS_PEAK_HOUR": is_peak_hour(hour),
        "IS_WEEKEND": is_weekend("DAY_OF_WEEK") if _has(df, "DAY_OF_WEEK") else F.lit(None).cast("boolean"),
        "SEASON": season("MONTH") if _has(df, "MONTH") else null_str,
        "IS_DELAYED_DEPARTURE": flag_gt("DEPARTURE_DELAY", DELAY_THRESHOLD_MIN),
        "IS_DELAYED_ARRIVAL": flag_gt("ARRIVAL_DELAY", DELAY_THRESHOLD_MIN),
        "TOTAL_DELAY": (F.coalesce(F.col("DEPARTURE_DELAY"), F.lit(0))
                        + F.coalesce(F.col("ARRIVAL_DELAY"), F.lit(0))).cast("double"),
        "HAS_WEATHER_DELAY": flag_gt("WEATHER_DELAY", 0) if _has(df, "WEATHER_DELAY") else F.lit(False),
        "IS_CANCELLED": flag_eq("CANCELLED", 1) if _has(df, "CANCELLED") else F.lit(False),
        "IS_DIVERTED": flag_eq("DIVERTED", 1) if _has(df, "DIVERTED") else F.lit(False),
        "DISTANCE_CATEGORY": distance_category("DISTANCE") if _has(df, "DISTANCE") else null_str,
        "ISO_YEAR": iso_year("FLIGHT_DATE"),
        "ISO_WEEK": iso_week("FLIGHT_DATE"),
    }
    return df.withColumns(exprs)


def tail_count_groups(df: DataFrame, tail: str = "TAIL_NUMBER") -> DataFrame:
    """One row per (tail, date) with that day's and that ISO week's flight counts
    (rows with a null tail or date are not counted). A day lies in one ISO week, so
    the weekly count sums the at most seven daily counts: the flights are read once."""
    keyed = df.where(F.col(tail).isNotNull() & F.col("FLIGHT_DATE").isNotNull())
    per_day = keyed.groupBy(tail, "FLIGHT_DATE").agg(F.count(F.lit(1)).alias(PER_DAY))
    week = Window.partitionBy(tail, iso_year("FLIGHT_DATE"), iso_week("FLIGHT_DATE"))
    return per_day.withColumn(PER_WEEK, F.sum(PER_DAY).over(week))


def add_tail_counts(df: DataFrame, tail: str = "TAIL_NUMBER", *, groups: DataFrame | None = None,
                    max_hot_groups: int = DEFAULT_MAX_HOT_GROUPS,
                    broadcast_max_rows: int = DEFAULT_GROUP_BROADCAST_ROWS, unread: bool = False) -> DataFrame:
    """H1 + H2: flights per tail number per day and per ISO week, on every row
    (null when the tail number or the date is null). ``groups``: a precomputed
    (already persisted) ``tail_count_groups`` table. ``unread``: the caller reads neither count."""
    if tail not in df.columns:
        return df.withColumns({PER_DAY: F.lit(None).cast("long"), PER_WEEK: F.lit(None).cast("long")})
    both = groups if groups is not None else tail_count_groups(df, tail)
    return join_group_values(df, [tail, "FLIGHT_DATE"], both, PER_DAY, [PER_DAY, PER_WEEK],
                             max_hot_groups=max_hot_groups,
                             broadcast_max_rows=broadcast_max_rows, persist_groups=groups is None, unread=unread)


CONGESTION_KEYS = ["ORIGIN_AIRPORT", "FLIGHT_DATE", "DEPARTURE_HOUR"]


def congestion_groups(df: DataFrame) -> DataFrame:
    """One row per (origin, date, hour) with its departure count."""
    keyed = df.where(F.col("ORIGIN_AIRPORT").isNotNull() & F.col("FLIGHT_DATE").isNotNull()
                     & F.col("DEPARTURE_HOUR").isNotNull())
    return keyed.groupBy(*CONGESTION_KEYS).agg(F.count(F.lit(1)).alias(CONGESTION))


def add_origin_congestion(df: DataFrame, *, groups: DataFrame | None = None,
                          max_hot_groups: int = DEFAULT_MAX_HOT_GROUPS,
                          broadcast_max_rows: int = DEFAULT_GROUP_BROADCAST_ROWS, unread: bool = False) -> DataFrame:
    """H3: departures per origin airport per date per scheduled hour. ``unread``: the caller does not read them."""
    g = groups if groups is not None else congestion_groups(df)
    return join_group_values(df, CONGESTION_KEYS, g, CONGESTION, [CONGESTION],
                             max_hot_groups=max_hot_groups,
                             broadcast_max_rows=broadcast_max_rows, persist_groups=groups is None, unread=unread)


def add_features(df: DataFrame, **skew) -> DataFrame:
    """All 19 feature columns of the feature stage."""
    return (df.transform(add_scalar_features)
            .transform(add_tail_counts, **skew)
            .transform(add_origin_congestion, **skew))


def add_model_features(df: DataFrame) -> DataFrame:
    """IS_LONG_DISTANCE (> 1500 mi), IS_EVENING (hour >= 18), HAS_DELAY_CAUSE
    (any of airline / weather / air-system / late-aircraft minutes > 0), as int 0/1."""
    cause = None
    for c in S.DELAY_CAUSE_FLAG_COLS:
        part = F.col(c) > 0
        cause = part if cause is None else (cause | part)
    return df.withColumns({
        "IS_LONG_DISTANCE": F.when(F.col("DISTANCE") > LONG_DISTANCE_MILES, 1).otherwise(0),
        "IS_EVENING": F.when(F.col("DEPARTURE_HOUR") >= EVENING_FROM_HOUR, 1).otherwise(0),
        "HAS_DELAY_CAUSE": F.when(cause, 1).otherwise(0),
    })
