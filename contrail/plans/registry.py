"""Registered queries: name -> (Spark builder, oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
flight-shaped views of ``sf_dir``; building it may already run jobs and write
intermediate tables (the views, group tables, size checks). Each oracle is DuckDB
SQL over the same parquet tables. Column names match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import cleaning as C
from contrail.operators import enrich as E
from contrail.operators import features as FT
from contrail.operators import incremental as INC
from contrail.operators import reports as R
from contrail.plans import oracle as O
from contrail.plans import sql_layer as SQ
from contrail.plans.pipeline import fixture_enriched, fixture_features, fixture_frames
from contrail.session import scratch_path

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

# Row identity of a flight-shaped view row.
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_K = ", ".join(KEYS)

# Reports that use no per-group count read the persisted stage-1 table; stage 2
# only appends the count columns (row-preserving left joins), so the rows are
# the same and the smoke check does not have to build stage 2.

# Report thresholds of the analysed pipeline, and of the second runs in which they bite on small inputs.
ORIGIN_MIN_FLIGHTS, ORIGIN_BUSY_FLIGHTS = 500, 3000
ROUTE_MIN_FLIGHTS, ROUTE_BUSY_FLIGHTS = 300, 50


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.bigint_counts(sql)
        return fn
    return deco


# ---------------------------------------------------------------------------
# Descriptive reports
# ---------------------------------------------------------------------------

@register("executive_snapshot", O.with_stages(f"""
SELECT COUNT(*) AS total_flights,
  {O.rate_sql('IS_DELAYED_ARRIVAL')} AS overall_arrival_delay_rate,
  {O.rate_sql('CANCELLED')} AS overall_cancel_rate,
  ROUND(AVG(ARRIVAL_DELAY), 2) AS avg_arrival_delay_minutes
FROM feat"""))
def q_executive_snapshot(spark, sf):
    return R.executive_snapshot(fixture_enriched(spark, sf))


@register("airline_performance", O.with_stages(f"""
SELECT AIRLINE, COUNT(*) AS total_flights,
  {O.rate_sql('IS_DELAYED_ARRIVAL')} AS arrival_delay_rate,
  {O.rate_sql('IS_DELAYED_DEPARTURE')} AS departure_delay_rate,
  {O.rate_sql('CANCELLED')} AS cancel_rate,
  ROUND(AVG(ARRIVAL_DELAY), 2) AS avg_arrival_delay
FROM feat GROUP BY AIRLINE ORDER BY arrival_delay_rate DESC, AIRLINE"""))
def q_airline_performance(spark, sf):
    return R.airline_performance(fixture_enriched(spark, sf))


def _congestion_sql(min_flights: int) -> str:
    return O.with_stages(f"""
SELECT ORIGIN_AIRPORT, COUNT(*) AS total_flights,
  {O.rate_sql('IS_DELAYED_ARRIVAL')} AS delay_rate,
  {O.rate_sql('CANCELLED')} AS cancel_rate,
  ROUND(AVG(ORIGIN_CONGESTION), 2) AS avg_congestion
FROM feat GROUP BY ORIGIN_AIRPORT HAVING COUNT(*) > {min_flights}
ORDER BY delay_rate DESC, ORIGIN_AIRPORT LIMIT 20""")


@register("airport_congestion", _congestion_sql(ORIGIN_MIN_FLIGHTS))
def q_airport_congestion(spark, sf):
    return R.airport_congestion(fixture_features(spark, sf, reads=[FT.CONGESTION]), min_flights=ORIGIN_MIN_FLIGHTS)


@register("airport_congestion_busy", _congestion_sql(ORIGIN_BUSY_FLIGHTS))
def q_airport_congestion_busy(spark, sf):
    return R.airport_congestion(fixture_features(spark, sf, reads=[FT.CONGESTION]), min_flights=ORIGIN_BUSY_FLIGHTS)


@register("monthly_trend", O.with_stages(f"""
SELECT MONTH, {O.rate_sql('IS_DELAYED_ARRIVAL')} AS delay_rate, {O.rate_sql('CANCELLED')} AS cancel_rate
FROM feat GROUP BY MONTH ORDER BY MONTH"""))
def q_monthly_trend(spark, sf):
    return R.monthly_trend(fixture_enriched(spark, sf))


@register("hourly_trend", O.with_stages(f"""
SELECT DEPARTURE_HOUR, {O.rate_sql('IS_DELAYED_ARRIVAL')} AS delay_rate
FROM feat GROUP BY DEPARTURE_HOUR ORDER BY DEPARTURE_HOUR"""))
def q_hourly_trend(spark, sf):
    return R.hourly_trend(fixture_enriched(spark, sf))


def _route_sql(min_flights: int) -> str:
    return O.with_stages(f"""
SELECT ROUTE, COUNT(*) AS total_flights,
  {O.rate_sql('IS_DELAYED_ARRIVAL')} AS delay_rate, {O.rate_sql('CANCELLED')} AS cancel_rate
FROM feat GROUP BY ROUTE HAVING COUNT(*) > {min_flights}
ORDER BY delay_rate DESC, ROUTE LIMIT 20""")


@register("route_bottlenecks", _route_sql(ROUTE_MIN_FLIGHTS))
def q_route_bottlenecks(spark, sf):
    return R.route_bottlenecks(fixture_enriched(spark, sf), min_flights=ROUTE_MIN_FLIGHTS)


@register("route_bottlenecks_busy", _route_sql(ROUTE_BUSY_FLIGHTS))
def q_route_bottlenecks_busy(spark, sf):
    return R.route_bottlenecks(fixture_enriched(spark, sf), min_flights=ROUTE_BUSY_FLIGHTS)


# ---------------------------------------------------------------------------
# Cleaning (D1-D11, C1) and joins
# ---------------------------------------------------------------------------

_TIME_OUT = S.TIME_COLS + [c + "_STR" for c in S.TIME_COLS]
_NA_OUT = S.NA_WHEN_CANCELLED + [c + "_STR" for c in S.NA_WHEN_CANCELLED if c in S.TIME_COLS]


@register("clean_times", O.with_stages(f"SELECT {_K}, {', '.join(_TIME_OUT)} FROM s_str"))
def q_clean_times(spark, sf):
    raw = fixture_frames(spark, sf).raw
    return C.clean_times(raw).select(*KEYS, *_TIME_OUT)


@register("null_cancelled", O.with_stages(f"SELECT {_K}, CANCELLED, {', '.join(_NA_OUT)} FROM s_na"))
def q_null_cancelled(spark, sf):
    raw = fixture_frames(spark, sf).raw
    return raw.transform(C.clean_times).transform(C.null_when_cancelled).select(*KEYS, "CANCELLED", *_NA_OUT)


@register("valid_airports_only", O.with_stages(
    f"SELECT {_K}, ORIGIN_AIRPORT, DESTINATION_AIRPORT FROM s_valid"))
def q_valid_airports_only(spark, sf):
    fr = fixture_frames(spark, sf)
    return C.keep_valid_airports(fr.raw, fr.airports).select(*KEYS, "ORIGIN_AIRPORT", "DESTINATION_AIRPORT")


@register("cancellation_reason", O.with_stages(
    f"SELECT {_K}, CANCELLED, CANCELLATION_REASON FROM s_clean"))
def q_cancellation_reason(spark, sf):
    return fixture_frames(spark, sf).cleaned.select(*KEYS, "CANCELLED", "CANCELLATION_REASON")


@register("clean_delay_causes", O.with_stages(
    f"SELECT {_K}, {', '.join(S.DELAY_CAUSE_COLS)} FROM s_clean"))
def q_clean_delay_causes(spark, sf):
    return fixture_frames(spark, sf).cleaned.select(*KEYS, *S.DELAY_CAUSE_COLS)


@register("enrich_airlines", O.with_stages(f"SELECT {_K}, AIRLINE, AIRLINE_FULL_NAME FROM s_enriched"))
def q_enrich_airlines(spark, sf):
    fr = fixture_frames(spark, sf)
    return E.join_airlines(fr.cleaned, fr.airlines).select(*KEYS, "AIRLINE", "AIRLINE_FULL_NAME")


_AP_OUT = [f"{r}_{s}" for r in ("ORIGIN", "DESTINATION") for s in S.AIRPORT_ATTRS.values()
           if s not in ("LAT", "LON")]
_LL_OUT = [f"{r}_{s}" for r in ("ORIGIN", "DESTINATION") for s in ("LAT", "LON")]


@register("enrich_airports", O.with_stages(
    f"SELECT {_K}, ORIGIN_AIRPORT, DESTINATION_AIRPORT, {', '.join(_AP_OUT)} FROM s_enriched"))
def q_enrich_airports(spark, sf):
    fr = fixture_frames(spark, sf)
    out = fr.cleaned.transform(E.join_airports, fr.airports, "ORIGIN") \
        .transform(E.join_airports, fr.airports, "DESTINATION")
    return out.select(*KEYS, "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", *_AP_OUT)


@register("patch_coordinates", O.with_stages(
    f"SELECT {_K}, ORIGIN_AIRPORT, DESTINATION_AIRPORT, {', '.join(_LL_OUT)} FROM s_enriched"))
def q_patch_coordinates(spark, sf):
    return fixture_enriched(spark, sf).select(*KEYS, "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", *_LL_OUT)


# ---------------------------------------------------------------------------
# Features (E1-E15, H1-H3)
# ---------------------------------------------------------------------------

def _scalar_features(spark, sf):
    return fixture_enriched(spark, sf)


_CAL = ["YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "DEPARTURE_HOUR", "DAYPART", "IS_PEAK_HOUR", "IS_WEEKEND",
        "SEASON", "FLIGHT_DATE", "ISO_YEAR", "ISO_WEEK"]
_DEL = ["IS_DELAYED_DEPARTURE", "IS_DELAYED_ARRIVAL", "TOTAL_DELAY", "HAS_WEATHER_DELAY",
        "IS_CANCELLED", "IS_DIVERTED"]


@register("calendar_features", O.with_stages(f"SELECT {_K}, {', '.join(_CAL)} FROM s_f2"))
def q_calendar_features(spark, sf):
    return _scalar_features(spark, sf).select(*KEYS, *_CAL)


@register("delay_features", O.with_stages(f"SELECT {_K}, {', '.join(_DEL)} FROM s_f2"))
def q_delay_features(spark, sf):
    return _scalar_features(spark, sf).select(*KEYS, *_DEL)


@register("distance_category", O.with_stages(f"SELECT {_K}, DISTANCE, DISTANCE_CATEGORY FROM s_f2"))
def q_distance_category(spark, sf):
    return _scalar_features(spark, sf).select(*KEYS, "DISTANCE", "DISTANCE_CATEGORY")


@register("route", O.with_stages(f"SELECT {_K}, ROUTE FROM s_f2"))
def q_route(spark, sf):
    return _scalar_features(spark, sf).select(*KEYS, "ROUTE")


@register("optional_column_defaults", O.with_stages(
    f"SELECT {_K}, FALSE AS HAS_WEATHER_DELAY, FALSE AS IS_CANCELLED, FALSE AS IS_DIVERTED, CAST(NULL AS VARCHAR) AS DISTANCE_CATEGORY FROM s_clean"))
def q_optional_column_defaults(spark, sf):
    """Flights without the optional columns get their defaults."""
    bare = fixture_frames(spark, sf).cleaned.drop("WEATHER_DELAY", "CANCELLED", "DIVERTED", "DISTANCE")
    return FT.add_scalar_features(bare).select(*KEYS, "HAS_WEATHER_DELAY", "IS_CANCELLED", "IS_DIVERTED", "DISTANCE_CATEGORY")


_TAIL = ["TAIL_NUMBER", "FLIGHT_DATE", "ISO_YEAR", "ISO_WEEK", FT.PER_DAY, FT.PER_WEEK]


@register("tail_utilisation", O.with_stages(f"SELECT {_K}, {', '.join(_TAIL)} FROM feat"))
def q_tail_utilisation(spark, sf):
    return FT.add_tail_counts(_scalar_features(spark, sf)).select(*KEYS, *_TAIL)


_CONG = ["ORIGIN_AIRPORT", "FLIGHT_DATE", "DEPARTURE_HOUR", FT.CONGESTION]


@register("origin_congestion", O.with_stages(f"SELECT {_K}, {', '.join(_CONG)} FROM feat"))
def q_origin_congestion(spark, sf):
    return FT.add_origin_congestion(_scalar_features(spark, sf)).select(*KEYS, *_CONG)


def _batches(flights):
    """The flights as they might arrive: a half-year, then the rest of the year in two overlapping batches."""
    late = F.coalesce("MONTH", F.lit(0)) > 6
    odd = F.coalesce(F.col("DAY") % 2 == 1, F.lit(False))
    return [flights.where(c) for c in (~late, late & odd, late & ~odd)]


@register("incremental_tail_utilisation", O.with_stages(f"SELECT {_K}, {', '.join(_TAIL)} FROM feat"))
def q_incremental_tail_utilisation(spark, sf):
    """H1, H2 from counts that were built up batch by batch."""
    flights, path = _scalar_features(spark, sf), scratch_path(spark, "tail-months")
    for batch in _batches(flights):
        INC.update_tail_counts(batch, path)
    return FT.add_tail_counts(flights, groups=INC.read_counts(spark, path)).select(*KEYS, *_TAIL)


@register("incremental_origin_congestion", O.with_stages(f"SELECT {_K}, {', '.join(_CONG)} FROM feat"))
def q_incremental_origin_congestion(spark, sf):
    """H3 from counts that were built up batch by batch."""
    flights, path = _scalar_features(spark, sf), scratch_path(spark, "congestion-months")
    for batch in _batches(flights):
        INC.update_congestion(batch, path)
    return FT.add_origin_congestion(flights, groups=INC.read_counts(spark, path)).select(*KEYS, *_CONG)


# ---------------------------------------------------------------------------
# The reports over the registered table (int 0/1 flags), and one SQL query on it
# ---------------------------------------------------------------------------

def _named_table(spark, sf, table) -> str:
    name = "flights_features_" + "".join(ch if ch.isalnum() else "_" for ch in sf.rstrip("/").split("/")[-1])
    return SQ.register_table(table, name)


for _name, _report, _table in [
    ("executive_snapshot", R.executive_snapshot, fixture_enriched),
    ("airline_performance", R.airline_performance, fixture_enriched),
    ("airport_congestion", R.airport_congestion, fixture_features),
    ("monthly_trend", R.monthly_trend, fixture_enriched),
    ("hourly_trend", R.hourly_trend, fixture_enriched),
    ("route_bottlenecks", R.route_bottlenecks, fixture_enriched),
]:
    def _make(report=_report, table=_table):
        def q(spark, sf):
            return report(spark.table(_named_table(spark, sf, table(spark, sf))))
        return q
    register(f"sql_{_name}", ORACLE[_name])(_make())


@register("sql_overview", O.with_stages("""
SELECT SEASON, DEPARTURE_HOUR, COUNT(*) AS flights, CAST(SUM(CAST(IS_DELAYED_ARRIVAL AS INTEGER)) AS BIGINT) AS late,
  MAX(ARRIVAL_DELAY) AS worst_delay FROM feat WHERE SEASON IS NOT NULL GROUP BY ALL"""))
def q_sql_overview(spark, sf):
    return spark.sql(SQ.overview_sql(_named_table(spark, sf, fixture_enriched(spark, sf))))


# Further query groups register themselves on import.
from contrail.plans import registry_quality  # noqa: E402,F401
from contrail.plans import registry_sources  # noqa: E402,F401
from contrail.plans import registry_stats  # noqa: E402,F401


def queries() -> dict[str, Builder]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

