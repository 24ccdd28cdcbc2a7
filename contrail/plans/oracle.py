"""Independent SQL formulation (DuckDB dialect) of each registered query.

The stage CTEs restate the cleaning / enrichment / feature rules in plain SQL,
with window functions for the group counts, so the oracle shares no code with
the Spark operators. Only the flight-shaped input views are common text.
"""

from __future__ import annotations

from contrail import schema as S
from contrail.sources.fixtures import (
    AIRLINES_SQL, AIRPORTS_SQL, FIXTURE_COORDINATE_PATCHES, FLIGHTS_SQL,
)


def _pad4(x: str) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN length({s}) >= 4 THEN {s} "
            f"WHEN {x} < 0 THEN '-' || lpad(CAST(-{x} AS VARCHAR), 3, '0') ELSE lpad({s}, 4, '0') END")


def _delay_cause(c: str) -> str:
    return (f"COALESCE(CAST(TRUNC(TRY_CAST(CASE WHEN regexp_full_match({c}, '\\s*') THEN NULL ELSE {c} END "
            f"AS DOUBLE)) AS INTEGER), 0)")


def _patch(code_col: str, base_col: str, idx: int) -> str:
    whens = " ".join(f"WHEN '{code}' THEN CAST({vals[idx]!r} AS DOUBLE)"
                     for code, vals in FIXTURE_COORDINATE_PATCHES.items())
    return f"CASE {code_col} {whens} ELSE {base_col} END"


_times = ",\n  ".join(f"CASE WHEN {c} = 2400 THEN 0 ELSE {c} END AS {c}" for c in S.TIME_COLS)
_strs = ",\n  ".join(f"{_pad4(c)} AS {c}_STR" for c in S.TIME_COLS)
_na_cols = S.NA_WHEN_CANCELLED + [c + "_STR" for c in S.NA_WHEN_CANCELLED if c in S.TIME_COLS]
_na = ",\n  ".join(f"CASE WHEN CANCELLED = 1 THEN NULL ELSE {c} END AS {c}" for c in _na_cols)
_causes = ",\n  ".join(f"{_delay_cause(c)} AS {c}" for c in S.DELAY_CAUSE_COLS)

_airport_cols = []
for role, alias in (("ORIGIN", "o"), ("DESTINATION", "d")):
    _airport_cols += [
        f"{alias}.AIRPORT AS {role}_AIRPORT_NAME", f"{alias}.CITY AS {role}_CITY",
        f"{alias}.STATE AS {role}_STATE", f"{alias}.COUNTRY AS {role}_COUNTRY",
        f"{_patch('f.' + role + '_AIRPORT', alias + '.LATITUDE', 0)} AS {role}_LAT",
        f"{_patch('f.' + role + '_AIRPORT', alias + '.LONGITUDE', 1)} AS {role}_LON",
    ]
_airport_sel = ",\n  ".join(_airport_cols)

STAGES = f"""
fv AS ({FLIGHTS_SQL}),
airlines AS ({AIRLINES_SQL}),
airports AS ({AIRPORTS_SQL}),
s_times AS (SELECT * REPLACE (
  {_times}) FROM fv),
s_str AS (SELECT *,
  {_strs} FROM s_times),
s_na AS (SELECT * REPLACE (
  {_na}) FROM s_str),
s_valid AS (SELECT * FROM s_na
  WHERE ORIGIN_AIRPORT IN (SELECT IATA_CODE FROM airports WHERE IATA_CODE IS NOT NULL)
    AND DESTINATION_AIRPORT IN (SELECT IATA_CODE FROM airports WHERE IATA_CODE IS NOT NULL)),
s_clean AS (SELECT * REPLACE (
  CASE WHEN CANCELLED = 0 THEN 'NC' ELSE COALESCE(CANCELLATION_REASON, 'NC') END AS CANCELLATION_REASON,
  {_causes}) FROM s_valid),
s_enriched AS (SELECT f.*, a.AIRLINE AS AIRLINE_FULL_NAME,
  {_airport_sel}
  FROM s_clean f
  LEFT JOIN airlines a ON f.AIRLINE = a.IATA_CODE
  LEFT JOIN airports o ON f.ORIGIN_AIRPORT = o.IATA_CODE
  LEFT JOIN airports d ON f.DESTINATION_AIRPORT = d.IATA_CODE),
s_f1 AS (SELECT *,
  ORIGIN_AIRPORT || '-' || DESTINATION_AIRPORT AS ROUTE,
  CASE WHEN regexp_full_match(SCHEDULED_DEPARTURE_STR, '[0-9]{{4}}')
        AND TRY_CAST(substr(SCHEDULED_DEPARTURE_STR, 1, 2) AS INTEGER) BETWEEN 0 AND 23
       THEN TRY_CAST(substr(SCHEDULED_DEPARTURE_STR, 1, 2) AS INTEGER) END AS DEPARTURE_HOUR,
  TRY_CAST(printf('%04d-%02d-%02d', YEAR, MONTH, DAY) AS DATE) AS FLIGHT_DATE
  FROM s_enriched),
s_f2 AS (SELECT *,
  CASE WHEN DEPARTURE_HOUR BETWEEN 0 AND 5 THEN 'Night' WHEN DEPARTURE_HOUR BETWEEN 6 AND 11 THEN 'Morning'
       WHEN DEPARTURE_HOUR BETWEEN 12 AND 17 THEN 'Afternoon' WHEN DEPARTURE_HOUR BETWEEN 18 AND 23 THEN 'Evening'
  END AS DAYPART,
  COALESCE(DEPARTURE_HOUR BETWEEN 6 AND 9 OR DEPARTURE_HOUR BETWEEN 16 AND 19, FALSE) AS IS_PEAK_HOUR,
  COALESCE(DAY_OF_WEEK IN (6, 7), FALSE) AS IS_WEEKEND,
  CASE WHEN MONTH IN (12, 1, 2) THEN 'Winter' WHEN MONTH IN (3, 4, 5) THEN 'Spring'
       WHEN MONTH IN (6, 7, 8) THEN 'Summer' WHEN MONTH IN (9, 10, 11) THEN 'Fall' END AS SEASON,
  COALESCE(DEPARTURE_DELAY > 15, FALSE) AS IS_DELAYED_DEPARTURE,
  COALESCE(ARRIVAL_DELAY > 15, FALSE) AS IS_DELAYED_ARRIVAL,
  CAST(COALESCE(DEPARTURE_DELAY, 0) + COALESCE(ARRIVAL_DELAY, 0) AS DOUBLE) AS TOTAL_DELAY,
  COALESCE(WEATHER_DELAY > 0, FALSE) AS HAS_WEATHER_DELAY,
  COALESCE(CANCELLED = 1, FALSE) AS IS_CANCELLED,
  COALESCE(DIVERTED = 1, FALSE) AS IS_DIVERTED,
  CASE WHEN DISTANCE >= 0 AND DISTANCE < 500 THEN 'short_haul'
       WHEN DISTANCE >= 500 AND DISTANCE < 1500 THEN 'medium_haul'
       WHEN DISTANCE >= 1500 THEN 'long_haul' END AS DISTANCE_CATEGORY,
  CAST(isoyear(FLIGHT_DATE) AS INTEGER) AS ISO_YEAR,
  CAST(week(FLIGHT_DATE) AS INTEGER) AS ISO_WEEK
  FROM s_f1),
feat AS (SELECT *,
  CASE WHEN TAIL_NUMBER IS NOT NULL AND FLIGHT_DATE IS NOT NULL
       THEN COUNT(*) OVER (PARTITION BY TAIL_NUMBER, FLIGHT_DATE) END AS FLIGHTS_PER_TAIL_NUMBER_PER_DAY,
  CASE WHEN TAIL_NUMBER IS NOT NULL AND ISO_YEAR IS NOT NULL AND ISO_WEEK IS NOT NULL
       THEN COUNT(*) OVER (PARTITION BY TAIL_NUMBER, ISO_YEAR, ISO_WEEK) END AS FLIGHTS_PER_TAIL_NUMBER_PER_WEEK,
  CASE WHEN ORIGIN_AIRPORT IS NOT NULL AND FLIGHT_DATE IS NOT NULL AND DEPARTURE_HOUR IS NOT NULL
       THEN COUNT(*) OVER (PARTITION BY ORIGIN_AIRPORT, FLIGHT_DATE, DEPARTURE_HOUR) END AS ORIGIN_CONGESTION
  FROM s_f2)
"""


def with_stages(select: str, extra_ctes: str = "") -> str:
    """Prefix ``select`` with the stage CTEs (and optional extra CTEs)."""
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {STAGES.strip()}{extra}\n{select}"


def rate_sql(flag: str, digits: int = 4) -> str:
    return f"ROUND(SUM(CAST({flag} AS INTEGER)) / COUNT(*), {digits})"


def _closing_paren(sql: str, open_at: int) -> int:
    """Index of the parenthesis closing the one at ``open_at`` (string literals skipped)."""
    depth, quote = 0, False
    for k in range(open_at, len(sql)):
        ch = sql[k]
        if ch == "'":
            quote = not quote
        elif not quote and ch == "(":
            depth += 1
        elif not quote and ch == ")":
            depth -= 1
            if depth == 0:
                return k
    raise ValueError("unbalanced parentheses in oracle SQL")


def bigint_counts(sql: str) -> str:
    """Wrap every ``COUNT_IF(...)`` in ``CAST(... AS BIGINT)``: DuckDB returns
    HUGEINT for it, Spark returns BIGINT (same values, different column type)."""
    token = "COUNT_IF("
    out, i = [], 0
    while (j := sql.find(token, i)) >= 0:
        k = _closing_paren(sql, j + len(token) - 1)
        out += [sql[i:j], f"CAST(COUNT_IF({bigint_counts(sql[j + len(token):k])}) AS BIGINT)"]
        i = k + 1
    out.append(sql[i:])
    return "".join(out)
