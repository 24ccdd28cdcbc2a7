"""Registered data-quality queries (B1-B37, J1-J3, F6) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import enrich as E
from contrail.operators import quality as Q
from contrail.operators.cleaning import clean_times, flag_valid_airports, keep_valid_airports, null_when_cancelled
from contrail.plans import oracle as O
from contrail.plans.pipeline import fixture_enriched, fixture_frames
from contrail.plans.registry import KEYS, register
from contrail.sources.fixtures import FIXTURE_COORDINATE_PATCHES

_K = ", ".join(KEYS)
RAW_COLS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "AIRLINE",
    "TAIL_NUMBER", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE",
    "DEPARTURE_TIME", "WHEELS_OFF", "WHEELS_ON", "SCHEDULED_ARRIVAL", "ARRIVAL_TIME", "DEPARTURE_DELAY",
    "ARRIVAL_DELAY", "TAXI_OUT", "TAXI_IN", "ELAPSED_TIME", "AIR_TIME", "DISTANCE", "CANCELLED", "DIVERTED",
    "CANCELLATION_REASON", *S.DELAY_CAUSE_COLS,
]
STRING_COLS = {"AIRLINE", "TAIL_NUMBER", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "CANCELLATION_REASON",
               *S.DELAY_CAUSE_COLS}
NUMERIC_COLS = ["YEAR", "MONTH", "DAY", "DAY_OF_WEEK", *S.TIME_COLS, "DEPARTURE_DELAY", "ARRIVAL_DELAY",
                "TAXI_OUT", "TAXI_IN", "ELAPSED_TIME", "AIR_TIME", "DISTANCE", "CANCELLED", "DIVERTED"]
DUP_SUBSET = ["l_orderkey", "l_linenumber"]
PATCH_CODES = list(FIXTURE_COORDINATE_PATCHES)
POINT_CODE = PATCH_CODES[0]


def _pct(part: str, whole: str, d: int) -> str:
    return f"ROUND(CAST({part} AS DOUBLE) * 100 / {whole}, {d})"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _raw(spark, sf):
    return fixture_frames(spark, sf).raw


def _times(spark, sf):
    return clean_times(_raw(spark, sf))


# --- B1, B2 ---------------------------------------------------------------

@register("table_shape", O.with_stages(f"SELECT COUNT(*) AS n_rows, {len(RAW_COLS)} AS n_columns FROM fv"))
def q_table_shape(spark, sf):
    return Q.table_shape(_raw(spark, sf))


@register("preview", O.with_stages(f"SELECT {', '.join(RAW_COLS)} FROM fv ORDER BY {_K} LIMIT 5"))
def q_preview(spark, sf):
    return Q.preview(_raw(spark, sf), 5, KEYS).select(*RAW_COLS)


# --- B3-B5 ----------------------------------------------------------------

def _null_row(c: str) -> str:
    blank = (f"COUNT_IF({c} IS NOT NULL AND regexp_full_match({c}, '\\s*'))" if c in STRING_COLS
             else "CAST(0 AS BIGINT)")
    return (f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS missing, "
            f"{_pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)', 3)} AS missing_pct, {blank} AS blank FROM fv")


@register("null_profile", O.with_stages(_union([_null_row(c) for c in RAW_COLS])))
def q_null_profile(spark, sf):
    return Q.null_profile(_raw(spark, sf))


def _num_row(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS column_name, COUNT({x}) AS count, ROUND(AVG({x}), 1) AS mean, "
            f"ROUND(STDDEV_SAMP({x}), 1) AS std, ROUND(MIN({x}), 1) AS min, "
            f"ROUND(quantile_cont({x}, 0.25), 1) AS q25, ROUND(quantile_cont({x}, 0.5), 1) AS q50, "
            f"ROUND(quantile_cont({x}, 0.75), 1) AS q75, ROUND(MAX({x}), 1) AS max FROM fv")


@register("numeric_summary", O.with_stages(_union([_num_row(c) for c in NUMERIC_COLS])))
def q_numeric_summary(spark, sf):
    return Q.numeric_summary(_raw(spark, sf), NUMERIC_COLS)


# --- B6-B8 ----------------------------------------------------------------

def _range_row(c: str, lo: int, hi: int, expected) -> str:
    ux = (f"COUNT(DISTINCT CASE WHEN {c} NOT IN ({', '.join(map(str, sorted(expected)))}) THEN {c} END)"
          if expected is not None else "CAST(NULL AS BIGINT)")
    return (f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS BIGINT) AS min_value, "
            f"CAST(MAX({c}) AS BIGINT) AS max_value, COUNT(DISTINCT {c}) AS n_distinct, "
            f"COUNT_IF({c} IS NULL) AS missing, {_pct(f'COUNT_IF({c} IS NULL)', 'COUNT(*)', 3)} AS missing_pct, "
            f"COUNT_IF({c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi})) AS invalid, {ux} AS unexpected_values "
            f"FROM fv")


@register("range_report", O.with_stages(_union([_range_row(c, *v) for c, v in S.DATE_RANGES.items()])))
def q_range_report(spark, sf):
    return Q.range_report(_raw(spark, sf))


def _topk_sql(pairs: str, cond: str, k: int) -> str:
    return (f"SELECT * FROM (SELECT column_name, value, n, CAST(ROW_NUMBER() OVER (PARTITION BY column_name "
            f"ORDER BY n DESC, value ASC) AS INTEGER) AS rank FROM (SELECT column_name, value, COUNT(*) AS n FROM ({pairs}) p "
            f"WHERE value IS NOT NULL AND ({cond}) GROUP BY column_name, value) c) r WHERE rank <= {k}")


_DATE_PAIRS = _union([f"SELECT '{c}' AS column_name, CAST({c} AS BIGINT) AS value FROM fv" for c in S.DATE_RANGES])
_DATE_BAD = " OR ".join(f"(column_name = '{c}' AND NOT (value BETWEEN {lo} AND {hi}))"
                        for c, (lo, hi, _) in S.DATE_RANGES.items())


@register("invalid_values_topk", O.with_stages(_topk_sql(_DATE_PAIRS, _DATE_BAD, 15)))
def q_invalid_values_topk(spark, sf):
    return Q.invalid_values_topk(_raw(spark, sf))


@register("range_values", O.with_stages(
    f"SELECT column_name, value, COUNT(*) AS n FROM ({_DATE_PAIRS}) p GROUP BY column_name, value"))
def q_range_values(spark, sf):
    return Q.range_values(_raw(spark, sf))


# --- B9-B15 ---------------------------------------------------------------

def _time_row(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS column_name, MIN({x}) AS min_value, MAX({x}) AS max_value, "
            f"COUNT_IF({c} IS NULL) AS missing, {_pct(f'COUNT_IF({c} IS NULL)', 'COUNT(*)', 3)} AS missing_pct, "
            f"COUNT_IF({c} IS NOT NULL AND ({c} < 0 OR {c} > 2359)) AS invalid FROM fv")


@register("time_report", O.with_stages(_union([_time_row(c) for c in S.TIME_COLS])))
def q_time_report(spark, sf):
    return Q.time_report(_raw(spark, sf))


_TIME_PAIRS = _union([f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM fv" for c in S.TIME_COLS])


@register("invalid_times_topk", O.with_stages(_topk_sql(_TIME_PAIRS, "value < 0 OR value > 2359", 12)))
def q_invalid_times_topk(spark, sf):
    return Q.invalid_times_topk(_raw(spark, sf))


_KEEP = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "YEAR", "MONTH", "DAY"]


@register("invalid_time_rows", O.with_stages(
    "SELECT * FROM (" + _union([f"SELECT {', '.join(_KEEP)}, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value "
                                f"FROM fv" for c in S.TIME_COLS]) + ") t WHERE value < 0 OR value > 2359"))
def q_invalid_time_rows(spark, sf):
    return Q.invalid_time_rows(_raw(spark, sf), keep=_KEEP)


def _hist_rows(c: str) -> list[str]:
    return [f"SELECT '{c}' AS column_name, '[{lo}, {hi})' AS bin, {lo} AS bin_start, "
            f"COUNT_IF({c} >= {lo} AND {c} < {hi}) AS n FROM s_str" for lo, hi in Q.HHMM_BINS]


@register("hhmm_histogram", O.with_stages(_union([r for c in S.TIME_COLS for r in _hist_rows(c)])))
def q_hhmm_histogram(spark, sf):
    return Q.hhmm_histogram(_times(spark, sf))


_HHMM_RE = "^([01][0-9]|2[0-3])[0-5][0-9]$"


def _fmt_row(c: str) -> str:
    s = f"{c}_STR"
    nok = f"COUNT_IF({s} IS NOT NULL AND NOT regexp_matches({s}, '{_HHMM_RE}'))"
    ln = f"COUNT_IF({s} IS NOT NULL AND length({s}) <> 4)"
    return (f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS BIGINT) AS min_value, "
            f"CAST(MAX({c}) AS BIGINT) AS max_value, COUNT_IF({c} < 0) AS below_zero, "
            f"COUNT_IF({c} > 2359) AS above_2359, COUNT_IF({c} IS NULL) AS missing, {ln} AS wrong_length, "
            f"COUNT_IF(regexp_matches({s}, '{_HHMM_RE}')) AS valid_hhmm, {nok} AS invalid_hhmm, "
            f"(COUNT_IF({c} < 0) = 0 AND COUNT_IF({c} > 2359) = 0 AND {ln} = 0 AND {nok} = 0) AS passed FROM s_na")


_FMT = _union([_fmt_row(c) for c in S.TIME_COLS])


@register("time_format_report", O.with_stages(_FMT))
def q_time_format_report(spark, sf):
    return Q.time_format_report(null_when_cancelled(_times(spark, sf)))


@register("time_verdict", O.with_stages(
    f"SELECT COALESCE(BOOL_AND(passed), TRUE) AS all_passed, COUNT_IF(NOT passed) AS failed_checks FROM ({_FMT}) t"))
def q_time_verdict(spark, sf):
    return Q.verdict(Q.time_format_report(null_when_cancelled(_times(spark, sf))))


# --- B16-B17, B24-B26 -----------------------------------------------------

def _cancel_row(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, b.c AS cancelled_flights, {_pct('b.c', 'b.n', 3)} AS cancelled_pct, "
            f"b.v_{c} AS non_null_before, a.v_{c} AS non_null_after FROM b, a")


_CANCEL_AGG = ", ".join(f"COUNT_IF(CANCELLED = 1 AND {c} IS NOT NULL) AS v_{c}" for c in S.NA_WHEN_CANCELLED)


@register("cancel_profile", O.with_stages(
    _union([_cancel_row(c) for c in S.NA_WHEN_CANCELLED]),
    f"b AS (SELECT COUNT(*) AS n, COUNT_IF(CANCELLED = 1) AS c, {_CANCEL_AGG} FROM s_str),\n"
    f"a AS (SELECT {_CANCEL_AGG} FROM s_na)"))
def q_cancel_profile(spark, sf):
    t = _times(spark, sf)
    return Q.cancel_profile(t, null_when_cancelled(t))


@register("cancellation_value_counts", O.with_stages(
    "SELECT CANCELLATION_REASON AS value, COUNT(*) AS n, 'before' AS stage FROM s_valid GROUP BY 1\n"
    "UNION ALL SELECT CANCELLATION_REASON AS value, COUNT(*) AS n, 'after' AS stage FROM s_clean GROUP BY 1"))
def q_cancellation_value_counts(spark, sf):
    fr = fixture_frames(spark, sf)
    before = keep_valid_airports(null_when_cancelled(clean_times(fr.raw)), fr.airports)
    return Q.value_counts(before, "CANCELLATION_REASON", "before").unionByName(
        Q.value_counts(fr.cleaned, "CANCELLATION_REASON", "after"))


def _cause_row(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, b.bl_{c} AS blank_before, a.neg_{c} AS negative_after, "
            f"a.pos_{c} AS positive_after, a.anypos AS rows_with_any_positive FROM b, a")


@register("delay_cause_checks", O.with_stages(
    _union([_cause_row(c) for c in S.DELAY_CAUSE_COLS]),
    "b AS (SELECT " + ", ".join(f"COUNT_IF({c} IS NOT NULL AND regexp_full_match({c}, '\\s*')) AS bl_{c}"
                                for c in S.DELAY_CAUSE_COLS) + " FROM s_valid),\n"
    "a AS (SELECT COUNT_IF(GREATEST(" + ", ".join(S.DELAY_CAUSE_COLS) + ") > 0) AS anypos, "
    + ", ".join(f"COUNT_IF({c} < 0) AS neg_{c}, COUNT_IF({c} > 0) AS pos_{c}" for c in S.DELAY_CAUSE_COLS)
    + " FROM s_clean)"))
def q_delay_cause_checks(spark, sf):
    fr = fixture_frames(spark, sf)
    before = keep_valid_airports(null_when_cancelled(clean_times(fr.raw)), fr.airports)
    return Q.delay_cause_checks(before, fr.cleaned)


# --- B18-B23, J1-J3, F6 ---------------------------------------------------

def _summary_sql(cols: list[str], lookup: str) -> str:
    seen = " UNION ".join(f"SELECT CAST({c} AS VARCHAR) AS code FROM fv WHERE {c} IS NOT NULL" for c in cols)
    return (f"SELECT COUNT(*) AS distinct_codes, COUNT(k.IATA_CODE) AS matched, "
            f"COUNT_IF(k.IATA_CODE IS NULL) AS invalid FROM (SELECT DISTINCT code FROM ({seen}) u) s "
            f"LEFT JOIN (SELECT DISTINCT IATA_CODE FROM {lookup} WHERE IATA_CODE IS NOT NULL) k ON s.code = k.IATA_CODE")


@register("airline_code_summary", O.with_stages(_summary_sql(["AIRLINE"], "airlines")))
def q_airline_code_summary(spark, sf):
    fr = fixture_frames(spark, sf)
    return Q.code_summary(fr.raw, fr.airlines, ["AIRLINE"])


_AP = ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]


@register("airport_code_summary", O.with_stages(_summary_sql(_AP, "airports")))
def q_airport_code_summary(spark, sf):
    fr = fixture_frames(spark, sf)
    return Q.code_summary(fr.raw, fr.airports, _AP)


def _invalid_sql(cols: list[str], lookup: str) -> str:
    side = _union([f"SELECT CAST({c} AS VARCHAR) AS code, COUNT(*) AS n, '{c}' AS side FROM fv "
                   f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT IATA_CODE FROM {lookup} WHERE IATA_CODE IS NOT NULL) "
                   f"GROUP BY 1" for c in cols])
    return (f"WITH ps AS ({side}) SELECT code, n, side FROM ps UNION ALL "
            f"SELECT code, CAST(SUM(n) AS BIGINT) AS n, 'ALL' AS side FROM ps GROUP BY code")


@register("invalid_airline_codes", O.with_stages(f"SELECT * FROM ({_invalid_sql(['AIRLINE'], 'airlines')}) x"))
def q_invalid_airline_codes(spark, sf):
    fr = fixture_frames(spark, sf)
    return Q.invalid_codes(fr.raw, fr.airlines, ["AIRLINE"])


@register("invalid_airport_codes", O.with_stages(f"SELECT * FROM ({_invalid_sql(_AP, 'airports')}) x"))
def q_invalid_airport_codes(spark, sf):
    fr = fixture_frames(spark, sf)
    return Q.invalid_codes(fr.raw, fr.airports, _AP)


@register("invalid_codes_topk", O.with_stages(
    f"SELECT code, n FROM ({_invalid_sql(_AP, 'airports')}) x WHERE side = 'ALL' ORDER BY n DESC, code LIMIT 10"))
def q_invalid_codes_topk(spark, sf):
    fr = fixture_frames(spark, sf)
    return (Q.invalid_codes(fr.raw, fr.airports, _AP).where(F.col("side") == "ALL")
            .orderBy(F.desc("n"), F.asc("code")).limit(10).select("code", "n"))


@register("code_set_difference", O.with_stages(
    "SELECT code FROM (SELECT CAST(ORIGIN_AIRPORT AS VARCHAR) AS code FROM fv UNION "
    "SELECT CAST(DESTINATION_AIRPORT AS VARCHAR) FROM fv) s WHERE code IS NOT NULL "
    "AND code NOT IN (SELECT IATA_CODE FROM airports WHERE IATA_CODE IS NOT NULL)"))
def q_code_set_difference(spark, sf):
    fr = fixture_frames(spark, sf)
    return Q.code_set_difference(fr.raw, fr.airports, _AP)


_VO = "ORIGIN_AIRPORT IN (SELECT IATA_CODE FROM airports WHERE IATA_CODE IS NOT NULL)"
_VD = "DESTINATION_AIRPORT IN (SELECT IATA_CODE FROM airports WHERE IATA_CODE IS NOT NULL)"


@register("first_unknown_codes", O.with_stages(
    "SELECT DISTINCT code FROM (SELECT ORIGIN_AIRPORT AS code FROM fv UNION ALL SELECT DESTINATION_AIRPORT FROM fv) u "
    "WHERE code IS NOT NULL AND code NOT IN (SELECT IATA_CODE FROM airports WHERE IATA_CODE IS NOT NULL) ORDER BY code LIMIT 30"))
def q_first_unknown_codes(spark, sf):
    fr = fixture_frames(spark, sf)
    return Q.code_set_difference(fr.raw, fr.airports, _AP, first=30)


@register("code_breakdown", O.with_stages(
    f"SELECT total_rows, both_valid, any_invalid, origin_only_invalid, destination_only_invalid, both_invalid, "
    f"{_pct('both_valid', 'total_rows', 2)} AS both_valid_pct, {_pct('any_invalid', 'total_rows', 2)} AS any_invalid_pct "
    f"FROM (SELECT COUNT(*) AS total_rows, COUNT_IF(vo AND vd) AS both_valid, COUNT_IF(NOT (vo AND vd)) AS any_invalid, "
    f"COUNT_IF(NOT vo AND vd) AS origin_only_invalid, COUNT_IF(vo AND NOT vd) AS destination_only_invalid, "
    f"COUNT_IF(NOT vo AND NOT vd) AS both_invalid FROM (SELECT COALESCE({_VO}, FALSE) AS vo, "
    f"COALESCE({_VD}, FALSE) AS vd FROM fv) f) t"))
def q_code_breakdown(spark, sf):
    fr = fixture_frames(spark, sf)
    return Q.code_breakdown(fr.raw, fr.airports)


@register("row_accounting", O.with_stages(
    "SELECT rows_before, rows_after, distinct_codes_left, rows_before - rows_after AS rows_removed, "
    f"{_pct('rows_before - rows_after', 'rows_before', 2)} AS removed_pct, "
    "ROUND(100 - CAST(rows_before - rows_after AS DOUBLE) * 100 / rows_before, 2) AS kept_pct FROM "
    "(SELECT (SELECT COUNT(*) FROM s_na) AS rows_before, (SELECT COUNT(*) FROM s_valid) AS rows_after, "
    "(SELECT COUNT(DISTINCT code) FROM (SELECT ORIGIN_AIRPORT AS code FROM s_valid UNION ALL "
    "SELECT DESTINATION_AIRPORT FROM s_valid) u WHERE code IS NOT NULL) AS distinct_codes_left) t"))
def q_row_accounting(spark, sf):
    fr = fixture_frames(spark, sf)
    before = null_when_cancelled(clean_times(fr.raw))
    return Q.row_accounting(flag_valid_airports(before, fr.airports))


@register("time_text_lengths", O.with_stages(_union([
    f"SELECT '{c}_STR' AS column_name, CAST(length({c}_STR) AS INTEGER) AS length, COUNT(*) AS n FROM s_str WHERE {c}_STR IS NOT NULL GROUP BY ALL"
    for c in S.TIME_COLS])))
def q_time_text_lengths(spark, sf):
    return Q.time_text_lengths(_times(spark, sf))


# --- B27-B30 --------------------------------------------------------------

@register("unmatched_after_joins", O.with_stages(
    "SELECT 'airlines' AS join_name, COUNT_IF(AIRLINE_FULL_NAME IS NULL) AS unmatched FROM s_enriched UNION ALL "
    "SELECT 'origin_airports', COUNT_IF(ORIGIN_AIRPORT_NAME IS NULL) FROM s_enriched UNION ALL "
    "SELECT 'destination_airports', COUNT_IF(DESTINATION_AIRPORT_NAME IS NULL) FROM s_enriched"))
def q_unmatched_after_joins(spark, sf):
    return Q.unmatched_after_joins(fixture_enriched(spark, sf))


@register("missing_metadata", O.with_stages(_union([
    f"SELECT f.{r}_AIRPORT AS code, COUNT(*) AS n, '{r}' AS side FROM s_clean f LEFT JOIN airports a "
    f"ON f.{r}_AIRPORT = a.IATA_CODE WHERE a.AIRPORT IS NULL OR a.CITY IS NULL OR a.LATITUDE IS NULL GROUP BY 1"
    for r in ("ORIGIN", "DESTINATION")])))
def q_missing_metadata(spark, sf):
    fr = fixture_frames(spark, sf)
    unpatched = E.enrich_flights(fr.cleaned, fr.airlines, fr.airports, patches={})
    return Q.missing_metadata(unpatched)


@register("airport_rows", O.with_stages(
    "SELECT ORIGIN_AIRPORT, ORIGIN_AIRPORT_NAME, ORIGIN_CITY, ORIGIN_STATE, ORIGIN_LAT, ORIGIN_LON "
    f"FROM s_enriched WHERE ORIGIN_AIRPORT = '{POINT_CODE}'"))
def q_airport_rows(spark, sf):
    return Q.rows_for_code(fixture_enriched(spark, sf), POINT_CODE)


_PC = ", ".join(f"'{c}'" for c in PATCH_CODES)


@register("patched_rows", O.with_stages(
    "SELECT code, COALESCE(o.n, 0) AS origin_rows, COALESCE(d.n, 0) AS destination_rows, "
    "COALESCE(o.n, 0) + COALESCE(d.n, 0) AS total_rows FROM "
    f"(SELECT ORIGIN_AIRPORT AS code, COUNT(*) AS n FROM s_enriched WHERE ORIGIN_AIRPORT IN ({_PC}) GROUP BY 1) o "
    f"FULL JOIN (SELECT DESTINATION_AIRPORT AS code, COUNT(*) AS n FROM s_enriched "
    f"WHERE DESTINATION_AIRPORT IN ({_PC}) GROUP BY 1) d USING (code)"))
def q_patched_rows(spark, sf):
    return Q.patched_rows(fixture_enriched(spark, sf), PATCH_CODES)


# --- B31-B37 --------------------------------------------------------------

_DS = ", ".join(DUP_SUBSET)


@register("duplicate_report", O.with_stages(
    "SELECT total_rows, total_rows - unique_rows AS duplicate_rows, "
    f"ROUND(CAST(total_rows - unique_rows AS DOUBLE) * 100 / total_rows, 4) AS duplicate_pct, unique_rows "
    f"FROM (SELECT CAST(SUM(c) AS BIGINT) AS total_rows, COUNT(*) AS unique_rows FROM "
    f"(SELECT COUNT(*) AS c FROM fv GROUP BY {_DS}) g) t"))
def q_duplicate_report(spark, sf):
    return Q.duplicate_report(_raw(spark, sf), DUP_SUBSET)


_REPEATED = ["AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "MONTH"]


@register("duplicate_full_rows", O.with_stages(
    f"SELECT {', '.join(_REPEATED)}, COUNT(*) OVER (PARTITION BY {', '.join(_REPEATED)}) AS copies FROM fv QUALIFY copies > 1"))
def q_duplicate_full_rows(spark, sf):
    """All columns decide: a projection of the flights that holds real copies."""
    return Q.duplicate_rows(_raw(spark, sf).select(*_REPEATED))


@register("duplicate_rows", O.with_stages(
    f"SELECT {_K}, AIRLINE, TAIL_NUMBER, copies FROM (SELECT *, COUNT(*) OVER (PARTITION BY {_DS}) AS copies "
    f"FROM fv) t WHERE copies > 1"))
def q_duplicate_rows(spark, sf):
    return Q.duplicate_rows(_raw(spark, sf), DUP_SUBSET).select(*KEYS, "AIRLINE", "TAIL_NUMBER", "copies")


_SPECIAL = "[^a-zA-Z0-9\\s\\-\\./]"


def _junk_row(c: str) -> str:
    digits = (f"COUNT_IF(regexp_matches(CAST({c} AS VARCHAR), '^\\d+$'))" if c in S.CODE_COLS
              else "CAST(0 AS BIGINT)")
    return (f"SELECT '{c}' AS column_name, COUNT_IF(regexp_matches({c}, '[\\x00-\\x1F\\x7F]')) AS non_printable, "
            f"COUNT_IF(length({c}) - length(regexp_replace({c}, '{_SPECIAL}', '', 'g')) > 5) AS excessive_special, "
            f"{digits} AS pure_numeric FROM s_enriched")


@register("junk_text_report", O.with_stages(_union([_junk_row(c) for c in S.JUNK_TEXT_COLS])))
def q_junk_text_report(spark, sf):
    return Q.junk_text_report(fixture_enriched(spark, sf))


def _junk_vals(c: str) -> str:
    digits = f" OR regexp_matches(CAST({c} AS VARCHAR), '^\\d+$')" if c in S.CODE_COLS else ""
    return (f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM s_enriched "
            f"WHERE regexp_matches({c}, '[\\x00-\\x1F\\x7F]') OR "
            f"length({c}) - length(regexp_replace({c}, '{_SPECIAL}', '', 'g')) > 5{digits}")


@register("junk_values", O.with_stages(_union([_junk_vals(c) for c in S.JUNK_TEXT_COLS])))
def q_junk_values(spark, sf):
    return Q.junk_values(fixture_enriched(spark, sf))


_CXL = ["YEAR", "MONTH", "DAY", "CANCELLED", "CANCELLATION_REASON", "DEPARTURE_TIME", "DEPARTURE_DELAY",
        "TAXI_OUT", "ELAPSED_TIME", "DEPARTURE_TIME_STR", "WHEELS_ON_STR", "ARRIVAL_TIME_STR"]


@register("cancelled_flights", O.with_stages(f"SELECT {_K}, {', '.join(_CXL)} FROM s_clean WHERE CANCELLED = 1"))
def q_cancelled_flights(spark, sf):
    return fixture_frames(spark, sf).cleaned.where(F.col("CANCELLED") == 1).select(*KEYS, *_CXL)


def _junk_rows(c: str) -> str:
    return _junk_vals(c).replace("SELECT DISTINCT", "SELECT", 1)


_RANKED = "SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rank FROM (SELECT column_name, value, COUNT(*) AS n FROM cells GROUP BY 1, 2)"
_TEXTS = ["TAIL_NUMBER", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]


@register("junk_values_topk", O.with_stages(
    f"SELECT * FROM ({_RANKED}) WHERE rank <= 10", f"cells AS ({_union([_junk_rows(c) for c in S.JUNK_TEXT_COLS])})"))
def q_junk_values_topk(spark, sf):
    return Q.junk_values_topk(fixture_enriched(spark, sf))


@register("frequent_texts", O.with_stages(
    f"SELECT * FROM ({_RANKED}) WHERE rank <= 20",
    "cells AS (" + _union([f"SELECT '{c}' AS column_name, {c} AS value FROM fv WHERE {c} IS NOT NULL" for c in _TEXTS]) + ")"))
def q_frequent_texts(spark, sf):
    """Few counters, so that the bounded summary bites at the test scales."""
    return Q.frequent_texts(_raw(spark, sf), _TEXTS, counters=64)
