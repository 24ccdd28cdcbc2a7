"""Profiling and data-quality reports.

Every report is read-only and small. Column-wise reports compute all their
figures in ONE aggregation pass (partial + final hash aggregate, no matter how
many columns) and then turn the single wide row into one row per column with
``inline`` -- never a loop of jobs, never rows collected to the driver.
Frequency reports are ``groupBy().count()`` (map-side combined, so a hot value
costs nothing) followed by a per-column top-k over the small counted table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.text import (
    MAX_SPECIAL_CHARS, blank_sql, control_chars_sql, digits_only_sql, has_control_chars, hhmm_sql, is_blank,
    is_digits_only, special_char_count, special_char_count_sql, sql_ident,
)
from contrail.operators.heavy_hitters import COUNTERS, cells, top_values
from contrail.operators.joins import (
    DEFAULT_BROADCAST_ROWS, broadcast_if_small, fits_broadcast, join_group_values, lookup_join, semi_join,
)
from contrail.operators.stats import quartiles
from contrail.session import materialize
from contrail.sources.files import lookup_keys

# ---------------------------------------------------------------------------
# Time-of-day histogram bins (HHMM, [lo, hi)) and valid HHMM range
# ---------------------------------------------------------------------------
HHMM_BINS = [(0, 600), (600, 1200), (1200, 1800), (1800, 2400)]
HHMM_MIN, HHMM_MAX = 0, 2359


def _pct(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part * 100.0 / whole, digits)


def _pct_sql(part: str, whole: str, digits: int) -> str:
    return f"round(({part}) * 100.0D / ({whole}), {digits})"


def _long(wide: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """One wide aggregate row -> one output row per entry of ``rows``."""
    structs = [F.struct(*[c.alias(n) for n, c in fields]) for fields in rows]
    return wide.select(F.inline(F.array(*structs)))


def _agg_sql(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    """One aggregation pass from SQL expression texts (one JVM call each)."""
    return df.agg(*[F.expr(e) for e in exprs])


def _long_sql(wide: DataFrame, rows: Sequence[Sequence[tuple[str, str]]]) -> DataFrame:
    """Like ``_long`` with SQL expression texts: a single ``selectExpr``."""
    structs = ", ".join("named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields) + ")" for fields in rows)
    return wide.selectExpr(f"inline(array({structs}))")


def _lit(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _numeric(c: str) -> Column:
    return F.col(c).try_cast("double")


def _num_sql(c: str) -> str:
    return f"try_cast({sql_ident(c)} AS DOUBLE)"


# ---------------------------------------------------------------------------
# Shape, nulls, numeric summary
# ---------------------------------------------------------------------------

def table_shape(df: DataFrame) -> DataFrame:
    """B1: row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """B2: first ``n`` rows in the order of the key columns ``order`` (any ``n`` rows without one)."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """Column name, position and Spark type (from the plan, no data read)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column non-null, missing, missing %, blank-text count."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    aggs = ["count(1) AS __n"]
    for i, c in enumerate(cols):
        q = sql_ident(c)
        aggs.append(f"count({q}) AS nn{i}")
        aggs.append(f"count_if({q} IS NOT NULL AND {blank_sql(c)}) AS bl{i}" if types[c] == "string"
                    else f"CAST(0 AS BIGINT) AS bl{i}")
    wide = _agg_sql(df, aggs)
    rows = [[("column_name", _lit(c)), ("non_null", f"nn{i}"), ("missing", f"__n - nn{i}"),
             ("missing_pct", _pct_sql(f"__n - nn{i}", "__n", 3)), ("blank", f"bl{i}")]
            for i, c in enumerate(cols)]
    return _long_sql(wide, rows)


def numeric_summary(df: DataFrame, cols: Sequence[str], digits: int = 1,
                    relative_error: float | None = None) -> DataFrame:
    """Count, mean, std (sample), min, quartiles, max per column, rounded.

    Quartiles are exact with linear interpolation, from counts per (column, value) that
    are combined before their shuffle; running counts within ranges of a column's values find
    them (``stats.running_counts``), so no task holds a column. With ``relative_error`` they
    come from the mergeable, bounded-memory ``percentile_approx`` instead: values whose rank is
    off by at most that share of the rows.
    """
    names = list(cols)
    aggs = []
    for i, c in enumerate(names):
        v = _num_sql(c)
        aggs += [f"count({v}) AS n{i}", f"avg({v}) AS m{i}", f"stddev_samp({v}) AS s{i}", f"min({v}) AS lo{i}", f"max({v}) AS hi{i}"]
        if relative_error is not None:
            aggs.append(f"CAST(percentile_approx({v}, array(0.25D, 0.5D, 0.75D), {int(round(1.0 / relative_error))}) AS ARRAY<DOUBLE>) AS q{i}")
    fields = [("count", "n"), ("mean", "m"), ("std", "s"), ("min", "lo"), ("max", "hi")]
    rounded = [[("column_name", _lit(c))] + [(f, f"{k}{i}" if f == "count" else f"round({k}{i}, {digits})") for f, k in fields]
               + ([(f"q{p}", f"round(q{i}[{j}], {digits})") for j, p in enumerate((25, 50, 75))] if relative_error is not None else [])
               for i, c in enumerate(names)]
    wide = _long_sql(_agg_sql(df, aggs), rounded)
    if relative_error is not None:
        return wide
    pairs = _stack(df.selectExpr(*[f"{_num_sql(c)} AS {sql_ident(c)}" for c in names]), names, "double").where("value IS NOT NULL")
    counts = materialize(pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("__c")), "value-counts")
    q = quartiles(counts, "column_name", "value", "__c").select(
        "column_name", *[F.round(a, digits).alias(b) for a, b in (("q1", "q25"), ("median", "q50"), ("q3", "q75"))])
    return wide.join(F.broadcast(q), "column_name", "left")  # one row per column


# ---------------------------------------------------------------------------
# Range validation of date parts
# ---------------------------------------------------------------------------

def range_report(df: DataFrame, ranges: Mapping[str, tuple] = S.DATE_RANGES) -> DataFrame:
    """Min, max, distinct count, missing, invalid (outside [lo, hi]) and,
    when an expected set is given, the number of distinct unexpected values."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    names = [c for c in ranges if c in df.columns]
    for i, c in enumerate(names):
        lo, hi, expected = ranges[c]
        col = F.col(c)
        aggs += [F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}"),
                 F.count_distinct(col).alias(f"d{i}"), F.count_if(col.isNull()).alias(f"na{i}"),
                 F.count_if(col.isNotNull() & ~col.between(lo, hi)).alias(f"bad{i}")]
        if expected is not None:
            aggs.append(F.count_distinct(F.when(~col.isin(list(expected)), col)).alias(f"ux{i}"))
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(names):
        ux = F.col(f"ux{i}") if ranges[c][2] is not None else F.lit(None).cast("long")
        rows.append([("column_name", F.lit(c)), ("min_value", F.col(f"lo{i}").cast("long")),
                     ("max_value", F.col(f"hi{i}").cast("long")), ("n_distinct", F.col(f"d{i}")),
                     ("missing", F.col(f"na{i}")), ("missing_pct", _pct(F.col(f"na{i}"), F.col("__n"), 3)),
                     ("invalid", F.col(f"bad{i}")), ("unexpected_values", ux)])
    return _long(wide, rows)


def _stack(df: DataFrame, cols: Sequence[str], value_type: str = "long") -> DataFrame:
    """(column_name, value) pairs for ``cols`` -- one narrow projection per row."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(value_type).alias("value"))
                      for c in cols])
    return df.select(F.inline(pairs))


def range_values(df: DataFrame, cols: Sequence[str] = tuple(S.DATE_RANGES)) -> DataFrame:
    """B6 (unique values): every distinct value of each column with its row count
    (a grouped count, not a collected list, so any cardinality stays distributed)."""
    names = [c for c in cols if c in df.columns]
    return _stack(df, names).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def invalid_time_rows(df: DataFrame, cols: Sequence[str] = S.TIME_COLS,
                      keep: Sequence[str] = ("YEAR", "MONTH", "DAY")) -> DataFrame:
    """B10 (offending rows): each (row, time column) whose value is outside 0-2359."""
    names = [c for c in cols if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _numeric(c).alias("value")) for c in names])
    v = F.col("value")
    return (df.select(*keep, F.inline(pairs))
            .where(v.isNotNull() & ((v < HHMM_MIN) | (v > HHMM_MAX))))


def _top_per_column(counts: DataFrame, k: int, buckets: int = 64) -> DataFrame:
    """Top ``k`` values per column by count, exactly, in two phases: first per
    (column, hash bucket of the value), then per column over at most k x buckets
    candidates -- a column with many distinct values is never ranked in one task."""
    order = [F.desc("n"), F.asc("value")]
    salted = counts.withColumn("__b", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    w1 = Window.partitionBy("column_name", "__b").orderBy(*order)
    cand = salted.withColumn("rank", F.row_number().over(w1)).where(F.col("rank") <= k).drop("__b")
    w2 = Window.partitionBy("column_name").orderBy(*order)
    return cand.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def invalid_values_topk(df: DataFrame, ranges: Mapping[str, tuple] = S.DATE_RANGES, k: int = 15) -> DataFrame:
    """Most frequent out-of-range values per column (top ``k``)."""
    names = [c for c in ranges if c in df.columns]
    bad = F.lit(False)
    pairs = _stack(df, names)
    for c in names:
        lo, hi, _ = ranges[c]
        bad = bad | ((F.col("column_name") == c) & ~F.col("value").between(lo, hi))
    counts = pairs.where(F.col("value").isNotNull() & bad).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))
    return _top_per_column(counts, k)


# ---------------------------------------------------------------------------
# Clock-time validation
# ---------------------------------------------------------------------------

def time_report(df: DataFrame, cols: Sequence[str] = S.TIME_COLS) -> DataFrame:
    """Per raw time column (coerced to a number): min, max, missing, invalid
    (non-missing outside 0-2359)."""
    names = [c for c in cols if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(names):
        v = _numeric(c)
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.count_if(v.isNull()).alias(f"na{i}"),
                 F.count_if(v.isNotNull() & ((v < HHMM_MIN) | (v > HHMM_MAX))).alias(f"bad{i}")]
    wide = df.agg(*aggs)
    rows = [[("column_name", F.lit(c)), ("min_value", F.col(f"lo{i}")), ("max_value", F.col(f"hi{i}")),
             ("missing", F.col(f"na{i}")), ("missing_pct", _pct(F.col(f"na{i}"), F.col("__n"), 3)),
             ("invalid", F.col(f"bad{i}"))] for i, c in enumerate(names)]
    return _long(wide, rows)


def invalid_times_topk(df: DataFrame, cols: Sequence[str] = S.TIME_COLS, k: int = 12) -> DataFrame:
    """Most frequent out-of-range time values per column (top ``k``)."""
    names = [c for c in cols if c in df.columns]
    pairs = _stack(df.select(*[_numeric(c).alias(c) for c in names]), names, "double")
    v = F.col("value")
    counts = (pairs.where(v.isNotNull() & ((v < HHMM_MIN) | (v > HHMM_MAX)))
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    return _top_per_column(counts, k)


def hhmm_histogram(df: DataFrame, cols: Sequence[str] = S.TIME_COLS, clean_only: bool = False) -> DataFrame:
    """Counts per time-of-day bin [0,600) [600,1200) [1200,1800) [1800,2400),
    every bin listed (zero included). ``clean_only`` lists only columns without any
    value outside the bins."""
    names = [c for c in cols if c in df.columns]
    aggs = []
    for i, c in enumerate(names):
        v = _numeric(c)
        for j, (lo, hi) in enumerate(HHMM_BINS):
            aggs.append(F.count_if((v >= lo) & (v < hi)).alias(f"b{i}_{j}"))
        aggs.append(F.count_if((v < HHMM_BINS[0][0]) | (v >= HHMM_BINS[-1][1])).alias(f"out{i}"))
    wide = df.agg(*aggs)
    rows = [[("column_name", F.lit(c)), ("bin", F.lit(f"[{lo}, {hi})")), ("bin_start", F.lit(lo)),
             ("n", F.col(f"b{i}_{j}")), ("outside", F.col(f"out{i}"))]
            for i, c in enumerate(names) for j, (lo, hi) in enumerate(HHMM_BINS)]
    long = _long(wide, rows)
    return (long.where("outside = 0") if clean_only else long).drop("outside")


def time_format_report(df: DataFrame, cols: Sequence[str] = S.TIME_COLS) -> DataFrame:
    """After cleaning -- numeric range and the 4-character HHMM text twin
    (length and pattern), with a pass flag per column."""
    names = [c for c in cols if c in df.columns]
    aggs = []
    for i, c in enumerate(names):
        v, st = sql_ident(c), sql_ident(f"{c}_STR")
        ok = hhmm_sql(f"{c}_STR")
        aggs += [f"min({v}) AS lo{i}", f"max({v}) AS hi{i}", f"count_if({v} < {HHMM_MIN}) AS neg{i}",
                 f"count_if({v} > {HHMM_MAX}) AS over{i}", f"count_if({v} IS NULL) AS na{i}",
                 f"count_if({st} IS NOT NULL AND length({st}) <> 4) AS len{i}", f"count_if({ok}) AS ok{i}",
                 f"count_if({st} IS NOT NULL AND NOT ({ok})) AS nok{i}"]
    wide = _agg_sql(df, aggs)
    rows = [[("column_name", _lit(c)), ("min_value", f"CAST(lo{i} AS BIGINT)"),
             ("max_value", f"CAST(hi{i} AS BIGINT)"), ("below_zero", f"neg{i}"), ("above_2359", f"over{i}"),
             ("missing", f"na{i}"), ("wrong_length", f"len{i}"), ("valid_hhmm", f"ok{i}"),
             ("invalid_hhmm", f"nok{i}"),
             ("passed", f"(neg{i} = 0 AND over{i} = 0 AND len{i} = 0 AND nok{i} = 0)")]
            for i, c in enumerate(names)]
    return _long_sql(wide, rows)


def time_text_lengths(df: DataFrame, cols: Sequence[str] = S.TIME_COLS) -> DataFrame:
    """How many values of each length every ``_STR`` twin holds."""
    names = [c + "_STR" for c in cols if c + "_STR" in df.columns]
    pairs = _stack(df.select(*[F.length(c).alias(c) for c in names]), names, "int").where("value IS NOT NULL")
    return pairs.groupBy("column_name", F.col("value").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def bad_hhmm_examples(df: DataFrame, cols: Sequence[str] = S.TIME_COLS, k: int = 10) -> DataFrame:
    """The most frequent ``_STR`` values that are no clock time, per column (top ``k``)."""
    names = [c + "_STR" for c in cols if c + "_STR" in df.columns]
    bad = df.selectExpr(*[f"CASE WHEN NOT ({hhmm_sql(c)}) THEN {sql_ident(c)} END AS {sql_ident(c)}" for c in names])
    counts = _stack(bad, names, "string").where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return _top_per_column(counts, k)


def verdict(report: DataFrame, flag: str = "passed") -> DataFrame:
    """Overall pass/fail over the rows of a check report."""
    return report.agg(F.coalesce(F.bool_and(flag), F.lit(True)).alias("all_passed"),
                      F.count_if(~F.col(flag)).alias("failed_checks"))


# ---------------------------------------------------------------------------
# Cancellations, value counts, delay causes
# ---------------------------------------------------------------------------

def _fold_sides(parts: Sequence[DataFrame], key: str, fields: Sequence[str]) -> DataFrame:
    """Union long rows tagged with a ``stage`` and fold them to one row per ``key``
    (``<field>_<stage>`` columns) -- a small aggregation, no join."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    stages = [r for r in ("before", "after")]
    aggs = [F.max(F.when(F.col("stage") == st, F.col(f))).alias(f"{f}_{st}") for f in fields for st in stages]
    return both.groupBy(key).agg(*aggs)


def cancel_profile(before: DataFrame, after: DataFrame, cols: Sequence[str] = S.NA_WHEN_CANCELLED,
                   cancelled: str = "CANCELLED") -> DataFrame:
    """Cancelled count and %, and non-null counts among cancelled flights
    before and after the not-applicable nulling (one aggregation pass per side)."""
    names = [c for c in cols if c in before.columns]
    is_c = F.coalesce(F.col(cancelled) == 1, F.lit(False))

    def side(df: DataFrame, stage: str) -> DataFrame:
        wide = df.agg(F.count(F.lit(1)).alias("__n"), F.count_if(is_c).alias("__c"),
                      *[F.count_if(is_c & F.col(c).isNotNull()).alias(f"v{i}") for i, c in enumerate(names)])
        return _long(wide, [[("column_name", F.lit(c)), ("stage", F.lit(stage)), ("non_null", F.col(f"v{i}")),
                             ("cancelled", F.col("__c")), ("total", F.col("__n"))] for i, c in enumerate(names)])

    out = _fold_sides([side(before, "before"), side(after, "after")], "column_name",
                      ["non_null", "cancelled", "total"])
    return out.select("column_name", F.col("cancelled_before").alias("cancelled_flights"),
                      _pct(F.col("cancelled_before"), F.col("total_before"), 3).alias("cancelled_pct"),
                      "non_null_before", "non_null_after")


def value_counts(df: DataFrame, col: str, stage: str | None = None) -> DataFrame:
    """Frequency of each value, null included."""
    out = df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return out if stage is None else out.withColumn("stage", F.lit(stage))


def delay_cause_checks(raw: DataFrame, cleaned: DataFrame, cols: Sequence[str] = S.DELAY_CAUSE_COLS) -> DataFrame:
    """Blank strings before cleaning, negatives and positives after, and
    the number of rows with any positive cause."""
    names = [c for c in cols if c in cleaned.columns]
    b = raw.agg(*[F.count_if(F.col(c).isNotNull() & is_blank(c)).alias(f"bl{i}") for i, c in enumerate(names)])
    any_pos = F.greatest(*[F.col(c) for c in names]) > 0
    a = cleaned.agg(F.count_if(any_pos).alias("__anypos"),
                    *[F.count_if(F.col(c) < 0).alias(f"neg{i}") for i, c in enumerate(names)],
                    *[F.count_if(F.col(c) > 0).alias(f"pos{i}") for i, c in enumerate(names)])
    before = _long(b, [[("column_name", F.lit(c)), ("stage", F.lit("before")), ("blank", F.col(f"bl{i}"))]
                       for i, c in enumerate(names)])
    after = _long(a, [[("column_name", F.lit(c)), ("stage", F.lit("after")), ("negative", F.col(f"neg{i}")),
                       ("positive", F.col(f"pos{i}")), ("any_positive", F.col("__anypos"))]
                      for i, c in enumerate(names)])
    out = _fold_sides([before, after], "column_name", ["blank", "negative", "positive", "any_positive"])
    return out.select("column_name", F.col("blank_before"), F.col("negative_after"), F.col("positive_after"),
                      F.col("any_positive_after").alias("rows_with_any_positive"))


# ---------------------------------------------------------------------------
# Code checks against the lookups
# ---------------------------------------------------------------------------

def _codes(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(col).cast("string").alias("code")).where(F.col("code").isNotNull())


def code_summary(df: DataFrame, lookup: DataFrame, cols: Sequence[str], key: str = "IATA_CODE",
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Distinct codes seen in ``cols`` (union), how many match the lookup,
    how many do not."""
    seen = None
    for c in cols:
        part = _codes(df, c)
        seen = part if seen is None else seen.unionByName(part)
    seen = seen.distinct()
    keys = broadcast_if_small(lookup_keys(lookup, key).withColumnRenamed(key, "code"), max_broadcast_rows)
    flagged = seen.join(keys.withColumn("__m", F.lit(1)), "code", "left")
    return flagged.agg(F.count(F.lit(1)).alias("distinct_codes"),
                       F.count("__m").alias("matched"),
                       F.count_if(F.col("__m").isNull()).alias("invalid"))


def invalid_codes(df: DataFrame, lookup: DataFrame, cols: Sequence[str], key: str = "IATA_CODE",
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows per code missing from the lookup, per side and
    summed over the sides (side = 'ALL')."""
    keys = broadcast_if_small(lookup_keys(lookup, key).withColumnRenamed(key, "code"), max_broadcast_rows)
    per_side = None
    for c in cols:
        # counted first: a frequent code is one row when it meets the lookup
        part = (_codes(df, c).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
                .join(keys, "code", "left_anti").withColumn("side", F.lit(c)))
        per_side = part if per_side is None else per_side.unionByName(part)
    total = per_side.groupBy("code").agg(F.sum("n").alias("n")).withColumn("side", F.lit("ALL"))
    return per_side.unionByName(total)


def code_set_difference(df: DataFrame, lookup: DataFrame, cols: Sequence[str], key: str = "IATA_CODE",
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, first: int | None = None) -> DataFrame:
    """Distinct codes of the union of ``cols`` that the lookup lacks (I5: the ``first`` of them in order)."""
    seen = None
    for c in cols:
        part = _codes(df, c)
        seen = part if seen is None else seen.union(part)
    keys = broadcast_if_small(lookup_keys(lookup, key).withColumnRenamed(key, "code"), max_broadcast_rows)
    out = seen.distinct().join(keys, "code", "left_anti")
    return out.orderBy("code").limit(first) if first else out


def code_breakdown(df: DataFrame, airports: DataFrame, origin: str = "ORIGIN_AIRPORT",
                   destination: str = "DESTINATION_AIRPORT", key: str = "IATA_CODE",
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows with both codes valid / any invalid / only origin / only
    destination / both invalid, with percentages (flags from two broadcast left
    joins, counted in one pass)."""
    keys = lookup_keys(airports, key)
    known = lambda c, flag: keys.select(F.col(key).alias(c), F.lit(True).alias(flag))
    codes = df.select(F.col(origin).cast("string").alias(origin), F.col(destination).cast("string").alias(destination))
    flagged = lookup_join(codes, known(origin, "__o"), [origin], "left", max_broadcast_rows, check_unique=False)
    flagged = lookup_join(flagged, known(destination, "__d"), [destination], "left", max_broadcast_rows, check_unique=False)
    vo, vd = F.col("__o").isNotNull(), F.col("__d").isNotNull()
    n = F.count(F.lit(1))
    out = flagged.agg(n.alias("total_rows"), F.count_if(vo & vd).alias("both_valid"),
                      F.count_if(~(vo & vd)).alias("any_invalid"),
                      F.count_if(~vo & vd).alias("origin_only_invalid"),
                      F.count_if(vo & ~vd).alias("destination_only_invalid"),
                      F.count_if(~vo & ~vd).alias("both_invalid"))
    return out.withColumns({"both_valid_pct": _pct(F.col("both_valid"), F.col("total_rows"), 2),
                            "any_invalid_pct": _pct(F.col("any_invalid"), F.col("total_rows"), 2)})


def row_accounting(flagged: DataFrame, keep: str = "keep",
                   code_cols: Sequence[str] = ("ORIGIN_AIRPORT", "DESTINATION_AIRPORT")) -> DataFrame:
    """Rows before and after a filter, removed count and %, kept %, and the
    distinct codes left in ``code_cols``.

    ``flagged`` holds all rows and whether the filter keeps each: one pass counts them by
    their codes, and the rest works on those few groups.
    """
    kept = F.coalesce(F.col(keep), F.lit(False))
    groups = flagged.groupBy(kept.alias("__keep"), *code_cols).agg(F.count(F.lit(1)).alias("__n"))
    codes = groups.select("__keep", "__n", F.posexplode(F.array(*[F.col(c).cast("string") for c in code_cols])).alias("__side", "__code"))
    per_code = codes.groupBy("__code").agg(F.sum(F.when(F.col("__side") == 0, F.col("__n"))).alias("before"),
                                           F.sum(F.when((F.col("__side") == 0) & F.col("__keep"), F.col("__n"))).alias("after"),
                                           F.max("__keep").alias("left"))
    wide = per_code.agg(F.coalesce(F.sum("before"), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("after"), F.lit(0)).alias("rows_after"),
                        F.count_if(F.col("left") & F.col("__code").isNotNull()).alias("distinct_codes_left"))
    removed = F.col("rows_before") - F.col("rows_after")
    return wide.withColumns({"rows_removed": removed,
                             "removed_pct": _pct(removed, F.col("rows_before"), 2),
                             "kept_pct": F.round(100 - removed * 100.0 / F.col("rows_before"), 2)})


# ---------------------------------------------------------------------------
# Join coverage and coordinate patches
# ---------------------------------------------------------------------------

def unmatched_after_joins(enriched: DataFrame) -> DataFrame:
    """Rows left without lookup data by each join."""
    wide = enriched.agg(F.count_if(F.col("AIRLINE_FULL_NAME").isNull()).alias("a"),
                        F.count_if(F.col("ORIGIN_AIRPORT_NAME").isNull()).alias("o"),
                        F.count_if(F.col("DESTINATION_AIRPORT_NAME").isNull()).alias("d"))
    return _long(wide, [[("join_name", F.lit("airlines")), ("unmatched", F.col("a"))],
                        [("join_name", F.lit("origin_airports")), ("unmatched", F.col("o"))],
                        [("join_name", F.lit("destination_airports")), ("unmatched", F.col("d"))]])


def missing_metadata(enriched: DataFrame, roles: Sequence[str] = ("ORIGIN", "DESTINATION")) -> DataFrame:
    """Rows whose airport name, city or latitude is missing, per role and code."""
    out = None
    for role in roles:
        miss = (F.col(f"{role}_AIRPORT_NAME").isNull() | F.col(f"{role}_CITY").isNull()
                | F.col(f"{role}_LAT").isNull())
        part = (enriched.where(miss).groupBy(F.col(f"{role}_AIRPORT").alias("code"))
                .agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(role)))
        out = part if out is None else out.unionByName(part)
    return out


def rows_for_code(enriched: DataFrame, code: str, role: str = "ORIGIN") -> DataFrame:
    """The rows of one airport code (point lookup, pushed to the scan)."""
    cols = [f"{role}_AIRPORT", f"{role}_AIRPORT_NAME", f"{role}_CITY", f"{role}_STATE",
            f"{role}_LAT", f"{role}_LON"]
    return enriched.where(F.col(f"{role}_AIRPORT") == code).select(*cols)


def patched_rows(enriched: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Rows affected per patched code, as origin, as destination, and summed."""
    o = enriched.where(F.col("ORIGIN_AIRPORT").isin(list(codes))).groupBy(
        F.col("ORIGIN_AIRPORT").alias("code")).agg(F.count(F.lit(1)).alias("origin_rows"))
    d = enriched.where(F.col("DESTINATION_AIRPORT").isin(list(codes))).groupBy(
        F.col("DESTINATION_AIRPORT").alias("code")).agg(F.count(F.lit(1)).alias("destination_rows"))
    out = o.join(d, "code", "full").fillna(0, ["origin_rows", "destination_rows"])
    return out.withColumn("total_rows", F.col("origin_rows") + F.col("destination_rows"))


# ---------------------------------------------------------------------------
# Duplicates and junk text
# ---------------------------------------------------------------------------

def row_digests(cols: Sequence[str]) -> list[Column]:
    """Two independent 64-bit hashes of the values of ``cols``. Equal values have equal digests; different ones may
    share them (nulls leave a hash as it is), so whoever uses digests compares the values afterwards."""
    values = [F.col(f"`{c}`") for c in cols]
    return [F.xxhash64(*values).alias("__d1"), F.xxhash64(F.lit(1), *reversed(values), F.lit(2)).alias("__d2")]


def _repeated(df: DataFrame, subset: Sequence[str], digest) -> tuple[DataFrame, DataFrame]:
    """(one row: rows, digests seen once; the rows of ``df`` whose digest occurs more than once).

    Only digests are grouped over all rows. Whole rows move only where a digest is repeated, and
    not even those where the repeated digests are few enough to broadcast.
    """
    keyed = df.select(*df.columns, *digest(subset))
    counts = materialize(keyed.groupBy("__d1", "__d2").agg(F.count(F.lit(1)).alias("__c")), "row-digests")
    once = counts.agg(F.coalesce(F.sum("__c"), F.lit(0)).alias("__rows"), F.count_if(F.col("__c") == 1).alias("__once"))
    again = counts.where("__c > 1").select(F.col("__d1").alias("__r1"), F.col("__d2").alias("__r2"))
    on = (F.col("__d1") == F.col("__r1")) & (F.col("__d2") == F.col("__r2"))
    if fits_broadcast(again):
        return once, keyed.join(F.broadcast(again), on, "left_semi").select(*df.columns)
    pair = keyed.withColumn("__d", F.struct("__d1", "__d2"))
    met = semi_join(pair, "__d", again.select(F.struct(F.col("__r1").alias("__d1"), F.col("__r2").alias("__d2")).alias("__r")), "__r", max_broadcast_rows=0)
    return once, met.select(*df.columns)


def duplicate_report(df: DataFrame, subset: Sequence[str] | None = None, digest=row_digests) -> DataFrame:
    """Duplicate rows (beyond the first of each group), their %, unique rows.

    Groups compare nulls as equal. Rows are grouped by digest; a digest that occurs once is a
    unique row, the others are grouped by their values.
    """
    subset = list(subset or df.columns)
    once, rows = _repeated(df.select(*subset), subset, digest)
    groups = rows.groupBy(*subset).agg(F.lit(1)).agg(F.count(F.lit(1)).alias("__groups"))
    out = once.join(F.broadcast(groups)).select(F.col("__rows").alias("total_rows"), (F.col("__once") + F.col("__groups")).alias("unique_rows"))  # one row each
    dup = F.col("total_rows") - F.col("unique_rows")
    return out.select("total_rows", dup.alias("duplicate_rows"),
                      F.round(F.try_divide(dup * 100.0, F.col("total_rows")), 4).alias("duplicate_pct"), "unique_rows")


def duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None, digest=row_digests, **skew) -> DataFrame:
    """Every member of a duplicate group (keep=False), with the group size ``copies``.

    Only rows whose digest occurs more than once are grouped by their values. Without
    ``subset`` the members of a group are equal in all columns, so each group of more than
    one row is repeated that often: no join. With it, only those rows are joined with their
    groups (rows of hot groups meet a broadcast table and are not shuffled; see
    ``join_group_values``).
    """
    subset = list(subset or df.columns)
    _, rows = _repeated(df, subset, digest)
    groups = rows.groupBy(*subset).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    if set(subset) == set(df.columns):
        return groups.select(*df.columns, "copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("col")
    return join_group_values(rows, subset, groups, "copies", ["copies"], null_safe=True, **skew).where(F.col("copies").isNotNull())


def junk_text_report(df: DataFrame, cols: Sequence[str] = S.JUNK_TEXT_COLS,
                     code_cols: Sequence[str] = S.CODE_COLS) -> DataFrame:
    """Per text column, values with control characters, with more than
    five special characters, and (code columns only) digits-only values."""
    names = [c for c in cols if c in df.columns]
    aggs = []
    for i, c in enumerate(names):
        aggs += [f"count_if({control_chars_sql(c)}) AS cc{i}",
                 f"count_if({special_char_count_sql(c)} > {MAX_SPECIAL_CHARS}) AS sp{i}",
                 (f"count_if({digits_only_sql(c)})" if c in code_cols else "CAST(0 AS BIGINT)") + f" AS dg{i}"]
    wide = _agg_sql(df, aggs)
    rows = [[("column_name", _lit(c)), ("non_printable", f"cc{i}"), ("excessive_special", f"sp{i}"),
             ("pure_numeric", f"dg{i}")] for i, c in enumerate(names)]
    return _long_sql(wide, rows)


def _junk_cells(df: DataFrame, cols: Sequence[str], code_cols: Sequence[str]) -> dict[str, Column]:
    """The offending cell of each text column, null where it is fine."""
    out = {}
    for c in [x for x in cols if x in df.columns]:
        bad = has_control_chars(c) | (special_char_count(c) > MAX_SPECIAL_CHARS)
        if c in code_cols:
            bad = bad | is_digits_only(c)
        out[c] = F.when(bad, F.col(c).cast("string"))
    return out


def junk_values_topk(df: DataFrame, cols: Sequence[str] = S.JUNK_TEXT_COLS, code_cols: Sequence[str] = S.CODE_COLS,
                     k: int = 10, counters: int = COUNTERS) -> DataFrame:
    """B36 + I4: the most frequent offending values per column (top ``k``). Free text can hold any number of
    different ones: tasks keep a bounded summary each (``heavy_hitters``)."""
    return top_values(df.select(F.inline(cells(_junk_cells(df, cols, code_cols)))), k, counters)


def frequent_texts(df: DataFrame, cols: Sequence[str], k: int = 20, counters: int = COUNTERS) -> DataFrame:
    """I4: the most frequent values per text column (top ``k``), by bounded summaries."""
    return top_values(df.select(F.inline(cells({c: F.col(c) for c in cols}))), k, counters)


def junk_values(df: DataFrame, cols: Sequence[str] = S.JUNK_TEXT_COLS,
                code_cols: Sequence[str] = S.CODE_COLS) -> DataFrame:
    """The distinct offending values per column, all columns in one pass."""
    return df.select(F.inline(cells(_junk_cells(df, cols, code_cols)))).distinct()
