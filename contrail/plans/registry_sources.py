"""Registered source and sink queries (A1-A3, A5, A8, A9, A11): what is written comes back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.operators.joins import lookup_join
from contrail.plans import oracle as O
from contrail.plans.pipeline import fixture_frames
from contrail.plans.registry import KEYS, register
from contrail.session import materialize, scratch_path
from contrail.sources import files as FS
from contrail.sources import versions as V

# The columns that the flight view shares with the raw file, keyed by the view's row identity.
_FIELDS = [T.StructField(k, T.LongType()) for k in KEYS] + [
    f for f in S.FLIGHTS_RAW.fields if f.name not in ("FLIGHT_NUMBER", "SCHEDULED_TIME")]
_SQL_TYPE = {"long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def _as_file(f: T.StructField) -> str:
    """An empty CSV cell is a missing value."""
    value = f"CAST({f.name} AS {_SQL_TYPE[f.dataType.typeName()]})"
    return f"NULLIF({value}, '') AS {f.name}" if f.dataType == T.StringType() else f"{value} AS {f.name}"


_AS_FILE = ", ".join(_as_file(f) for f in _FIELDS)


@register("csv_flights_round_trip", O.with_stages(f"SELECT {_AS_FILE} FROM fv"))
def q_csv_flights_round_trip(spark, sf):
    """Gzip CSV with its columns in reverse order, read back by header name."""
    path = scratch_path(spark, "flights-csv")
    raw = fixture_frames(spark, sf).raw
    FS.write_table(raw.select(*[f.name for f in reversed(_FIELDS)]), path, "csv", partition_by=None, compression="gzip")
    return FS.read_flights(spark, path, schema=T.StructType(_FIELDS))


@register("csv_airlines_round_trip", O.with_stages("SELECT IATA_CODE, AIRLINE FROM airlines"))
def q_csv_airlines_round_trip(spark, sf):
    path = scratch_path(spark, "airlines-csv")
    FS.write_table(fixture_frames(spark, sf).airlines, path, "csv", partition_by=None, compression="gzip")
    return FS.read_airlines(spark, path)


@register("csv_airports_round_trip", O.with_stages(
    "SELECT IATA_CODE, AIRPORT, CITY, STATE, COUNTRY, CAST(LATITUDE AS DOUBLE) AS LATITUDE, CAST(LONGITUDE AS DOUBLE) AS LONGITUDE FROM airports"))
def q_csv_airports_round_trip(spark, sf):
    path = scratch_path(spark, "airports-csv")
    FS.write_table(fixture_frames(spark, sf).airports, path, "csv", partition_by=None)
    return FS.read_airports(spark, path)


@register("catalog_round_trip", O.with_stages("SELECT IATA_CODE, AIRLINE FROM airlines"))
def q_catalog_round_trip(spark, sf):
    path = scratch_path(spark, "catalog")
    name = "contrail_airlines_" + path.rsplit("-", 1)[1]
    FS.save_as_table(fixture_frames(spark, sf).airlines, name, path=path)
    try:
        return materialize(FS.read_table(spark, name), "catalog-rows")
    finally:
        spark.sql(f"DROP TABLE {name}")


@register("rewrite_in_place", O.with_stages("SELECT IATA_CODE, upper(AIRLINE) AS AIRLINE FROM airlines"))
def q_rewrite_in_place(spark, sf):
    path = scratch_path(spark, "rewritten")
    FS.write_table(fixture_frames(spark, sf).airlines, path, partition_by=None)
    FS.rewrite_in_place(spark, path, lambda df: df.withColumn("AIRLINE", F.upper("AIRLINE")))
    return spark.read.parquet(path)


@register("partitioned_write", O.with_stages("SELECT MONTH, COUNT(*) AS n FROM fv WHERE MONTH IN (2, 11) GROUP BY 1"))
def q_partitioned_write(spark, sf):
    """Month-partitioned Parquet; the month filter prunes folders."""
    path = scratch_path(spark, "by-month")
    FS.write_table(fixture_frames(spark, sf).raw.select(*KEYS, "MONTH"), path)
    return spark.read.parquet(path).where(F.col("MONTH").isin(2, 11)).groupBy("MONTH").agg(F.count(F.lit(1)).alias("n"))


# One line in five is broken, each in its own way, by the row's key.
_KIND = "(l_orderkey * 7 + l_linenumber) % 25"
_LINE_FIELDS = [T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.LongType()),
                T.StructField("AIRLINE", T.StringType()), T.StructField("MONTH", T.IntegerType())]
_REASON = (f"CASE {_KIND} WHEN 0 THEN 'too few cells' WHEN 1 THEN 'too many cells' WHEN 2 THEN 'open quote' "
           "WHEN 3 THEN 'open quote' WHEN 4 THEN 'bad encoding' ELSE 'good' END")


@register("csv_quarantine", O.with_stages(
    f"SELECT {_REASON} AS reason, COUNT(*) AS n, CAST(SUM(l_orderkey) AS BIGINT) AS key_sum FROM fv GROUP BY 1"))
def q_csv_quarantine(spark, sf):
    """A1, A10: every flight as a line of CSV files, one in five broken; rows that load and rejected lines with their reason."""
    path = scratch_path(spark, "broken-csv")
    header = ",".join(f.name for f in _LINE_FIELDS)
    raw = fixture_frames(spark, sf).raw.withColumn("code", F.regexp_replace(F.coalesce("AIRLINE", F.lit("")), "[^A-Za-z0-9]", ""))
    start = "concat(l_orderkey, ',', l_linenumber, ','"
    line = (f"CASE {_KIND} WHEN 0 THEN {start}, code) WHEN 1 THEN {start}, code, ',', coalesce(MONTH, ''), ',x') "
            f"WHEN 2 THEN {start}, '\"', code, ',', coalesce(MONTH, '')) WHEN 3 THEN {start}, code, ',\"', coalesce(MONTH, '')) "
            f"WHEN 4 THEN {start}, code, '\ufffd,', coalesce(MONTH, '')) ELSE {start}, '\"', code, '\",', coalesce(MONTH, '')) END")
    lines = raw.select(F.expr(line).alias(header))
    # one column, whose name is the header line; a separator and a quote that no line holds keep the lines as they are
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").option("escapeQuotes", False).csv(path)
    good, rejects = FS.read_quarantined(spark, path, T.StructType(_LINE_FIELDS))
    loaded = good.select(F.lit("good").alias("reason"), "l_orderkey")
    left = rejects.select("reason", F.split_part("line", F.lit(","), F.lit(1)).cast("long").alias("l_orderkey"))
    return loaded.unionByName(left).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"))


@register("versioned_replace", O.with_stages(
    "SELECT 1::BIGINT AS version, IATA_CODE, AIRLINE FROM airlines UNION ALL SELECT 2, IATA_CODE, upper(AIRLINE) FROM airlines"))
def q_versioned_replace(spark, sf):
    """A table replaced by a transformed version of itself; the old version stays readable."""
    path = scratch_path(spark, "versioned")
    V.write_version(fixture_frames(spark, sf).airlines, path)
    V.replace(spark, path, lambda df: df.withColumn("AIRLINE", F.upper("AIRLINE")))
    both = [V.read_version(spark, path, v).select(F.lit(v).cast("long").alias("version"), "IATA_CODE", "AIRLINE") for v in V.versions(spark, path)]
    return both[0].unionByName(both[1])


@register("current_database", O.with_stages("SELECT IATA_CODE, upper(AIRLINE) AS AIRLINE FROM airlines"))
def q_current_database(spark, sf):
    """A table saved and read under its short name in the current database."""
    path = scratch_path(spark, "database")
    name, before = "contrail_db_" + path.rsplit("-", 1)[1], spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    try:
        FS.use_catalog(spark, database=name)
        FS.save_as_table(fixture_frames(spark, sf).airlines.withColumn("AIRLINE", F.upper("AIRLINE")), "airlines_here", path=f"{path}/airlines_here")
        FS.use_catalog(spark, database=before)
        return materialize(FS.read_table(spark, f"{name}.airlines_here"), "database-rows")
    finally:
        FS.use_catalog(spark, database=before)
        spark.sql(f"DROP DATABASE {name} CASCADE")


_WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


@register("literal_labels", O.with_stages(
    "SELECT label, COUNT(*) AS n FROM fv JOIN (VALUES " + ", ".join(f"('{i + 1}', '{d}')" for i, d in enumerate(_WEEKDAYS))
    + ") w(code, label) ON CAST(DAY_OF_WEEK AS VARCHAR) = code GROUP BY 1"))
def q_literal_labels(spark, sf):
    """Flights per weekday name; the names are a literal table."""
    names = FS.literal_table(spark, [(str(i + 1), d) for i, d in enumerate(_WEEKDAYS)], ["code", "label"])
    flights = fixture_frames(spark, sf).raw.select(F.col("DAY_OF_WEEK").cast("string").alias("code"))
    return lookup_join(flights, names, ["code"], "inner").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register("missing_input_fails", O.with_stages("SELECT AIRLINE, COUNT(*) AS n, TRUE AS failed FROM fv GROUP BY 1"))
def q_missing_input_fails(spark, sf):
    """A10: a missing input fails loudly, for every reader; the flights are counted beside it."""
    gone = scratch_path(spark, "never-written")
    failed = 0
    for read in (FS.read_flights, FS.read_airlines, FS.read_airports, FS.read_quarantined, V.read_version):
        try:
            read(spark, gone)
        except FileNotFoundError:
            failed += 1
    return fixture_frames(spark, sf).raw.groupBy("AIRLINE").agg(F.count(F.lit(1)).alias("n")).withColumn("failed", F.lit(failed == 5))
