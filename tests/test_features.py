from datetime import date

from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators.features import (
    PER_DAY, PER_WEEK, add_features, add_model_features, add_scalar_features,
)


def _flights(spark):
    rows = [
        # tail, y, m, d, dow, sched, origin, dest, dep_delay, arr_delay, weather, cancelled, diverted, distance
        ("N1", 2015, 12, 31, 4, "0530", "AAA", "BBB", 20.0, 16.0, 1, 0, 0, 1500.0),
        ("N1", 2015, 12, 31, 4, "0545", "AAA", "CCC", None, None, None, 1, 0, 499.0),
        ("N1", 2016, 1, 1, 5, "2310", "BBB", "AAA", 0.0, 15.0, 0, 0, 1, 2000.0),
        ("N1", 2016, 1, 4, 1, "0500", "AAA", "BBB", 5.0, -3.0, 0, 0, 0, -1.0),
        (None, 2015, 12, 31, 4, "0530", "AAA", "BBB", 1.0, 1.0, 0, 0, 0, 10.0),
        ("N2", 2015, 2, 31, 6, None, "AAA", "BBB", 1.0, 1.0, 0, 0, 0, 10.0),
    ]
    schema = ("TAIL_NUMBER string, YEAR int, MONTH int, DAY int, DAY_OF_WEEK int, SCHEDULED_DEPARTURE_STR string, "
              "ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, DEPARTURE_DELAY double, ARRIVAL_DELAY double, "
              "WEATHER_DELAY int, CANCELLED int, DIVERTED int, DISTANCE double")
    return spark.createDataFrame(rows, schema)


def test_scalar_features(spark):
    r = add_scalar_features(_flights(spark)).collect()
    assert r[0].ROUTE == "AAA-BBB" and r[0].DEPARTURE_HOUR == 5 and r[0].DAYPART == "Night"
    assert r[0].IS_DELAYED_DEPARTURE and r[0].IS_DELAYED_ARRIVAL and r[0].HAS_WEATHER_DELAY
    assert r[0].TOTAL_DELAY == 36.0 and r[0].DISTANCE_CATEGORY == "long_haul" and r[0].SEASON == "Winter"
    assert not r[1].IS_DELAYED_DEPARTURE and r[1].TOTAL_DELAY == 0.0 and r[1].IS_CANCELLED
    assert not r[2].IS_DELAYED_ARRIVAL and r[2].IS_DIVERTED and r[2].DAYPART == "Evening"
    assert r[3].DISTANCE_CATEGORY is None
    assert r[5].FLIGHT_DATE is None and r[5].DEPARTURE_HOUR is None and r[5].DAYPART is None and r[5].IS_WEEKEND


def test_group_counts_and_iso_week(spark):
    r = sorted(add_features(_flights(spark)).collect(), key=lambda x: (x.TAIL_NUMBER or "", x.FLIGHT_DATE or date.min))
    by = {(x.TAIL_NUMBER, x.FLIGHT_DATE, x.DEPARTURE_HOUR): x for x in r}
    a = by[("N1", date(2015, 12, 31), 5)]
    assert a[PER_DAY] == 2 and (a.ISO_YEAR, a.ISO_WEEK) == (2015, 53)
    # 2015-12-31 and 2016-01-01 share ISO week 2015-W53; 2016-01-04 starts W1
    assert a[PER_WEEK] == 3 and by[("N1", date(2016, 1, 4), 5)][PER_WEEK] == 1
    assert a.ORIGIN_CONGESTION == 3  # AAA, 2015-12-31, hour 5: two N1 flights and the null-tail one
    nul = by[(None, date(2015, 12, 31), 5)]
    assert nul[PER_DAY] is None and nul[PER_WEEK] is None and nul.ORIGIN_CONGESTION == 3
    bad = by[("N2", None, None)]
    assert bad[PER_DAY] is None and bad.ORIGIN_CONGESTION is None


def test_model_features(spark):
    df = spark.createDataFrame([(1501.0, 18, 0, 0, 1, 0), (1500.0, 17, 0, 0, 0, 0), (None, None, None, 0, 0, 0)],
                               "DISTANCE double, DEPARTURE_HOUR int, AIRLINE_DELAY int, WEATHER_DELAY int, "
                               "AIR_SYSTEM_DELAY int, LATE_AIRCRAFT_DELAY int")
    r = add_model_features(df).collect()
    assert (r[0].IS_LONG_DISTANCE, r[0].IS_EVENING, r[0].HAS_DELAY_CAUSE) == (1, 1, 1)
    assert (r[1].IS_LONG_DISTANCE, r[1].IS_EVENING, r[1].HAS_DELAY_CAUSE) == (0, 0, 0)
    assert (r[2].IS_LONG_DISTANCE, r[2].IS_EVENING, r[2].HAS_DELAY_CAUSE) == (0, 0, 0)


def test_feature_stage_persists_only_when_told(spark):
    from contrail.plans.pipeline import feature_stage
    from contrail.session import materialize
    s1 = materialize(add_scalar_features(_flights(spark)), "unit-stage1")
    lazy = feature_stage(s1, broadcast_max_rows=0)
    assert not any("flights-features" in f for f in lazy.inputFiles())
    written = feature_stage(s1, persist=True)
    assert all("flights-features" in f for f in written.inputFiles())
    cols = sorted(lazy.columns)
    assert lazy.select(cols).exceptAll(written.select(cols)).count() == 0 and lazy.count() == written.count()


def test_dates_of_integer_parts_are_not_parsed(spark):
    """The arithmetic date is that of the text, for valid, invalid and null parts."""
    from itertools import product

    from contrail.functions.calendar import date_from_numbers, flight_date
    parts = product([None, -2015, -5, 0, 999, 1900, 2015, 2016, 12345], [None, 0, 2, 4, 12, 13], [None, -3, 0, 1, 28, 29, 30, 31, 32])
    df = spark.createDataFrame([(*p, 0) for p in parts], "YEAR int, MONTH int, DAY int, SCHEDULED_DEPARTURE int")
    both = df.select(flight_date("YEAR", "MONTH", "DAY").alias("a"), date_from_numbers("YEAR", "MONTH", "DAY").alias("b"))
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).isEmpty() and not both.where("b IS NOT NULL").isEmpty()
    flights = df.withColumns({c: F.lit(0) for c in ("DEPARTURE_DELAY", "ARRIVAL_DELAY", "WEATHER_DELAY")}).withColumns(
        {c: F.lit("x") for c in ("ORIGIN_AIRPORT", "DESTINATION_AIRPORT")})
    dated = add_scalar_features(flights).select("FLIGHT_DATE")
    assert "gettimestamp" not in dated._jdf.queryExecution().optimizedPlan().toString().lower()


def test_the_queries_share_no_written_wide_table(spark, tmp_path):
    """A query over the enriched rows reads only the columns that it needs, from the raw flights."""
    from contrail.plans.pipeline import FlightFrames, enriched_rows
    raw = spark.createDataFrame([(1, 2015, 1, 2, 3, "AA", "N1", "JFK", "LAX")],
                                "id int, YEAR int, MONTH int, DAY int, DAY_OF_WEEK int, AIRLINE string, TAIL_NUMBER string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string")
    raw = raw.withColumns({c: F.lit(1) for c in (*S.TIME_COLS, *S.NA_WHEN_CANCELLED, "CANCELLED", "DIVERTED", "DISTANCE") if c not in raw.columns})
    raw = raw.withColumns({c: F.lit("0") for c in ("CANCELLATION_REASON", *S.DELAY_CAUSE_COLS)})
    raw.write.parquet(str(tmp_path / "raw"))
    airports = spark.createDataFrame([("JFK", "J", "NYC", "NY", "USA", 1.0, 2.0), ("LAX", "L", "LA", "CA", "USA", 3.0, 4.0)],
                                     "IATA_CODE string, AIRPORT string, CITY string, STATE string, COUNTRY string, LATITUDE double, LONGITUDE double")
    airlines = spark.createDataFrame([("AA", "American")], "IATA_CODE string, AIRLINE string")
    rows = enriched_rows(FlightFrames(spark.read.parquet(str(tmp_path / "raw")), airlines, airports))
    assert len(rows.columns) > 40 and rows.count() == 1
    cut = rows.select("ORIGIN_CITY", "MONTH")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    scanned = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert cut.first()["ORIGIN_CITY"] == "NYC" and "TAXI_OUT" not in scanned and "WEATHER_DELAY" not in scanned
