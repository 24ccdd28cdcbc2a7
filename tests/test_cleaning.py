from pyspark.sql import functions as F

from contrail.operators import cleaning as C


def test_clean_times_and_str_twin(spark):
    df = spark.createDataFrame([("2400", "615.0"), ("5", None), ("abc", "2359")], "SCHEDULED_DEPARTURE string, ARRIVAL_TIME string")
    out = C.clean_times(df).collect()
    assert [(r.SCHEDULED_DEPARTURE, r.SCHEDULED_DEPARTURE_STR) for r in out] == [(0, "0000"), (5, "0005"), (None, None)]
    assert [(r.ARRIVAL_TIME, r.ARRIVAL_TIME_STR) for r in out] == [(615, "0615"), (None, None), (2359, "2359")]
    assert "WHEELS_OFF_STR" not in C.clean_times(df).columns  # only existing columns get a twin


def test_null_when_cancelled_keeps_wheels_off_and_schedule(spark):
    df = spark.createDataFrame([(1, 100, 200, 300, 5.0), (0, 100, 200, 300, 5.0), (None, 100, 200, 300, 5.0)],
                               "CANCELLED int, DEPARTURE_TIME int, WHEELS_OFF int, SCHEDULED_DEPARTURE int, ARRIVAL_DELAY double")
    out = C.null_when_cancelled(C.clean_times(df)).collect()
    assert out[0].DEPARTURE_TIME is None and out[0].DEPARTURE_TIME_STR is None and out[0].ARRIVAL_DELAY is None
    assert out[0].WHEELS_OFF == 200 and out[0].WHEELS_OFF_STR == "0200" and out[0].SCHEDULED_DEPARTURE == 300
    assert out[1].DEPARTURE_TIME == 100 and out[2].DEPARTURE_TIME == 100


def test_fill_cancellation_reason(spark):
    df = spark.createDataFrame([(0, "A"), (1, None), (1, "B"), (None, None), (None, "C")],
                               "CANCELLED int, CANCELLATION_REASON string")
    assert [r[0] for r in C.fill_cancellation_reason(df).select("CANCELLATION_REASON").collect()] == \
        ["NC", "NC", "B", "NC", "C"]


def test_clean_delay_causes(spark):
    rows = [("",), ("   ",), ("ND",), ("12.7",), ("-3.5",), (None,), ("7",), (" ",)]
    df = spark.createDataFrame(rows, "WEATHER_DELAY string")
    assert [r[0] for r in C.clean_delay_causes(df).collect()] == [0, 0, 0, 12, -3, 0, 7, 0]


def test_delay_causes_without_a_digit_are_not_cast(spark):
    rows = [("NaN", 0), ("Infinity", 0), ("-", 0), ("ND", 0), ("\u0663", 0), ("1e2", 100), (" 8 ", 8), ("x9", 0), ("99999999999", 0)]
    out = C.clean_delay_causes(spark.createDataFrame(rows, "WEATHER_DELAY string, want int"))
    assert all(r.WEATHER_DELAY == r.want for r in out.collect())
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "RLIKE(cast(WEATHER_DELAY" in plan and "[0-9]" in plan


def test_keep_valid_airports_drops_null_and_unknown(spark):
    airports = spark.createDataFrame([("AAA",), ("BBB",), (None,)], "IATA_CODE string")
    df = spark.createDataFrame([("AAA", "BBB"), ("AAA", None), ("ZZZ", "AAA"), ("BBB", "BBB")],
                               "ORIGIN_AIRPORT string, DESTINATION_AIRPORT string")
    out = sorted(tuple(r) for r in C.keep_valid_airports(df, airports).collect())
    assert out == [("AAA", "BBB"), ("BBB", "BBB")]
    # the size-checked fallback (no broadcast) gives the same rows
    assert sorted(tuple(r) for r in C.keep_valid_airports(df, airports, max_broadcast_rows=1).collect()) == out


def test_patch_coordinates_overwrites_both_roles(spark):
    df = spark.createDataFrame([("ECP", 1.0, 2.0, "XXX", 3.0, 4.0), ("XXX", None, None, "UST", None, None)],
                               "ORIGIN_AIRPORT string, ORIGIN_LAT double, ORIGIN_LON double, "
                               "DESTINATION_AIRPORT string, DESTINATION_LAT double, DESTINATION_LON double")
    out = C.patch_coordinates(df).collect()
    assert (out[0].ORIGIN_LAT, out[0].ORIGIN_LON) == (30.3583, -85.7956)
    assert (out[0].DESTINATION_LAT, out[0].DESTINATION_LON) == (3.0, 4.0)
    assert (out[1].ORIGIN_LAT, out[1].DESTINATION_LAT, out[1].DESTINATION_LON) == (None, 29.9592, -81.3397)
    assert F is not None
