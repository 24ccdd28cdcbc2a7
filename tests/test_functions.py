from datetime import date

import pytest
from pyspark.sql import functions as F

from contrail.functions import (
    daypart, distance_category, flight_date, hhmm_normalise, hhmm_string, hour_from_hhmm, is_peak_hour,
    is_weekend, iso_week, iso_year, recommended_action, risk_level, season, zfill,
)
from contrail.functions.special import chi2_sf, f_sf


def one(spark, expr, value, dtype):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,hour", [
    ("0530", 5), ("730", 7), ("615.0", 6), ("5", 0), ("", 0), ("2359", 23), ("2400", None),
    ("12345", None), ("-5", None), ("abc", None), (None, None), ("0000", 0),
])
def test_hour_from_hhmm(spark, text, hour):
    assert one(spark, hour_from_hhmm, text, "string") == hour


def test_hour_from_hhmm_default(spark):
    assert one(spark, lambda c: hour_from_hhmm(c, default=-1), "abc", "string") == -1


@pytest.mark.parametrize("value,out", [("5", "0005"), ("-5", "-005"), ("+5", "+005"), ("12345", "12345"), (None, None)])
def test_zfill_never_shortens_and_keeps_sign(spark, value, out):
    assert one(spark, lambda c: zfill(c, 4), value, "string") == out


@pytest.mark.parametrize("value,out", [(5, "0005"), (-5, "-005"), (12345, "12345"), (0, "0000"), (None, None)])
def test_hhmm_string(spark, value, out):
    assert one(spark, hhmm_string, value, "int") == out


@pytest.mark.parametrize("text,out", [("2400", 0), ("2400.0", 0), ("615.0", 615), ("abc", None), (None, None),
                                      ("NaN", None)])
def test_hhmm_normalise(spark, text, out):
    assert one(spark, hhmm_normalise, text, "string") == out


@pytest.mark.parametrize("hour,part", [(0, "Night"), (5, "Night"), (6, "Morning"), (12, "Afternoon"),
                                       (18, "Evening"), (23, "Evening"), (None, None), (24, None)])
def test_daypart_null_hour_is_null(spark, hour, part):
    assert one(spark, daypart, hour, "int") == part


@pytest.mark.parametrize("hour,peak", [(6, True), (9, True), (10, False), (16, True), (19, True), (20, False),
                                       (None, False)])
def test_peak_hour(spark, hour, peak):
    assert one(spark, is_peak_hour, hour, "int") is peak


def test_weekend_and_season(spark):
    assert one(spark, is_weekend, 6, "int") is True
    assert one(spark, is_weekend, None, "int") is False
    assert one(spark, season, 12, "int") == "Winter"
    assert one(spark, season, 13, "int") is None


@pytest.mark.parametrize("d,cat", [(-1.0, None), (0.0, "short_haul"), (499.9, "short_haul"), (500.0, "medium_haul"),
                                   (1499.0, "medium_haul"), (1500.0, "long_haul"), (None, None)])
def test_distance_category(spark, d, cat):
    assert one(spark, distance_category, d, "double") == cat


def test_flight_date_invalid_is_null_and_iso(spark):
    df = spark.createDataFrame([(2015, 2, 31), (2015, 1, 1), (2016, 1, 3)], "y int, m int, d int")
    out = df.select(flight_date("y", "m", "d").alias("fd")).select(
        "fd", iso_year("fd").alias("iy"), iso_week("fd").alias("iw")).collect()
    assert out[0]["fd"] is None and out[0]["iy"] is None
    assert out[1]["fd"] == date(2015, 1, 1) and (out[1]["iy"], out[1]["iw"]) == (2015, 1)
    assert (out[2]["iy"], out[2]["iw"]) == (2015, 53)  # 2016-01-03 belongs to ISO week 2015-W53


@pytest.mark.parametrize("p,tier", [(0.76, "High Risk"), (0.75, "Medium Risk"), (0.51, "Medium Risk"),
                                    (0.5, "Low Risk"), (None, "Low Risk")])
def test_risk_tiers(spark, p, tier):
    assert one(spark, risk_level, p, "double") == tier
    assert one(spark, recommended_action, tier, "string") in (
        "Assign priority gate and backup crew", "Monitor operations and prepare support", "Normal operation")


def test_distribution_tails():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(0.4464285714, 1) == pytest.approx(0.5040, abs=1e-4)
    assert chi2_sf(30.0, 20) == pytest.approx(0.06985366069940, rel=1e-8)
    assert f_sf(13.5, 1, 4) == pytest.approx(0.021311641128756723, rel=1e-8)
    assert f_sf(0.0, 3, 10) == 1.0


def test_hhmm_string_is_padded_without_a_formatter(spark):
    from pyspark.sql import functions as F

    from contrail.functions.hhmm import hhmm_string
    df = spark.createDataFrame([(v,) for v in (0, 5, 45, 930, 2359, 12345, -5, -930, -12345, None)], "v int")
    out = df.select("v", hhmm_string("v").alias("s"), F.format_string("%04d", "v").alias("f"))
    assert "format_string" not in df.select(hhmm_string("v"))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert all(r.s == (None if r.v is None else r.f) for r in out.collect())
