"""Schemas and the fixed column lists of the flight data model.

Column names are the defaults of every operator; each operator also takes them
as parameters so the same code runs on differently named inputs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the analysed pipeline's for identical results)
# ---------------------------------------------------------------------------

# HHMM clock-time columns, in pipeline order.
TIME_COLS = [
    "SCHEDULED_DEPARTURE",
    "DEPARTURE_TIME",
    "WHEELS_OFF",
    "WHEELS_ON",
    "SCHEDULED_ARRIVAL",
    "ARRIVAL_TIME",
]

# Columns that are "not applicable" for a cancelled flight.
NA_WHEN_CANCELLED = [
    "DEPARTURE_TIME",
    "DEPARTURE_DELAY",
    "TAXI_OUT",
    "ELAPSED_TIME",
    "AIR_TIME",
    "WHEELS_ON",
    "TAXI_IN",
    "ARRIVAL_TIME",
    "ARRIVAL_DELAY",
]

# Delay-cause minute columns (string in the raw file, int after cleaning).
DELAY_CAUSE_COLS = [
    "AIR_SYSTEM_DELAY",
    "SECURITY_DELAY",
    "AIRLINE_DELAY",
    "LATE_AIRCRAFT_DELAY",
    "WEATHER_DELAY",
]

# Delay causes that make HAS_DELAY_CAUSE true (SECURITY_DELAY is not one).
DELAY_CAUSE_FLAG_COLS = [
    "AIRLINE_DELAY",
    "WEATHER_DELAY",
    "AIR_SYSTEM_DELAY",
    "LATE_AIRCRAFT_DELAY",
]

# Date columns and their valid ranges for the range report.
DATE_RANGES = {
    "YEAR": (2015, 2015, {2015}),
    "MONTH": (1, 12, None),
    "DAY": (1, 31, None),
    "DAY_OF_WEEK": (1, 7, None),
}

# Airport attributes copied per role by the lookup joins: lookup column -> suffix.
AIRPORT_ATTRS = {
    "AIRPORT": "AIRPORT_NAME",
    "CITY": "CITY",
    "STATE": "STATE",
    "COUNTRY": "COUNTRY",
    "LATITUDE": "LAT",
    "LONGITUDE": "LON",
}

# Coordinates filled for the airports that lack them in the lookup file.
COORDINATE_PATCHES = {
    "ECP": (30.3583, -85.7956),
    "PBG": (44.6509, -73.4682),
    "UST": (29.9592, -81.3397),
}

# Text columns screened for junk, and the code columns also screened for digits-only.
JUNK_TEXT_COLS = [
    "AIRLINE", "AIRLINE_FULL_NAME",
    "ORIGIN_AIRPORT", "ORIGIN_AIRPORT_NAME", "ORIGIN_CITY", "ORIGIN_STATE",
    "DESTINATION_AIRPORT", "DESTINATION_AIRPORT_NAME", "DESTINATION_CITY", "DESTINATION_STATE",
    "TAIL_NUMBER", "CANCELLATION_REASON",
]
CODE_COLS = ["AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]

# Model inputs and target.
MODEL_FEATURES = [
    "DISTANCE",
    "DEPARTURE_HOUR",
    "DAY_OF_WEEK",
    "ORIGIN_CONGESTION",
    "IS_LONG_DISTANCE",
    "IS_EVENING",
    "HAS_DELAY_CAUSE",
    "FLIGHTS_PER_TAIL_NUMBER_DAY",
    "FLIGHTS_PER_TAIL_NUMBER_WEEK",
]
MODEL_TARGET = "IS_DELAYED_ARRIVAL"

# Business columns carried into the recommendation table when present.
BUSINESS_COLS = ["AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "DEPARTURE_HOUR", "DISTANCE"]

# ---------------------------------------------------------------------------
# Input schemas (CSV sources)
# ---------------------------------------------------------------------------

_INT = T.IntegerType()
_DBL = T.DoubleType()
_STR = T.StringType()

# Raw fact: clock times and delay causes are read as text and coerced later, so a
# dirty value becomes null instead of failing the whole scan.
FLIGHTS_RAW = T.StructType([
    T.StructField("YEAR", _INT),
    T.StructField("MONTH", _INT),
    T.StructField("DAY", _INT),
    T.StructField("DAY_OF_WEEK", _INT),
    T.StructField("AIRLINE", _STR),
    T.StructField("FLIGHT_NUMBER", _STR),
    T.StructField("TAIL_NUMBER", _STR),
    T.StructField("ORIGIN_AIRPORT", _STR),
    T.StructField("DESTINATION_AIRPORT", _STR),
    T.StructField("SCHEDULED_DEPARTURE", _STR),
    T.StructField("DEPARTURE_TIME", _STR),
    T.StructField("DEPARTURE_DELAY", _DBL),
    T.StructField("TAXI_OUT", _DBL),
    T.StructField("WHEELS_OFF", _STR),
    T.StructField("SCHEDULED_TIME", _DBL),
    T.StructField("ELAPSED_TIME", _DBL),
    T.StructField("AIR_TIME", _DBL),
    T.StructField("DISTANCE", _DBL),
    T.StructField("WHEELS_ON", _STR),
    T.StructField("TAXI_IN", _DBL),
    T.StructField("SCHEDULED_ARRIVAL", _STR),
    T.StructField("ARRIVAL_TIME", _STR),
    T.StructField("ARRIVAL_DELAY", _DBL),
    T.StructField("DIVERTED", _INT),
    T.StructField("CANCELLED", _INT),
    T.StructField("CANCELLATION_REASON", _STR),
    T.StructField("AIR_SYSTEM_DELAY", _STR),
    T.StructField("SECURITY_DELAY", _STR),
    T.StructField("AIRLINE_DELAY", _STR),
    T.StructField("LATE_AIRCRAFT_DELAY", _STR),
    T.StructField("WEATHER_DELAY", _STR),
])

AIRLINES = T.StructType([
    T.StructField("IATA_CODE", _STR),
    T.StructField("AIRLINE", _STR),
])

AIRPORTS = T.StructType([
    T.StructField("IATA_CODE", _STR),
    T.StructField("AIRPORT", _STR),
    T.StructField("CITY", _STR),
    T.StructField("STATE", _STR),
    T.StructField("COUNTRY", _STR),
    T.StructField("LATITUDE", _DBL),
    T.StructField("LONGITUDE", _DBL),
])
