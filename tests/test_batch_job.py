import os
import tempfile

from contrail import schema as S
from contrail.plans.pipeline import run_batch


def _write(path: str, text: str) -> str:
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def _row(**kw) -> str:
    base = {f.name: "" for f in S.FLIGHTS_RAW.fields}
    base.update(YEAR="2015", MONTH="1", DAY="1", DAY_OF_WEEK="4", AIRLINE="AA", FLIGHT_NUMBER="1",
                TAIL_NUMBER="N1", ORIGIN_AIRPORT="AAA", DESTINATION_AIRPORT="BBB", SCHEDULED_DEPARTURE="530",
                DEPARTURE_TIME="545.0", DEPARTURE_DELAY="15", ARRIVAL_DELAY="16", DISTANCE="600",
                CANCELLED="0", DIVERTED="0")
    base.update(kw)
    return ",".join(base[f.name] for f in S.FLIGHTS_RAW.fields)


def test_csv_to_feature_table(spark):
    tmp = tempfile.mkdtemp(prefix="contrail-batch-")
    header = ",".join(f.name for f in S.FLIGHTS_RAW.fields)
    rows = [
        _row(),
        _row(DEPARTURE_TIME="2400", WEATHER_DELAY="ND", AIR_SYSTEM_DELAY=" ", LATE_AIRCRAFT_DELAY="7.9"),
        _row(ORIGIN_AIRPORT="10397"),                                       # not an airport code: dropped
        _row(CANCELLED="1", DEPARTURE_TIME="600", ARRIVAL_DELAY="40"),      # cancelled, no reason
        _row(MONTH="2", DAY="31", TAIL_NUMBER="", SCHEDULED_DEPARTURE="abc"),  # impossible date, bad time
    ]
    flights = _write(os.path.join(tmp, "flights.csv"), header + "\n" + "\n".join(rows) + "\n")
    airlines = _write(os.path.join(tmp, "airlines.csv"), "IATA_CODE,AIRLINE\nAA,American Airlines Inc.\n")
    airports = _write(os.path.join(tmp, "airports.csv"),
                      "IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\n"
                      "AAA,A Airport,A City,AA,USA,1.0,2.0\nBBB,B Airport,B City,BB,USA,,\n")
    out = os.path.join(tmp, "features")
    table = run_batch(spark, flights, airlines, airports, out)
    assert sorted(p for p in os.listdir(out) if p.startswith("MONTH=")) == ["MONTH=1", "MONTH=2"]
    r = sorted(table.collect(), key=lambda x: (x.MONTH, x.CANCELLED, x.DEPARTURE_TIME or -1))
    assert len(r) == 4
    ok, midnight, cancelled, bad = r[1], r[0], r[2], r[3]
    assert ok.DEPARTURE_TIME == 545 and ok.DEPARTURE_TIME_STR == "0545" and ok.SCHEDULED_DEPARTURE_STR == "0530"
    assert ok.DEPARTURE_HOUR == 5 and ok.IS_DELAYED_ARRIVAL and not ok.IS_DELAYED_DEPARTURE
    assert midnight.DEPARTURE_TIME == 0 and midnight.DEPARTURE_TIME_STR == "0000"
    assert (midnight.WEATHER_DELAY, midnight.AIR_SYSTEM_DELAY, midnight.LATE_AIRCRAFT_DELAY) == (0, 0, 7)
    assert cancelled.CANCELLATION_REASON == "NC" and cancelled.DEPARTURE_TIME is None
    assert cancelled.ARRIVAL_DELAY is None and not cancelled.IS_DELAYED_ARRIVAL
    assert ok.CANCELLATION_REASON == "NC" and ok.AIRLINE_FULL_NAME == "American Airlines Inc."
    assert ok.DESTINATION_LAT is None and ok.ORIGIN_LAT == 1.0
    # three Jan-1 flights of tail N1 (the cancelled one included), none of them at a bad hour
    assert ok.FLIGHTS_PER_TAIL_NUMBER_PER_DAY == 3 and ok.ORIGIN_CONGESTION == 3
    assert bad.FLIGHT_DATE is None and bad.DEPARTURE_HOUR is None and bad.FLIGHTS_PER_TAIL_NUMBER_PER_DAY is None
    assert bad.TAIL_NUMBER is None and bad.ORIGIN_CONGESTION is None
