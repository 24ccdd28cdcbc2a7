import os
import tempfile

import pytest
from pyspark.sql import functions as F

from contrail.sources import files as FS


def _csv(tmp: str, name: str, text: str) -> str:
    path = os.path.join(tmp, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_read_lookups_and_keys(spark):
    tmp = tempfile.mkdtemp(prefix="contrail-src-")
    al = _csv(tmp, "airlines.csv", "IATA_CODE,AIRLINE\nUA,United Air Lines Inc.\nAA,American Airlines Inc.\n")
    ap = _csv(tmp, "airports.csv", "IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\n"
                                   "AGS,Augusta Regional Airport at (Bush Field),Augusta,GA,USA,33.36996,-81.9645\n"
                                   "ECP,Northwest Florida Beaches International Airport,Panama City,FL,USA,,\n")
    airlines = FS.read_airlines(spark, al)
    airports = FS.read_airports(spark, ap)
    assert airlines.count() == 2 and dict(airports.dtypes)["LATITUDE"] == "double"
    assert airports.where(F.col("LATITUDE").isNull()).first().IATA_CODE == "ECP"
    assert " " in airports.first().AIRPORT  # UTF-8 kept as is
    assert sorted(r.IATA_CODE for r in FS.lookup_keys(airports).collect()) == ["AGS", "ECP"]


def test_read_flights_dirty_text_stays_text(spark):
    tmp = tempfile.mkdtemp(prefix="contrail-src-")
    header = ",".join(f.name for f in FS.S.FLIGHTS_RAW.fields)
    row = ["2015", "1", "1", "4", "AS", "98", "N407AS", "ANC", "SEA", "5", "2354.0", "-11", "21", "15", "205",
           "194", "169", "1448", "404", "4", "430", "408", "-22", "0", "0", "", "ND", " ", "", "", ""]
    path = _csv(tmp, "flights.csv", header + "\n" + ",".join(row) + "\n")
    df = FS.read_flights(spark, path)
    r = df.first()
    assert r.DEPARTURE_TIME == "2354.0" and r.AIR_SYSTEM_DELAY == "ND" and r.DISTANCE == 1448.0


def test_missing_input_raises(spark):
    with pytest.raises(FileNotFoundError):
        FS.read_airlines(spark, "/nonexistent/contrail/airlines.csv")


def test_write_partitioned_and_rewrite_in_place(spark):
    tmp = tempfile.mkdtemp(prefix="contrail-out-")
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], "id int, MONTH int, v string")
    out = os.path.join(tmp, "t")
    FS.write_table(df, out)
    assert sorted(p for p in os.listdir(out) if p.startswith("MONTH=")) == ["MONTH=1", "MONTH=2"]
    assert spark.read.parquet(out).where("MONTH = 2").count() == 1
    FS.rewrite_in_place(spark, out, lambda d: d.withColumn("v", F.upper("v")))
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == ["A", "B", "C"]
    csv = os.path.join(tmp, "c")
    FS.write_table(df, csv, fmt="csv", partition_by=None, compression="gzip")
    assert any(n.endswith(".csv.gz") for n in os.listdir(csv))


def test_literal_table_and_temp_table(spark):
    lk = FS.literal_table(spark, [("AA", "American Airlines"), ("DL", "Delta Air Lines")], ["AIRLINE", "AIRLINE_NAME"])
    FS.save_as_table(lk, "contrail_test_lookup", temp=True)
    assert FS.read_table(spark, "contrail_test_lookup").count() == 2


def test_use_catalog_sets_current_database(spark):
    before = spark.catalog.currentDatabase()
    FS.use_catalog(spark, database="default")
    assert spark.catalog.currentDatabase() == "default"
    FS.use_catalog(spark, database=before)


def test_csv_binds_by_header_name_and_reports_bad_cells(spark):
    tmp = tempfile.mkdtemp(prefix="contrail-src-")
    swapped = FS.read_airlines(spark, _csv(tmp, "a.csv", "AIRLINE,extra,IATA_CODE\nUnited,x,UA\n")).first()
    assert (swapped.IATA_CODE, swapped.AIRLINE) == ("UA", "United")
    with pytest.raises(ValueError, match="IATA_CODE"):
        FS.read_airlines(spark, _csv(tmp, "b.csv", "CODE,AIRLINE\nUA,United\n"))
    names = [f.name for f in FS.S.FLIGHTS_RAW.fields]
    cells = {"YEAR": "2015", "MONTH": " 2", "CANCELLED": "1.0", "DIVERTED": "0.5", "DISTANCE": "n/a", "DAY": ""}
    path = _csv(tmp, "f.csv", ",".join(reversed(names)) + "\n" + ",".join(cells.get(n, "") for n in reversed(names)) + "\n")
    r = FS.read_flights(spark, path).first()
    assert (r.YEAR, r.MONTH, r.CANCELLED, r.DIVERTED, r.DISTANCE, r.DAY) == (2015, 2, 1, None, None, None)
    bad = {x.column_name: x.unparsable for x in FS.unparsable(spark, path).collect()}
    assert {k for k, v in bad.items() if v} == {"DIVERTED", "DISTANCE"}


def test_failed_rewrite_leaves_the_input(spark):
    tmp = tempfile.mkdtemp(prefix="contrail-out-")
    out = os.path.join(tmp, "t")
    spark.range(5).write.parquet(out)
    with pytest.raises(Exception):
        FS.rewrite_in_place(spark, out, lambda d: d.select(F.raise_error(F.lit("no")).alias("id")))
    assert spark.read.parquet(out).count() == 5


def test_a_file_with_one_row_group_is_spread_over_the_cores(spark, tmp_path):
    """Its splits are many, but one task would read all rows."""
    from contrail.sources.fixtures import spread
    path, conf, cores = str(tmp_path / "t"), "spark.sql.files.maxPartitionBytes", spark.sparkContext.defaultParallelism
    spark.range(50_000).selectExpr("id", "md5(string(id)) AS t").coalesce(1).write.parquet(path)
    before = spark.conf.get(conf)
    spark.conf.set(conf, "100000")
    try:
        df = spark.read.parquet(path)
        full = lambda d: d.select(F.spark_partition_id().alias("p")).distinct().count()
        assert df.rdd.getNumPartitions() > cores and full(df) < cores
        assert full(spread(df, "id")) == cores and spread(df, "id").count() == 50_000
        dealt = df.repartition(cores, "id")
        assert spread(dealt, "id") is dealt
    finally:
        spark.conf.set(conf, before)
