"""Flight-shaped test views derived from the driver's TPC-H-like tables.

The SQL below is portable (Spark SQL and DuckDB run it unchanged), so the same text
builds the inputs of ``queries()`` (as Spark temp views) and of ``oracle_sql()``
(as leading CTEs). It is test input, not library logic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import materialize, session_key

FLIGHTS_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
 CAST(EXTRACT(YEAR FROM l.l_shipdate) AS INT) AS YEAR,
 CAST(EXTRACT(MONTH FROM l.l_shipdate) AS INT) AS MONTH,
 CASE WHEN l.l_orderkey % 101 = 0 THEN 31 ELSE CAST(EXTRACT(DAY FROM l.l_shipdate) AS INT) END AS DAY,
 CAST((l.l_orderkey + l.l_linenumber) % 7 + 1 AS INT) AS DAY_OF_WEEK,
 CASE WHEN l.l_orderkey % 997 = 5 THEN '12' WHEN l.l_orderkey % 997 = 6 THEN '345' ELSE p.p_brand END AS AIRLINE,
 CASE WHEN l.l_orderkey % 499 = 7 THEN CONCAT('N', CHR(9), CAST(l.l_suppkey % 10 AS VARCHAR(20)))
      WHEN l.l_orderkey % 499 = 6 THEN CONCAT('N', CHR(127), '7')
      WHEN l.l_orderkey % 499 = 5 THEN CONCAT('#$%^&*', CAST(l.l_suppkey % 10 AS VARCHAR(20)))
      WHEN l.l_suppkey % 9 <> 4 THEN CONCAT('N', CAST(l.l_suppkey AS VARCHAR(20))) END AS TAIL_NUMBER,
 ns.n_name AS ORIGIN_AIRPORT, nc.n_name AS DESTINATION_AIRPORT,
 CASE WHEN l.l_partkey % 61 <> 5 THEN CAST(((l.l_orderkey*7 + l.l_linenumber*131) % 24)*100 + l.l_partkey % 60 AS INT) END AS SCHEDULED_DEPARTURE,
 CAST(CASE WHEN (l.l_orderkey + l.l_partkey) % 97 = 0 THEN 2400 ELSE ((l.l_orderkey*7 + l.l_linenumber*131 + 1) % 24)*100 + l.l_partkey % 60 END AS INT) AS DEPARTURE_TIME,
 CAST(CASE WHEN (l.l_orderkey + l.l_partkey) % 89 = 0 THEN 2400 ELSE ((l.l_orderkey*7 + l.l_linenumber*131 + 1) % 24)*100 + l.l_suppkey % 60 END AS INT) AS WHEELS_OFF,
 CAST(CASE WHEN (l.l_orderkey + l.l_partkey) % 83 = 0 THEN 2400 ELSE ((l.l_orderkey*7 + l.l_linenumber*131 + 4) % 24)*100 + l.l_suppkey % 60 END AS INT) AS WHEELS_ON,
 CAST(CASE WHEN (l.l_orderkey + l.l_partkey) % 79 = 0 THEN 2400 ELSE ((l.l_orderkey*7 + l.l_linenumber*131 + 4) % 24)*100 + l.l_partkey % 60 END AS INT) AS SCHEDULED_ARRIVAL,
 CAST(CASE WHEN (l.l_orderkey + l.l_partkey) % 73 = 0 THEN 2400 ELSE ((l.l_orderkey*7 + l.l_linenumber*131 + 5) % 24)*100 + l.l_partkey % 60 END AS INT) AS ARRIVAL_TIME,
 CAST((l.l_orderkey*3 + l.l_suppkey*17 + l.l_linenumber*29) % 120 - 60 AS INT) AS DEPARTURE_DELAY,
 CAST((l.l_orderkey*3 + l.l_suppkey*17 + l.l_linenumber*29) % 120 - 85 + CAST(l.l_quantity AS INT) AS INT) AS ARRIVAL_DELAY,
 CAST(l.l_partkey % 40 AS INT) AS TAXI_OUT, CAST(l.l_suppkey % 30 AS INT) AS TAXI_IN,
 CAST(60 + l.l_partkey % 300 AS INT) AS ELAPSED_TIME, CAST(40 + l.l_partkey % 280 AS INT) AS AIR_TIME,
 CAST((l.l_partkey*13 + l.l_orderkey) % 3000 AS INT) AS DISTANCE,
 CASE WHEN (l.l_orderkey + l.l_linenumber) % 53 = 0 THEN 1 ELSE 0 END AS CANCELLED,
 CASE WHEN (l.l_orderkey + l.l_partkey) % 211 = 0 THEN 1 ELSE 0 END AS DIVERTED,
 CASE WHEN (l.l_orderkey + l.l_linenumber) % 53 = 0 AND l.l_partkey % 10 <> 0
        THEN CASE l.l_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END
      WHEN l.l_partkey % 50 = 1 THEN 'A' END AS CANCELLATION_REASON,
 CASE l.l_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN 'ND' WHEN 3 THEN CAST(l.l_suppkey % 50 AS VARCHAR(20)) END AS AIR_SYSTEM_DELAY,
 CASE l.l_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN CAST(l.l_suppkey % 7 AS VARCHAR(20)) END AS SECURITY_DELAY,
 CASE l.l_orderkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN '0' WHEN 2 THEN CAST(l.l_partkey % 90 AS VARCHAR(20)) END AS AIRLINE_DELAY,
 CASE l.l_orderkey % 3 WHEN 0 THEN 'ND' WHEN 1 THEN CAST(l.l_partkey % 60 AS VARCHAR(20)) END AS LATE_AIRCRAFT_DELAY,
 CASE WHEN l.l_returnflag = 'R' THEN CAST(CAST(ROUND(l.l_discount*100) AS INT) AS VARCHAR(20)) END AS WEATHER_DELAY
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation ns ON s.s_nationkey = ns.n_nationkey
JOIN nation nc ON c.c_nationkey = nc.n_nationkey
"""

AIRLINES_SQL = """
SELECT DISTINCT p_brand AS IATA_CODE, CONCAT('Carrier ', p_brand) AS AIRLINE FROM part WHERE p_brand <> 'Brand#7'
"""

AIRPORTS_SQL = """
SELECT n.n_name AS IATA_CODE, CONCAT(n.n_name, ' Airport') AS AIRPORT, r.r_name AS CITY, r.r_name AS STATE, 'USA' AS COUNTRY,
 CASE WHEN n.n_nationkey % 8 <> 1 THEN n.n_nationkey * 2.5e0 - 30e0 END AS LATITUDE,
 CASE WHEN n.n_nationkey % 8 <> 1 THEN n.n_nationkey * -3.5e0 END AS LONGITUDE
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey % 8 <> 6
"""
SOURCE_TABLES = ["lineitem", "part", "supplier", "orders", "customer", "nation", "region"]

# Codes of the fixture airports that lack coordinates, patched with the same
# coordinates the real pipeline writes for its three incomplete airports.
FIXTURE_COORDINATE_PATCHES = {
    "NATION_1": (30.3583, -85.7956),
    "NATION_9": (44.6509, -73.4682),
    "NATION_17": (29.9592, -81.3397),
}


# The fact side of the flight view; spread over the cluster when its files give
# fewer input splits than there are cores (one-row-group files do).
FACT_TABLE, FACT_KEY = "lineitem", "l_orderkey"


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df``, dealt by its key where fewer of its partitions hold rows than there are cores.

    A file is split by bytes, but a row group is read whole by one task: of many splits of a file with few row groups most
    are empty. The count reads no column.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.select(F.spark_partition_id().alias("p")).distinct().count() < cores:
        # hash (not round-robin) partitioning: deterministic under task retries
        return df.repartition(cores, key)
    return df


def register_sources(spark: SparkSession, sf_dir: str) -> None:
    """Register the driver's parquet tables as temp views (column pruning and
    filter pushdown still reach the parquet scan through the views)."""
    for name in SOURCE_TABLES:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        if name == FACT_TABLE:
            df = spread(df, FACT_KEY)
        df.createOrReplaceTempView(name)


_VIEWS: dict[tuple[str, str], tuple[DataFrame, DataFrame, DataFrame]] = {}


def flight_views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw flights, carrier lookup and airport lookup over ``sf_dir`` (built once
    per session and directory).

    ``spark.sql`` analyses each text right away, so the returned frames stay bound
    to this ``sf_dir`` even if the views are registered again later.
    """
    key = (session_key(spark), sf_dir)
    if key not in _VIEWS:
        register_sources(spark, sf_dir)
        # The derived flights play the raw flights file: written once as Parquet
        # (under the shared checkpoint folder) and scanned by every query.
        raw = materialize(spark.sql(FLIGHTS_SQL), "flights-raw")
        _VIEWS[key] = (raw, spark.sql(AIRLINES_SQL), spark.sql(AIRPORTS_SQL))
    return _VIEWS[key]
