"""Utilisation counts kept up to date by month (H1-H3).

The group tables of ``features`` (flights per tail and day, with those of its ISO week, and
departures per origin, date and hour) are stored in month partitions. Counts are sums, so a
new batch of flights is counted alone and merged into the months it touches; other months are
neither read nor written. An ISO week can span two months: weekly sums are taken anew for the
weeks that the batch touches, which lie within its months and their neighbours, and kept for
all others.

An update is written as a new version of the touched months and takes effect with one commit
(``sources.versions``), so a lost job leaves the table as it was, and of two updates that start
from the same state one fails instead of losing counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.functions.calendar import iso_week, iso_year
from contrail.operators.features import CONGESTION, CONGESTION_KEYS, PER_DAY, PER_WEEK, congestion_groups
from contrail.operators.joins import broadcast_if_small
from contrail.session import materialize
from contrail.sources import versions as V

DATE = "FLIGHT_DATE"
MONTH = "month_no"


def month_of(date: Column) -> Column:
    """Months since year 0, a number whose neighbours are the months before and after."""
    return F.year(date) * 12 + F.month(date) - 1


def _stored(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """The table's version and its map of months to the folders that hold them."""
    version = V.current_version(spark, path)
    return version, (V.read_version(spark, path, version) if version else None)


def _months(spark: SparkSession, path: str, folders: dict[int, str], months: Sequence[int]) -> DataFrame | None:
    """The stored rows of ``months``: whole folders, so nothing else is listed or read."""
    names = [f"{path.rstrip('/')}/{folders[m]}" for m in sorted(set(months)) if m in folders]
    return spark.read.parquet(*names) if names else None


def _folders(index: DataFrame | None) -> dict[int, str]:
    return {r["month"]: r["folder"] for r in index.collect()} if index is not None else {}  # one row per month


def _publish(spark: SparkSession, path: str, rows: DataFrame, version: int, folders: dict[int, str]) -> int:
    """Write the months of ``rows`` and commit a map that names them instead of what was there."""
    stage = f"months-{version + 1}-{uuid.uuid4().hex}"
    rows.write.partitionBy(MONTH).parquet(f"{path.rstrip('/')}/{stage}")
    written = [r[MONTH] for r in rows.select(MONTH).distinct().collect()]
    now = folders | {m: f"{stage}/{MONTH}={m}" for m in written}
    index = spark.createDataFrame(sorted(now.items()), "month int, folder string").coalesce(1)
    return V.write_version(index, path, version)


def update_tail_counts(flights: DataFrame, path: str, tail: str = "TAIL_NUMBER") -> int:
    """H1 + H2: add a batch of flights to the stored counts per (tail, date); returns the new version.

    Rows with a null tail or date are not counted, as in ``tail_count_groups``.
    """
    spark = flights.sparkSession
    version, index = _stored(spark, path)
    folders = _folders(index)
    keyed = flights.where(F.col(tail).isNotNull() & F.col(DATE).isNotNull())
    batch = materialize(keyed.groupBy(tail, DATE).agg(F.count(F.lit(1)).alias(PER_DAY)), "batch-tail-days")
    touched = [r["m"] for r in batch.select(month_of(F.col(DATE)).alias("m")).distinct().collect()]
    old = _months(spark, path, folders, [m + d for m in touched for d in (-1, 0, 1)])
    added = batch.withColumn(PER_WEEK, F.lit(None).cast("long"))
    days = (old.select(*added.columns).unionByName(added) if old is not None else added).groupBy(tail, DATE).agg(
        F.sum(PER_DAY).alias(PER_DAY), F.max(PER_WEEK).alias("__kept"))
    weeks = batch.select(iso_year(DATE).alias("__y"), iso_week(DATE).alias("__w")).distinct().withColumn("__touched", F.lit(True))
    dated = days.withColumns({"__iy": iso_year(DATE), "__iw": iso_week(DATE)})
    # at most 53 a year of the batch; a week of all tails is taken anew where any of them flew
    marked = dated.join(broadcast_if_small(materialize(weeks, "batch-weeks")), (F.col("__iy") == F.col("__y")) & (F.col("__iw") == F.col("__w")), "left")
    week = F.sum(PER_DAY).over(Window.partitionBy(tail, "__iy", "__iw"))  # at most seven rows
    fresh = marked.select(tail, DATE, PER_DAY, F.when(F.col("__touched"), week).otherwise(F.col("__kept")).alias(PER_WEEK),
                          month_of(F.col(DATE)).cast("int").alias(MONTH))
    return _publish(spark, path, materialize(fresh, "tail-months"), version, folders)


def update_congestion(flights: DataFrame, path: str) -> int:
    """H3: add a batch of flights to the stored departures per (origin, date, hour); returns the new version."""
    spark = flights.sparkSession
    version, index = _stored(spark, path)
    folders = _folders(index)
    batch = materialize(congestion_groups(flights), "batch-congestion")
    touched = [r["m"] for r in batch.select(month_of(F.col(DATE)).alias("m")).distinct().collect()]
    old = _months(spark, path, folders, touched)
    both = old.select(*batch.columns).unionByName(batch) if old is not None else batch
    merged = both.groupBy(*CONGESTION_KEYS).agg(F.sum(CONGESTION).alias(CONGESTION)).withColumn(MONTH, month_of(F.col(DATE)).cast("int"))
    return _publish(spark, path, materialize(merged, "congestion-months"), version, folders)


def read_counts(spark: SparkSession, path: str, months: Sequence[int] | None = None) -> DataFrame:
    """The stored group table, whole or of some months (``month_of`` numbers); ready for ``add_tail_counts`` or
    ``add_origin_congestion`` as ``groups``."""
    _, index = _stored(spark, path)
    folders = _folders(index)
    rows = _months(spark, path, folders, list(folders) if months is None else months)
    if rows is None:
        raise FileNotFoundError(f"Input not found: {path}")
    return rows
