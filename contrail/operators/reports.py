"""Descriptive reports (G1-G6, I1-I2) over the feature table.

Rates divide by all flights of the group (a cancelled flight counts as not
delayed); flags are summed as int 0/1; averages skip nulls. Each report is one
hash aggregation (partial + final), and the top-k ones end in
TakeOrderedAndProject, which keeps only k rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.flags import rate


def _count() -> F.Column:
    return F.count(F.lit(1))


def executive_snapshot(df: DataFrame) -> DataFrame:
    """G1: one row of headline figures."""
    return df.agg(
        _count().alias("total_flights"),
        rate("IS_DELAYED_ARRIVAL").alias("overall_arrival_delay_rate"),
        rate("CANCELLED").alias("overall_cancel_rate"),
        F.round(F.avg("ARRIVAL_DELAY"), 2).alias("avg_arrival_delay_minutes"),
    )


def airline_performance(df: DataFrame) -> DataFrame:
    """Per carrier, worst arrival-delay rate first."""
    return (df.groupBy("AIRLINE").agg(
        _count().alias("total_flights"),
        rate("IS_DELAYED_ARRIVAL").alias("arrival_delay_rate"),
        rate("IS_DELAYED_DEPARTURE").alias("departure_delay_rate"),
        rate("CANCELLED").alias("cancel_rate"),
        F.round(F.avg("ARRIVAL_DELAY"), 2).alias("avg_arrival_delay"),
    ).orderBy(F.desc("arrival_delay_rate"), F.asc("AIRLINE")))


def airport_congestion(df: DataFrame, min_flights: int = 500, top: int = 20) -> DataFrame:
    """Origins with more than ``min_flights`` flights, top ``top`` by delay rate."""
    return (df.groupBy("ORIGIN_AIRPORT").agg(
        _count().alias("total_flights"),
        rate("IS_DELAYED_ARRIVAL").alias("delay_rate"),
        rate("CANCELLED").alias("cancel_rate"),
        F.round(F.avg("ORIGIN_CONGESTION"), 2).alias("avg_congestion"),
    ).where(F.col("total_flights") > min_flights)
        .orderBy(F.desc("delay_rate"), F.asc("ORIGIN_AIRPORT")).limit(top))


def monthly_trend(df: DataFrame) -> DataFrame:
    """Delay and cancel rate by month."""
    return (df.groupBy("MONTH").agg(
        rate("IS_DELAYED_ARRIVAL").alias("delay_rate"),
        rate("CANCELLED").alias("cancel_rate"),
    ).orderBy("MONTH"))


def hourly_trend(df: DataFrame) -> DataFrame:
    """Arrival-delay rate by scheduled departure hour (null hour is its own group)."""
    return (df.groupBy("DEPARTURE_HOUR").agg(rate("IS_DELAYED_ARRIVAL").alias("delay_rate"))
            .orderBy("DEPARTURE_HOUR"))


def route_bottlenecks(df: DataFrame, min_flights: int = 300, top: int = 20) -> DataFrame:
    """Routes with more than ``min_flights`` flights, top ``top`` by delay rate."""
    return (df.groupBy("ROUTE").agg(
        _count().alias("total_flights"),
        rate("IS_DELAYED_ARRIVAL").alias("delay_rate"),
        rate("CANCELLED").alias("cancel_rate"),
    ).where(F.col("total_flights") > min_flights)
        .orderBy(F.desc("delay_rate"), F.asc("ROUTE")).limit(top))
