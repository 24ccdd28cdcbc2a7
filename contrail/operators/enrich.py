"""Lookup joins (F1-F4): carrier names and airport attributes per role."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators.cleaning import patch_coordinates
from contrail.operators.joins import DEFAULT_BROADCAST_ROWS, lookup_join


def join_airlines(df: DataFrame, airlines: DataFrame, key: str = "AIRLINE",
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """add AIRLINE_FULL_NAME (left join; unknown carriers keep a null name)."""
    lk = airlines.select(F.col("IATA_CODE").cast("string").alias(key),
                         F.col("AIRLINE").alias("AIRLINE_FULL_NAME"))
    return lookup_join(df, lk, [key], "left", max_broadcast_rows)


def join_airports(df: DataFrame, airports: DataFrame, role: str,
                  attrs: Mapping[str, str] = S.AIRPORT_ATTRS,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, how: str = "left") -> DataFrame:
    """add the airport attributes for one role (ORIGIN or DESTINATION) as
    ``<role>_<suffix>`` columns, joined on ``<role>_AIRPORT``. With ``how="inner"`` the
    join is the airport-code filter (C1) of that role as well."""
    key = f"{role}_AIRPORT"
    lk = airports.select(F.col("IATA_CODE").cast("string").alias(key),
                         *[F.col(src).alias(f"{role}_{dst}") for src, dst in attrs.items()])
    return lookup_join(df, lk, [key], how, max_broadcast_rows)


def label_with_fallback(df: DataFrame, labels: DataFrame, key: str = "AIRLINE",
                        label: str = "AIRLINE_NAME",
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """left join a (key, label) table; a missing label falls back to the key."""
    out = lookup_join(df, labels.select(key, label), [key], "left", max_broadcast_rows)
    return out.withColumn(label, F.coalesce(F.col(label), F.col(key)))


def enrich_flights(df: DataFrame, airlines: DataFrame, airports: DataFrame,
                   patches: Mapping[str, tuple[float, float]] = S.COORDINATE_PATCHES,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, how: str = "left") -> DataFrame:
    """F1-F3 then D11: the enriched table (raw + _STR + carrier + 2 x 6 airport columns).
    ``how="inner"``: rows with an unknown airport code go in the same joins."""
    return (df.transform(join_airlines, airlines, max_broadcast_rows=max_broadcast_rows)
            .transform(join_airports, airports, "ORIGIN", max_broadcast_rows=max_broadcast_rows, how=how)
            .transform(join_airports, airports, "DESTINATION", max_broadcast_rows=max_broadcast_rows, how=how)
            .transform(patch_coordinates, patches))
