"""Prescriptive layer (M14-M19): risk tiers and actions from a delay probability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.flags import as_int
from contrail.functions.risk import recommended_action, risk_level
from contrail.operators.joins import all_not_null, join_group_values

PROB = "delay_probability"


def historical_delay_score(df: DataFrame, keys: Sequence[str], flag: str = "IS_DELAYED_ARRIVAL",
                           **skew) -> DataFrame:
    """A deterministic probability: the arrival-delay rate of the row's group
    (e.g. origin, destination and departure hour), joined back skew-safely.
    Serves as the score when no trained model is at hand."""
    keys = list(keys)
    keyed = df.where(all_not_null(keys))
    rates = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                     F.avg(as_int(flag).cast("double")).alias(PROB))
    return join_group_values(df, keys, rates, "__n", [PROB], **skew)


def add_risk(df: DataFrame, prob: str = PROB) -> DataFrame:
    """risk_level and recommended_action columns."""
    return df.withColumns({"risk_level": risk_level(prob)}).withColumn(
        "recommended_action", recommended_action("risk_level"))


def recommendation_table(df: DataFrame, business_cols: Sequence[str] = S.BUSINESS_COLS,
                         prob: str = PROB, id_cols: Sequence[str] = ()) -> DataFrame:
    """The business columns that exist, then probability, tier, action."""
    present = [c for c in business_cols if c in df.columns]
    return add_risk(df, prob).select(*id_cols, *present, prob, "risk_level", "recommended_action")


def risk_distribution(df: DataFrame) -> DataFrame:
    """Flights per risk tier."""
    return df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))


def top_risk(df: DataFrame, k: int = 20, prob: str = PROB, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` highest probabilities (a key tie-break keeps it repeatable)."""
    order = [F.desc(prob), *[F.asc(c) for c in tie_break]]
    return df.orderBy(*order).limit(k)
