"""Risk tiers and recommended actions for a delay probability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Tier thresholds (strict >), tier names and action texts
# ---------------------------------------------------------------------------
HIGH_RISK_ABOVE = 0.75
MEDIUM_RISK_ABOVE = 0.50
HIGH_RISK = "High Risk"
MEDIUM_RISK = "Medium Risk"
LOW_RISK = "Low Risk"
ACTIONS = {
    HIGH_RISK: "Assign priority gate and backup crew",
    MEDIUM_RISK: "Monitor operations and prepare support",
    LOW_RISK: "Normal operation",
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def risk_level(prob: str | Column) -> Column:
    p = _col(prob)
    return (F.when(p > HIGH_RISK_ABOVE, F.lit(HIGH_RISK))
            .when(p > MEDIUM_RISK_ABOVE, F.lit(MEDIUM_RISK))
            .otherwise(F.lit(LOW_RISK)))


def recommended_action(risk: str | Column) -> Column:
    r = _col(risk)
    return (F.when(r == HIGH_RISK, F.lit(ACTIONS[HIGH_RISK]))
            .when(r == MEDIUM_RISK, F.lit(ACTIONS[MEDIUM_RISK]))
            .otherwise(F.lit(ACTIONS[LOW_RISK])))
