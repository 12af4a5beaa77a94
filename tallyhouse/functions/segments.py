"""Business classifications as CASE chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import settings as S


def rfm_segment(spend: Column, days: Column, t: S.RfmThresholds = S.RfmThresholds()) -> Column:
    """Segment from rounded lifetime spend and days since the last purchase; first match wins."""
    return (
        F.when((spend > t.champion_spend) & (days <= t.champion_days), "Champions")
        .when((spend > t.loyal_spend) & (days <= t.loyal_days), "Loyal Customers")
        .when((spend > t.potential_spend) & (days <= t.potential_days), "Potential Loyalists")
        .when((days > t.risk_days) & (spend > t.risk_spend), "At Risk")
        .otherwise("Recent/Standard")
    )


def reorder_status(stock: Column, reorder_point: Column) -> Column:
    return F.when(stock <= reorder_point, S.REORDER_NEEDED).otherwise(S.HEALTHY)


def score_band(score: Column) -> Column:
    return F.when(score > S.HIGH_SCORE, "high").when(score > S.MEDIUM_SCORE, "medium").otherwise("low")


def system_status(quality_flag: Column, prediction: Column) -> Column:
    """A rule violation outranks the model's verdict."""
    return (
        F.when(quality_flag, S.STATUS_QUALITY)
        .when(prediction == -1, S.STATUS_ANOMALY)
        .otherwise(S.STATUS_NORMAL)
    )
