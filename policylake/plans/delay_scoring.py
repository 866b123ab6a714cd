"""Scoring of claims: probability, risk level and expected delay."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import risk_level
from ..functions.text import ACTIVE_STATUSES
from .delay_training import delay_probability

STATUS = "statut_sinistre_claim"
LATE_ABOVE = 0.5
DEFAULT_DELAY_DAYS = 30


def active_claims(df: DataFrame) -> DataFrame:
    """Claims in an active status; all claims where none is active or no status is known."""
    if STATUS not in df.columns:
        return df
    active = F.coalesce(F.col(STATUS).isin(*ACTIVE_STATUSES), F.lit(False))
    some = df.agg(F.max(active).alias("some")).scalar()
    return df.filter(active | ~some)


def with_risk(scored: DataFrame) -> DataFrame:
    return scored.withColumn("risk_level", risk_level(F.col("delay_probability")))


def with_default_delay(scored: DataFrame) -> DataFrame:
    """The fixed expected delay, for use without a duration model."""
    late = F.col("delay_probability") > LATE_ABOVE
    return scored.withColumn("predicted_delay_days", F.when(late, float(DEFAULT_DELAY_DAYS)).otherwise(0.0))


def score_claims(claims: DataFrame, delay: PipelineModel, duration: PipelineModel | None = None) -> DataFrame:
    """Claims with ``delay_probability``, ``risk_level`` and ``predicted_delay_days``.

    With a duration model only claims above the limit get days, the others get null; where no claim is above it, all get 0.
    """
    keep = claims.columns
    scored = delay.transform(claims).withColumn("delay_probability", delay_probability())
    scored = with_risk(scored.select(*keep, "delay_probability"))
    if duration is None:
        return with_default_delay(scored)
    late = F.col("delay_probability") > LATE_ABOVE
    none_late = ~F.coalesce(scored.agg(F.max(late).alias("late")).scalar(), F.lit(False))
    days = F.when(late, F.col("prediction")).when(none_late, 0.0)
    kept = scored.columns
    return duration.transform(scored).withColumn("predicted_delay_days", days).select(*kept, "predicted_delay_days")


def checked_active_claims(ml_claim: DataFrame) -> DataFrame:
    """Active claims, or an error where there is no claim at all."""
    found = active_claims(ml_claim)
    if found.isEmpty():
        raise ValueError("there are no claims to score")
    return found
