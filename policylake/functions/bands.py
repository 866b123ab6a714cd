"""Right-closed bands: a value belongs to the first band whose upper edge reaches it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Edges and labels of the bands.
AGE_EDGES = (24, 34, 44, 54, 64, 120)
AGE_LABELS = ("<25", "25-34", "35-44", "45-54", "55-64", "65+")
CREDIT_EDGES = (450, 600, 750)
CREDIT_LABELS = ("poor", "fair", "good", "excellent")
TENURE_EDGES = (180, 365, 730, 1095)
TENURE_LABELS = ("<6m", "6-12m", "1-2y", "2-3y", "3y+")
RISK_EDGES = (0.3, 0.7, 1.0)
RISK_LABELS = ("Low", "Medium", "High")
QUINTILES = (0.2, 0.4, 0.6, 0.8)
QUINTILE_LABELS = ("very_low", "low", "mid", "high", "very_high")
SEVERITY_QUANTILES = (0.5, 0.8, 0.95)
SEVERITY_LABELS = ("low", "medium", "high", "very_high")


def band(c: Column, edges: Sequence[float | None], labels: Sequence[str]) -> Column:
    """One label more than edges makes the last band open-ended, else values above get null."""
    if any(e is None for e in edges):
        return F.lit(None).cast("string")
    result = F.when(c <= F.lit(edges[0]), labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        result = result.when(c <= F.lit(edge), label)
    if len(labels) > len(edges):
        result = result.when(c.isNotNull(), labels[-1])
    return result


def age_group(c: Column) -> Column:
    return F.when(c > 0, band(c, AGE_EDGES, AGE_LABELS))


def credit_band(c: Column) -> Column:
    return band(c, CREDIT_EDGES, CREDIT_LABELS)


def tenure_bucket(c: Column) -> Column:
    return band(c, TENURE_EDGES, TENURE_LABELS)


def risk_level(c: Column) -> Column:
    return F.when(c >= 0, band(c, RISK_EDGES, RISK_LABELS))
