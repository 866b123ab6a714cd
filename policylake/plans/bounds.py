"""Learned limits (clip ends, band edges): learn once, apply to any batch, keep in a table.

Limits depend on all rows of a table, so they are numbers found by a pass of their own.
Streams and later batches apply the saved numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import clip
from ..operators.quantiles import clipped_quantile, interpolated, neighbours
from ..session import stage

Bounds = dict[str, list]

# Outliers are capped at these quantiles.
CLIP_QUANTILES = (0.01, 0.99)


def learned(parsed: DataFrame, learn: Callable[[DataFrame], Bounds], bounds: Bounds | None, purpose: str) -> tuple[DataFrame, Bounds]:
    """A typed table with its limits. Where these must be learned first, the table is staged, so that raw rows are parsed once."""
    if bounds is not None:
        return parsed, bounds
    typed = stage(parsed, f"{purpose}-typed")
    return typed, learn(typed)


def clip_bounds(df: DataFrame, columns: Iterable[str], edges: Mapping[str, tuple[str, Sequence[float]]] | None = None) -> Bounds:
    """Clip ends of the listed columns that exist, all in the same passes.

    ``edges`` maps the name of a band to (column, probabilities): band edges are quantiles of the capped column. Capping
    keeps the order of the values, so they come from the same passes as the ends.
    """
    present = [c for c in columns if c in df.columns]
    bands = {n: v for n, v in (edges or {}).items() if v[0] in present}
    asked = {c: [*CLIP_QUANTILES, *[p for of, ps in bands.values() if of == c for p in ps]] for c in present}
    found = neighbours(df, {c: (F.col(c), ps) for c, ps in asked.items()})
    at = {c: dict(zip(asked[c], found[c])) for c in present}
    bounds = {c: [None if v is None else interpolated(*v) for v in (at[c][p] for p in CLIP_QUANTILES)] for c in present}
    return bounds | {n: [clipped_quantile(at[c][p], *bounds[c]) for p in ps] for n, (c, ps) in bands.items()}


def clipped(bounds: Bounds, name: str, c: Column | None = None) -> Column:
    low, high = bounds[name]
    return clip(F.col(name) if c is None else c, low, high)


def clip_columns(df: DataFrame, bounds: Bounds, columns: Iterable[str]) -> DataFrame:
    capped = {c: clipped(bounds, c) for c in columns if c in df.columns}
    return df.withColumns(capped) if capped else df


def bounds_table(spark: SparkSession, tables: dict[str, Bounds]) -> DataFrame:
    """Limits as rows (table_name, name, place, value), to be written beside a model."""
    rows = [(t, n, i, None if v is None else float(v)) for t, b in tables.items() for n, vs in b.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "table_name string, name string, place int, value double")


def read_bounds(df: DataFrame) -> dict[str, Bounds]:
    """The limits back from their table, a few dozen numbers."""
    found: dict[str, Bounds] = {}
    for r in df.orderBy("table_name", "name", "place").collect():
        found.setdefault(r["table_name"], {}).setdefault(r["name"], []).append(r["value"])
    return found
