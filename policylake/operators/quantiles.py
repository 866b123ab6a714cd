"""Exact quantiles with linear interpolation, of all columns in the same few passes.

Sorting the values, like ``percentile``, needs them all in one task. Here a first pass builds a mergeable rank sketch of every column, all in one
aggregate; it names two values that surely enclose each wanted rank, and some between them. A second pass counts exactly what lies below the
lower one and at each named value, and takes over the values strictly between. Where these are too many to take over, they are sketched
instead and the next pass goes on between closer values. Counts decide, never the sketch: a rank that it enclosed wrongly
is seen by the counts and looked for again. No pass explodes or shuffles rows; its state is a few kilobytes a column.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizes import source_bytes

Wanted = Mapping[str, tuple[Column, Sequence[float]]]
# Two neighbours in the order of the values, and how far from the first the quantile lies.
Neighbours = tuple[float, float, float]

SKETCH = 2048
ERROR = 0.0075  # about three times the sketch's rank error
STEPS = 64
TAKEN = 100_000  # values between two named ones that a pass hands over
PASSES = 20
MERGED_AT_ONCE = 64 << 30  # bytes of the source up to which one task merges the sketches of all tasks
INF = float("inf")


@dataclass
class Target:
    """A wanted rank of a column, and the values known to enclose it."""

    series: int
    rank: int
    low: float = -INF
    high: float = INF
    named: list[float] = field(default_factory=list)
    inside: float = INF  # how many values are expected between


def quantiles(df: DataFrame, wanted: Wanted) -> dict[str, list[float | None]]:
    """Quantiles of several columns at once; no values give None.

    ``wanted`` maps a name to (column, probabilities). Nulls, NaN and both infinities are left out. The result is a
    handful of numbers.
    """
    return {n: [None if v is None else interpolated(*v) for v in vs] for n, vs in neighbours(df, wanted).items()}


def interpolated(low: float, high: float, share: float) -> float:
    """Between two neighbours, counted from the nearer one."""
    return low + (high - low) * share if share < 0.5 else high - (high - low) * (1 - share)


def clipped_quantile(found: Neighbours | None, low: float | None, high: float | None) -> float | None:
    """The same quantile of the column capped at both ends: capping keeps the order, so the neighbours are capped."""
    if found is None or low is None or high is None:
        return None
    return interpolated(*(min(max(v, low), high) for v in found[:2]), found[2])


def neighbours(df: DataFrame, wanted: Wanted) -> dict[str, list[Neighbours | None]]:
    """For every wanted quantile the two values between which it lies."""
    names = list(wanted)
    if not names:
        return {}
    numbers = [c.cast("double") for c, _ in wanted.values()]
    rows = df.select(*[F.when(F.abs(c) < INF, c + 0.0).alias(f"s{i}") for i, c in enumerate(numbers)])
    two_steps = (source_bytes(df) or 0) > MERGED_AT_ONCE

    first: dict[str, Measure] = {}
    for i, n in enumerate(names):
        near = sorted({min(max(p + e * ERROR, 0.0), 1.0) for p in wanted[n][1] for e in (-1, -1 / 3, 0, 1 / 3, 1)})
        first |= {f"n{i}": counted(F.col(f"s{i}").isNotNull()), f"q{i}": sketched(F.col(f"s{i}"), near), f"p{i}": near}
    got = measured(rows, {k: v for k, v in first.items() if k[0] != "p"}, two_steps)
    totals = [got[f"n{i}"] for i in range(len(names))]

    targets = []
    for i, n in enumerate(names):
        at = dict(zip(first[f"p{i}"], got[f"q{i}"] or []))
        for p, rank in sorted({(p, r) for p in wanted[n][1] if totals[i] for r in _ranks(p, totals[i])}):
            if totals[i] <= TAKEN // 4:
                targets.append(Target(i, rank, inside=totals[i]))
            else:
                low, high = p - ERROR, p + ERROR
                values = sorted({at[q] for q in at if low <= q <= high})
                targets.append(Target(i, rank, at[low] if low > 0 else -INF, at[high] if high < 1 else INF, values, 2 * ERROR * totals[i]))
    found: dict[tuple[int, int], float] = {}
    targets = list({(t.series, t.rank): t for t in targets}.values())
    for _ in range(PASSES):
        if not targets:
            break
        targets = _narrowed(rows, targets, found, two_steps)
    if targets:
        raise RuntimeError("quantiles did not settle")

    def value(i: int, p: float) -> Neighbours | None:
        if not totals[i]:
            return None
        place = p * (totals[i] - 1)
        low, high = _ranks(p, totals[i])
        return found[i, low], found[i, high], place - low

    return {n: [value(i, float(p)) for p in wanted[n][1]] for i, n in enumerate(names)}


def _ranks(p: float, n: int) -> tuple[int, int]:
    place = p * (n - 1)
    return math.floor(place), math.ceil(place)


def _narrowed(rows: DataFrame, targets: list[Target], found: dict[tuple[int, int], float], two_steps: bool) -> list[Target]:
    """One pass: ranks that the counts settle go to ``found``, the others come back between closer values."""
    grid = [s / STEPS for s in range(STEPS + 1)]
    measures: dict[str, Measure] = {}
    for t in targets:
        t.named = sorted({*t.named, *(v for v in (t.low, t.high) if abs(v) < INF)})
    # Neighbouring ranks are mostly enclosed by the same values, and share their counts.
    spans = [(t.series, t.low, t.high, tuple(t.named), t.inside <= TAKEN) for t in targets]
    number = {span: k for k, span in enumerate(dict.fromkeys(spans))}
    for t, k in {number[s]: (t, number[s]) for t, s in zip(targets, spans)}.values():
        x, edges = F.col(f"s{t.series}"), t.named
        between = x.isNotNull()
        if t.low > -INF:
            between &= x > t.low
            measures[f"b{k}"] = counted(x < t.low)
        if t.high < INF:
            between &= x < t.high
        if edges:
            between &= ~x.isin(edges)
        measures |= {f"e{k}_{j}": counted(x == v) for j, v in enumerate(edges)}
        if t.inside <= TAKEN:
            measures[f"l{k}"] = listed(F.when(between, x))
        else:
            measures |= {f"q{k}": sketched(F.when(between, x), grid), f"m{k}": counted(between)}
            # Values between are placed by how many lie below each named one.
            measures |= {f"u{k}_{j}": counted(x < v) for j, v in enumerate(edges)}
    got = measured(rows, measures, two_steps)

    left = []
    for t, k in zip(targets, [number[s] for s in spans]):
        below, at = got.get(f"b{k}", 0), {v: got[f"e{k}_{j}"] for j, v in enumerate(t.named)}
        if f"l{k}" in got:
            held = Counter(got[f"l{k}"])
            held.update(at)
            rank = t.rank - below
            for v in sorted(held):
                if 0 <= rank < held[v]:
                    found[t.series, t.rank] = v
                    break
                rank -= held[v]
            else:  # not enclosed
                lower = t.rank < below
                left.append(Target(t.series, t.rank, -INF if lower else t.high, t.low if lower else INF))
            continue
        under = {v: got[f"u{k}_{j}"] for j, v in enumerate(t.named)}
        hit = next((v for v in t.named if under[v] <= t.rank < under[v] + at[v]), None)
        if hit is not None:
            found[t.series, t.rank] = hit
            continue
        low = max((v for v in t.named if under[v] + at[v] <= t.rank), default=-INF)
        high = min((v for v in t.named if under[v] > t.rank), default=INF)
        if low < t.low or high > t.high:  # not enclosed
            left.append(Target(t.series, t.rank, low, high))
            continue
        # Of the values between, so many come before the rank; the sketch names closer ones, and the counts check them.
        share = (t.rank - below - sum(n for v, n in at.items() if v <= low)) / max(got[f"m{k}"], 1)
        steps = got[f"q{k}"]
        near = [v for g, v in zip(grid, steps) if abs(g - share) <= ERROR + 1 / STEPS and low < v < high]
        span = (min(near), max(near)) if len(near) > 1 else (low, high)
        if share <= ERROR + 1 / STEPS:
            span = (low, span[1])
        if share >= 1 - ERROR - 1 / STEPS:
            span = (span[0], high)
        left.append(Target(t.series, t.rank, *span, near, got[f"m{k}"] * (2 * ERROR + 3 / STEPS)))
    return left


@dataclass
class Measure:
    """An aggregate in two steps: over rows, and over the results of the first step."""

    partial: Column
    merge: object
    final: object


def counted(condition: Column) -> Measure:
    return Measure(F.count(F.when(condition, 1)), F.sum, lambda c: c)


def listed(values: Column) -> Measure:
    return Measure(F.collect_list(values), lambda c: F.flatten(F.collect_list(c)), lambda c: c)


def sketched(values: Column, probabilities: Sequence[float]) -> Measure:
    """The values at some probabilities; null where there are none."""
    def read(sketch: Column) -> Column:
        at = [F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probabilities]
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.array(*at))

    return Measure(F.kll_sketch_agg_double(values, F.lit(SKETCH)), lambda c: F.kll_merge_agg_double(c, F.lit(SKETCH)), read)


def measured(rows: DataFrame, measures: dict[str, Measure], two_steps: bool) -> dict[str, object]:
    """All measures by one aggregate over the rows, merged in two steps if the tasks are many."""
    partial = [m.partial.alias(n) for n, m in measures.items()]
    if two_steps:
        some = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(256)).alias("part")).agg(*partial)
        whole = some.agg(*[m.merge(n).alias(n) for n, m in measures.items()])
    else:
        whole = rows.agg(*partial)
    row = whole.select(*[m.final(F.col(n)).alias(n) for n, m in measures.items()]).collect()[0]
    return row.asDict()


def rank_sketches(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``(name, n, sketch)`` of each column: a state that can be kept, and merged with those of other rows. Nulls and non-finite values are left out."""
    rows = df.select(*[F.when(F.abs(c.cast("double")) < INF, c.cast("double") + 0.0).alias(f"s{i}") for i, c in enumerate(columns.values())])
    one = rows.agg(*[F.struct(F.lit(n).alias("name"), F.count(f"s{i}").alias("n"), F.kll_sketch_agg_double(f"s{i}", F.lit(SKETCH)).alias("sketch")).alias(f"s{i}")
                     for i, n in enumerate(columns)])
    return one.select(F.inline(F.array(*[f"s{i}" for i in range(len(columns))])))


def merged_sketches(states: DataFrame) -> DataFrame:
    """One state for each name, of all rows that any of the states has seen."""
    return states.filter("n > 0").groupBy("name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("sketch"))


def sketch_quantiles(states: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``(name, p, value)`` from merged states: values whose rank is right within the sketch's error (``ERROR``); ends are exact."""
    at = [F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probabilities]
    return merged_sketches(states).select("name", F.inline(F.array(*at)))
