"""Vectors as integers: components become floor(256 * x), kept exact whatever their size."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

SCALE = 256
EXACT = 2.0**53  # doubles hold all integers below


def whole(x: float) -> int:
    """floor(256 * x), also where the product leaves the range of doubles."""
    return math.floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE


def packed(column: pa.Array) -> list[tuple[int, float, bytes] | None]:
    """Of each vector its length, greatest magnitude and integers: doubles if they hold all, else decimal text. None for null, empty and non-finite ones."""
    flat = column.flatten().to_numpy(zero_copy_only=False)  # nulls become NaN
    ends = np.cumsum(np.diff(column.offsets.to_numpy()) if not column.null_count else [len(v) if v.is_valid else 0 for v in column])
    finite, scaled = np.isfinite(flat), np.floor(np.where(np.abs(flat) < 1e300, flat, 0) * SCALE)
    wide = np.maximum(np.abs(scaled), np.where(np.abs(flat) < 1e300, 0, np.inf))
    out, begin = [], 0
    for end in ends.tolist():
        own = slice(begin, end)
        begin = end
        if own.start == end or not finite[own].all():
            out.append(None)
        elif (top := float(wide[own].max())) < EXACT:
            out.append((end - own.start, top, scaled[own].tobytes()))
        else:
            numbers = [whole(x) for x in flat[own].tolist()]
            out.append((len(numbers), float(min(max(map(abs, numbers)), 2**1000)), ",".join(map(str, numbers)).encode()))
    return out


def matrix(vectors: list[bytes], tops: np.ndarray, exact: bool) -> np.ndarray:
    """Rows of equal length: as doubles where ``exact`` says that these hold all integers, else as Python's integers."""
    if exact:
        return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    rows = [np.frombuffer(v, np.float64).astype(np.int64).tolist() if t < EXACT else [int(x) for x in v.split(b",")] for v, t in zip(vectors, tops.tolist())]
    return np.array(rows, dtype=object)
