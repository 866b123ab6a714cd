"""What several operators share: text columns as bytes, hashing in numpy, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

SPACES = b" \t\n\x0b\x0c\r"
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def texts(batch: pa.RecordBatch | pa.Table, name: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    column = batch.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every bit of a key depends on all of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def batches(rows: Iterator[dict], schema: pa.Schema, most_rows: int = 2000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size from rows; binary and string values count for the size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, (bytes, str)))
        if len(held) >= most_rows or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


Parts = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def trimmed(apply: Parts) -> Parts:
    """The same, and at the end of a task freed memory goes back to the system: a worker serves many stages, and would else keep the most that any of them took."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from apply(parts)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run


def connected(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` of every node of the undirected edges; a component is named by its smallest node.

    Each round hangs every node's larger neighbours and itself on its smallest neighbour, first over all
    neighbours, then over the smaller ones only (alternating stars). Rounds are logarithmic in practice. Every
    round is written to the shared folder, so lost executors cost one round, and no link reaches the driver.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    now = stage(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Larger neighbours go to the smallest of the neighbourhood.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large.filter("u <> v"), "links")
        # Of what is left (u > v), smaller neighbours and the node itself go to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("p"))
        now = stage(small.select(F.col("p.v").alias("u"), F.col("p.m").alias("v")).filter("u <> v").distinct(), "links")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.unionByName(roots).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
