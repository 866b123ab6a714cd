"""Repeats in a corpus, found block by block.

Documents are packed into blocks of a few MB that keep their number. A block asks about its keys (64-bit names of
strings) in bucket-sized messages; a bucket is sorted in one task and answers each block which of its keys occur
more than once in the corpus. Messages hold a key at most twice per block, so one string that fills a third of the
corpus weighs two entries a block. Keys travel as differences of sorted numbers, byte planes first, which the
shuffle compresses.

Two rounds: first the keys of a sparse sample, which rule out almost all window starts; then the windows that are
left. The number of windows wrongly taken for equal is about n * n / 2**65 for n left-over windows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import batches, texts

BLOCK_BYTES = 4 << 20
KEYS_A_BUCKET = 2 << 20
ASK = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary())])
ANSWER = pa.schema([("block", pa.int64()), ("keys", pa.binary())])


def pack(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents as blocks ``(block, ids, ends, body, size)``, written once, in buckets of ``block``.

    A document longer than a block has one of its own. Written as a bucketed table, blocks meet their answers
    without being shuffled.
    """
    spark = docs.sparkSession
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("body", pa.binary()), ("size", pa.int64())])

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bodies, size = [], [], 0
        number = TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(x) for x in bodies]).tolist()
            return pa.RecordBatch.from_pylist([{"block": number, "ids": ids, "ends": ends, "body": b"".join(bodies), "size": size}], schema)

        for part in parts:
            for doc, text in zip(part.column("id").to_pylist(), texts(part)):
                if bodies and size + len(text) > block_bytes:
                    yield block()
                    number, ids, bodies, size = number + 1, [], [], 0
                ids.append(doc)
                bodies.append(text)
                size += len(text)
        if ids:
            yield block()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(packed, "block long, ids array<long>, ends array<long>, body binary, size long")
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "block").option("compression", "zstd").option("path", scratch_folder(spark, "blocks")).saveAsTable(name)
    return spark.table(name)


def encoded(keys: np.ndarray) -> bytes:
    """Sorted keys as byte planes of their differences."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def decoded(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def cut_points(buckets: int) -> np.ndarray:
    return np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)


def questions(block: int, keys: np.ndarray, buckets: int) -> Iterator[dict]:
    """A block's keys, at most two of each, by bucket."""
    keys = np.sort(keys)
    if len(keys) > 2:
        keys = keys[np.concatenate(([True, True], keys[2:] != keys[:-2]))]
    cuts = [0, *np.searchsorted(keys, cut_points(buckets)).tolist(), len(keys)]
    for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            yield {"bucket": bucket, "block": block, "keys": encoded(keys[a:b])}


def answered(table: pa.Table) -> pa.Table:
    """One bucket: which keys of each block occur more than once."""
    blocks = table.column("block").to_pylist()
    asked = [decoded(x) for x in table.column("keys").to_pylist()]
    every = np.sort(np.concatenate(asked))
    again = every[1:][every[1:] == every[:-1]]
    again = again[np.concatenate(([True], again[1:] != again[:-1]))] if len(again) else again
    rows = []
    for block, keys in zip(blocks, asked):
        if len(again):
            keys = keys[isin_sorted(keys, again)]
            keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
            if len(keys):
                rows.append({"block": block, "keys": encoded(keys)})
    return pa.Table.from_pylist(rows, ANSWER)


def isin_sorted(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def repeated_keys(asked: DataFrame) -> DataFrame:
    """Questions ``(bucket, block, keys)`` to answers ``(block, keys)``."""
    return asked.groupBy("bucket").applyInArrow(answered, "block long, keys binary")


def bucket_count(keys: int) -> int:
    return max(1, math.ceil(keys / KEYS_A_BUCKET))


def parts(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, list, np.ndarray, bytes]]:
    for row in table.select(["block", "ids", "ends", "body"]).to_pylist():
        yield row["block"], row["ids"], np.array(row["ends"], np.int64), row["body"]


def known(answers: pa.Table) -> np.ndarray:
    got = [decoded(x) for x in answers.column("keys").to_pylist()]
    return np.sort(np.concatenate(got)) if got else np.zeros(0, np.uint64)


def covered(starts: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of ``length`` places lie in a window of ``width`` that begins at one of the distinct ``starts``."""
    edge = np.zeros(length + 1, np.int32)
    edge[starts] += 1
    edge[starts + width] -= 1
    return np.cumsum(edge[:-1]) > 0


def inner_starts(ends: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which places begin a window that ends within its own document."""
    ok = np.zeros(length + 1, np.int32)
    begins = np.concatenate(([0], ends[:-1]))
    long = ends - begins >= width
    np.add.at(ok, begins[long], 1)
    np.add.at(ok, ends[long] - width + 1, -1)
    return np.cumsum(ok[:-1]) > 0


class Finder:
    """What differs between repeats of bytes and of words. Works on one block at a time."""

    density: float  # keys of the sample a byte of text, for the number of buckets
    out_schema: pa.Schema
    out: str

    def read(self, body: bytes, ends: np.ndarray):
        """The block in the form that the other methods take."""
        raise NotImplementedError

    def sample(self, state) -> tuple[np.ndarray, ...]:
        """Keys of the sample, then what ``left`` needs besides."""
        raise NotImplementedError

    def left(self, state, sample: tuple[np.ndarray, ...], repeated: np.ndarray) -> np.ndarray:
        """Starts of windows that may be repeated, given which keys of the sample are."""
        raise NotImplementedError

    def names(self, state, starts: np.ndarray) -> np.ndarray:
        """Names of the windows at these starts."""
        raise NotImplementedError

    def starts(self, state) -> np.ndarray:
        """All starts of windows."""
        raise NotImplementedError

    def finish(self, ids: list, ends: np.ndarray, body: bytes, state, starts: np.ndarray) -> list[dict]:
        """Output rows of a block, given the starts of its repeated windows."""
        raise NotImplementedError


def repeats(blocks: DataFrame, finder: Finder) -> DataFrame:
    """The two rounds over packed blocks, then the output rows of each."""
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = bucket_count(int(total * finder.density))
    asks, answers = "bucket int, block long, keys binary", "block long, keys binary"

    def first(batch: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for part in batch:
                for block, _, ends, body in parts(part):
                    yield from questions(block, finder.sample(finder.read(body, ends))[0], buckets)

        yield from batches(rows(), ASK)

    def second(block_table: pa.Table, repeated: pa.Table) -> pa.Table:
        rows = []
        for block, _, ends, body in parts(block_table):
            state = finder.read(body, ends)
            starts = finder.left(state, finder.sample(state), known(repeated))
            rows += questions(block, finder.names(state, starts), buckets)
        return pa.Table.from_pylist(rows, ASK)

    def third(block_table: pa.Table, repeated: pa.Table) -> pa.Table:
        rows, again = [], known(repeated)
        for _, ids, ends, body in parts(block_table):
            state = finder.read(body, ends)
            starts = finder.starts(state) if len(again) else np.zeros(0, np.int64)
            rows += finder.finish(ids, ends, body, state, starts[isin_sorted(finder.names(state, starts), again)])
        return pa.Table.from_pylist(rows, finder.out_schema)

    grouped = blocks.groupBy("block")
    sampled = repeated_keys(blocks.mapInArrow(first, asks))
    asked = grouped.cogroup(sampled.groupBy("block")).applyInArrow(second, asks)
    return grouped.cogroup(repeated_keys(asked).groupBy("block")).applyInArrow(third, finder.out)
