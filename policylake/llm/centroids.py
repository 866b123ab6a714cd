"""Centroid clustering with the dimensions sharded: Lloyd's rounds over column blocks.

Vectors are cut into blocks of rows, and each block into shards of a few columns. A task holds one shard of one block and the same columns of the centroids; it
computes its part of all squared distances exactly, as integers. The parts of a block are added up by its number, and the least sum names each vector's
centroid. The names go back to the shards, and each shard sums and divides its own columns of the centroids alone.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .integer_vectors import EXACT, SCALE, matrix, packed, whole

CLUSTERS, ROUNDS, DIMENSIONS, SEED = 40, 5, 64, 2
SHARD_COLUMNS = 16
BLOCK_ROWS = 2048
SALTS = 64
LONGEST = 2**63 - 1

BLOCKS = "block long, shard int, ids array<long>, columns binary"
BLOCKS_SCHEMA = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("ids", pa.list_(pa.int64())), ("columns", pa.binary())])
PARTS = "block long, part binary"
PARTS_SCHEMA = pa.schema([("block", pa.int64()), ("part", pa.binary())])
NAMED = "block long, names binary, distances binary"
NAMED_SCHEMA = pa.schema([("block", pa.int64()), ("names", pa.binary()), ("distances", pa.binary())])
SUMS = "shard int, sums binary"
SUMS_SCHEMA = pa.schema([("shard", pa.int32()), ("sums", pa.binary())])
ROWS = "vec_id long, cluster int, distance decimal(38,0)"


def narrow(x: np.ndarray) -> bytes:
    """An integer array in the smallest type that holds it."""
    if x.dtype != object:
        top = np.abs(x).max(initial=0)
        x = x.astype(np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.int64)
    return pickle.dumps(x)


def exact_sum(x: np.ndarray, limit: float) -> bool:
    """Whether doubles hold squares and products of such numbers, summed over the dimensions."""
    return x.dtype != object and float(np.abs(x).max(initial=0)) < limit


SMALL = 2.0**20  # 4 * 2**40 * 64 is below 2**53


def partial_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances in these columns, rows by centroids, exact: int64, or Python's integers where numbers are large."""
    if exact_sum(x, SMALL) and exact_sum(centroids, SMALL):
        x = x.astype(np.float64)
        out = np.square(x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + np.square(centroids).sum(axis=1)[None, :]
        return out.astype(np.int64)
    big = lambda a: a if a.dtype == object else a.astype(np.int64).astype(object)
    x, c = big(x), big(centroids)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]


def column_sums(x: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """For each centroid the sums of its vectors' columns, and at the end how many they are; Python's integers."""
    x = x.astype(np.int64) if x.dtype != object else x
    out = np.zeros((k, x.shape[1] + 1), object)
    for c in np.unique(names).tolist():
        own = x[names == c]
        out[c, :-1] = [int(v) for v in own.sum(axis=0)]
        out[c, -1] = len(own)
    return out


def added(tables: list[bytes]) -> np.ndarray:
    """The sum of integer arrays."""
    arrays = [pickle.loads(t) for t in tables]
    return sum(a if a.dtype == object else a.astype(np.int64) for a in arrays)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
            dimensions: int = DIMENSIONS, seed: int = SEED, shard_columns: int = SHARD_COLUMNS) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for every vector of ``dimensions`` finite components.

    Components become floor(256 * x). Centroids start as the vectors with the smallest hexadecimal sha256 of ``seed:id``, in that order (fewer
    vectors than clusters: all). A round assigns all vectors to the nearest centroid (ties: the smaller number), then moves each centroid that has
    vectors to the floor of their mean. After the last round vectors are assigned once more.

    Vectors that are null, of another length or hold null or non-finite components are left out. Repeated rows and rows of one id count each; among them the
    first start is the one whose integers come first. A row with a null id is clustered, but never a start unless nothing else is left. Arithmetic is exact at any
    size; a distance or inertia beyond a long is returned as the greatest long. An empty table gives no rows. Other columns are not read.

    Through the driver go the centroids alone: ``clusters * dimensions`` numbers.
    """
    shards = -(-dimensions // shard_columns)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(F.size("vector") == dimensions)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, count = TaskContext.get().partitionId() << 33, 0
        for part in parts:
            good = [(i, v) for i, v in zip(part.column("id").to_pylist(), packed(part.column("vector"))) if v]
            for at in range(0, len(good), BLOCK_ROWS):
                few = good[at : at + BLOCK_ROWS]
                tops = np.array([v[1] for _, v in few])
                x = matrix([v[2] for _, v in few], tops, bool(tops.max() < EXACT))
                found = [{"block": base + count, "shard": s, "ids": [i for i, _ in few] if s == 0 else None,
                          "columns": narrow(x[:, s * shard_columns : (s + 1) * shard_columns])} for s in range(shards)]
                count += 1
                yield pa.RecordBatch.from_pylist(found, BLOCKS_SCHEMA)

    blocks = stage(rows.mapInArrow(cut, BLOCKS), "column-blocks")

    # The first few of all, by partial sorts. Floors are taken as doubles here, only to order rows of one id.
    name = F.when(F.col("id").isNull(), F.lit("~")).otherwise(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    floors = F.transform("vector", lambda x: x * SCALE - F.pmod(x * SCALE, F.lit(1.0)))
    first = rows.filter(finite).orderBy(name, floors).limit(clusters).collect()
    starts = [[whole(x) for x in r["vector"]] for r in first]
    return _lloyd(blocks, starts, rounds, shards, shard_columns)


def _lloyd(blocks: DataFrame, starts: list[list[int]], rounds: int, shards: int, width: int) -> DataFrame:
    k = len(starts)

    def sliced(centroids: list[list[int]]) -> list[np.ndarray]:
        """Each shard's columns of the centroids; doubles where these hold them."""
        large = any(abs(v) >= EXACT for c in centroids for v in c)
        whole = np.array(centroids, dtype=object if large else np.float64).reshape(k, len(centroids[0]) if k else 0)
        return [whole[:, s * width : (s + 1) * width] for s in range(shards)]

    def assigned(centroids: list[list[int]], purpose: str) -> DataFrame:
        slices = sliced(centroids)

        def part(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in parts:
                for row in batch.to_pylist():
                    found = partial_distances(pickle.loads(row["columns"]), slices[row["shard"]])
                    yield pa.RecordBatch.from_pylist([{"block": row["block"], "part": narrow(found)}], PARTS_SCHEMA)

        def least(key: tuple, table: pa.Table) -> pa.Table:
            total = added(table.column("part").to_pylist())
            names = np.argmin(total, axis=1).astype(np.int32)
            distances = [int(v) for v in total[np.arange(len(names)), names]]
            return pa.Table.from_pylist([{"block": key[0].as_py(), "names": names.tobytes(), "distances": pickle.dumps(distances)}], NAMED_SCHEMA)

        return stage(blocks.select("block", "shard", "columns").mapInArrow(part, PARTS).groupBy("block").applyInArrow(least, NAMED), purpose)

    def shard_sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in parts:
            for row in batch.to_pylist():
                own = column_sums(pickle.loads(row["columns"]), np.frombuffer(row["names"], np.int32), k)
                held[row["shard"]] = held[row["shard"]] + own if row["shard"] in held else own
        yield pa.RecordBatch.from_pylist([{"shard": s, "sums": pickle.dumps(v)} for s, v in held.items()], SUMS_SCHEMA)

    def subtotal(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([{"shard": key[0].as_py(), "sums": pickle.dumps(added(table.column("sums").to_pylist()))}], SUMS_SCHEMA)

    def moved(old: list[np.ndarray]):
        def update(key: tuple, table: pa.Table) -> pa.Table:
            shard, total = key[0].as_py(), added(table.column("sums").to_pylist())
            now = [[int(s) // int(row[-1]) for s in row[:-1]] if row[-1] else [int(v) for v in before] for row, before in zip(total, old[shard])]
            return pa.Table.from_pylist([{"shard": shard, "sums": pickle.dumps(now)}], SUMS_SCHEMA)

        return update

    centroids = starts
    if k:
        for _ in range(rounds):
            named = assigned(centroids, "named")
            joined = blocks.select("block", "shard", "columns").join(named.select("block", "names"), "block").select("shard", "columns", "names")
            # Added up in two steps, so that a shard's last task does not read a row from every task.
            sums = joined.mapInArrow(shard_sums, SUMS).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
            sums = sums.groupBy("shard", "salt").applyInArrow(subtotal, SUMS)
            slices = sums.groupBy("shard").applyInArrow(moved(sliced(centroids)), SUMS).collect()
            by_shard = {r["shard"]: pickle.loads(r["sums"]) for r in slices}
            centroids = [[v for s in range(shards) for v in by_shard[s][c]] for c in range(k)]
    named = assigned(centroids, "named")

    def flat(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                names = np.frombuffer(row["names"], np.int32)
                distances = [min(d, 10**38 - 1) for d in pickle.loads(row["distances"])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], pa.int64()), pa.array(names, pa.int32()), pa.array([Decimal(d) for d in distances], pa.decimal128(38, 0)),
                ], ["vec_id", "cluster", "distance"])

    rows = blocks.filter("shard = 0").select("block", "ids").join(named, "block").mapInArrow(flat, ROWS)
    rows = stage(rows, "clustered")
    long = lambda c: F.least(F.col(c), F.lit(Decimal(LONGEST))).cast("long").alias(c)
    # More than a long holds is returned as the greatest long, so what goes further need not be summed.
    inertia = rows.groupBy("cluster").agg(F.sum(F.least(F.col("distance"), F.lit(Decimal(10**25)))).alias("cluster_inertia"))
    inertia = inertia.withColumn("hash", F.element_at(F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids] or [F.lit("")]), F.col("cluster") + 1))
    total = inertia.agg(F.sum("cluster_inertia").alias("inertia"))
    # One row for each cluster, of a fixed number.
    facts = F.broadcast(inertia.crossJoin(total))
    return rows.join(facts, "cluster").select("vec_id", "cluster", long("distance"), long("cluster_inertia"), long("inertia"), F.col("hash").alias("centroid_sha256"))

