"""Approximate nearest neighbours by inner product, on robust-pruned directed graphs.

Distinct vectors are dealt to shards of bounded size, each of vectors of nearly one length. A shard's graph grows by insertion: a greedy search over the graph so far
proposes neighbours of a new vector, and pruning with a relaxed distance keeps those that no kept one stands closer to,
so edges point in diverse directions. Queries, in blocks, run a beam search over every shard; what the beams hold is
scored exactly. Inner product becomes distance by one more component, which brings a shard's vectors to the length of its longest; as they are
of nearly one length, that component stays small beside the others, whatever lengths the table holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import batches

SHARD_ROWS = 4096
QUERY_BLOCK, AT_ONCE = 4096, 256  # queries that travel together, and that are searched at once
LENGTHS = 8  # classes of length to a power of two
DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 32, 64, 96, 1.2
EXPAND = 4


def squared(x: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``q`` to the vectors its row of ``ids`` names; -1 is infinitely far."""
    out = np.square(x[ids] - q[:, None, :]).sum(axis=2)
    out[ids < 0] = np.inf
    return out


def beam_search(graph: np.ndarray, x: np.ndarray, q: np.ndarray, entry: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest found for all queries at once, nearest first (-1 pads), and the vectors expanded on the way."""
    n, rows = len(q), np.arange(len(q))[:, None]
    ids = np.full((n, beam), -1, np.int32)
    ids[:, 0] = entry
    dist = np.full((n, beam), np.inf, np.float32)
    dist[:, 0] = squared(x, ids[:, :1], q)[:, 0]
    done = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(x) + 1), bool)
    seen[:, entry] = seen[:, -1] = True
    walked = []
    while True:
        waits = ~done & (ids >= 0)
        if not waits.any():
            return ids, np.concatenate(walked, axis=1)
        order = np.argsort(~waits, axis=1, kind="stable")[:, :EXPAND]
        chosen = np.where(np.take_along_axis(waits, order, 1), np.take_along_axis(ids, order, 1), -1)
        np.put_along_axis(done, order, True, 1)
        walked.append(chosen)
        near = graph[chosen].reshape(n, -1)
        near[np.repeat(chosen < 0, graph.shape[1], axis=1)] = -1
        near[seen[rows, near]] = -1
        # The same neighbour from two expanded vectors counts once.
        by = np.argsort(near, axis=1, kind="stable")
        near = np.take_along_axis(near, by, 1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[rows, near] = True
        ids, dist = np.concatenate((ids, near), axis=1), np.concatenate((dist, squared(x, near, q)), axis=1)
        done = np.concatenate((done, np.zeros(near.shape, bool)), axis=1)
        best = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist, done = (np.take_along_axis(a, best, 1) for a in (ids, dist, done))
        ids[~np.isfinite(dist)] = -1


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """For each point up to ``degree`` of its candidates: the nearest left is kept, and what lies ``relax`` times closer to it than to the point goes."""
    out = np.full((len(points), degree), -1, np.int32)
    for a in range(0, len(points), 256):
        own, ids = points[a : a + 256], np.sort(candidates[a : a + 256], axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        ids[ids == own[:, None]] = -1
        dist = squared(x, ids, x[own])
        order = np.argsort(dist, axis=1, kind="stable")[:, : 4 * degree]
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        vectors, left, rows = x[ids], np.isfinite(dist), np.arange(len(own))
        for k in range(degree):
            if not left.any():
                break
            first = left.argmax(axis=1)
            live = left[rows, first]
            out[a : a + 256, k] = np.where(live, ids[rows, first], -1)
            gap = np.square(vectors - vectors[rows, first][:, None, :]).sum(axis=2)
            left &= ~(live[:, None] & (relax * relax * gap <= dist))
            left[rows, first] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX) -> tuple[np.ndarray, int]:
    """Neighbour lists (-1 pads) and the vector at which searches enter: the one nearest to the mean."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int32)
    entry = int(np.square(x - x.mean(axis=0)).sum(axis=1).argmin())
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate(([entry], order[order != entry])).astype(np.int32)
    begin = 1
    while begin < n:
        points = order[begin : begin + min(begin, 256)]
        begin += len(points)
        found, walked = beam_search(graph, x, x[points], entry, beam)
        graph[points] = robust_prune(x, points, np.concatenate((found, walked), axis=1).astype(np.int32), degree, relax)
        # Edges back, pruned where a list runs over.
        to, from_ = graph[points].ravel(), np.repeat(points, degree)
        to, from_ = to[graph[points].ravel() >= 0], from_[graph[points].ravel() >= 0]
        by = np.argsort(to, kind="stable")
        to, from_ = to[by], from_[by]
        targets, first, times = np.unique(to, return_index=True, return_counts=True)
        back = np.full((len(targets), times.max(initial=0)), -1, np.int32)
        back[np.repeat(np.arange(len(targets)), times), np.arange(len(to)) - np.repeat(first, times)] = from_
        graph[targets] = robust_prune(x, targets, np.concatenate((graph[targets], back), axis=1), degree, relax)
    return graph, entry


CLEAN = "id long, key string, size int, length int, vector binary"
CLEAN_SCHEMA = pa.schema([("id", pa.int64()), ("key", pa.string()), ("size", pa.int32()), ("length", pa.int32()), ("vector", pa.binary())])
INDEX = "size int, length int, part int, members array<array<long>>, vectors binary, graph binary, entry int"
INDEX_SCHEMA = pa.schema([
    ("size", pa.int32()), ("length", pa.int32()), ("part", pa.int32()), ("members", pa.list_(pa.list_(pa.int64()))), ("vectors", pa.binary()),
    ("graph", pa.binary()), ("entry", pa.int32()),
])
BLOCK = "size int, block int, keys array<string>, vectors binary"
BLOCK_SCHEMA = pa.schema([("size", pa.int32()), ("block", pa.int32()), ("keys", pa.list_(pa.string())), ("vectors", pa.binary())])
FOUND = "key string, score double, least long, members array<long>"
FOUND_SCHEMA = pa.schema([("key", pa.string()), ("score", pa.float64()), ("least", pa.int64()), ("members", pa.list_(pa.int64()))])


def unit_scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by powers of two so that the largest component is below one and at least a half, and the exponents; no row is zero."""
    exponents = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, -exponents[:, None]), exponents


def clean(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can be compared, as bytes of doubles with a 128-bit name and the class of their length."""
    def rows() -> Iterator[dict]:
        for part in parts:
            for i, v in zip(part.column("id").to_pylist(), part.column("vector").to_pylist()):
                if i is None or not v or any(c is None for c in v):
                    continue
                a = np.array(v, np.float64) + 0.0  # -0.0 is 0.0
                if np.isfinite(a).all() and a.any():
                    scaled, exponents = unit_scaled(a[None, :])
                    length = math.floor((math.log2(np.square(scaled).sum()) / 2 + int(exponents[0])) * LENGTHS)
                    yield {"id": i, "key": xxhash.xxh3_128_hexdigest(a.tobytes()), "size": len(a), "length": length, "vector": a.tobytes()}

    yield from batches(rows(), CLEAN_SCHEMA)


def lengthened(x: np.ndarray) -> np.ndarray:
    """A shard's vectors, scaled by one power of two and brought to one length by one more component."""
    x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))
    squares = np.square(x).sum(axis=1)
    return np.column_stack((x, np.sqrt(np.maximum(squares.max() - squares, 0)))).astype(np.float32)


def asked(q: np.ndarray) -> np.ndarray:
    """Queries at unit length, which changes none of their orders."""
    q = unit_scaled(q)[0]
    q = q / np.sqrt(np.square(q).sum(axis=1, keepdims=True))
    return np.column_stack((q, np.zeros(len(q)))).astype(np.float32)


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for rows where ``is_query`` holds, the ``k`` rows of the largest inner product found.

    A query is no candidate of its own; ties go to the smaller id; with fewer candidates, all. Null and zero vectors and those with null or non-finite
    components take no part, nor rows with a null id. Vectors of different numbers of components are not compared. A product beyond the range of doubles scores
    infinity. Equal
    vectors are indexed once, so groups of copies are found as a whole. Rows repeated under one id count once. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks"))
    kept = stage(rows.mapInArrow(clean, CLEAN).dropDuplicates(["id", "key"]), "vectors")

    # A class of equal vectors: any k + 1 smallest ids are enough for every answer.
    by_id = Window.partitionBy("key").orderBy("id")
    few = kept.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    classes = few.groupBy("key", "size", "length").agg(F.sort_array(F.collect_list("id")).alias("members"), F.first("vector").alias("vector"))
    classes = stage(classes, "vector-classes")
    # Shards are told by size, class of length and part; there are as many parts as the class fills.
    parts = classes.groupBy("size", "length").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("parts"))
    dealt = classes.join(stage(parts, "vector-parts"), ["size", "length"]).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    shard = ["size", "length", "part"]

    def build(key: tuple, table: pa.Table) -> pa.Table:
        size, length, part = (v.as_py() for v in key)
        x = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(-1, size)
        graph, entry = build_graph(lengthened(x))
        row = {"size": size, "length": length, "part": part, "members": table.column("members").to_pylist(), "vectors": x.tobytes(), "graph": graph.tobytes(), "entry": entry}
        return pa.Table.from_pylist([row], INDEX_SCHEMA)

    index = stage(dealt.select(*shard, "members", "vector").groupBy(*shard).applyInArrow(build, INDEX), "vector-index")

    asking = kept.join(vectors.filter(is_query).select(F.col(id_col).cast("long").alias("id")).distinct(), "id").select("id", "key")
    asking = stage(asking, "vector-queries")
    queries = classes.join(asking.select("key").distinct(), "key", "left_semi")
    n_blocks = stage(queries.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")), "query-blocks")

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        row = {"size": key[0].as_py(), "block": key[1].as_py(), "keys": table.column("key").to_pylist(), "vectors": b"".join(table.column("vector").to_pylist())}
        return pa.Table.from_pylist([row], BLOCK_SCHEMA)

    numbered = queries.join(n_blocks, "size").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "key"), F.col("blocks")).cast("int"))
    blocks = stage(numbered.select("size", "block", "key", "vector").groupBy("size", "block").applyInArrow(gather, BLOCK), "queries")
    # Each block of queries meets each shard of its size.
    left = blocks.join(stage(index.select(*shard), "shard-list"), "size")
    right = index.join(stage(blocks.select("size", "block"), "block-list"), "size")

    def search(block_table: pa.Table, shard_table: pa.Table) -> pa.Table:
        if not block_table.num_rows or not shard_table.num_rows:
            return FOUND_SCHEMA.empty_table()
        block, own = block_table.to_pylist()[0], shard_table.to_pylist()[0]
        q, x = (np.frombuffer(t["vectors"], np.float64).reshape(-1, own["size"]) for t in (block, own))
        graph, long = np.frombuffer(own["graph"], np.int32).reshape(len(x), -1), lengthened(x)
        least_ids, out = np.array([m[0] for m in own["members"]]), []
        for begin in range(0, len(q), AT_ONCE):
            some = q[begin : begin + AT_ONCE]
            ids, _ = beam_search(graph, long, asked(some), own["entry"], max(SEARCH_BEAM, 2 * k))
            for name, vector, found in zip(block["keys"][begin:], some, ids):
                found = found[found >= 0]
                with np.errstate(over="ignore", invalid="ignore"):
                    scores = (x[found] * vector).sum(axis=1)
                least = least_ids[found]
                for at in np.lexsort((least, -scores))[: k + 1].tolist():
                    out.append({"key": name, "score": float(scores[at]), "least": int(least[at]), "members": own["members"][found[at]]})
        return pa.Table.from_pylist(out, FOUND_SCHEMA)

    found = left.groupBy("block", *shard).cogroup(right.groupBy("block", *shard)).applyInArrow(search, FOUND)
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "least"))).filter(F.col("n") <= k + 1)
    answers = asking.withColumnRenamed("id", "query_id").join(best, "key").select("query_id", "score", F.explode("members").alias("vec_id")).filter("query_id <> vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
