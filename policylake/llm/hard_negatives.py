"""Hard negatives for anchors: other-label rows scored just below each of the anchor's positives.

The distinct scores of an anchor's positives are the upper limits of its windows; they cut the score axis into disjoint slots, so a
row's score falls into one slot although it may lie in every window. Tasks score a block of anchors against a block of rows and keep the
top of each slot; the tops of all blocks are merged per slot. A window is its upper limit's slot and all slots below: going up from the lowest
slot, the running top of the slots so far answers each window in turn, cut at the window's lower limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import batches
from .integer_vectors import EXACT, matrix, packed

ROWS_A_BLOCK, ANCHORS_A_BLOCK = 16384, 4096
LEAST_BLOCKS = 24  # so that small tables use several tasks too
TOP = 5
LONG = 2**63

CLEAN = "uid long, id long, label long, size int, top double, vector binary, anchor boolean"
CLEAN_SCHEMA = pa.schema([
    ("uid", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("size", pa.int32()), ("top", pa.float64()), ("vector", pa.binary()), ("anchor", pa.bool_()),
])
TOPS = "anchor long, anchor_id long, slot int, id long, score long"
TOPS_SCHEMA = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
MINED_SCHEMA = pa.schema([
    ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()), ("positive_score", pa.int64()),
    ("negative_score", pa.int64()),
])


def scores(anchors: dict, rows: dict) -> np.ndarray:
    """Exact inner products of every anchor with every row, as int64; those out of its range become its least value."""
    size, most = int(anchors["size"][0]), float(anchors["top"].max()) * float(rows["top"].max())
    exact = size * most < EXACT and max(anchors["top"].max(), rows["top"].max()) < EXACT
    a, r = matrix(anchors["vector"], anchors["top"], exact), matrix(rows["vector"], rows["top"], exact)
    out = a @ r.T
    if exact:
        return out.astype(np.int64)
    held = np.vectorize(lambda v: v if -LONG < v < LONG else -LONG, otypes=[object])(out)
    return held.astype(np.int64)


def cleaner(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with finite vectors, their components as integers."""
    def found() -> Iterator[dict]:
        for part in parts:
            names = [part.column(c).to_pylist() for c in ("uid", "id", "label", "anchor")]
            for uid, own, label, anchor, vector in zip(*names, packed(part.column("vector"))):
                if vector:
                    yield {"uid": uid, "id": own, "label": label, "size": vector[0], "top": vector[1], "vector": vector[2], "anchor": anchor}

    yield from batches(found(), CLEAN_SCHEMA)


def columns(table: pa.Table, order: bool = False) -> dict:
    """A table's columns as arrays; ordered by id (null last) if asked, so that places settle ties."""
    if order and table.num_rows:
        table = table.sort_by([("id", "ascending")])
    plain = {c: np.array(table.column(c).to_pylist() if c in ("id", "vector") else table.column(c).to_numpy(), dtype=object if c in ("id", "vector") else None)
             for c in table.column_names if c in ("uid", "id", "label", "size", "top", "vector")}
    return plain


def pick(values: np.ndarray, places: np.ndarray, top: int) -> np.ndarray:
    """The places of the ``top`` largest values, largest first, equal ones by place."""
    if len(places) > top:
        edge = np.partition(values, len(values) - top)[len(values) - top]
        keep = values >= edge
        values, places = values[keep], places[keep]
    return places[np.lexsort((places, -values))[:top]]


def of_size(rows: dict, size: int) -> dict:
    keep = rows["size"] == size
    return {c: v[keep] for c, v in rows.items()}


def block_positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Each anchor's best rows of its label in one block of rows."""
    out = []
    every, own = columns(rows, True), columns(anchors)
    for size in np.unique(own["size"]) if anchors.num_rows and rows.num_rows else ():
        right, left = of_size(every, size), of_size(own, size)
        for label in np.unique(left["label"]):
            a, r = ({c: v[x["label"] == label] for c, v in x.items()} for x in (left, right))
            if not len(r["uid"]):
                continue
            found = scores(a, r)
            for i, uid in enumerate(a["uid"].tolist()):
                places = np.flatnonzero((r["uid"] != uid) & (found[i] > -LONG))
                for p in pick(found[i][places], places, TOP).tolist():
                    out.append({"anchor": uid, "anchor_id": a["id"][i], "slot": 0, "id": r["id"][p], "score": int(found[i][p])})
    return pa.Table.from_pylist(out, TOPS_SCHEMA)


def lowest(positive: int) -> int:
    """The least score of a positive's window: 80 * positive <= 100 * score."""
    return -(-80 * positive // 100)


def block_slots(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Each anchor's best rows of other labels in one block of rows, slot by slot (0 is the highest)."""
    out = []
    every, own = columns(rows, True), columns(anchors)
    limits = dict(zip(anchors.column("uid").to_pylist(), anchors.column("limits").to_pylist()))
    for size in np.unique(own["size"]) if anchors.num_rows and rows.num_rows else ():
        r, a = of_size(every, size), of_size(own, size)
        if not len(r["uid"]):
            continue
        for at in range(0, len(a["uid"]), 512):
            part = {c: v[at : at + 512] for c, v in a.items()}
            found = scores(part, r)
            for i, uid in enumerate(part["uid"].tolist()):
                upper = limits[uid]  # distinct, descending
                bounds = np.array([lowest(u) for u in upper], np.int64)
                fit = np.flatnonzero((found[i] <= upper[0]) & (found[i] >= bounds[-1]) & (r["label"] != part["label"][i]) & (found[i] > -LONG))
                value = found[i][fit]
                # Slot s holds upper[s + 1] < score <= upper[s]; below its window's lower limit nothing is asked.
                slot = len(upper) - 1 - np.searchsorted(np.array(upper[::-1], np.int64), value, side="left")
                for s in np.unique(slot).tolist():
                    here = (slot == s) & (value >= bounds[s])
                    for p in pick(value[here], fit[here], TOP).tolist():
                        out.append({"anchor": uid, "anchor_id": part["id"][i], "slot": s, "id": r["id"][p], "score": int(found[i][p])})
    return pa.Table.from_pylist(out, TOPS_SCHEMA)


def answers(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of an anchor from the tops of its slots, lowest slot first."""
    by_rank = lambda x: (-x["score"], x["id"] is None, x["id"])

    def mined() -> Iterator[dict]:
        for part in parts:
            for row in part.to_pylist():
                positives = sorted(row["positives"], key=by_rank)
                upper = sorted({p["score"] for p in positives}, reverse=True)
                running, window = [], {}
                for s in range(len(upper) - 1, -1, -1):
                    running = sorted(running + [t for t in row["tops"] or () if t["slot"] == s], key=by_rank)[:TOP]
                    window[upper[s]] = [t for t in running if 80 * upper[s] <= 100 * t["score"]]
                for p in positives:
                    for rank, t in enumerate(window[p["score"]], 1):
                        yield {"anchor_id": row["anchor_id"], "positive_id": p["id"], "rank": rank, "negative_id": t["id"], "positive_score": p["score"], "negative_score": t["score"]}

    yield from batches(mined(), MINED_SCHEMA)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become floor(256 * x); a score is the exact inner product. An anchor's positives are the five best other rows of its label; a
    positive's negatives are the five best rows of other labels that score between 80 and 100 percent of it, higher scores and then smaller ids first (null ids
    last). Fewer if there are fewer; a negative positive has none, as its window is empty.

    Rows with a null label or vector, an empty vector, or a null or non-finite component take no part. Rows are told apart by themselves, not by their
    ids: repeated rows count each. Rows of different lengths are not compared. Pairs whose score does not fit a long are not returned.
    An empty table gives no rows. Other columns are not read.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    rows = stage(rows.filter("label is not null and vector is not null").mapInArrow(cleaner, CLEAN), "mining-rows")
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("anchor").cast("long")), F.lit(0)).alias("anchors")).first()
    n_rows = max(1, math.ceil(n["rows"] / ROWS_A_BLOCK), min(LEAST_BLOCKS, math.ceil(n["rows"] / 256)))
    n_anchors = max(1, math.ceil(n["anchors"] / ANCHORS_A_BLOCK))

    # Every block of anchors meets every block of rows; both sides are of bounded size.
    dealt = rows.drop("anchor").withColumn("row_block", F.pmod(F.xxhash64("uid"), F.lit(n_rows)).cast("int"))
    dealt = dealt.withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))))

    def spread(anchors: DataFrame) -> DataFrame:
        own = anchors.withColumn("anchor_block", F.pmod(F.xxhash64(F.lit(1), "uid"), F.lit(n_anchors)).cast("int"))
        return own.withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))).groupBy("anchor_block", "row_block")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= TOP)

    anchors = stage(rows.filter("anchor").drop("anchor"), "mining-anchors")
    near = spread(anchors).cogroup(dealt.groupBy("anchor_block", "row_block")).applyInArrow(block_positives, TOPS)
    positives = best(near).groupBy("anchor", "anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    positives = stage(positives.withColumn("limits", F.sort_array(F.array_distinct(F.col("positives.score")), asc=False)), "mining-positives")

    # Windows of positives below zero are empty: an anchor whose best is below zero asks for nothing.
    asking = anchors.join(positives.select(F.col("anchor").alias("uid"), "limits"), "uid").filter("limits[0] >= 0")
    asking = asking.withColumn("limits", F.filter("limits", lambda x: x >= 0))
    found = spread(asking).cogroup(dealt.groupBy("anchor_block", "row_block")).applyInArrow(block_slots, TOPS)
    tops = best(found).groupBy("anchor").agg(F.collect_list(F.struct("slot", "id", "score")).alias("tops"))
    return positives.join(tops, "anchor").select("anchor_id", "positives", "tops").mapInArrow(answers, MINED)
