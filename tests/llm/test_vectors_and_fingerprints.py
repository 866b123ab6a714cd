"""Hard negatives, centroids and fingerprints against plain versions, on odd rows too."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policylake.llm import centroids, fingerprints, hard_negatives, queries
from policylake.llm.oracle import ORACLE
from policylake.session import stage

from check_oracles import compare, connect

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
    *[T.StructField(n, T.StringType()) for n in ("uid", "block", "slot", "score", "cluster", "anchor", "size")],
])


def vector_rows(dims):
    rng = random.Random(dims)
    make = lambda: [rng.gauss(0.2, 1) for _ in range(dims)]
    same = make()
    out = [(i, make(), rng.choice([0, 0, 0, 1, 2])) for i in range(300)]
    out += [(i, same, i % 3) for i in range(300, 420)]  # a hot vector, ties everywhere
    out += [(5, make(), 1), (5, out[5][1], out[5][2]), (100, make(), 0), (None, make(), 0), (None, make(), None)]
    out += [(501, None, 1), (502, [], 1), (503, [1.0, None] + [0.0] * (dims - 2), 1), (504, [math.nan] * dims, 1), (505, [math.inf] * dims, 1), (506, [0.0] * dims, 1), (600, [1.0] * (dims + 1), 0), (700, make(), None)]
    return [(*r, *["noise"] * 7) for r in out]


def negatives_by_hand(rows):
    kept = []
    for i, v, label, *_ in rows:
        if v and label is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    by = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for n, (i, v, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, own) for m, (j, w, own) in enumerate(kept) if m != n and len(w) == len(v)]
        for score, j, _ in sorted([t for t in scored if t[2] == label], key=by)[:5]:
            window = sorted([t for t in scored if t[2] != label and 80 * score <= 100 * t[0] <= 100 * score], key=by)[:5]
            out += [(i, j, rank, t[1], score, t[0]) for rank, t in enumerate(window, 1)]
    return sorted(out, key=str)


def mined(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, label).collect()
    return sorted([(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out], key=str)


def test_hard_negatives(spark, monkeypatch):
    rows = vector_rows(6)
    assert mined(spark, rows) == negatives_by_hand(rows) != []
    monkeypatch.setattr(hard_negatives, "ROWS_A_BLOCK", 50)
    monkeypatch.setattr(hard_negatives, "ANCHORS_A_BLOCK", 2)
    assert mined(spark, rows) == negatives_by_hand(rows)


def test_hard_negatives_of_large_numbers_and_none(spark):
    rows = [(*r[:3], *["noise"] * 7) for r in [(100, [1e9, 3e-3], 1), (1, [1e5 + 1, 2.0], 1), (2, [9.5e4, 1.0], 2), (3, [1e300, 1.0], 2), (4, [1e5, 7.0], 2)]]
    got = mined(spark, rows)
    assert got == [r for r in negatives_by_hand(rows) if abs(r[4]) < 2**63 and abs(r[5]) < 2**63] and len(got) == 2
    assert mined(spark, []) == []


def clusters_by_hand(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if v and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: "~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min((far(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        named = [nearest(v)[1] for _, v in kept]
        for n in range(len(centres)):
            own = [v for (_, v), m in zip(kept, named) if m == n]
            centres[n] = [sum(c) // len(own) for c in zip(*own)] if own else centres[n]
    named = [nearest(v) for _, v in kept]
    inertia = [sum(d for d, m in named if m == n) for n in range(len(centres))]
    cut = lambda x: min(x, 2**63 - 1)
    print_ = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, cut(d), cut(inertia[n]), cut(sum(inertia)), print_[n]) for (i, _), (d, n) in zip(kept, named)), key=str)


def clustered(spark, rows, **settings):
    out = centroids.cluster(spark.createDataFrame(rows, VECTORS).repartition(3), **settings).collect()
    return sorted([(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out], key=str)


def test_centroids(spark):
    rows = vector_rows(7)
    assert clustered(spark, rows, clusters=9, rounds=3, dimensions=7, shard_columns=3) == clusters_by_hand(rows, 9, 3, 7)
    few = rows[:4] + [(9, [1e30, -1e30, 5.0, 1.0, 2.0, 3.0, 1e12], 0, *["noise"] * 7), (8, [1e12, 0.0, 5.0, 1.0, 2.0, 3.0, 1e9], 0, *["noise"] * 7)]
    assert clustered(spark, few, clusters=3, rounds=2, dimensions=7, shard_columns=2) == clusters_by_hand(few, 3, 2, 7)
    assert clustered(spark, few, clusters=40, rounds=2, dimensions=7) == clusters_by_hand(few, 40, 2, 7)
    assert clustered(spark, [], clusters=3, rounds=2, dimensions=7) == []


def tokens(text):
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
    return [text[i : i + 4] for i in range(0, len(text), 4)] if len(words) * 17 < len(text) else words


def winnowed(text):
    """Places of the chosen token runs; runs are compared as tuples, so only which places share a choice can be checked by hash."""
    own = tokens(text)
    runs = [tuple(own[i : i + fingerprints.GRAM]) for i in range(max(1, len(own) - fingerprints.GRAM + 1))] if own else []
    return own, runs


def test_fingerprints(spark, docs, rows):
    named = stage(docs.select(F.coalesce("text", F.lit("")).alias("t")).distinct().withColumn("n", F.monotonically_increasing_id()), "texts")
    out = fingerprints.fingerprints(named.withColumn("text", F.col("t")), ["n"])
    out = out.join(named, "n").collect()
    code = {}  # every run has one hash, and it is the least of a window at the place chosen
    for r in out:
        own, runs = winnowed(r.t)
        for p, h in zip(r.places, r.hashes):
            assert code.setdefault(runs[p], h) == h
    for r in out:
        own, runs = winnowed(r.t)
        known = [code.get(run) for run in runs]
        spans = range(max(1, len(runs) - fingerprints.WINDOW + 1)) if runs else ()
        wanted = set()
        for i in spans:
            window = [(known[j], -j) for j in range(i, min(i + fingerprints.WINDOW, len(runs))) if known[j] is not None]
            wanted.add(-min(window)[1])  # a run never chosen anywhere is above the least here
        assert sorted(wanted) == r.places, r.t[:80]


def test_edited_fingerprints(spark, docs, rows, no_docs):
    plain = [(i, t or "") for i, t, *_ in rows]
    plain.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = fingerprints.edited_fingerprints(docs).collect()
    assert len(out) == len(rows)
    once = {i for i, _ in plain if sum(j == i for j, _ in plain) == 1}
    ids = [i for i, _ in plain]
    got = {r.doc_id: r for r in out}
    for n, (i, text) in enumerate(plain):
        after = plain[(n + 1) % len(plain)]
        if i in once and after[0] in once:
            half = len(text) // 2
            edited = text[: len(text) - half] + after[1][:half]
            assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), ids[n]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    twins = [r for r in out if r.doc_id == 7]
    assert len(twins) == 2 and sorted(r.near_next for r in twins)[-1] == 1.0  # copies follow each other
    assert {tuple(r.hashes) for r in out if r.doc_id in (6, 7)} == {tuple(got[6].hashes)}
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
    assert [r.near_next for r in fingerprints.edited_fingerprints(docs.filter("doc_id = 6")).collect()] == [1.0]


def test_shared_passages_share_a_run(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    passage = [word() for _ in range(fingerprints.REACH)]
    made = [(k, " ".join([word() for _ in range(rng.randint(0, 90))] + passage + [word() for _ in range(rng.randint(0, 90))])) for k in range(30)]
    out = fingerprints.fingerprints(spark.createDataFrame(made, "k long, text string"), ["k"]).collect()
    assert set.intersection(*[set(r.hashes) for r in out])


def test_fingerprints_are_native(spark, folder):
    plan = queries.op13_fingerprints(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_centroids"])
def test_registered(spark, folder, name):
    assert compare(queries.QUERIES[name](spark, folder).toArrow(), connect(folder).sql(ORACLE[name]).to_arrow_table()) is None
