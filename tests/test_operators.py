import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from policylake.operators import quantiles as rank
from policylake.operators import schema
from policylake.operators.dedupe import keep_first
from policylake.operators.lookup import hot_keys, lookup
from policylake.operators.quality import key_violations, rejected_rows
from policylake.operators.quantiles import quantiles

PS = (0.0, 0.01, 0.2, 0.5, 0.8, 0.95, 0.99, 1.0)


def columns_of_numbers():
    rng = random.Random(7)
    n = 3000
    return {
        "spread": [rng.uniform(-1e6, 1e6) for _ in range(n)],
        "third_equal": [5.0 if i % 3 == 0 else rng.gauss(0, 1) for i in range(n)],
        "magnitudes": [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(n)],
        "close": [1.0 + i * 2.0 ** -52 for i in range(n)],
        "with_nulls": [None if i % 5 else float(i) for i in range(n)],
        "empty": [None] * n,
        "not_finite": [(float("nan"), float("inf"), -float("inf"), None)[i % 4] if i % 3 else float(i) for i in range(n)],
    }


def test_quantiles_equal_brute_force(spark):
    data = columns_of_numbers()
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(5)
    found = quantiles(df, {c: (F.col(c), PS) for c in data})
    for c, values in data.items():
        values = [v for v in values if v is not None and math.isfinite(v)]
        wanted = [None] * len(PS) if not values else [float(np.quantile(values, p)) for p in PS]
        assert found[c] == (wanted if not values else pytest.approx(wanted, rel=1e-12, abs=0)), c


@pytest.mark.parametrize("settings", [{}, {"TAKEN": 500}, {"TAKEN": 200, "MERGED_AT_ONCE": -1}, {"TAKEN": 2000, "ERROR": 0.0001}])
def test_quantiles_of_many_rows(spark, monkeypatch, settings):
    """Ties that hold a third of the rows, heavy tails, NaN; few values taken at once, sketches merged in two steps, and brackets that miss."""
    for name, value in settings.items():
        monkeypatch.setattr(rank, name, value)
    rng = np.random.default_rng(7)
    n = 40_000
    tied = np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 12, n))
    tail = np.exp(rng.normal(size=n) * 6) * rng.choice([-1, 1], n)
    holes = np.where(rng.random(n) < 0.1, np.nan, rng.random(n))
    df = spark.createDataFrame(pd.DataFrame({"tied": tied, "tail": tail, "holes": holes})).withColumn("none", F.lit(None).cast("double"))
    ps = (0.0, 0.01, 0.5, 0.95, 1.0)
    found = quantiles(df, {c: (F.col(c), ps) for c in df.columns})
    for c, v in (("tied", tied), ("tail", tail), ("holes", holes[~np.isnan(holes)])):
        assert found[c] == pytest.approx([float(np.quantile(v, p)) for p in ps], rel=1e-12), c
    assert found["none"] == [None] * 5


def test_sketches_of_batches_merge(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    parts = [rank.rank_sketches(df.filter(f"x % 3 = {k}"), {"x": F.col("x"), "y": F.col("y")}) for k in range(3)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = {r["p"]: r["value"] for r in rank.sketch_quantiles(states, (0.0, 0.01, 0.5, 0.99, 1.0)).collect()}
    assert got[0.0] == 0 and got[1.0] == 19_999
    assert all(abs(v / 20_000 - p) < rank.ERROR for p, v in got.items())
    assert rank.merged_sketches(states).select("name", "n").collect() == [("x", 20_000)]


def test_quantiles_of_a_file_that_packs_well(spark, tmp_path):
    path = str(tmp_path / "packed")
    spark.range(1_000_000).select((F.col("id") % 7).cast("double").alias("v")).write.parquet(path)
    assert quantiles(spark.read.parquet(path), {"v": (F.col("v"), (0.0, 0.5, 1.0))}) == {"v": [0.0, 3.0, 6.0]}


def test_keep_first_with_maps(spark):
    df = spark.sql("select * from values (1, map('a', 2)), (1, map('a', 1)), (2, null) as t(k, m)")
    assert {(r["k"], str(r["m"])) for r in keep_first(df, "k").collect()} == {(1, "{'a': 1}"), (2, "None")}


def hot_tables(spark):
    left = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))).alias("key"),
    )
    right = spark.range(500).select(F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
                                    (F.col("id") * 10).alias("value"))
    return left, right


def test_salted_lookup_equals_plain(spark):
    left, right = hot_tables(spark)
    plain = lookup(left, right, "key", ["value"], unique=True, salted=False)
    salted = lookup(left, right, "key", ["value"], unique=True, salted=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.select(plain.columns).collect()))
    assert [r["key"] for r in hot_keys(left, "key").collect() if r["key"] == "hot"] == ["hot"]


def test_lookup_keeps_the_row_count_with_repeated_right_keys(spark):
    left, right = hot_tables(spark)
    assert lookup(left, right.union(right), "key", ["value"]).count() == 3000


def test_name_clash_gets_suffixes(spark):
    left, right = hot_tables(spark)
    out = lookup(left.withColumn("value", F.lit(1)), right, "key", ["value"], unique=True)
    assert {"value_x", "value_y"} <= set(out.columns)


def test_keep_first_is_the_same_for_any_partitioning(spark, folder):
    df = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity")
    a, b = keep_first(df.repartition(7), "l_orderkey"), keep_first(df.repartition(3, "l_quantity"), "l_orderkey")
    assert sorted(a.collect()) == sorted(b.collect())


def test_keep_first_drops_rows_before_the_shuffle(spark, folder):
    df = keep_first(spark.read.parquet(f"{folder}/lineitem.parquet"), "l_orderkey", ["l_shipdate"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Partial")


def test_key_violations_and_rejects(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, v int")
    assert {(r["key"], r["rows"]) for r in key_violations(df, "k").collect()} == {("a", 2), (None, 1)}
    assert {(r["v"], r["reason"]) for r in rejected_rows(df, "k").collect()} == {(1, "repeated key"), (2, "repeated key"), (3, "null key")}


def test_headers(spark):
    assert schema.header_name(" Montant Estimé / Dommage ") == "montant_estime_dommage"
    df = spark.createDataFrame([(1,)], "id_client int")
    assert schema.require_column(df, "client_id").columns == ["client_id"]
    with pytest.raises(KeyError, match="claim_id"):
        schema.require_column(df, "claim_id")
