"""Disk that staging takes: shuffle files of finished queries are gone, and wide claims are made slice by slice."""

import os
import uuid
from datetime import date

from pyspark.sql import functions as F

from policylake import session
from policylake.plans import build, jobs
from policylake.sources.driver_tables import raw_tables


def claim_tables(spark, folder):
    ids = spark.range(60)
    key = [F.concat(F.lit(p), F.col("id") % n).alias(c) for p, n, c in (("p", 13, "contract_id"), ("c", 7, "client_id"), ("v", 5, "vehicle_id"))]
    tables = {
        "clean_claims": ids.select(F.concat(F.lit("k"), "id").alias("claim_id"), key[0], F.when(F.col("id") % 3 > 0, key[1]).alias("client_id"), key[2]).repartition(6),
        "clean_policies": spark.range(11).select(F.concat(F.lit("p"), "id").alias("contract_id"), F.concat(F.lit("c"), F.col("id") % 7).alias("client_id"), F.col("id").alias("policy_duration_days")),
        "clean_clients": spark.range(6).select(F.concat(F.lit("c"), "id").alias("client_id"), F.col("id").alias("age")),
        "clean_vehicles": spark.range(4).select(F.concat(F.lit("v"), "id").alias("vehicle_id"), F.col("id").alias("vehicle_age")),
    }
    return {n: session.stage(df, n) for n, df in tables.items()}


def test_wide_claims_in_slices(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_folder", lambda spark, purpose: f"{tmp_path}/a b%20c/{purpose}-{uuid.uuid4().hex}")
    clean, slices, real = claim_tables(spark, folder), [], session.file_slices

    def few(staged, most=8, least_bytes=1):
        slices.extend(real(staged, 4, 1))
        return slices

    monkeypatch.setattr(build, "file_slices", few)
    found = build.stage_wide(clean)
    assert len(slices) == 4 and sum(s.count() for s in slices) == 60
    wanted = build.wide_claims(clean)
    assert found.columns == wanted.columns and sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


def test_only_files_as_they_are_read_are_sliced(spark, folder):
    claims = claim_tables(spark, folder)["clean_claims"]
    assert len(session.file_slices(claims)) == 1  # small
    assert len(session.file_slices(claims, least_bytes=1)) == 6
    some = claims.filter("claim_id <> 'k1'")
    assert session.file_slices(some, least_bytes=1) == [some]


def test_shuffle_files_go_with_their_query(spark):
    session.tune(spark, session.TABLE_SETTINGS)
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    blocks, kept = env.blockManager().diskBlockManager(), []
    spark._jvm.System.gc()
    before = {b.toString() for b in _files(blocks) if "shuffle" in b.toString()}
    kept.append(spark.range(10000).repartition(5, "id"))
    session.stage(kept[0], "rows")
    assert not {b.toString() for b in _files(blocks) if "shuffle" in b.toString()} - before
    assert kept[0].count() == kept[0].count() == 10000


def test_clean_copies_go_before_the_wide_outputs_are_written(spark, folder, tmp_path, monkeypatch):
    scratch, staged, real = tmp_path / "scratch", [], jobs.write_outputs
    monkeypatch.setattr(session, "scratch_folder", lambda spark, purpose: f"{scratch}/{purpose}-{uuid.uuid4().hex}")
    monkeypatch.setattr(jobs, "write_outputs", lambda found, *a: staged.append((len(found), {f.split("-")[0] for f in os.listdir(scratch)})) or real(found, *a))
    jobs.build(spark, raw_tables(spark, folder), str(tmp_path / "zones"), date(2024, 6, 30))
    assert staged == [(8, {"clean_clients", "clean_policies", "clean_vehicles", "clean_claims", "claim_wide"}), (2, {"claim_wide"})]
    assert os.listdir(scratch) == []


def _files(blocks):
    found = blocks.getAllFiles()
    return [found.apply(k) for k in range(found.size())]
