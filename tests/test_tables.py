import os
import uuid
from datetime import date

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from policylake import session
from policylake.checks import queries
from policylake.plans import build, dashboard, delay_scoring, jobs, warehouse
from policylake.plans.bounds import bounds_table, read_bounds
from policylake.plans.claims import DAYS, clean_claims, delay_label
from policylake.plans.delay_training import TrainingSize, best_by_auc
from policylake.sources import ingest, tables
from policylake.sources.driver_tables import raw_tables


def test_write_modes_and_guards(spark, tmp_path):
    root = str(tmp_path)
    a = spark.createDataFrame([("x", 1.0), ("y", float("nan"))], "id string, v double")
    tables.write_table(a, root, "stg.t", "replace", "id")
    assert {tuple(r) for r in tables.read_table(spark, root, "stg.t").collect()} == {("x", 1.0), ("y", None)}
    tables.write_table(a.withColumn("id", F.concat("id", F.lit("2"))), root, "stg.t", "append", "id")
    assert tables.read_table(spark, root, "stg.t").count() == 4
    with pytest.raises(ValueError, match="repeated"):
        tables.write_table(a, root, "stg.t", "append", "id")
    with pytest.raises(ValueError, match="differ"):
        tables.write_table(a.withColumn("extra", F.lit(1)), root, "stg.t", "append")
    tables.write_table(a.withColumn("extra", F.lit(1)), root, "stg.t", "append", replace_changed=True)
    assert tables.read_table(spark, root, "stg.t").columns == ["id", "v", "extra"]
    with pytest.raises(ValueError, match="empty"):
        tables.write_table(a.filter("false"), root, "stg.new")
    assert [d for d in os.listdir(f"{root}/stg") if d != "t"] == []


def test_ingest(spark, tmp_path):
    root, csv = str(tmp_path / "zones"), str(tmp_path / "new.csv")
    old = spark.createDataFrame([(1, "a", 2.0)], "id bigint, name string, amount double")
    tables.write_table(old, root, "raw.t", "replace")
    with open(csv, "w") as f:
        f.write("id,amount,other\n2,3.5,z\n3,abc,z\n,1,z\n")
    assert ingest.append_csv(spark, csv, root, "raw.t", dry_run=True).first()["appended"] == 3
    assert tables.read_table(spark, root, "raw.t").count() == 1
    row = ingest.append_csv(spark, csv, root, "raw.t", "id", "raw.t_rejected").first()
    assert (row["read"], row["appended"], row["set_aside"]) == (3, 1, 2)
    assert {tuple(r) for r in tables.read_table(spark, root, "raw.t").collect()} == {(1, "a", 2.0), (2, None, 3.5)}
    reasons = {r["reason"] for r in tables.read_table(spark, root, "raw.t_rejected").collect()}
    assert reasons == {"amount", "null key"}
    assert ingest.append_csv(spark, str(tmp_path / "none.csv"), root, "raw.t").first()["read"] == 0


def test_ingest_keeps_every_line(spark, tmp_path):
    root, csv = str(tmp_path / "zones"), str(tmp_path / "new.csv")
    old = spark.createDataFrame([(1, "a", True)], "id bigint, name string, ok boolean")
    tables.write_table(old, root, "raw.t", "replace")
    with open(csv, "w") as f:
        f.write('id,name,ok\n2,"say ""hi"", ok",1.0\n3,b,0.0,too many\n4\n5,c,false\n')
    row = ingest.append_csv(spark, csv, root, "raw.t", "id", "raw.t_rejected").first()
    assert (row["read"], row["appended"], row["set_aside"]) == (4, 2, 2)
    assert {tuple(r) for r in tables.read_table(spark, root, "raw.t").collect()} == {(1, "a", True), (2, 'say "hi", ok', True), (5, "c", False)}
    lines = {r[ingest.CORRUPT] for r in tables.read_table(spark, root, "raw.t_rejected").collect()}
    assert lines == {"3,b,0.0,too many", "4"}
    with open(csv, "w") as f:
        f.write('id,name,ok\n7,"two\nlines",true\n')
    assert ingest.append_csv(spark, csv, root, "raw.t", "id", "raw.t_rejected", multi_line=True).first()["appended"] == 1


@pytest.fixture(scope="module")
def outputs(spark, folder):
    return build.build_outputs(raw_tables(spark, folder), date(2024, 6, 30))


def test_row_counts_and_keys(outputs):
    counts = {n: df.count() for n, df in outputs.items()}
    assert counts["clean_claims"] == counts["fact_claim"] == counts["ml_claim"] > 0
    for _, name, key in tables.OUTPUT_TABLES:
        keys = outputs[name].select(key)
        assert keys.distinct().count() == counts[name] and keys.filter(F.col(key).isNull()).isEmpty(), name


def test_build_leaves_no_staged_folder(spark, folder, tmp_path, monkeypatch):
    scratch, root = tmp_path / "scratch", str(tmp_path / "zones")
    monkeypatch.setattr(session, "scratch_folder", lambda spark, purpose: f"{scratch}/{purpose}-{uuid.uuid4().hex}")
    jobs.build(spark, raw_tables(spark, folder), root, date(2024, 6, 30))
    assert all(not tables.read_table(spark, root, f"{zone}.{name}").isEmpty() for zone, name, _ in tables.OUTPUT_TABLES)
    assert os.listdir(scratch) == []


def test_dropped_columns(outputs):
    assert not set(warehouse.FACT_DROPPED) & set(outputs["fact_claim"].columns)
    assert not set(warehouse.ML_DROPPED) & set(outputs["ml_claim"].columns)


def test_plans_stay_in_the_jvm(outputs):
    for df in outputs.values():
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_claims_with_the_required_columns_only(spark):
    raw = spark.createDataFrame([("c1", "k", "p", "v"), (None, "k", "p", "v")], "claimid string, contractid string, client string, vehicule_id string")
    out = clean_claims(raw).collect()
    assert [(r["claim_id"], r["is_delayed"]) for r in out] == [("C1", 0)]


def test_delay_label(spark):
    df = spark.createDataFrame([(5.0, 3.0), (None, 3.0), (5.0, None), (3.0, 3.0)], "duree_traitement_jours double, sla_jours double")
    assert [r[0] for r in df.select(delay_label()).collect()] == [1, 0, 0, 0]
    assert [r[0] for r in df.select(delay_label(None)).collect()] == [1, None, None, 0]


def test_staff_of_the_recorded_run(spark):
    row = spark.range(1).select(dashboard.staff_needed(F.lit(108), F.lit(2266), F.lit(843)).alias("n")).first()
    assert row["n"] == 90


def test_active_claims_fall_back_to_all(spark):
    some = spark.createDataFrame([("a", "Ouvert"), ("b", "Clos"), ("c", None)], "claim_id string, statut_sinistre_claim string")
    assert [r["claim_id"] for r in delay_scoring.active_claims(some).collect()] == ["a"]
    assert delay_scoring.active_claims(some.filter("claim_id <> 'a'")).count() == 2
    with pytest.raises(ValueError):
        delay_scoring.checked_active_claims(some.filter("false"))


class Fixed:
    """A stand-in for a model: probabilities or days from a column."""

    def __init__(self, **columns):
        self.columns = columns

    def transform(self, df):
        return df.withColumns(self.columns)


@pytest.mark.parametrize("limit, wanted", [(0.5, {"a": 12.0, "b": None}), (2.0, {"a": 0.0, "b": 0.0})])
def test_days_follow_the_scores(spark, limit, wanted):
    """With a late claim the others have no days; without any, all have 0. The rule that checks scores holds in both cases, and fails on wrong days."""
    claims = spark.createDataFrame([("a", 0.9), ("b", 0.2)], "claim_id string, p double")
    p = F.col("p") / (1.0 if limit < 1 else 4.0)
    delay = Fixed(probability=array_to_vector(F.array(1 - p, p)))
    scored = delay_scoring.score_claims(claims, delay, Fixed(prediction=F.lit(12.0)))
    assert {r["claim_id"]: r["predicted_delay_days"] for r in scored.collect()} == wanted
    assert all(r[0] for r in scored.select(queries.days_follow(scored)).collect())
    wrong = scored.withColumn("predicted_delay_days", F.lit(7.0))
    assert not all(r[0] for r in wrong.select(queries.days_follow(wrong)).collect())


def test_dashboard_document(spark):
    rows = [(f"c{i}", 0.5 + i / 40, 10.0) for i in range(20)]
    df = spark.createDataFrame(rows, "claim_id string, delay_probability double, montant_indemnisation_claim double")
    scored = delay_scoring.with_default_delay(delay_scoring.with_risk(df))
    doc = dashboard.dashboard_document(scored, date(2024, 1, 20)).first()
    assert doc["summary"]["projection_month"] == 2
    assert doc["summary"]["estimated_total_delay_days"] == 30 * 19
    assert [r["claim_id"] for r in doc["high_risk_claims"]] == [f"c{i}" for i in range(19, 9, -1)]
    assert sum(doc["risk_distribution"].values()) == 20


def test_best_model_tie_goes_to_the_forest():
    assert best_by_auc({"boosted_trees": 0.7, "random_forest": 0.7}) == "random_forest"
    assert best_by_auc({"boosted_trees": 0.8, "random_forest": 0.7}) == "boosted_trees"


def test_train_store_load_and_score(spark, tmp_path):
    rows = [(f"c{i:04d}", i % 3 == 0, "Ouvert" if i % 2 else "Clos", float(i % 3 + i % 7), "AB"[i % 2], 10.0 * i, float(i % 50)) for i in range(1200)]
    names = "claim_id string, is_delayed boolean, statut_sinistre_claim string, vehicle_age double, genre string, montant_estime double, claim_duration_days double"
    ml = spark.createDataFrame(rows, names).withColumn("is_delayed", F.col("is_delayed").cast("int"))
    clean = ml.select("claim_id", "is_delayed", F.col("claim_duration_days").alias(DAYS))
    ml = ml.drop("claim_duration_days").withColumn(DAYS, F.lit(None).cast("double"))
    root, models, report = (str(tmp_path / n) for n in ("zones", "models", "report"))
    with pytest.raises(FileNotFoundError):
        jobs.score(spark, root, models, report)
    tables.write_table(ml, root, "ml.ml_claim", "replace", "claim_id")
    tables.write_table(clean, root, "stg.clean_claims", "replace", "claim_id")
    trained = jobs.train(spark, root, models, TrainingSize(trees=3, tree_depth=3, rounds=2, boost_depth=2))
    scored = jobs.score(spark, root, models, report, date(2024, 1, 20)).collect()
    assert sorted(r["claim_id"] for r in scored) == [r[0] for r in rows if r[2] == "Ouvert"]
    assert all(0 <= r["delay_probability"] <= 1 for r in scored)
    assert all((r["predicted_delay_days"] is None) == (r["delay_probability"] <= 0.5) for r in scored)
    saved = {r["model"]: r for r in spark.read.parquet(f"{models}/metrics").collect()}
    for name, test in trained.scored.items():
        matrix = {(r["label"], r["predicted"]): r["rows"] for r in spark.read.parquet(f"{models}/matrices/model={name}").collect()}
        right = sum(n for (label, said), n in matrix.items() if label == said)
        assert sum(matrix.values()) == saved[name]["test_rows"] == test.count()
        assert abs(right / sum(matrix.values()) - saved[name]["accuracy"]) < 1e-12
        assert spark.read.parquet(f"{models}/reports/model={name}").agg(F.sum("support")).first()[0] == test.count()
    document = spark.read.json(report).first()
    assert document["summary"]["total_active_claims"] == len(scored)


def test_saved_limits_come_back(spark):
    limits = {"claims": {"a": [1.0, 2.5], "b": [None, 3.0]}, "ml": {"a": [0.0]}}
    assert read_bounds(bounds_table(spark, limits)) == limits


def test_typed_copies_go_once_the_clean_tables_stand(spark, folder, monkeypatch, tmp_path):
    """Only the four clean tables are left of what building them has staged, also inside ``staging``, which then removes these."""
    monkeypatch.setattr(session, "scratch_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    with session.staging(spark):
        build.clean_tables(raw_tables(spark, folder), as_of=queries.AS_OF, order_by=queries.ORDER, staged=True)
        assert sorted(os.listdir(tmp_path)) == ["clean_claims", "clean_clients", "clean_policies", "clean_vehicles"]
    assert os.listdir(tmp_path) == []
