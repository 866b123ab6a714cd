"""Claims are sorted without the columns that follow from others, and plain days are read without the rules for other spellings."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from policylake.functions.dates import PLAIN_DAY_FIRST, parsed_timestamp
from policylake.functions.steps import apply_steps
from policylake.plans import claims

NAMES = "claim_id string, contract_id string, client_id string, vehicle_id string, statut_sinistre_claim string, montant_estime_dommage_claim double, montant_indemnisation_claim double"
ROWS = [
    ("c1", "k", "a", "v", "Refusée", 10.0, 900.0), ("c1", "k", "a", "v", "Refusée", 10.0, 500.0), ("c1", "k", "a", "v", "Refusée", 10.0, 500.0),
    ("c2", None, None, None, None, None, None), ("c2", "k", None, None, None, 1.0, 2.0), (None, "k", "a", "v", "Rejet", 1.0, 2.0), ("c3", "k", "a", "v", "x é", 0.0, -0.0),
]
BOUNDS = {"montant_estime_dommage_claim": [0.0, 8.0], "montant_indemnisation_claim": [0.0, 400.0], "claim_severity_bucket": [100.0, 200.0], "claim_gap_ratio": [-1.0, 1.0]}


def test_derived_columns_are_not_sorted(spark):
    raw = spark.createDataFrame(ROWS, NAMES)
    clean = claims.clean_claims(raw, BOUNDS)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert limits and all("montant_indemnisation_claim" in line for line in limits)
    assert not any(re.search("claim_gap|severity|is_delayed", line) for line in limits)
    columns = clean.columns
    got = {r.claim_id: r for r in clean.collect()}
    assert columns[-4:] == ["is_delayed", "claim_gap_amount", "claim_gap_ratio", "claim_severity_bucket"]
    assert set(got) == {"C1", "C2", "C3"} and got["C1"].claim_gap_amount == 392.0 and got["C1"].claim_gap_ratio == 1.0
    assert got["C2"].contract_id is None and got["C2"].claim_gap_amount is None and got["C1"].statut_sinistre_claim == "Refusé"


def test_an_order_by_a_derived_column_holds(spark):
    raw = spark.createDataFrame(ROWS, NAMES)
    bounds = BOUNDS | {"montant_indemnisation_claim": [0.0, 1000.0]}
    last = {r.claim_id: r.claim_gap_amount for r in claims.clean_claims(raw, bounds, ["claim_gap_amount"]).collect()}
    assert last == {"C1": 492.0, "C2": None, "C3": 0.0}
    named = raw.withColumn("claim_gap_amount", F.lit(7.0))
    assert {r.claim_id: r.claim_gap_amount for r in claims.clean_claims(named, bounds).collect()} == last


def test_plain_days(spark):
    spelled = {
        "13/05/2020 18:45": datetime(2020, 5, 13, 18, 45), " 01-02-2021": datetime(2021, 2, 1), "31/13/2020": None, "1.2.2021": datetime(2021, 2, 1), "01.02.2021": datetime(2021, 2, 1),
        "12-05-2020 10:00 America/Marigot": None, "12-05-20201": None, "12-05-20": datetime(2020, 5, 12), "12 mar 2020": datetime(2020, 3, 12), "32/01/2020": None, "": None,
        "2020-05-13 01:00": datetime(2020, 5, 13, 1), "20200513": datetime(2020, 5, 13),
    }
    df = spark.createDataFrame([(s, s) for s in spelled], "s string, d string")
    assert {r.s: r.d for r in apply_steps(df, {"d": parsed_timestamp()}).collect()} == spelled
    assert re.match(PLAIN_DAY_FIRST, "13-05-2020 18:45") and not re.match(PLAIN_DAY_FIRST, "13-05-2020 mar")
