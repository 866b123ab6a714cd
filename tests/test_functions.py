from datetime import datetime

import pytest
from pyspark.sql import functions as F

from policylake.functions import bands, dates, numbers, text
from policylake.functions.steps import apply_steps

RULES = [
    ("id", text.normalized_id(), [" cli-1 ", "none", "NaN", "", None, " x\t"], ["CLI-1", None, None, None, None, "X"]),
    ("missing", text.missing_to_null(), ["N/A", "--", "Non renseigné", " x "], [None, None, None, "x"]),
    ("strict", (*numbers.strict_number(), numbers.within()), ["1 234,5", "1.234.5", "12.", "1.0d", "1e5", "inf", "NaN", " 7\t"],
     [1234.5, None, 12.0, None, 100000.0, None, None, 7.0]),
    ("flexible", numbers.flexible_number(), ["oui", "F", "DT:2", "1.234,5", "abc", "--3"], [1.0, 0.0, 2.0, 1.234, None, -3.0]),
    ("count", numbers.whole_count(), ["2.7", "-1", "na"], [2, None, None]),
    ("flag", numbers.flag(), ["Vrai", "non", "1.0", "2", None], [True, False, True, None, None]),
    ("title", text.clean_text(), ["JEAN-PIERRE L'ARIANA 3EME", "None", " "], ["Jean-Pierre L'Ariana 3Eme", None, None]),
    ("collapse", text.collapsed_text(), ["  a \t b\n", "nan", " "], ["a b", None, None]),
    ("plate", text.plate(), [" 12 tu 5 "], ["12TU5"]),
    ("gender", text.gender(), ["Homme", "f", "x", "N/A"], ["M", "F", None, None]),
    ("status", text.claim_status(), ["Refusée", "clos avec indemnisation", "En cours", "Clôturé", "nan"],
     ["Refusé", "Clos_avec_indemnisation", "En_cours", "Clôturé", None]),
    ("time", dates.parsed_timestamp(), ["2024-02-01", "01/02/2024", "01/02/2024 10:30", "xx", "31/13/2020", "2024/02/01"],
     [datetime(2024, 2, 1), datetime(2024, 2, 1), datetime(2024, 2, 1, 10, 30), None, None, datetime(2024, 2, 1)]),
    ("spellings", dates.parsed_timestamp(),
     ["20240131", "01/02/24", "01.02.69 10:30", "31 Jan 2024", "31-January-2024", "Feb 1, 2024 08:05", "31 Foo 2024", "20241331", "2024", None],
     [datetime(2024, 1, 31), datetime(2024, 2, 1), datetime(1969, 2, 1, 10, 30), datetime(2024, 1, 31), datetime(2024, 1, 31),
      datetime(2024, 2, 1, 8, 5), None, None, None, None]),
]


@pytest.mark.parametrize("name,steps,given,wanted", RULES, ids=[r[0] for r in RULES])
def test_text_rules(spark, name, steps, given, wanted):
    df = spark.createDataFrame(list(enumerate(given)), "i int, v string")
    got = [r["v"] for r in apply_steps(df, {"v": steps}).orderBy("i").collect()]
    assert got == wanted


def test_typed_numbers_skip_text_parsing(spark):
    df = spark.createDataFrame([(5e-05,), (12345678.9,), (float("nan"),)], "v double")
    steps = (*numbers.flexible_number("double"), numbers.within())
    assert [r["v"] for r in apply_steps(df, {"v": steps}).collect()] == [5e-05, 12345678.9, None]


def test_number_ids_lose_their_decimals(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.5,)], "v double")
    assert [r["v"] for r in apply_steps(df, {"v": text.normalized_id("double")}).collect()] == ["1", None, "2.5"]


def test_bands(spark):
    df = spark.createDataFrame([(24.0, 0.0), (24.5, 0.3), (34.0, 0.31), (64.0, 0.7), (65.0, 0.71), (None, 1.0)], "a double, p double")
    rows = df.select(bands.age_group(F.col("a")).alias("a"), bands.risk_level(F.col("p")).alias("p")).collect()
    assert [r["a"] for r in rows] == ["<25", "25-34", "25-34", "55-64", "65+", None]
    assert [r["p"] for r in rows] == ["Low", "Low", "Medium", "Medium", "High", "High"]


def test_equal_edges_give_the_first_band(spark):
    df = spark.createDataFrame([(3.0,), (None,)], "v double")
    got = [r[0] for r in df.select(bands.band(F.col("v"), [3.0] * 4, bands.QUINTILE_LABELS)).collect()]
    assert got == ["very_low", None]


def test_elapsed_days_floor_whole_days(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 2), datetime(2024, 1, 2, 1)), (datetime(2024, 1, 3), datetime(2024, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    days = df.select(dates.elapsed_days(F.col("a"), F.col("b")).alias("d"))
    assert [r["d"] for r in apply_steps(days, {"d": [numbers.within(0)]}).collect()] == [0.0, None]


def test_rules_are_idempotent(spark):
    df = spark.createDataFrame([(" Ab-c ",), ("N/A",), ("x ",)], "v string")
    for steps in (text.normalized_id(), text.missing_to_null(), text.collapsed_text()):
        once = apply_steps(df, {"v": steps})
        assert once.collect() == apply_steps(once, {"v": steps}).collect()
