import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracles import compare, connect
from policylake.checks.queries import QUERIES

# Quick queries; check_oracles.py runs every one of them.
NAMES = (
    "normalize_id", "safe_numeric", "safe_datetime", "clean_text_title", "std_status", "claim_duration", "quantiles",
    "fact_join_vehicle", "coalesce_client", "dashboard_metrics", "classification_report", "stratified_split",
    "ingest_conform", "stream_ingest", "clean_policies", "clean_vehicles",
)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, folder, name):
    con = connect(folder)
    assert compare(queries()[name](spark, folder).toArrow(), con.sql(oracle_sql()[name]).to_arrow_table()) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
