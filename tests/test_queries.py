"""Registered queries against their SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entries
from check_queries import TABLES, rows_of
from landfall.plans.oracles import ORACLES
from landfall.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LIGHT = [
    "L2_normalize_response", "L3_route_records", "L3_rejected", "L4_table_name", "L7_append_discovery", "S1_value_type",
    "S2_infer_per_response", "S10_detect_drift_full", "S4_map_event_types", "S6_load_event_registry", "S10_event_drift_full",
    "K1_detect_event_keys", "K3_event_singleton_columns", "K4_event_unique_column", "T4_init_event_tables", "K5_check_unique", "K8_check_foreign_key", "T5_evolve_table",
    "U1_upsert_full", "U1_upsert_partial", "U1_upsert_null_key", "U1_upsert_optional", "U2_last_wins",
    "U4_cast_record", "K9_default_keeps_stored", "R3_progress_from_log", "Q1_fetch_column", "R1_run_summary", "R2_latest_state", "R3_progress", "R4_task_durations",
    "R5_drift_report", "R6_failures",
]


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entries.oracle_sql()) <= set(entries.queries())


@pytest.mark.parametrize("name", LIGHT)
def test_query(spark, db, name):
    df = entries.queries()[name](spark, FOLDER)
    cursor = db.execute(entries.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    assert entries.entry(spark).count() == 450
