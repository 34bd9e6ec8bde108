import json

import pytest
from helpers import tuples

from landfall.operators import (
    capped_ids,
    failures,
    fetch_column,
    latest_state,
    progress,
    run_summary,
    sql,
    task_durations,
)
from landfall.sources import append_discovery, append_run_events, read_discovery, read_run_events


@pytest.fixture
def log(spark):
    return spark.sql("""
        select run_id, task, status, cast(time as timestamp_ntz) as time, error,
               cast(current as bigint) as current, cast(total as bigint) as total, cast(current_id as bigint) as current_id
        from values
            ('r', 'a', 'started', '2024-01-01 00:00:00', null, null, null, null),
            ('r', 'a', 'running', '2024-01-01 00:00:01', null, 5, 20, 11),
            ('r', 'a', 'running', '2024-01-01 00:00:02', null, 10, 20, null),
            ('r', 'a', 'success', '2024-01-01 00:00:02.56', null, null, null, null),
            ('r', 'b', 'started', '2024-01-01 00:00:03', null, null, null, null),
            ('r', 'b', 'failed', '2024-01-01 00:00:04', 'boom', null, null, null),
            ('r', 'c', 'skipped', '2024-01-01 00:00:05', null, null, null, null),
            ('q', 'a', 'success', '2024-01-01 00:00:01', null, null, null, null)
        as v(run_id, task, status, time, error, current, total, current_id)""")


def test_summary(log):
    assert tuples(run_summary(log)) == [("q", 1, 0), ("r", 1, 1)]


def test_latest_state(log):
    assert tuples(latest_state(log), "run_id", "task", "status") == [
        ("q", "a", "success"), ("r", "a", "success"), ("r", "b", "failed"), ("r", "c", "skipped"),
    ]


def test_progress(log, spark):
    assert tuples(progress(log)) == [("r", "a", 10, 20, 50.0, 11)]
    other = spark.createDataFrame([("r", "b")], "run_id string, task string")
    assert tuples(progress(log, known=other)) == []


def test_durations(log):
    assert tuples(task_durations(log)) == [("r", "a", "success", 2.6), ("r", "b", "failed", 1.0)]


def test_failures(log):
    assert tuples(failures(log), "run_id", "task", "error") == [("r", "b", "boom")]


def lines(folder):
    return [json.loads(x) for f in folder.glob("*.json") for x in f.read_text().splitlines()]


def test_run_log_lines(spark, tmp_path):
    rows = spark.createDataFrame(
        [("r", "t", "started", None, None), ("r", "t", "failed", 1.5, "boom")],
        "run_id string, task string, status string, duration_s double, error string",
    ).coalesce(1)
    append_run_events(rows, str(tmp_path / "log"))
    append_run_events(rows.limit(1), str(tmp_path / "log"))
    found = sorted(lines(tmp_path / "log"), key=len)
    assert set(found[0]) == {"run_id", "task", "status", "time"}
    assert (found[2]["duration_s"], found[2]["error"]) == (1.5, "boom")
    assert found[0]["time"].endswith("+00:00")
    assert read_run_events(spark, str(tmp_path / "log")).filter("time is not null").count() == 3


def test_discovery_lines(spark, tmp_path):
    rows = spark.createDataFrame(
        [("e", "t", "new_column", "c", "TEXT", None, None), ("e", "t", "type_change", "d", None, "INTEGER", "TEXT")],
        "endpoint string, table string, event string, column string, type string, was string, now string",
    )
    append_discovery(rows, str(tmp_path / "log"))
    by_event = {x["event"]: x for x in lines(tmp_path / "log")}
    assert "was" not in by_event["new_column"] and by_event["new_column"]["type"] == "TEXT"
    assert (by_event["type_change"]["was"], by_event["type_change"]["now"]) == ("INTEGER", "TEXT")
    assert read_discovery(spark, str(tmp_path / "log")).count() == 2


def test_fetch_column(spark):
    df = spark.createDataFrame([(2,), (1,), (None,), (3,), (1,)], "id int")
    assert [r[0] for r in fetch_column(df, "id").collect()] == [1, 1, 2, 3, None]
    assert fetch_column(df.limit(0), "id").collect() == []


def test_capped_ids(spark):
    df = spark.createDataFrame([(2,), (1,), (3,)], "id int")
    assert [r[0] for r in capped_ids(df, "id", 2).collect()] == [1, 2]
    assert [r[0] for r in capped_ids(df, "id", 0).collect()] == [1, 2, 3]
    assert [r[0] for r in capped_ids(df, "id").collect()] == [1, 2, 3]


def test_sql_error_names_the_statement(spark):
    assert tuples(sql(spark, "select 1 as x")) == [(1,)]
    with pytest.raises(RuntimeError, match="Failed to execute: SELEKT"):
        sql(spark, "SELEKT 1")
