import datetime as dt

import pytest
from helpers import tuples

from landfall.operators import (
    TableColumn,
    TableSchema,
    create_table,
    drop_old_versions,
    evolve_table,
    snapshot_table,
    table_exists,
)
from landfall.operators.tables import replace_table, table_location

SCHEMA = TableSchema("t", (
    TableColumn("id", "INTEGER", False, True), TableColumn("name", "TEXT"), TableColumn("meta", "JSON"),
    TableColumn("code", "INTEGER", unique=True), TableColumn("team_id", "INTEGER", references=("teams", "id")),
    TableColumn("at", "TIMESTAMP"), TableColumn("state", "TEXT", default="'new'"),
))


def test_statement(store):
    text = create_table(store, SCHEMA)
    for part in (
        f"CREATE TABLE IF NOT EXISTS `{store.database}`.`t`", "`id` INT NOT NULL", "`name` STRING", "`at` TIMESTAMP_NTZ",
        "`state` STRING DEFAULT 'new'", "'primary_key' = 'id'", "'unique' = 'code'",
        "'foreign_keys' = 'team_id -> teams(id)'", "'json_columns' = 'meta'",
    ):
        assert part in text
    assert "IF NOT EXISTS" not in create_table(store, SCHEMA, if_not_exists=False)
    assert not table_exists(store, "t")


def test_statement_without_a_database(store):
    store.database = None
    assert "CREATE TABLE IF NOT EXISTS `t`" in create_table(store, SCHEMA)


def test_create_twice(store):
    create_table(store, SCHEMA, execute=True)
    create_table(store, SCHEMA, execute=True)
    assert table_exists(store, "t") and not table_exists(store, "absent")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_table(store, SCHEMA, execute=True, if_not_exists=False)


SMALL = TableSchema("s", (TableColumn("id", "INTEGER", False, True), TableColumn("v", "TEXT")))


def rows(spark, *values):
    return spark.createDataFrame(values, "id int, v string")


@pytest.mark.parametrize("buckets", [{}, {"s": 4}])
def test_versions(spark, store, buckets):
    store.buckets = buckets
    create_table(store, SMALL, execute=True)
    replace_table(store, "s", rows(spark, (1, "a"), (2, "b")), ["id"])
    replace_table(store, "s", store.table("s").filter("id = 1"), ["id"])
    assert tuples(store.table("s")) == [(1, "a")]
    assert table_location(store, "s").endswith("/s/v2")
    assert [p.rsplit("/", 1)[1] for p in drop_old_versions(store, "s", keep=1)] == ["v1"]
    assert tuples(store.table("s")) == [(1, "a")]


def test_bucketed_side_is_not_shuffled(spark, store):
    store.buckets = {"s": 4}
    create_table(store, SMALL, execute=True)
    replace_table(store, "s", spark.range(100).selectExpr("cast(id as int) id", "'x' v"), ["id"])
    joined = store.table("s").hint("merge").join(rows(spark, (1, "n")).repartition(4, "id"), "id", "full_outer")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_a_failing_write_changes_nothing(spark, store):
    create_table(store, SMALL, execute=True)
    replace_table(store, "s", rows(spark, (1, "a")))
    with pytest.raises(Exception, match="boom"):
        replace_table(store, "s", rows(spark, (2, "b")).selectExpr("id", "raise_error('boom') as v"))

    def refuse(_df):
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        replace_table(store, "s", rows(spark, (2, "b")), check=refuse)
    assert tuples(store.table("s")) == [(1, "a")]
    replace_table(store, "s", rows(spark, (3, "c")))
    assert tuples(store.table("s")) == [(3, "c")]


def test_evolve(spark, store):
    create_table(store, SMALL, execute=True)
    replace_table(store, "s", rows(spark, (1, "a")))
    added = evolve_table(store, "s", [TableColumn("V", "TEXT"), TableColumn("n", "INTEGER"), TableColumn("d", "TEXT", default="'x'")])
    assert added == ["n", "d"]
    assert tuples(store.table("s")) == [(1, "a", None, "x")]


def test_snapshot(spark, store, tmp_path):
    assert snapshot_table(store, "s") is None
    create_table(store, SMALL, execute=True)
    replace_table(store, "s", rows(spark, (1, "a")))
    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    path = snapshot_table(store, "s", when, str(tmp_path / "copies"))
    assert path == str(tmp_path / "copies" / "s" / "20240102_030405")
    assert "/backups/s/" in snapshot_table(store, "s")
    replace_table(store, "s", rows(spark, (2, "b")))
    assert tuples(spark.read.parquet(path)) == [(1, "a")]
