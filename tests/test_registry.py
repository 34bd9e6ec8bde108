from helpers import tuples
from pyspark.sql import functions as F

from landfall.operators import (
    definitions_of,
    detect_drift,
    drift_report,
    load_registry,
    map_types,
    registry_columns,
    resolve_schema,
    save_registry,
)
from landfall.operators.registry import DEFINITION_SCHEMA


def definitions(spark, *rows):
    return spark.createDataFrame([(*r, 1) if len(r) == 3 else r for r in rows], DEFINITION_SCHEMA)


def mapped(spark, *rows):
    df = spark.createDataFrame(
        [("e", *r) for r in rows], "endpoint string, table_name string, ordinal int, name string, type string"
    )
    return map_types(df)


def test_pinned_definition(spark):
    got = registry_columns(definitions(spark, (
        "teams", "id", [("id", "INTEGER", ["not_null"]), ("name", "TEXT", None), ("code", "INTEGER", ["unique"])],
    )))
    assert tuples(got, "name", "nullable", "unique", "primary_key") == [
        ("code", True, True, False), ("id", False, False, True), ("name", True, False, False),
    ]


def test_singleton_mark_is_no_column(spark):
    got = registry_columns(definitions(spark, ("cfg", "!singleton", [("a", "TEXT", None)])))
    assert tuples(got, "name", "primary_key", "table_key") == [("a", False, "!singleton")]


def test_nothing_pinned_is_empty(spark, tmp_path):
    assert load_registry(spark, str(tmp_path / "none")).count() == 0


def test_last_definition_holds_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "r")
    both = mapped(spark, ("t", 0, "id", "int"), ("t", 1, "a", "str"), ("u", 0, "id", "int"))
    save_registry(both, path, 1)
    save_registry(both.filter("table_name = 't' and name = 'id'"), path, 2)
    assert tuples(load_registry(spark, path), "table_name", "name") == [("t", "id"), ("u", "id")]


def test_round_trip_keeps_little(spark):
    columns = mapped(spark, ("t", 0, "a", "int"), ("t", 1, "b", "int"), ("t", 2, "c", "str")).withColumn(
        "primary_key", F.col("name") != "c"
    ).withColumn("unique", F.col("name") == "c").withColumn("nullable", F.lit(False))
    saved = definitions_of(columns)
    assert tuples(saved, "name", "primary_key") == [("t", None)]
    again = registry_columns(saved)
    assert tuples(again, "name", "nullable", "primary_key", "unique") == [
        ("a", False, False, False), ("b", False, False, False), ("c", True, False, True),
    ]


def test_pinned_wins_else_inferred(spark):
    arriving = mapped(spark, ("t", 0, "id", "int"), ("t", 1, "new", "str"), ("u", 0, "x", "str"))
    pinned = registry_columns(definitions(
        spark, ("t", "id", [("id", "BIGINT", ["not_null"])]), ("other", None, [("y", "TEXT", None)])
    ))
    assert tuples(resolve_schema(arriving, pinned), "endpoint", "table_name", "name", "data_type") == [
        ("e", "t", "id", "BIGINT"), ("e", "u", "x", "TEXT"),
    ]


def test_new_column_is_drift(spark):
    arriving = mapped(spark, ("t", 0, "id", "int"), ("t", 1, "zeta", "float"), ("t", 2, "alpha", "str"), ("u", 0, "x", "int"))
    pinned = registry_columns(definitions(spark, ("t", "id", [("id", "INTEGER", None), ("gone", "TEXT", None)])))
    got = [tuple(r) for r in detect_drift(arriving, pinned).collect()]
    assert got == [
        ("e", "t", "new_column", "alpha", "TEXT", None, None), ("e", "t", "new_column", "zeta", "DOUBLE", None, None),
    ]


def test_no_drift(spark):
    arriving = mapped(spark, ("t", 0, "id", "int"))
    pinned = registry_columns(definitions(spark, ("t", "id", [("id", "INTEGER", None)])))
    assert detect_drift(arriving, pinned).count() == 0
    assert detect_drift(arriving, pinned, full=True).count() == 0


def test_full_drift(spark):
    arriving = mapped(spark, ("t", 0, "id", "float"), ("t", 1, "new", "int"))
    pinned = registry_columns(definitions(
        spark, ("t", "id", [("id", "INTEGER", None), ("gone", "TEXT", None)]), ("absent", None, [("q", "TEXT", None)])
    ))
    assert tuples(detect_drift(arriving, pinned, full=True), "event", "column", "type", "was", "now") == [
        ("missing_column", "gone", "TEXT", None, None),
        ("new_column", "new", "INTEGER", None, None),
        ("type_change", "id", None, "INTEGER", "DOUBLE"),
    ]


def test_drift_report(spark):
    events = spark.sql(
        "select * from values (timestamp_ntz'2024-01-01', 't', 'new_column', 'a'), "
        "(timestamp_ntz'2024-01-03', 't', 'new_column', 'a') as v(time, table, event, column)"
    )
    got = drift_report(events).first()
    assert (got["n_events"], got["first_seen"].day, got["last_seen"].day) == (2, 1, 3)
