import datetime as dt
import random

import pytest
from helpers import land, tuples
from pyspark.sql import functions as F

from landfall.operators import cast_record, last_wins, project_records, upsert
from landfall.sources import route_records


def cast(spark, text, data_type):
    """(value, fits) of one JSON value in a column of a type."""
    records = route_records(land(spark, ("e", f'{{"t":[{{"v":{text}}}]}}')))
    row = cast_record(records, [("v", data_type)]).first()
    return row["v"], not row["problems"]


@pytest.mark.parametrize(
    ("text", "data_type", "value"),
    [
        ("8.5", "INTEGER", 8), ("7.5", "INTEGER", 8), ("-2.5", "INTEGER", -2), ('"12"', "INTEGER", 12),
        ('" 12 "', "INTEGER", 12), ('"7.5"', "INTEGER", 8), ('"8.5"', "INTEGER", 9), ('"1e3"', "INTEGER", 1000),
        ("true", "INTEGER", 1), ("8.0", "BIGINT", 8), ("3000000000", "BIGINT", 3000000000),
        ("9223372036854775807", "BIGINT", 9223372036854775807), ("1e3", "INTEGER", 1000),
        ('"7.5"', "DOUBLE", 7.5), ('" 7 "', "DOUBLE", 7.0), ("true", "DOUBLE", 1.0), ("5", "DOUBLE", 5.0),
        ('"1e5"', "DOUBLE", 100000.0), ("100000000000000000000", "DOUBLE", 1e20), ('"inf"', "DOUBLE", float("inf")),
        ("1", "BOOLEAN", True), ("0", "BOOLEAN", False), ("0.5", "BOOLEAN", True), ('"yes"', "BOOLEAN", True),
        ('"F"', "BOOLEAN", False), ('"TRUE"', "BOOLEAN", True),
        ("5", "TEXT", "5"), ("8.0", "TEXT", "8.0"), ("7.5", "TEXT", "7.5"), ("1e7", "TEXT", "10000000.0"),
        ("1.5e20", "TEXT", "1.5e+20"), ("1e-5", "TEXT", "1e-05"), ("12345678.5", "TEXT", "12345678.5"),
        ("true", "TEXT", "true"), ("100000000000000000000", "TEXT", "100000000000000000000"),
        ('{"b": 1, "a": [1]}', "TEXT", '{"a":[1],"b":1}'), ("0.1", "TEXT", "0.1"),
        ('{"a": null}', "JSON", '{"a":null}'), ("[1, 2]", "JSON", "[1,2]"), ("5", "JSON", "5"), ("true", "JSON", "true"),
        ('"[1]"', "JSON", "[1]"),
        ('"2024-01-02T03:04:05Z"', "TIMESTAMP", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ('"2024-01-02T17:30:00+02:00"', "TIMESTAMP", dt.datetime(2024, 1, 2, 17, 30)),
        ('"2024-01-02 03:04"', "TIMESTAMP", dt.datetime(2024, 1, 2, 3, 4)),
        ('"2024-01-02"', "TIMESTAMP", dt.datetime(2024, 1, 2)),
    ],
)
def test_value_is_stored_as(spark, text, data_type, value):
    assert cast(spark, text, data_type) == (value, True)


@pytest.mark.parametrize(
    ("text", "data_type"),
    [
        ('"abc"', "INTEGER"), ('""', "INTEGER"), ("3000000000", "INTEGER"), ("1e300", "INTEGER"), ('{"a":1}', "INTEGER"),
        ('"true"', "INTEGER"), ('"1d"', "DOUBLE"), ('"abc"', "DOUBLE"), ('"on"', "BOOLEAN"), ('"abc"', "JSON"),
        ('""', "JSON"), ('"bad"', "TIMESTAMP"), ("5", "TIMESTAMP"), ('"2024-02-30T01:00"', "TIMESTAMP"),
    ],
)
def test_value_does_not_fit(spark, text, data_type):
    assert cast(spark, text, data_type) == (None, False)


def test_null_fits_every_type(spark):
    for data_type in ("INTEGER", "DOUBLE", "BOOLEAN", "TEXT", "JSON", "TIMESTAMP"):
        assert cast(spark, "null", data_type) == (None, True)


def test_projection_of_records(spark):
    records = route_records(land(spark, ("e", '{"t":[{"id":1,"a":"x","more":1},{"id":2},{"id":"bad","a":"y"},{"z":1}]}')))
    columns = [("id", "INTEGER"), ("a", "TEXT")]
    assert tuples(project_records(records, columns), "pos", "id", "a", "problem") == [
        (0, 1, "x", None), (1, 2, None, None), (2, None, "y", "does not fit: id"), (3, None, None, "no known field"),
    ]
    strict = project_records(records, columns, missing="fail")
    assert tuples(strict.filter("pos = 1"), "problem") == [("missing: a",)]


def test_last_row_wins_and_null_keys_stay(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 3, "c"), (None, 4, "d"), (2, 5, None)], "k int, seq long, v string")
    assert tuples(last_wins(rows, ["k"], ["seq"]), "k", "v") == [(1, "b"), (2, None), (None, "c"), (None, "d")]


def test_last_wins_reduces_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
    plan = last_wins(rows, ["k"], ["seq"], null_keys=False)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_last_value_per_column(spark):
    rows = spark.createDataFrame(
        [(1, 1, "a", 1, ["k", "x", "y"]), (1, 2, "b", None, ["k", "x"]), (1, 3, None, 5, ["k", "y"]), (1, 4, None, None, ["k", "y"]),
         (2, 5, "z", 9, None)],
        "k int, seq long, x string, y int, found array<string>",
    )
    got = last_wins(rows, ["k"], ["seq"], null_keys=False, found="found")
    assert tuples(got, "k", "x.v", "y.v") == [(1, "b", None), (2, "z", 9)]


BASE = [(1, "a", 10), (2, "b", 20), (None, "n", 30)]


@pytest.mark.parametrize("small", [False, True])
def test_upsert(spark, small):
    base = spark.createDataFrame(BASE, "id int, name string, n int")
    full = spark.createDataFrame([(1, "updated", None), (3, "c", 3), (None, "m", 4)], "id int, name string, n int")
    assert tuples(upsert(base, full, ["id"], small=small)) == sorted(
        [(1, "updated", None), (2, "b", 20), (3, "c", 3), (None, "n", 30), (None, "m", 4)], key=repr
    )
    partial = full.select("id", "n")
    assert tuples(upsert(base, partial, ["id"], small=small)) == sorted(
        [(1, "a", None), (2, "b", 20), (3, None, 3), (None, "n", 30), (None, None, 4)], key=repr
    )


@pytest.mark.parametrize("small", [False, True])
def test_upsert_of_keys_only_inserts_what_is_absent(spark, small):
    base = spark.createDataFrame([(1, 1), (2, 2)], "a int, b int")
    more = spark.createDataFrame([(2, 2), (3, 3)], "a int, b int")
    assert tuples(upsert(base, more, ["a", "b"], null_keys=False, small=small)) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("small", [False, True])
def test_optional_columns(spark, small):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    more = spark.createDataFrame([(1, None), (2, (None,)), (3, ("c",)), (4, None)], "id int, name struct<v:string>")
    got = upsert(base, more, ["id"], null_keys=False, small=small, optional=["name"])
    assert tuples(got) == [(1, "a"), (2, None), (3, "c"), (4, None)]


def test_small_batch_leaves_the_base_in_place(spark, tmp_path):
    spark.range(1000).select("id", F.col("id").alias("v")).write.parquet(str(tmp_path / "b"))
    base = spark.read.parquet(str(tmp_path / "b"))
    plan = upsert(base, base.limit(5), ["id"], False, small=True)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_batches_match_row_by_row(spark, seed):
    rng = random.Random(seed)
    state, base, batches = {}, [], []
    for k in range(20):
        row = (k, rng.randint(0, 9), None)
        base.append(row)
        state[k] = row
    incoming = [(rng.randint(0, 30), s, rng.choice([None, rng.randint(0, 9)])) for s in range(60)]
    for k, s, v in incoming:
        old = state.get(k)
        state[k] = (k, v, old[2] if old else None)
        batches.append((k, s, v))
    got = upsert(
        spark.createDataFrame(base, "k int, v int, w int"),
        last_wins(spark.createDataFrame(batches, "k int, seq int, v int"), ["k"], ["seq"]).select("k", "v"),
        ["k"],
    )
    assert tuples(got) == sorted(state.values(), key=repr)
