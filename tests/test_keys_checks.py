from helpers import tuples
from pyspark.sql import functions as F
from test_registry import mapped

from landfall.operators import (
    apply_key_map,
    as_singleton,
    check_foreign_key,
    check_not_null,
    check_primary_key,
    check_unique,
    detect_keys,
    key_map,
)
from landfall.operators.keys import add_parents

KEYS = {"cfg": "singleton", "stats": ["name"], "history": ["element", "fixture"]}


def keys_of(spark, columns, **options):
    found = detect_keys(columns, key_map(spark, KEYS), **options)
    return {r["table_name"]: (r["key_columns"], r["is_primary"], r["problem"]) for r in found.collect()}


def test_key_detection(spark):
    columns = mapped(
        spark, ("t", 0, "id", "int"), ("history", 0, "element", "int"), ("history", 1, "fixture", "int"),
        ("none", 0, "x", "str"),
    )
    assert keys_of(spark, columns) == {
        "t": (["id"], True, None),
        "history": (["element", "fixture"], False, None),
        "none": (None, False, "none: neither an integer id nor a key in the key map"),
    }


def test_parent_joins_a_key_of_id_alone(spark):
    columns = add_parents(
        mapped(spark, ("t", 0, "id", "int"), ("history", 0, "element", "int"), ("u", 0, "id", "int")),
        {"t": "parent", "history": "parent"},
    )
    assert tuples(columns, "table_name", "ordinal", "name", "data_type", "nullable") == [
        ("history", 0, "element", "INTEGER", True), ("history", 1, "parent", "INTEGER", False),
        ("t", 0, "id", "INTEGER", False), ("t", 1, "parent", "INTEGER", False), ("u", 0, "id", "INTEGER", False),
    ]
    assert keys_of(spark, columns, parents={"t": "parent", "history": "parent"})["t"][0] == ["parent", "id"]
    assert keys_of(spark, columns)["t"][0] == ["id"]


def test_singleton_gets_an_id(spark):
    columns = apply_key_map(mapped(spark, ("cfg", 0, "b", "str"), ("cfg", 1, "a", "str")), key_map(spark, KEYS))
    assert tuples(columns, "ordinal", "name", "primary_key") == [(0, "id", True), (1, "b", False), (2, "a", False)]


def test_singleton_id_is_not_doubled(spark):
    columns = apply_key_map(mapped(spark, ("cfg", 0, "id", "int"), ("cfg", 1, "a", "str")), key_map(spark, KEYS))
    assert tuples(columns, "ordinal", "name") == [(0, "id"), (1, "a")]


def test_one_unique_column_is_marked(spark):
    columns = apply_key_map(
        mapped(spark, ("stats", 0, "name", "str"), ("stats", 1, "v", "int"), ("history", 0, "element", "int"),
               ("t", 0, "name", "str")),
        key_map(spark, KEYS),
    )
    assert tuples(columns.filter("unique"), "table_name", "name") == [("stats", "name")]


def test_singleton_row(spark):
    rows = spark.createDataFrame(
        [(1, 0, 99, "first"), (2, 0, 98, "last"), (2, 1, 97, "second record")], "seq long, pos int, id int, setting string"
    )
    assert tuples(as_singleton(rows), "id", "setting") == [(1, "last")]


def test_singletons_by_group(spark):
    rows = spark.createDataFrame([("a", 1, 0, 5), ("a", 2, 0, 6), ("b", 1, 0, 7)], "t string, seq long, pos int, v int")
    assert tuples(as_singleton(rows, ["t"]), "t", "id", "v") == [("a", 1, 6), ("b", 1, 7)]


def test_unique(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert tuples(check_unique(rows, ["a", "b"])) == [(1, 1, 2)]
    assert tuples(check_primary_key(rows, ["a", "b"])) == [(1, 1, 2, "duplicate key"), (None, 1, 2, "null key")]


def test_not_null(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (None, 3)], "a int, b int")
    assert tuples(check_not_null(rows, ["a", "b"])) == [("a", 1), ("b", 2)]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "ref int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert tuples(check_foreign_key(child, "ref", parent, "id")) == [(2, 2)]
    assert tuples(check_foreign_key(child, "ref", parent, "id", rows=True)) == [(2,), (2,)]


def test_hot_reference_is_counted_before_the_shuffle(spark):
    child = spark.range(100).select((F.col("id") % 2).alias("ref"))
    plan = check_foreign_key(child, "ref", spark.range(1), "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
