import pytest
from helpers import land, tuples
from pyspark.sql import functions as F

from landfall.functions import value_type
from landfall.operators import infer_record_schema, infer_schema, map_types
from landfall.sources import route_records


def types(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("v"))
    return df.select(value_type(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("true", "bool"), ("1", "int"), ("-7", "int"), ("1.5", "float"), ("8.0", "float"), ("1e5", "float"),
        ("123456789012345678901", "int"), ("null", "null"), ('"x"', "str"), ('"12"', "str"),
        ('"2024-01-02T03:04:05Z"', "datetime"), ('"2024-01-02 03:04"', "datetime"), ('"2024-01-02"', "str"),
        ('"x 2024-01-02T03:04"', "str"), ('{"a":1}', "jsonb"), ("[1]", "jsonb"), ("[]", "jsonb"), ("{}", "jsonb"),
    ],
)
def test_value_type(spark, text, expected):
    assert types(spark, text) == expected


def columns(df, **options):
    found = infer_schema(df, **options).orderBy("table_name", "ordinal")
    return [tuple(r) for r in found.select("name", "type", "nullable").collect()]


def test_names_order_types_and_flags(spark):
    df = land(spark, ("orders", '{"lines":[{"weight":0.25,"paid":false,"sku":"k-9","qty":12,"due":"2023-07-01T00:00"}]}'))
    assert columns(df) == [
        ("weight", "float", False), ("paid", "bool", False), ("sku", "str", False), ("qty", "int", False),
        ("due", "datetime", False),
    ]


def test_null_looks_ahead(spark):
    df = land(spark, ("e", '{"t":[{"id":1,"form":null},{"id":2,"form":"7.5"}]}'))
    assert columns(df) == [("id", "int", False), ("form", "str", True)]
    df = land(spark, ("e", '{"t":[{"v":null},{"v":null},{"v":3},{"v":1.5}]}'))
    assert columns(df) == [("v", "int", True)]


def test_all_null_is_text(spark):
    df = land(spark, ("e", '{"t":[{"detail":null},{"detail":null}]}'))
    assert columns(df) == [("detail", "str", True)]


def test_missing_is_nullable_and_later_names_are_dropped(spark):
    df = land(spark, ("e", '{"t":[{"b":1,"a":2},{"b":1,"c":3}]}'))
    assert columns(df) == [("b", "int", False), ("a", "int", True)]
    assert columns(df, union_keys=True) == [("b", "int", False), ("a", "int", True), ("c", "int", True)]


def test_first_type_holds_unless_widened(spark):
    df = land(spark, ("e", '{"t":[{"v":1},{"v":1.5}]}'))
    assert columns(df) == [("v", "int", False)]
    assert columns(df, widen=True) == [("v", "float", False)]


def test_look_ahead_of_one_response_is_six_records(spark):
    far = ",".join(['{"v":null}'] * 6 + ['{"v":1}'])
    near = ",".join(['{"v":null}'] * 5 + ['{"v":1}'])
    assert columns(land(spark, ("e", f'{{"t":[{far}]}}')), per_response=True) == [("v", "str", True)]
    assert columns(land(spark, ("e", f'{{"t":[{near}]}}')), per_response=True) == [("v", "int", True)]
    assert columns(land(spark, ("e", f'{{"t":[{far}]}}'))) == [("v", "int", True)]


def test_first_response_with_records_names_the_columns(spark):
    df = land(spark, ("e", 1, '{"t":[]}'), ("e", 2, '{"t":[{"z":1,"a":2}]}'), ("e", 3, '{"t":[{"a":1,"z":2,"n":3}]}'))
    assert columns(df) == [("z", "int", False), ("a", "int", False)]


def test_counts(spark):
    df = land(spark, ("e", '{"t":[{"a":1,"b":null},{"a":2}],"o":{"x":1}}'))
    got = infer_record_schema(route_records(df))
    assert tuples(got, "table_name", "name", "n_records", "n_present") == [
        ("o", "x", 1, 1), ("t", "a", 2, 2), ("t", "b", 2, 1),
    ]


def test_envelope_gives_one_table_per_list_and_object(spark):
    first = '{"page":4,"orders":[{"no":1,"lines":[{"sku":"a"}]}],"shop":{"city":null,"open":true},"codes":[7],"gone":[]}'
    second = '{"page":5,"orders":[],"gone":[{"no":2}],"shop":{"city":"Rome","open":null}}'
    got = infer_schema(land(spark, ("e", first), ("e", second)))
    assert tuples(got, "table_name", "name", "type", "nullable") == [
        ("gone", "no", "int", False), ("orders", "lines", "jsonb", False), ("orders", "no", "int", False),
        ("shop", "city", "str", True), ("shop", "open", "bool", True),
    ]


def test_map_types(spark):
    rows = [
        ("t", 0, "id", "int"), ("t", 1, "name", "str"), ("t", 2, "score", "float"), ("t", 3, "active", "bool"),
        ("t", 4, "meta", "jsonb"), ("t", 5, "at", "datetime"), ("t", 6, "odd", "mystery"), ("u", 0, "id", "str"),
        ("u", 1, "code", "int"),
    ]
    df = spark.createDataFrame(rows, "table_name string, ordinal int, name string, type string")
    got = {(r["table_name"], r["name"]): r for r in map_types(df).collect()}
    assert [got["t", n]["data_type"] for n in ("id", "name", "score", "active", "meta", "at", "odd")] == [
        "INTEGER", "TEXT", "DOUBLE", "BOOLEAN", "JSON", "TIMESTAMP", "TEXT",
    ]
    assert [k for k, r in got.items() if r["primary_key"]] == [("t", "id")]
    assert [k for k, r in got.items() if not r["nullable"]] == [("t", "id")]
    assert map_types(df, long_ints=True).filter("name = 'code'").first()["data_type"] == "BIGINT"


def test_map_types_carries_foreign_keys(spark):
    df = spark.createDataFrame(
        [("t", 0, "team_id", "int", "teams", "id")],
        "table_name string, ordinal int, name string, type string, references_table string, references_column string",
    )
    assert tuples(map_types(df), "references_table", "references_column") == [("teams", "id")]
