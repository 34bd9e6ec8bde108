from helpers import land, tuples
from pyspark.sql import functions as F

from landfall.functions import response_key_col, table_name_col
from landfall.sources import (
    inject_columns,
    normalize_response,
    read_landing,
    rejected,
    route_records,
    with_endpoints,
)


def routed(df):
    return tuples(route_records(df).select("table_name", "pos", F.to_json("record").alias("r")))


def test_bare_array_is_wrapped_and_objects_pass(spark):
    df = normalize_response(land(spark, ("fixtures/", '[{"id":1}, {"id":2}]'), ("x/y", ' {"a":[]} ')))
    assert tuples(df, "seq", "body") == [(0, '{"fixtures":[{"id":1}, {"id":2}]}'), (1, '{"a":[]}')]


def test_lists_and_objects_become_records(spark):
    df = land(spark, ("e", '{"events":[{"id":1},{"id":2}],"settings":{"a":null,"b":{"c":1}},"total":3}'))
    assert routed(df) == [
        ("events", 0, '{"id":1}'), ("events", 1, '{"id":2}'), ("settings", 0, '{"a":null,"b":{"c":1}}'),
    ]


def test_scalars_empty_lists_and_scalar_lists_are_no_tables(spark):
    df = land(spark, ("e", '{"page":0.5,"gone":[],"flags":[true,false],"note":"[{}]","off":false,"late":["a",{"b":2}],"deep":[[{"c":3}]]}'))
    assert routed(df) == []
    assert rejected(df).count() == 0


def test_empty_scalar_and_malformed_bodies_are_rejected(spark):
    bodies = ["{}", "null", "0", '""', "5", '"text"', "{oops", '{"a":{"b":1}} x', '{"a":{"b":1}} {"c":1}', None]
    found = rejected(land(spark, *[("e", b) for b in bodies]))
    assert [p for _, p in tuples(found, "seq", "problem")] == (
        ["empty response"] * 4 + ["not an object"] * 2 + ["malformed body"] * 4
    )


def test_later_element_that_is_no_object_is_rejected(spark):
    df = land(spark, ("e", '{"a":[{"b":1},5,{"b":2},[1]]}'))
    assert routed(df) == [("a", 0, '{"b":1}'), ("a", 2, '{"b":2}')]
    assert tuples(rejected(df), "table_name", "pos", "rejected_text") == [("a", 1, "5"), ("a", 3, "[1]")]


def test_repeated_object_key_keeps_the_last(spark):
    assert routed(land(spark, ("e", '{"a":{"k":1,"k":2}}'))) == [("a", 0, '{"k":2}')]


def test_head_keys_keep_text_order(spark):
    df = land(spark, ("e", '{"a":[{"z":1,"b":2,"y":3},{"b":1}]}'))
    assert [r[0] for r in route_records(df).orderBy("pos").select("keys").collect()] == [["z", "b", "y"], None]


def test_table_prefix_and_its_reversal(spark):
    df = spark.createDataFrame([("p", "a-b"), ("", "a"), (None, "c")], "prefix string, key string")
    name = table_name_col(F.col("prefix"), F.col("key"))
    got = df.select(name.alias("t"), response_key_col(name, F.col("prefix")).alias("k"))
    assert tuples(got) == [("a", "a"), ("c", "c"), ("p_a_b", "a_b")]


def test_endpoint_prefixes(spark):
    df = with_endpoints(land(spark, ("a/{id}/live/", 1, '{"x":{"i":1}}'), ("b", '{"x":{"i":1}}')), {"a/{id}/live": "live"})
    assert [t for t, *_ in routed(df)] == ["live_x", "x"]


def test_injected_column_replaces_a_field(spark):
    rows = spark.createDataFrame([(1, "payload", 5)], "id int, event string, entity_id bigint")
    got = inject_columns(rows, {"event": F.col("entity_id")})
    assert tuples(got, "id", "event") == [(1, 5)]


def test_landing_files(spark, tmp_path):
    for path, body in {"event/7/live/12.json": '{"a":1}', "fixtures/3.json": "[]"}.items():
        target = tmp_path / path
        target.parent.mkdir(parents=True)
        target.write_text(body)
    got = read_landing(spark, str(tmp_path), "files")
    assert tuples(got) == [("event/{id}/live", 7, 12, '{"a":1}'), ("fixtures", None, 3, "[]")]


def test_landing_round_trip(spark, tmp_path):
    df = land(spark, ("e", 4, '{"a":"ü\\n"}'))
    for fmt in ("parquet", "json"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert tuples(read_landing(spark, str(tmp_path / fmt), fmt)) == [("e", 4, 0, '{"a":"ü\\n"}')]
