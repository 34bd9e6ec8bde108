import pathlib

import pytest
from helpers import land, tuples

from landfall.operators import latest_state, load_registry, progress
from landfall.plans import Endpoint, IngestError, Options, ingest, ingest_fanout, init_tables, logged_task, stage
from landfall.sources import LANDING_SCHEMA, read_discovery, read_run_events
from landfall.streaming import ingest_stream


def events(store, kind):
    return tuples(read_discovery(store.spark, store.discovery_path).filter(f"event = '{kind}'"), "table", "column", "type")


def test_init_creates_once_and_pins(spark, store):
    data = land(spark, ("bootstrap-static", '{"teams":[{"id":1,"name":"a"}],"game_settings":{"z":1}}'))
    assert init_tables(store, data) == ["game_settings", "teams"]
    assert init_tables(store, data) == []
    assert tuples(load_registry(spark, store.registry_path), "table_name", "ordinal", "name", "primary_key") == [
        ("game_settings", 0, "id", True), ("game_settings", 1, "z", False), ("teams", 0, "id", True), ("teams", 1, "name", False),
    ]
    assert events(store, "table_created") == [("game_settings", None, None), ("teams", None, None)]
    assert store.table("teams").count() == 0


def test_missing_table_is_an_error(spark, store):
    with pytest.raises(IngestError, match="'teams' does not exist"):
        ingest(store, land(spark, ("x", '{"teams":[{"id":1}]}')))


def test_no_key_is_an_error(spark, store):
    with pytest.raises(IngestError, match="teams: neither an integer id nor a key"):
        ingest(store, land(spark, ("x", '{"teams":[{"name":"a"}]}')), init=True)


def test_upsert_drift_and_count(spark, store):
    first = '{"teams":[{"id":1,"name":"a","meta":{"k":1}},{"id":2,"name":"b","meta":null}]}'
    assert ingest(store, land(spark, ("x", first)), init=True) == {"teams": 2}
    assert events(store, "new_column") == []
    again = '{"teams":[{"id":2,"name":null,"extra":5},{"id":3,"name":"c","extra":6},{"id":3,"name":"d","extra":7}]}'
    assert ingest(store, land(spark, ("x", again))) == {"teams": 3}
    assert tuples(store.table("teams")) == [(1, "a", '{"k":1}'), (2, None, None), (3, "d", None)]
    assert events(store, "new_column") == [("teams", "extra", "INTEGER")]


def test_extra_column_as_error_or_as_new_column(spark, store):
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"a":1}]}')), init=True)
    more = land(spark, ("x", '{"t":[{"id":1,"a":2,"b":"new"}]}'))
    with pytest.raises(IngestError, match="column 'b' is not pinned"):
        ingest(store, more, Options(extra="fail"))
    assert tuples(store.table("t")) == [(1, 1)]
    ingest(store, more, Options(extra="evolve"))
    assert tuples(store.table("t")) == [(1, 2, "new")]
    assert tuples(load_registry(spark, store.registry_path), "name") == [("a",), ("b",), ("id",)]


def test_column_that_is_absent_keeps_its_value(spark, store):
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"a":1,"b":"x"}]}')), init=True)
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"a":2}]}')))
    assert tuples(store.table("t")) == [(1, 2, "x")]
    mixed = land(spark, ("x", '{"t":[{"id":1,"a":3,"b":null}]}'), ("x", '{"t":[{"id":1,"a":4},{"id":2,"b":"z"}]}'))
    ingest(store, mixed)
    assert tuples(store.table("t")) == [(1, 4, None), (2, None, "z")]


def test_missing_field_as_error(spark, store):
    data = land(spark, ("x", '{"t":[{"id":1,"a":1},{"id":2}]}'))
    with pytest.raises(IngestError, match="lacks 'a'"):
        ingest(store, data, Options(missing="fail"), init=True)


def test_rejects(spark, store):
    data = land(spark, ("x", '{"t":[{"id":1,"n":1},{"id":2,"n":"bad"},{"id":null,"n":3}]}'), ("x", "{oops"))
    with pytest.raises(IngestError, match="malformed body"):
        ingest(store, data, Options(rejects="fail"), init=True)
    assert ingest(store, data) == {"t": 1}
    assert tuples(store.table("t")) == [(1, 1)]
    assert tuples(spark.read.parquet(store.path("_rejects")), "pos", "problem") == [
        (0, "malformed body"), (1, "does not fit: n"), (2, "null in id"),
    ]
    assert tuples(stage(data).rejects, "problem", "rejected_text") == [("malformed body", "{oops")]
    with pytest.raises(IngestError, match="does not fit: n"):
        ingest(store, land(spark, ("x", '{"t":[{"id":9,"n":"bad"}]}')), Options(rejects="fail"))


def test_singleton(spark, store):
    ingest(store, land(spark, ("x", '{"game_settings":{"id":99,"a":"x"}}'), ("x", '{"game_settings":{"id":98,"a":"y"}}')), init=True)
    assert tuples(store.table("game_settings")) == [(1, "y")]
    ingest(store, land(spark, ("x", '{"game_settings":{"a":"z"}}')))
    assert tuples(store.table("game_settings")) == [(1, "z")]


def test_null_keys_of_a_key_map_table_are_all_inserted(spark, store):
    data = land(spark, ("event-status/", '{"status":[{"event":1,"ok":true},{"event":null,"ok":true}]}'))
    ingest(store, data, init=True)
    ingest(store, data)
    assert tuples(store.table("status")) == [(1, True), (None, True), (None, True)]


def test_fanout(spark, store):
    ingest(store, land(spark, ("bootstrap-static", '{"events":[{"id":1},{"id":2},{"id":3}]}')), init=True)
    data = land(
        spark,
        ("dream-team/{id}/", 1, '{"team":[{"element":7,"points":1}],"top_player":{"id":5,"points":1}}'),
        ("dream-team/{id}/", 2, '{"team":[{"element":7,"points":2}],"top_player":{"id":5,"points":2}}'),
        ("dream-team/{id}/", 3, '{"team":[],"top_player":null}'),
        ("dream-team/{id}/", 9, '{"team":[{"element":7,"points":9}]}'),
    )
    assert ingest_fanout(store, data, init=True) == {"dream_team_team": 2, "dream_team_top_player": 2}
    assert tuples(store.table("dream_team_team"), "event_id", "element", "points") == [(1, 7, 1), (2, 7, 2)]
    assert tuples(store.table("dream_team_top_player"), "event_id", "id", "points") == [(1, 5, 1), (2, 5, 2)]
    assert ingest_fanout(store, data, max_ids=1) == {"dream_team_team": 1, "dream_team_top_player": 1}


def test_fanout_keyed_by_id_alone(spark, store):
    data = land(
        spark, ("dream-team/{id}", 1, '{"top_player":{"id":5,"points":1}}'), ("dream-team/{id}", 2, '{"top_player":{"id":5,"points":2}}')
    )
    ingest(store, data, Options(faithful=True), init=True)
    assert tuples(store.table("dream_team_top_player"), "id", "points", "event_id") == [(5, 2, 2)]


def test_list_that_is_empty_for_the_first_parent(spark, store):
    data = land(spark, ("element-summary/{id}", 1, '{"history":[]}'), ("element-summary/{id}", 2, '{"history":[{"element":2,"fixture":4}]}'))
    ingest(store, data, init=True)
    assert tuples(store.table("element_summary_history")) == [(2, 4, 2)]


def test_hyphen_in_the_endpoint(spark, store):
    ingest(store, land(spark, ("x/set-pieces/", '[{"id":1}]')), init=True)
    assert tuples(store.table("set_pieces")) == [(1,)]


def test_partitions_and_buckets(spark, store):
    options = Options(endpoints=(Endpoint("r/{id}", prefix="p", parent_column="parent"),))
    store.partition_by = {"p_t": ["parent"]}
    store.buckets = {"b": 4}
    ingest(store, land(spark, ("r/{id}", 1, '{"t":[{"id":1,"v":1}]}'), ("r/{id}", 2, '{"t":[{"id":1,"v":2}]}'),
                       ("b", '[{"id":1,"v":1},{"id":2,"v":1}]')), options, init=True)
    ingest(store, land(spark, ("r/{id}", 2, '{"t":[{"id":1,"v":3},{"id":2,"v":4}]}'), ("b", '[{"id":2,"v":5}]')), options)
    assert tuples(store.table("p_t"), "parent", "id", "v") == [(1, 1, 1), (2, 1, 3), (2, 2, 4)]
    assert tuples(store.table("b")) == [(1, 1), (2, 5)]


def test_unique_column_that_is_no_key(spark, store):
    from landfall.operators import save_registry
    from landfall.operators.registry import registry_columns
    from test_registry import definitions

    pinned = registry_columns(definitions(spark, ("t", "id", [("id", "INTEGER", ["not_null"]), ("code", "INTEGER", ["unique"])])))
    save_registry(pinned, store.registry_path, 1)
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"code":1},{"id":2,"code":2}]}')), init=True)
    with pytest.raises(IngestError, match="'code' is not unique"):
        ingest(store, land(spark, ("x", '{"t":[{"id":3,"code":2}]}')))
    assert tuples(store.table("t")) == [(1, 1), (2, 2)]


def test_logged_task(spark, store):
    with logged_task(store, "r1", "load"):
        pass
    with pytest.raises(ValueError, match="no"), logged_task(store, "r1", "fail"):
        raise ValueError("no")
    log = tuples(read_run_events(spark, store.run_log_path), "task", "status", "error")
    assert log == [("fail", "failed", "no"), ("fail", "started", None), ("load", "started", None), ("load", "success", None)]


def test_stream_takes_each_file_once(spark, store, tmp_path):
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")

    def add(seq, body):
        spark.createDataFrame([("t", None, seq, body)], LANDING_SCHEMA).coalesce(1).write.mode("append").parquet(path)

    add(1, '[{"id":1,"v":"a"},{"id":2,"v":"b"}]')
    ingest_stream(store, path, checkpoint).awaitTermination()
    add(2, '[{"id":2,"v":"c"}]')
    add(3, '[{"id":2,"v":"d"},{"id":3,"v":"e"}]')
    ingest_stream(store, path, checkpoint).awaitTermination()
    ingest_stream(store, path, checkpoint).awaitTermination()
    assert tuples(store.table("t")) == [(1, "a"), (2, "d"), (3, "e")]


def test_hot_parent(spark, store):
    """A third of all records in one body of one parent."""
    body = "[" + ",".join(f'{{"id":{i}}}' for i in range(300)) + "]"
    data = [("r/{id}", 1, f'{{"t":{body}}}')] + [("r/{id}", p, '{"t":[{"id":1},{"id":2}]}') for p in range(2, 302)]
    options = Options(endpoints=(Endpoint("r/{id}", parent_column="parent"),))
    assert ingest(store, land(spark, *data), options, init=True) == {"t": 900}
    assert store.table("t").count() == 900


def test_field_of_a_later_response_is_stored(spark, store):
    data = land(spark, ("x", '{"t":[{"id":1,"a":1}]}'), ("x", '{"t":[{"id":2,"a":2,"b":3}]}'))
    ingest(store, data, init=True)
    assert tuples(store.table("t"), "id", "a", "b") == [(1, 1, None), (2, 2, 3)]


def test_rejects_of_many_tables_and_bodies_are_kept(spark, store):
    good = "{" + ",".join(f'"t{i}":[{{"id":1,"n":1}}]' for i in range(6)) + "}"
    ingest(store, land(spark, ("x", good)), init=True)
    bad = "{" + ",".join(f'"t{i}":[{{"id":2,"n":"bad"}}]' for i in range(6)) + "}"
    ingest(store, land(spark, ("x", bad), ("x", "{oops")))
    kept = spark.read.parquet(store.path("_rejects"))
    assert sorted(r.problem for r in kept.collect() if r.problem == "malformed body") == ["malformed body"]
    assert {r.table_name for r in kept.collect() if r.problem != "malformed body"} == {f"t{i}" for i in range(6)}


def test_rows_stored_before_the_first_ingest_stay(spark, store):
    data = land(spark, ("x", '{"t":[{"id":1,"a":1}]}'))
    init_tables(store, data)
    spark.sql(f"INSERT INTO {store.qualify('t')} SELECT 9 AS id, 9 AS a")
    ingest(store, data)
    assert tuples(store.table("t"), "id", "a") == [(1, 1), (9, 9)]


def test_integers_round_once(spark, store):
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"n":1}]}')), init=True)
    ingest(store, land(spark, ("x", '{"t":[{"id":2,"n":1.4999999999},{"id":3,"n":"1.4999999999"},{"id":4,"n":2.5}]}')))
    assert tuples(store.table("t"), "id", "n") == [(1, 1), (2, 1), (3, 1), (4, 2)]


def test_fields_may_be_called_like_our_own_columns(spark, store):
    names = ["pos", "seq", "endpoint", "entity_id", "found", "problem", "problems", "record", "_in", "_spread", "k0", "c1", "o1"]
    record = lambda i, v, own=names: "{" + ",".join([f'"id":{i}', *(f'"{n}":"{v}"' for n in own)]) + "}"
    ingest(store, land(spark, ("x", f'{{"t":[{record(1, "a")},{record(2, "b")}]}}')), init=True)
    again = f'{{"t":[{record(2, "c")},{record(3, "d", names[1:])},{record(1, "e", names[:5])}]}}'
    assert ingest(store, land(spark, ("x", again))) == {"t": 3}
    n = len(names)
    assert tuples(store.table("t"), "id", *names) == [
        (1, *["e"] * 5, *["a"] * (n - 5)), (2, *["c"] * n), (3, None, *["d"] * (n - 1)),
    ]


def test_odd_names_do_not_stop_a_batch(spark, store):
    body = """{"a.b":[{"id":1,"v.w":2}],"t":[{"id":1,"ID":7,"x'\\"y":3,"sp ace":4}]}"""
    counts = ingest(store, land(spark, ("x", body)), init=True)
    odd = next(name for name in counts if name != "t")
    assert odd.startswith("a_b_") and tuples(store.table(odd)) == [(1, 2)]
    assert store.table("t").columns == ["id", "sp ace"] and tuples(store.table("t")) == [(1, 4)]
    assert {e[1] for e in events(store, "unusable_name")} == {"ID", "x'\"y"}
    with pytest.raises(IngestError, match="differ in case only"):
        ingest(store, land(spark, ("x", '{"u":[{"id":1}],"U":[{"id":1}]}')), init=True)


def test_fanout_of_two_endpoints_uses_the_parents_of_each(spark, store):
    ingest(store, land(spark, ("x", '{"events":[{"id":1}],"elements":[{"id":8}]}')), init=True)
    both = land(
        spark, ("event/{id}/live", 1, '{"elements":[{"id":5}]}'), ("event/{id}/live", 8, '{"elements":[{"id":6}]}'),
        ("element-summary/{id}", 8, '{"fixtures":[{"id":7}]}'), ("element-summary/{id}", 1, '{"fixtures":[{"id":9}]}'),
    )
    assert ingest_fanout(store, both, init=True) == {"element_summary_fixtures": 1, "event_live_elements": 1}
    assert tuples(store.table("element_summary_fixtures"), "id", "element_id") == [(7, 8)]
    assert tuples(store.table("event_live_elements"), "id", "event_id") == [(5, 1)]


def test_progress_comes_back_from_the_log(spark, store):
    with logged_task(store, "r", "fan-out") as report:
        report(1, 4, 17)
        report(3, 4, 19)
    log = read_run_events(spark, store.run_log_path)
    assert tuples(progress(log)) == [("r", "fan-out", 3, 4, 75.0, "19")]
    assert tuples(latest_state(log), "task", "status") == [("fan-out", "success")]


def test_an_ingest_leaves_nothing_in_the_shared_folder(spark, store):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    here = lambda: {f.name for f in shared.glob("*") if f.name.startswith(("records-", "batch-"))}
    before = here()
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"v":"a"}]}')), init=True)
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"v":"b"},{"id":2,"v":"c"}]}')))
    assert here() == before
    assert tuples(store.table("t")) == [(1, "b"), (2, "c")]
    own = stage(land(spark, ("x", '{"t":[{"id":3,"v":"d"}]}')))
    ingest(store, own)
    assert own.records.count() == 1


@pytest.mark.parametrize("limit", ["10MB", "100"])
def test_merge_with_and_without_broadcast(spark, store, limit):
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"v":"a","w":1},{"id":2,"v":"b","w":2}]}')), init=True)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        ingest(store, land(spark, ("x", '{"t":[{"id":3,"v":null,"w":4},{"id":2,"v":"' + "x" * 200 + '"}]}')))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert tuples(store.table("t")) == [(1, "a", 1), (2, "x" * 200, 2), (3, None, 4)]


def test_an_ingest_does_not_infer_per_response(spark, store):
    with pytest.raises(ValueError, match="per_response"):
        ingest(store, land(spark, ("x", '{"t":[{"id":1}]}')), Options(infer={"per_response": True}), init=True)
