"""Layouts, commits, replays, snapshots and references of a store."""

import datetime as dt
import json
import threading

import pytest
from helpers import land, tuples
from pyspark.sql import functions as F

from landfall.operators import (
    CommitConflict,
    RegistryConflict,
    TableColumn,
    TableSchema,
    check_unique,
    check_unique_merge,
    compact_registry,
    create_table,
    drop_old_versions,
    infer_record_schema,
    infer_responses,
    load_registry,
    map_types,
    open_state,
    orphans,
    read_snapshot,
    read_version,
    restore_store,
    run_summary,
    save_registry,
    snapshot_store,
    task_state,
    upsert,
)
from landfall.operators.commits import names_in, write_commit
from landfall.operators.registry import current_version
from landfall.operators.tables import KEY_PART, TableState, in_partitions, replace_table
from landfall.plans import ingest
from landfall.plans.endpoints import Endpoint
from landfall.plans.flow import IngestError, Options
from landfall.session import remove_dir
from landfall.sources import RUN_SCHEMA, append_run_events, read_run_events, route_all, route_large
from landfall.streaming import ingest_stream, run_log_stream


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def forget(checkpoint, batch):
    """As if the driver had died after the batch's last commit and before the stream noted it."""
    for name in (f"{batch}", f".{batch}.crc"):
        (checkpoint / "commits" / name).unlink()


def many(n, value="a"):
    return json.dumps({"t": [{"id": i, "v": f"{value}{i}"} for i in range(n)]})


def test_one_row_touches_one_key_part(spark, store):
    store.parts = {"t": 64}
    ingest(store, land(spark, ("x", many(500))), init=True)
    first = open_state(store, "t")
    assert len(first.folders) == 64 and store.table("t").columns == ["id", "v"]
    ingest(store, land(spark, ("x", '{"t":[{"id":7,"v":"new"}]}')))
    second = open_state(store, "t")
    changed = {p for p in second.folders if second.folders[p] != first.folders[p]}
    assert len(changed) == 1 and set(first.folders) == set(second.folders)
    assert names_in(spark, store.path("t", "v2"))[-1:] == list(changed)
    assert tuples(store.table("t")) == sorted(((i, "new" if i == 7 else f"a{i}") for i in range(500)), key=repr)
    part = int(changed.pop().split("=")[1])
    assert f"PartitionFilters: [isnotnull({KEY_PART}" in plan_of(store.stored("t").filter(in_partitions([KEY_PART], [(part,)])))


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_merges_into_key_parts(spark, store, limit):
    """By broadcast and by shuffle; null keys are all inserted, and spread."""
    store.parts = {"t": 8}
    options = Options(keys={"t": ["a"]})
    ingest(store, land(spark, ("x", '{"t":[{"a":1,"b":1},{"a":null,"b":2},{"a":null,"b":3},{"a":4,"b":4}]}')), options, init=True)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        ingest(store, land(spark, ("x", '{"t":[{"a":1,"b":10},{"a":null,"b":2},{"a":5,"b":5}]}')), options)
        ingest(store, land(spark, ("x", '{"t":[{"a":6,"b":6},{"a":4}]}')), options)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert tuples(store.table("t")) == [(1, 10), (4, 4), (5, 5), (6, 6), (None, 2), (None, 2), (None, 3)]


def test_partitions_of_the_batch_are_literals(spark, store):
    store.partition_by = {"p": ["a", "b"]}
    schema = TableSchema("p", (TableColumn("a", "INTEGER"), TableColumn("b", "TEXT"), TableColumn("v", "INTEGER")))
    create_table(store, schema, execute=True, keys=["a", "b"])
    rows = spark.createDataFrame([(1, "x y", 1), (1, None, 2), (None, "z=/'", 3), (2, "q", 4)], "a int, b string, v int")
    replace_table(store, "p", rows.select("v", "a", "b"))
    assert tuples(store.table("p").select("a", "b", "v")) == tuples(rows)
    one = store.table("p").filter(in_partitions(["a", "b"], [(None, "z=/'"), (1, None)]))
    assert tuples(one.select("v")) == [(2,), (3,)]
    plan = plan_of(one)
    assert "PartitionFilters: []" not in plan and "numPartitions" not in plan.split("PartitionFilters")[0][-20:]
    assert tuples(read_version(store, "p").select("a", "b", "v")) == tuples(rows)
    assert store.table("p").filter(in_partitions(["a", "b"], [(i, "x y") for i in range(600)])).count() == 1


def test_parent_partitions_and_the_null_one_are_rewritten_alone(spark, store):
    options = Options(endpoints=(Endpoint("r/{id}", prefix="p", parent_column="parent"),))
    store.partition_by = {"p_t": ["parent"]}
    ingest(store, land(spark, *[("r/{id}", i, '{"t":[{"id":1,"v":%d}]}' % i) for i in range(1, 6)]), options, init=True)
    before = open_state(store, "p_t")
    ingest(store, land(spark, ("r/{id}", 3, '{"t":[{"id":1,"v":30},{"id":2,"v":31}]}')), options)
    after = open_state(store, "p_t")
    assert {p for p in after.folders if after.folders[p] != before.folders[p]} == {"parent=3"}
    assert tuples(store.table("p_t"), "parent", "id", "v") == [(1, 1, 1), (2, 1, 2), (3, 1, 30), (3, 2, 31), (4, 1, 4), (5, 1, 5)]
    # What was replaced stays readable until it is dropped.
    assert tuples(read_version(store, "p_t", before), "parent", "v") == [(i, i) for i in range(1, 6)]
    assert [p.split("/")[-2:] for p in drop_old_versions(store, "p_t", keep=1)] == [["v1", "parent=3"]]
    assert store.table("p_t").count() == 6 and drop_old_versions(store, "p_t", keep=1) == []


def test_of_two_writers_from_one_version_one_commits(spark, store):
    create_table(store, TableSchema("s", (TableColumn("id", "INTEGER", False, True), TableColumn("v", "TEXT"))), execute=True)
    base = open_state(store, "s")
    replace_table(store, "s", spark.sql("select 1 as id, 'first' as v"), base=base)
    with pytest.raises(CommitConflict):
        replace_table(store, "s", spark.sql("select 1 as id, 'second' as v"), base=base)
    assert tuples(store.table("s")) == [(1, "first")]
    replace_table(store, "s", spark.sql("select 1 as id, 'third' as v"))
    assert tuples(store.table("s")) == [(1, "third")]


@pytest.mark.parametrize("parts", [{}, {"t": 4}])
def test_the_next_writer_finishes_a_switch_that_was_cut_off(spark, store, parts):
    store.parts = parts
    ingest(store, land(spark, ("x", many(20))), init=True)
    state = open_state(store, "t")
    rows = store.table("t").withColumn("v", F.lit("later"))
    path = store.path("t", "v9")
    if parts:
        rows = store.stored("t").withColumn("v", F.lit("later"))
        rows.write.partitionBy(KEY_PART).parquet(path)
    else:
        rows.write.parquet(path)
    folders = {p: f"v9/{p}".rstrip("/") for p in state.folders}
    write_commit(spark, store.path("t"), 1, TableState(state.version + 1, folders, state.batches))
    assert store.table("t").filter("v = 'later'").count() == 0  # the writer died here
    open_state(store, "t")
    assert store.table("t").filter("v = 'later'").count() == 20
    # A commit that was cut off while it was written counts for nothing.
    with open(store.path("t", "_commits", "000000000002.json"), "w") as half:
        half.write('{"version": 3, "fold')
    ingest(store, land(spark, ("x", '{"t":[{"id":99,"v":"on"}]}')))
    assert store.table("t").count() == 21


def test_a_replayed_batch_is_stored_once(spark, store, tmp_path):
    options = Options(keys={"t": ["a"]})
    body = '{"t":[{"a":1,"b":1},{"a":null,"b":2}],"u":[{"id":1,"c":"x"}],"w":[{"id":1,"n":1},{"id":2,"n":"bad"}]}'
    land(spark, ("x", body)).write.parquet(str(tmp_path / "in"))
    run = lambda: ingest_stream(store, str(tmp_path / "in"), str(tmp_path / "state"), options).awaitTermination()
    run()
    versions = {t: open_state(store, t).version for t in "tuw"}
    forget(tmp_path / "state", 0)
    run()
    assert {t: open_state(store, t).version for t in "tuw"} == versions
    assert tuples(store.table("t")) == [(1, 1), (None, 2)]
    rejects = spark.read.parquet(store.path("_rejects"))
    assert tuples(rejects, "problem", "rejected_text") == [("does not fit: n", '{"id":2,"n":"bad"}')]
    # A table that failed to commit takes the batch up when it comes again.
    spark.sql(f"DROP TABLE {store.qualify('u')}")
    remove_dir(spark, store.path("u"))
    forget(tmp_path / "state", 0)
    run()
    assert tuples(store.table("u")) == [(1, "x")] and store.table("t").count() == 2
    land(spark, ("x", '{"t":[{"a":1,"b":5},{"a":null,"b":2}]}')).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert tuples(store.table("t")) == [(1, 5), (None, 2), (None, 2)]


@pytest.mark.parametrize("parts", [{}, {"t": 4}])
def test_snapshot_and_restore(spark, store, parts):
    store.parts = parts
    data = land(spark, ("x", many(30)), ("y", '{"u":[{"id":1}]}'))
    ingest(store, data, init=True)
    label = snapshot_store(store, ["t", "u", "absent"], "before")
    with pytest.raises(ValueError, match="before"):
        snapshot_store(store, ["t"], "before")
    files = {p: names_in(spark, store.path("t", p)) for p in names_in(spark, store.path("t")) if p[0] == "v"}
    held = read_snapshot(store, label, "t")
    ingest(store, land(spark, ("x", '{"t":[{"id":3,"v":"new","more":1},{"id":77,"v":"x","more":2}]}')), Options(extra="evolve"))
    ingest(store, land(spark, ("x", '{"t":[{"id":4,"v":"newer"}]}')))
    drop_old_versions(store, "t", keep=1)
    assert {p: names_in(spark, store.path("t", p)) for p in files} == files  # nothing was copied, nothing dropped
    assert tuples(held.select("id", "v")) == sorted(((i, f"a{i}") for i in range(30)), key=repr)
    assert restore_store(store, label) == ["t", "u"]
    assert tuples(store.table("t").select("id", "v", "more")) == sorted(((i, f"a{i}", None) for i in range(30)), key=repr)
    assert "more" not in [r.name for r in load_registry(spark, store.registry_path).collect()]
    ingest(store, land(spark, ("x", '{"t":[{"id":4,"v":"again"}]}')))
    assert store.table("t").filter("v = 'again'").count() == 1 and store.table("t").count() == 30


def columns(spark, *rows):
    return map_types(spark.createDataFrame([("e", *r) for r in rows], "endpoint string, table_name string, ordinal int, name string, type string"))


def test_of_two_savers_of_one_version_one_wins(spark, tmp_path):
    path = str(tmp_path / "r")
    save_registry(columns(spark, ("t", 0, "id", "int")), path)
    errors, wins = [], []

    def save(name):
        try:
            wins.append(save_registry(columns(spark, ("t", 0, "id", "int"), ("t", 1, name, "str")), path, 2))
        except RegistryConflict as e:
            errors.append(e)

    threads = [threading.Thread(target=save, args=(n,)) for n in ("a", "b", "c")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert wins == [2] and len(errors) == 2
    assert len(tuples(load_registry(spark, path), "name")) == 2
    assert save_registry(columns(spark, ("u", 0, "id", "int")), path) == 3


def test_compaction_keeps_the_last_definitions(spark, tmp_path):
    path = str(tmp_path / "r")
    assert compact_registry(spark, path) == 0
    for n in range(4):
        save_registry(columns(spark, ("t", 0, f"c{n}", "int"), *([("u", 0, "id", "int")] if n == 1 else [])), path)
    before = tuples(load_registry(spark, path))
    assert compact_registry(spark, path) == 4
    assert tuples(load_registry(spark, path)) == before and spark.read.parquet(path).count() == 2
    assert current_version(spark, path) == 4 and save_registry(columns(spark, ("t", 0, "z", "int")), path) == 5


def test_writers_of_different_tables_both_pin(spark, store):
    from landfall.plans import flow

    staged = flow.stage(land(spark, ("x", '{"t":[{"id":1}]}')))
    batch = flow._plan(store, staged, Options())
    ingest(store, land(spark, ("y", '{"u":[{"id":1}]}')), init=True)
    assert flow._create(store, batch) == ["t"]
    assert sorted({r.table_name for r in load_registry(spark, store.registry_path).collect()}) == ["t", "u"]
    other = flow._plan(store, flow.stage(land(spark, ("x", '{"n":[{"id":1}]}'))), Options())
    ingest(store, land(spark, ("y", '{"n":[{"id":1,"a":2}]}')), init=True)
    with pytest.raises(RegistryConflict):
        flow._pin(store, other, other.columns)


def test_unique_columns_are_compared_with_the_batch_alone(spark):
    pairs = [(i, i % 7 if i % 4 else None) for i in range(40)]
    stored = spark.createDataFrame(list({v: (k, v) for k, v in pairs if v is not None}.values()) + [(100, None), (None, 50)], "k int, u int")
    for batch in ([(1, 3)], [(100, 50)], [(35, 6), (200, 6)], [(39, None), (300, 4)], [(None, 50)], [(38, 90), (37, 90)], [(400, 91)]):
        incoming = spark.createDataFrame(batch, "k int, u int")
        merged = check_unique(upsert(stored, incoming, ["k"]), ["u"])
        found = check_unique_merge(stored, incoming, ["k"], "u")
        assert {r.value for r in found.collect()} == {r.u for r in merged.collect()}, batch
        small = check_unique_merge(stored, incoming, ["k"], "u", small=True)
        assert {r.value for r in small.collect()} == {r.u for r in merged.collect()}, batch
    big = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("u"))
    plan = plan_of(check_unique_merge(big, spark.range(5).select(F.col("id").alias("k"), (F.col("id") + 3).alias("u")), ["k"], "u"))
    base_side = plan[plan.index("Range (0, 1000"):]
    assert "Range (0, 1000" in plan and "Aggregate" not in base_side.split("\n")[0]
    for line in plan.split("\n"):
        assert "Aggregate" not in line or "value" in line


def test_unique_column_left_out_or_defaulted(spark, store):
    from landfall.operators.registry import registry_columns
    from test_registry import definitions

    pinned = registry_columns(definitions(spark, ("t", "id", [("id", "INTEGER", ["not_null"]), ("code", "INTEGER", ["unique"]), ("v", "TEXT", None)])))
    save_registry(pinned, store.registry_path, 1)
    store.parts = {"t": 4}
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"code":1,"v":"a"},{"id":2,"code":2,"v":"b"}]}')), init=True)
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"code":2,"v":"a"},{"id":2,"code":1,"v":"b"}]}')))  # they change places
    assert tuples(store.table("t")) == [(1, 2, "a"), (2, 1, "b")]
    ingest(store, land(spark, ("x", '{"t":[{"id":3,"code":3,"v":null},{"id":1,"v":"c"}]}')))
    with pytest.raises(IngestError, match="'code' is not unique"):
        ingest(store, land(spark, ("x", '{"t":[{"id":4,"code":2,"v":"e"},{"id":1,"v":"d"}]}')))
    assert tuples(store.table("t")) == [(1, 2, "c"), (2, 1, "b"), (3, 3, None)]


REFS = {"orders": {"customer": ("customers", "id")}, "lines": {"order": ("orders", "id")}}


def test_references_are_checked_in_the_ingest(spark, store):
    body = '{"lines":[{"id":1,"order":10},{"id":2,"order":11}],"orders":[{"id":10,"customer":1},{"id":11,"customer":5},{"id":12,"customer":null}],"customers":[{"id":1}]}'
    counts = ingest(store, land(spark, ("x", body)), Options(references=REFS), init=True)
    assert counts == {"customers": 1, "lines": 1, "orders": 2}
    assert tuples(store.table("orders")) == [(10, 1), (12, None)] and tuples(store.table("lines")) == [(1, 10)]
    assert tuples(spark.read.parquet(store.path("_rejects")), "table_name", "problem", "rejected_text") == [
        ("lines", "order has no orders.id: 11", '{"id":2,"order":11}'), ("orders", "customer has no customers.id: 5", '{"id":11,"customer":5}'),
    ]
    with pytest.raises(IngestError, match="customer = 9 has no customers.id"):
        ingest(store, land(spark, ("x", '{"orders":[{"id":13,"customer":9}]}')), Options(references=REFS, orphans="fail"))
    ingest(store, land(spark, ("x", '{"orders":[{"id":14,"customer":1},{"id":10},{"id":15,"customer":8}]}')), Options(references=REFS))
    assert tuples(store.table("orders")) == [(10, 1), (12, None), (14, 1)]
    ingest(store, land(spark, ("x", '{"orders":[{"id":16,"customer":9}]}')), Options(references=REFS, orphans="keep"))
    assert store.table("orders").count() == 4


def test_the_parent_is_cut_to_the_references_of_the_batch(spark):
    parent = spark.range(10_000).withColumnRenamed("id", "p")
    batch = spark.createDataFrame([(1, 5), (2, 20_000), (3, None), (4, 20_000)], "id int, ref bigint")
    lost = orphans(batch, "ref", parent, "p", small=True)
    assert tuples(lost) == [(20_000,)] == tuples(orphans(batch, "ref", parent, "p"))
    plan = plan_of(lost)
    assert "LeftSemi, BuildRight" in plan[: plan.index("Range (0, 10000")]


# Bodies, names, values


def test_a_large_body_gives_the_records_of_its_halves(spark, store, monkeypatch):
    records = [{"id": i, "v": "x" * 50, "n": None if i % 3 else 1.5} for i in range(300)]
    whole = json.dumps({"t": records, "u": {"id": 1}, "page": 1, "none": [], "plain": [1, 2]})
    halves = [json.dumps({"t": records[:150], "u": {"id": 1}}), json.dumps({"t": records[150:]})]
    options = Options(largest_body=9000)
    assert len(whole) > 9000 > 0
    ingest(store, land(spark, ("x", whole)), options, init=True)
    split = tuples(store.table("t"))
    store.database += "_h"
    store.root += "_h"
    ingest(store, land(spark, *[("x", h) for h in halves]), init=True)
    assert split == tuples(store.table("t")) and len(split) == 300
    assert store.table("t").columns == ["id", "v", "n"]


def test_a_body_beyond_a_variant(spark):
    """140 MB of records, parsed in many tasks."""
    body = spark.range(1).select(
        F.lit("big").alias("endpoint"), F.lit(None).cast("bigint").alias("entity_id"), F.col("id").alias("seq"),
        F.concat(F.lit('{"t":['), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(140)), lambda i: F.concat(
            F.lit('{"id":'), i.cast("string"), F.lit(',"v":"'), F.repeat(F.lit("x"), 1 << 20), F.lit('"}'))), ","), F.lit("]}")).alias("body"),
    )
    assert [r.problem for r in route_all(body).select("problem").collect()] == ["body too large"]
    rows = route_large(body).select("problem", F.try_variant_get("record", "$.id", "int").alias("id"), F.spark_partition_id().alias("task"))
    found = rows.collect()
    assert sorted(r.id for r in found) == list(range(1, 141)) and len({r.task for r in found}) > 1 and not any(r.problem for r in found)


def test_large_bodies_are_judged_like_others(spark):
    bodies = ['{"a":{"k":1},"a":{"k":2}}', '{"a":[{"b":1},5,{"b":2},[1]],"c":7,"d":["x"]}', "{oops", '{"a":{"b":1}} x', '[{"id":1},{"id":2}]', '{"p-q":[{"i":1}],"p_q":[{"i":2}]}']
    data = land(spark, *[("e/z", b) for b in bodies])
    same = lambda df: tuples(df.select("seq", "table_name", "pos", "problem", "rejected_text", F.to_json("record").alias("r"), "keys"))
    assert same(route_large(data)) == same(route_all(data))


def test_alike_names_keep_apart(spark, store):
    counts = ingest(store, land(spark, ("x", '{"a-b":[{"id":1,"p":1}],"a_b":[{"id":1,"q":2}]}')), init=True)
    assert len(counts) == 2 and counts["a_b"] == 1
    assert tuples(store.table("a_b")) == [(1, 2)]
    other = next(t for t in counts if t != "a_b")
    assert other.startswith("a_b_") and tuples(store.table(other)) == [(1, 1)]


def test_a_table_that_cannot_be_stored_stops_no_other(spark, store):
    counts = ingest(store, land(spark, ("x", '{"ok":[{"id":1}],"T":[{"id":1}],"t":[{"id":2}],"nokey":[{"a":5}]}')), init=True)
    assert counts == {"ok": 1}
    rejects = tuples(spark.read.parquet(store.path("_rejects")), "table_name", "rejected_text")
    assert rejects == [("T", '{"id":1}'), ("nokey", '{"a":5}'), ("t", '{"id":2}')]
    with pytest.raises(IngestError, match="nokey|differ in case"):
        ingest(store, land(spark, ("x", '{"ok":[{"id":1}],"nokey":[{"a":5}]}')), Options(rejects="fail"), init=True)


def test_extra_columns_of_any_type(spark, store):
    extra = {"x": {"a": "s", "n": 3, "f": 1.5, "b": False, "j": [1], "d": dt.datetime(2024, 1, 1), "w": 2**40, "none": None, "v": ("TEXT", F.concat(F.lit("1"), "seq"))}}
    ingest(store, land(spark, ("x", '{"t":[{"id":1,"v":7}]}')), Options(extra_columns=extra), init=True)
    assert dict(store.table("t").dtypes) == {
        "id": "int", "v": "int", "a": "string", "b": "boolean", "d": "timestamp_ntz", "f": "double", "j": "string", "n": "int", "none": "string", "w": "bigint",
    }
    extra = {"x": {"a": "later", "v": ("INTEGER", F.lit("oops"))}}
    ingest(store, land(spark, ("x", '{"t":[{"id":2,"v":7}]}')), Options(extra_columns=extra))
    assert tuples(store.table("t"), "id", "v") == [(1, 10)]  # a value that does not fit makes a reject


def test_responses_are_inferred_without_a_shuffle(spark):
    bodies = [
        '{"a":[{"z":1,"b":null,"y":"2024-01-01T00:00:00"},{"z":2.5,"b":true,"q":1},5,{"b":"x"}],"s":{"k":[1],"m":{"n":1}},"none":[],"c":1}',
        '{"a":[%s,{"z":1}]}' % ",".join(['{"z":null}'] * 6), '[{"z":"t"}]', "{oops", '{"a":{"z":18446744073709551616}}',
    ]
    data = land(spark, *[("e", i, b) for i, b in enumerate(bodies)])
    from landfall.sources import route_records

    wanted = infer_record_schema(route_records(data), per_response=True)
    mine = infer_responses(data)
    names = ["endpoint", "table_name", "seq", "entity_id", "ordinal", "name", "type", "nullable", "n_records", "n_present"]
    assert tuples(mine, *names) == tuples(wanted, *names)
    assert "Exchange" not in plan_of(mine)


def run_log(spark, *rows):
    text = "run_id string, task string, status string, time string, number bigint, error string, current bigint, total bigint, current_id string"
    return spark.createDataFrame(rows, text).withColumn("time", F.col("time").cast("timestamp"))


def test_the_streams_tables_are_the_batch_results_after_each_run(spark, store, tmp_path):
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "state")
    day = "2024-01-01 00:00:0"
    batches = [
        [("r", "a", "started", day + "1", 1, None, None, None, None), ("r", "b", "started", day + "1", 2, None, None, None, None)],
        [("r", "a", "running", day + "2", 3, None, 5, 20, "x"), ("r", "b", "failed", day + "3", 4, "no", None, None, None)],
        [("r", "a", "success", day + "4", 5, None, None, None, None), ("r", "c", "running", day + "4", 6, None, 0, 0, None), (None, "d", "success", day + "5", 7, None, None, None, None)],
    ]
    for rows in batches:
        append_run_events(run_log(spark, *rows), path)
        run_log_stream(store, path, checkpoint).awaitTermination()
        run_log_stream(store, path, checkpoint + "-runs", by_run=True).awaitTermination()
        log = read_run_events(spark, path)
        known = task_state(log).filter("run_id is not null")
        mine = store.table("task_state").filter("run_id is not null").withColumn("time", F.col("time").cast("timestamp"))
        assert tuples(mine.select(*known.columns)) == tuples(known)
        assert tuples(store.table("run_state").filter("run_id is not null")) == tuples(run_summary(log).filter("run_id is not null"))
    version = open_state(store, "task_state").version
    forget(tmp_path / "state", 2)
    run_log_stream(store, path, checkpoint).awaitTermination()
    assert open_state(store, "task_state").version == version
    assert RUN_SCHEMA.startswith("run_id")
