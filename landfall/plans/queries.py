"""The registered queries: one or more per operator, over whole base tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.names import response_key_col, table_name_col
from landfall.functions.values import value_kind, value_type
from landfall.operators import (
    TableColumn,
    TableSchema,
    apply_key_map,
    as_singleton,
    capped_ids,
    cast_record,
    check_foreign_key,
    check_not_null,
    check_primary_key,
    check_unique,
    check_unique_merge,
    create_table,
    definitions_of,
    detect_drift,
    detect_keys,
    drift_report,
    evolve_table,
    failures,
    fetch_column,
    infer_record_schema,
    infer_responses,
    infer_schema,
    key_map,
    last_wins,
    latest_state,
    load_registry,
    map_types,
    progress,
    project_records,
    registry_columns,
    resolve_schema,
    restore_store,
    run_summary,
    save_registry,
    snapshot_store,
    snapshot_table,
    sql,
    table_exists,
    task_durations,
    upsert,
)
from landfall.operators.tables import column_defaults, replace_table
from landfall.plans.endpoints import Endpoint
from landfall.plans.flow import Options, ingest, ingest_fanout, init_tables
from landfall.plans.samples import (
    ACTIVITY,
    ACTIVITY_KEYS,
    ENDPOINTS,
    activity_landing,
    customer_landing,
    fanout_landing,
    landing,
    load,
    new_store,
    order_landing,
    order_record,
    run_events,
    to_body,
)
from landfall.session import prepare, remove_dir, shared_dir
from landfall.sources import (
    append_discovery,
    append_run_events,
    inject_columns,
    normalize_response,
    read_discovery,
    read_landing,
    read_run_events,
    rejected,
    route_large,
    route_records,
    with_endpoints,
)
from landfall.streaming import ingest_stream, run_log_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LONG = Options(endpoints=ENDPOINTS, keys={"settings": "singleton"}, long_ints=True)
PREFIXES = {e.path: e.prefix for e in ENDPOINTS}
KEYS = {
    "customer_accounts": ["customer_id", "id"],
    "customer_profile": ["name"],
    "parts": ["brand"],
    "orders": ["id"],
    "settings": "singleton",
}


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(prepare(spark), sf_dir)

    QUERIES[f.__name__] = run
    return f


# Sources, sinks, routing


@query
def L1_read_landing(spark, sf):
    path = shared_dir(spark, "landing")
    customer_landing(spark, sf).write.json(path)
    return read_landing(spark, path, "json").select(
        "endpoint", "entity_id", "seq",
        F.get_json_object("body", "$.profile.name").alias("name"),
        F.get_json_object("body", "$.accounts[1].id").cast("bigint").alias("second_id"),
    )


def _bare_arrays(spark, sf):
    endpoint = F.when(F.col("s_suppkey") % 2 == 0, "x/suppliers/").otherwise("x/set-suppliers")
    body = to_body(F.array(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))))
    wrapped = to_body(F.struct(F.array(F.struct(F.col("s_suppkey").alias("id"))).alias("plain")))
    return landing(
        load(spark, sf, "supplier"), endpoint, "s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, wrapped).otherwise(body)
    )


@query
def L2_normalize_response(spark, sf):
    members = normalize_response(_bare_arrays(spark, sf)).select(
        "seq", F.explode(F.from_json("body", "map<string,string>")).alias("response_key", "list")
    )
    return members.select("seq", "response_key", F.json_array_length("list").cast("bigint").alias("n"))


@query
def L3_route_records(spark, sf):
    return route_records(customer_landing(spark, sf)).select(
        "table_name", "entity_id", F.col("pos").cast("bigint").alias("pos"),
        F.try_variant_get("record", "$.id", "bigint").alias("id"),
    )


@query
def L3_rejected(spark, sf):
    bad = (
        F.when(F.col("s_suppkey") % 4 == 0, "{oops")
        .when(F.col("s_suppkey") % 4 == 1, "5")
        .when(F.col("s_suppkey") % 4 == 2, "{}")
        .otherwise('{"good":[{"id":1},7]}')
    )
    found = rejected(landing(load(spark, sf, "supplier"), "s", "s_suppkey", bad))
    return found.select("seq", F.col("pos").cast("bigint").alias("pos"), "problem", "rejected_text")


@query
def L4_table_name(spark, sf):
    names = load(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("prefix"),
        F.concat(F.lit("of-"), F.col("user_id")).alias("key"),
    )
    table = table_name_col(F.col("prefix"), F.col("key"))
    return names.select(
        "event_id", table.alias("table_name"), response_key_col(table, F.col("prefix")).alias("response_key")
    )


@query
def L5_inject_columns(spark, sf):
    records = route_records(with_endpoints(fanout_landing(spark, sf), PREFIXES))
    rows = project_records(records, [("orderkey", "BIGINT"), ("price", "DOUBLE"), ("customer_id", "BIGINT")])
    rows = inject_columns(rows, {"customer_id": F.col("entity_id")})
    return rows.select("orderkey", F.col("pos").cast("bigint").alias("pos"), "price", "customer_id")


@query
def L6_append_run_events(spark, sf):
    path = shared_dir(spark, "runs")
    log = run_events(spark, sf).withColumn("time", F.col("time").cast("timestamp"))
    append_run_events(log.filter("status = 'failed'"), path)
    append_run_events(log.filter("status <> 'failed'"), path)
    return read_run_events(spark, path).select(
        "run_id", "task", "status", F.col("time").cast("timestamp_ntz").alias("time"), "error"
    )


def _discovery(spark, sf):
    return load(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("time"),
        F.concat(F.lit("endpoint-"), F.col("user_id") % 3).alias("endpoint"),
        F.concat(F.lit("table-"), F.col("user_id")).alias("table"),
        F.when(F.col("event_type") == "error", "type_change").otherwise("new_column").alias("event"),
        F.col("event_type").alias("column"),
        F.when(F.col("event_type") != "error", "INTEGER").alias("type"),
        F.when(F.col("event_type") == "error", "TEXT").alias("was"),
        F.when(F.col("event_type") == "error", "JSON").alias("now"),
    )


@query
def L7_append_discovery(spark, sf):
    path = shared_dir(spark, "discovery")
    append_discovery(_discovery(spark, sf), path)
    return read_discovery(spark, path).withColumn("time", F.col("time").cast("timestamp_ntz"))


def _stored(spark, df: DataFrame, name: str, key: str, **layout):
    """A store with one table that holds ``df``."""
    store = new_store(spark, **layout)
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}
    columns = tuple(TableColumn(c, types.get(t, "TEXT"), c != key, c == key) for c, t in df.dtypes)
    create_table(store, TableSchema(name, columns), execute=True, keys=[key])
    replace_table(store, name, df, [key])
    return store


@query
def L8_snapshot_table(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    store = _stored(spark, orders, "orders", "o_orderkey")
    path = snapshot_table(store, "orders")
    replace_table(store, "orders", store.table("orders").withColumn("o_totalprice", F.lit(0.0)), ["o_orderkey"])
    assert snapshot_table(store, "absent") is None
    return spark.read.parquet(path)


# Schema inference, registry, drift


def _typed_landing(spark, sf):
    return landing(
        load(spark, sf, "documents"), "documents", "doc_id",
        to_body(F.array(F.struct(
            F.col("doc_id").alias("id"),
            F.col("text"),
            (F.col("n_chars") / 2).alias("half"),
            (F.col("n_chars") > 1000).alias("long"),
            F.when(F.col("doc_id") % 3 == 1, F.col("source")).alias("source"),
            F.when(F.col("doc_id") % 2 == 0, "2024-01-02T03:04:05Z").otherwise("2024-01-02").alias("day"),
            F.array("lang").alias("langs"),
            F.struct("lang").alias("meta"),
            F.lit(None).cast("string").alias("nothing"),
        ))),
    )


@query
def S1_value_type(spark, sf):
    records = route_records(_typed_landing(spark, sf)).select("record")
    fields = records.lateralJoin(spark.tvf.variant_explode(F.col("record").outer()))
    kinds = fields.select(F.col("key").alias("name"), "value", value_kind(F.col("value")).alias("kind"))
    typed = kinds.select("name", value_type(F.col("value"), F.col("kind")).alias("type"))
    return typed.groupBy("name", "type").agg(F.count(F.lit(1)).alias("n"))


@query
def S2_infer_record_schema(spark, sf):
    return infer_record_schema(route_records(_typed_landing(spark, sf))).drop("endpoint")


@query
def S2_infer_per_response(spark, sf):
    """Each response by itself: the type of its own first value, else text."""
    lists = landing(
        load(spark, sf, "orders"), "orders", "o_orderkey",
        to_body(F.array(
            F.struct(F.col("o_orderkey").alias("id"), F.lit(None).cast("bigint").alias("v")),
            F.struct(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("v")),
        )),
    )
    found = infer_record_schema(route_records(lists), per_response=True)
    return found.select("seq", "ordinal", "name", "type", "nullable")


@query
def S3_infer_schema(spark, sf):
    return infer_schema(with_endpoints(customer_landing(spark, sf), PREFIXES))


def _mapped(spark, sf):
    return map_types(infer_schema(with_endpoints(customer_landing(spark, sf), PREFIXES)))


def _keymap(spark):
    return key_map(spark, KEYS)


def _definition_rows(columns: DataFrame) -> DataFrame:
    return columns.select(
        "table_name", F.col("ordinal").cast("bigint").alias("ordinal"), "name", "data_type", "nullable",
        "primary_key", "unique", "table_key",
    )


@query
def S4_map_types(spark, sf):
    return _definition_rows(_mapped(spark, sf)).drop("table_key")


@query
def S5_registry_columns(spark, sf):
    """What a pinned definition keeps of a schema with a unique column."""
    return _definition_rows(registry_columns(definitions_of(apply_key_map(_mapped(spark, sf), _keymap(spark)))))


@query
def S6_load_registry(spark, sf):
    """The last definition of a table holds, as a whole."""
    path = shared_dir(spark, "registry")
    mapped = _mapped(spark, sf)
    save_registry(mapped, path, 1)
    save_registry(mapped.filter("table_name = 'customer_profile' and name <> 'segment'"), path, 2)
    return _definition_rows(load_registry(spark, path))


@query
def S7_save_registry(spark, sf):
    path = shared_dir(spark, "registry")
    save_registry(apply_key_map(_mapped(spark, sf), _keymap(spark)), path, 7)
    rows = spark.read.parquet(path).select("name", "primary_key", "version", F.posexplode("columns").alias("pos", "c"))
    return rows.select(
        F.col("name").alias("table_name"), "primary_key", "version", F.col("pos").cast("bigint").alias("pos"),
        F.col("c.name").alias("name"), F.col("c.data_type").alias("data_type"),
        F.array_join("c.tests", ",").alias("tests"),
    )


@query
def S8_resolve_schema(spark, sf):
    """Accounts are pinned with another type; the profile is not pinned."""
    mapped = _mapped(spark, sf)
    pinned = mapped.filter("table_name = 'customer_accounts'").withColumn(
        "data_type", F.when(F.col("name") == "balance", "TEXT").otherwise(F.col("data_type"))
    )
    return _definition_rows(resolve_schema(mapped, pinned))


def _drift_sides(spark, sf):
    pinned = map_types(infer_schema(order_landing(spark, sf, F.col("o_custkey").alias("customer"))))
    changed = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("string").alias("price"), F.col("o_custkey").alias("customer"),
        F.array("o_orderpriority").alias("tags"), F.lit(True).alias("added"),
    )
    arriving = landing(load(spark, sf, "orders"), "orders", "o_orderkey", to_body(F.array(changed)))
    return map_types(infer_schema(arriving)), pinned


@query
def S9_detect_drift(spark, sf):
    return detect_drift(*_drift_sides(spark, sf)).drop("was", "now")


@query
def S10_detect_drift_full(spark, sf):
    return detect_drift(*_drift_sides(spark, sf), full=True)


# The same operators where names, order and types of columns come from the data


def _activity(spark, sf, shift=0):
    """Columns of the tables that events make, by type."""
    found = infer_schema(with_endpoints(activity_landing(spark, sf, shift), {ACTIVITY.path: ACTIVITY.prefix}), union_keys=True)
    return map_types(found)


def _activity_keymap(spark):
    return key_map(spark, ACTIVITY_KEYS)


_REPINNED = "table_name IN ('events_click', 'events_view')"


@query
def S4_map_event_types(spark, sf):
    return _definition_rows(_activity(spark, sf)).drop("table_key")


@query
def S5_event_registry_columns(spark, sf):
    columns = apply_key_map(_activity(spark, sf), _activity_keymap(spark))
    return _definition_rows(registry_columns(definitions_of(columns)))


@query
def S6_load_event_registry(spark, sf):
    """Two of the tables are pinned anew, with other fields."""
    path = shared_dir(spark, "registry")
    save_registry(_activity(spark, sf), path, 1)
    save_registry(_activity(spark, sf, 1).filter(_REPINNED), path, 2)
    return _definition_rows(load_registry(spark, path))


@query
def S7_save_event_registry(spark, sf):
    path = shared_dir(spark, "registry")
    save_registry(apply_key_map(_activity(spark, sf), _activity_keymap(spark)), path, 3)
    rows = spark.read.parquet(path).select("name", "primary_key", "version", F.posexplode("columns").alias("pos", "c"))
    return rows.select(
        F.col("name").alias("table_name"), "primary_key", "version", F.col("pos").cast("bigint").alias("pos"),
        F.col("c.name").alias("name"), F.col("c.data_type").alias("data_type"),
        F.array_join("c.tests", ",").alias("tests"),
    )


@query
def S8_resolve_event_schema(spark, sf):
    """Two of the tables are pinned with other fields, the rest is not pinned."""
    return _definition_rows(resolve_schema(_activity(spark, sf), _activity(spark, sf, 1).filter(_REPINNED)))


@query
def S9_event_drift(spark, sf):
    return detect_drift(_activity(spark, sf, 1), _activity(spark, sf)).drop("was", "now")


@query
def S10_event_drift_full(spark, sf):
    return detect_drift(_activity(spark, sf, 1), _activity(spark, sf), full=True)


@query
def K1_detect_event_keys(spark, sf):
    """Tables with an id, one of the key map, and one without a key."""
    keymap = _activity_keymap(spark)
    return detect_keys(_activity(spark, sf), keymap).select(
        "table_name", F.array_join("key_columns", ",").alias("key_columns"), "is_primary", F.col("problem").isNotNull().alias("no_key")
    )


@query
def K3_event_singleton_columns(spark, sf):
    columns = apply_key_map(_activity(spark, sf), _activity_keymap(spark)).filter("table_name = 'events_error'")
    return _definition_rows(columns).drop("table_key")


@query
def K4_event_unique_column(spark, sf):
    return apply_key_map(_activity(spark, sf), _activity_keymap(spark)).select("table_name", "name", "unique")


@query
def T4_init_event_tables(spark, sf):
    """Each type of event gets its table, pinned and reported."""
    store = new_store(spark)
    init_tables(store, activity_landing(spark, sf), Options(endpoints=(ACTIVITY,), keys=ACTIVITY_KEYS, long_ints=True))
    events = read_discovery(spark, store.discovery_path).select("table", "event")
    pinned = load_registry(spark, store.registry_path).select("table_name", "name", "data_type", "nullable")
    return pinned.join(events, pinned["table_name"] == events["table"]).drop("table")


# Keys, tables, integrity


def _many_tables(spark, sf):
    parts = landing(
        load(spark, sf, "part"), "parts", "p_partkey",
        to_body(F.array(F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")))),
    )
    settings = landing(
        load(spark, sf, "supplier"), "settings", "s_suppkey",
        to_body(F.struct(F.struct(F.col("s_name").alias("owner"), F.col("s_acctbal").alias("limit")).alias("settings"))),
    )
    loose = landing(
        load(spark, sf, "supplier"), "settings", "s_suppkey",
        to_body(F.struct(F.array(F.struct(F.col("s_name").alias("word"))).alias("loose"))),
    )
    everything = customer_landing(spark, sf).union(parts).union(settings).union(loose)
    return map_types(infer_schema(with_endpoints(everything, PREFIXES)))


@query
def K1_detect_keys(spark, sf):
    columns = apply_key_map(_many_tables(spark, sf), _keymap(spark))
    return detect_keys(columns, _keymap(spark)).select(
        "table_name", F.array_join("key_columns", ",").alias("key_columns"), "is_primary", "problem"
    )


@query
def K3_as_singleton(spark, sf):
    settings = landing(
        load(spark, sf, "orders"), "settings", "o_orderkey",
        to_body(F.array(
            F.struct(F.lit(99).alias("id"), F.col("o_orderkey").alias("last"), F.col("o_totalprice").alias("price")),
            F.struct(F.lit(98).alias("id"), F.lit(-1).alias("last"), F.lit(0.5).alias("price")),
        )),
    )
    rows = project_records(
        route_records(settings), [("id", "INTEGER"), ("last", "BIGINT"), ("price", "DOUBLE")], carried=("seq", "pos")
    )
    return as_singleton(rows.drop("found", "problem")).select("id", "last", "price")


@query
def K3_singleton_columns(spark, sf):
    columns = apply_key_map(_many_tables(spark, sf), _keymap(spark)).filter("table_name = 'settings'")
    return _definition_rows(columns).drop("table_key")


@query
def K4_unique_column(spark, sf):
    columns = apply_key_map(_many_tables(spark, sf), _keymap(spark))
    return columns.select("table_name", "name", "unique")


@query
def K5_check_unique(spark, sf):
    return check_unique(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def K6_check_primary_key(spark, sf):
    items = load(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber"
    )
    return check_primary_key(items, ["l_orderkey", "l_linenumber"])


@query
def K7_check_not_null(spark, sf):
    orders = load(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_totalprice") > 1000, F.col("o_orderdate")).alias("o_orderdate"),
    )
    return check_not_null(orders, orders.columns)


@query
def K8_check_foreign_key(spark, sf):
    """Half of the customers are missing."""
    customers = load(spark, sf, "customer").filter("c_custkey % 2 = 0")
    return check_foreign_key(load(spark, sf, "orders"), "o_custkey", customers, "c_custkey")


@query
def K8_orphan_rows(spark, sf):
    customers = load(spark, sf, "customer").filter("c_custkey % 2 = 0")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return check_foreign_key(orders, "o_custkey", customers, "c_custkey", rows=True)


@query
def K9_column_default(spark, sf):
    """A batch without a column gives inserted rows its default."""
    schema = TableSchema("orders", (
        TableColumn("o_orderkey", "BIGINT", False, True), TableColumn("o_totalprice", "DOUBLE"),
        TableColumn("state", "TEXT", default="'new'"),
    ))
    store = new_store(spark)
    create_table(store, schema, execute=True)
    batch = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    replace_table(store, "orders", upsert(
        store.table("orders"), batch, ["o_orderkey"], False, defaults=column_defaults(schema)
    ))
    return store.table("orders")


@query
def K9_default_keeps_stored(spark, sf):
    """Stored rows keep their value when a batch without the column meets them."""
    schema = TableSchema("orders", (
        TableColumn("o_orderkey", "BIGINT", False, True), TableColumn("o_totalprice", "DOUBLE"),
        TableColumn("state", "TEXT", default="'new'"),
    ))
    store = new_store(spark)
    create_table(store, schema, execute=True)
    orders = load(spark, sf, "orders")
    replace_table(store, "orders", orders.filter("o_orderkey % 2 = 0").select(
        "o_orderkey", "o_totalprice", F.lower("o_orderstatus").alias("state")
    ))
    batch = orders.select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    replace_table(store, "orders", upsert(
        store.table("orders"), batch, ["o_orderkey"], False, defaults=column_defaults(schema)
    ))
    return store.table("orders")


@query
def T1_create_table(spark, sf):
    """Create from an inferred schema, then fill."""
    store = new_store(spark)
    columns = (
        TableColumn("id", "BIGINT", False, True), TableColumn("name", "TEXT"), TableColumn("price", "DOUBLE"),
    )
    assert "CREATE TABLE IF NOT EXISTS" in create_table(store, TableSchema("parts", columns))
    assert not table_exists(store, "parts")
    create_table(store, TableSchema("parts", columns), execute=True)
    parts = load(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )
    replace_table(store, "parts", parts)
    return store.table("parts")


@query
def T3_table_exists(spark, sf):
    store = _stored(spark, load(spark, sf, "part").select("p_partkey"), "parts", "p_partkey")
    counted = store.table("parts").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "n", F.lit(table_exists(store, "parts")).alias("parts"), F.lit(table_exists(store, "absent")).alias("absent")
    )


@query
def T4_init_tables(spark, sf):
    """Tables of a landing are made once, pinned, and reported."""
    store = new_store(spark)
    made = init_tables(store, customer_landing(spark, sf), LONG)
    assert made == ["customer_accounts", "customer_profile"]
    events = read_discovery(spark, store.discovery_path).select("table", "event")
    pinned = load_registry(spark, store.registry_path).select("table_name", "name", "data_type", "nullable")
    return pinned.join(events, pinned["table_name"] == events["table"]).drop("table")


@query
def T5_evolve_table(spark, sf):
    """A column added after the load is null in old rows."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    store = _stored(spark, orders.filter("o_orderkey % 2 = 0"), "orders", "o_orderkey")
    evolve_table(store, "orders", [TableColumn("o_custkey", "BIGINT"), TableColumn("o_totalprice", "DOUBLE")])
    new = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey").filter("o_orderkey % 2 = 1")
    replace_table(store, "orders", upsert(store.table("orders"), new, ["o_orderkey"], False), ["o_orderkey"])
    return store.table("orders")


# Row writing


def _order_base(spark, sf):
    return load(spark, sf, "orders").filter("o_orderkey % 3 <> 0")


def _order_updates(spark, sf):
    return load(spark, sf, "orders").filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query
def U1_upsert_full(spark, sf):
    return upsert(_order_base(spark, sf), _order_updates(spark, sf), ["o_orderkey"], null_keys=False)


@query
def U1_upsert_partial(spark, sf):
    updates = _order_updates(spark, sf).select("o_orderkey", "o_totalprice")
    return upsert(_order_base(spark, sf), updates, ["o_orderkey"], null_keys=False)


@query
def U1_upsert_null_key(spark, sf):
    """Rows without a key are all inserted; the others replace by user."""
    events = load(spark, sf, "events").select(
        "event_id", "value", F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_id")
    )
    base = last_wins(events.filter("event_id % 2 = 0"), ["user_id"], ["event_id"])
    incoming = last_wins(events.filter("event_id % 2 = 1"), ["user_id"], ["event_id"])
    return upsert(base, incoming, ["user_id"])


@query
def U1_upsert_optional(spark, sf):
    """Two responses for each order, the later without a status and with a null price."""
    first = order_record(F.col("o_custkey").alias("customer"))
    later = F.struct(
        F.col("o_orderkey").alias("id"), F.lit(None).cast("double").alias("price"), F.lit(0).alias("customer")
    )
    orders = load(spark, sf, "orders")
    lists = landing(orders, "orders", "o_orderkey", to_body(F.array(first))).union(
        landing(
            orders.filter("o_orderkey % 2 = 0").withColumn("o_seq", F.col("o_orderkey") + 10**15),
            "orders", "o_seq", to_body(F.array(later)),
        )
    )
    columns = [("id", "BIGINT"), ("status", "TEXT"), ("price", "DOUBLE"), ("customer", "BIGINT")]
    rows = project_records(route_records(lists), columns, carried=("seq", "pos")).drop("problem")
    incoming = last_wins(rows, ["id"], ["seq", "pos"], null_keys=False, found="found")
    base = orders.filter("o_orderkey % 3 = 0").select(
        F.col("o_orderkey").alias("id"), F.lit("old").alias("status"), F.lit(1.0).alias("price"),
        F.lit(-5).cast("bigint").alias("customer"),
    )
    return upsert(base, incoming, ["id"], null_keys=False, optional=["status", "price", "customer"])


@query
def U2_last_wins(spark, sf):
    items = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return last_wins(items, ["l_orderkey", "l_linenumber"], order, null_keys=False)


@query
def U3_project_records(spark, sf):
    """A column that some records lack, and fields that no column takes."""
    record = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(order_record())).otherwise(
        F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.lit(1).alias("x")))
    )
    lists = landing(load(spark, sf, "orders"), "orders", "o_orderkey", F.concat(F.lit("["), record, F.lit("]")))
    rows = project_records(
        route_records(lists), [("id", "BIGINT"), ("status", "TEXT"), ("price", "DOUBLE")], missing="fail"
    )
    return rows.select("id", "status", "price", "problem")


@query
def U4_cast_record(spark, sf):
    """Values into columns of another type, with the storage's rules."""
    orders = load(spark, sf, "orders").withColumn("n", F.col("o_orderkey") % 7)
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        (F.col("n") + 0.5).alias("half_int"),
        F.concat((F.col("n") + 0.5).cast("string"), F.lit(" ")).alias("half_text"),
        F.col("o_totalprice").cast("string").alias("price_text"),
        F.when(F.col("n") == 0, "no").when(F.col("n") == 1, "yes").otherwise("T").alias("flag_text"),
        (F.col("n") > 3).alias("bool_int"),
        F.col("o_custkey").alias("int_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("zoned"),
        F.when(F.col("n") < 3, "junk").otherwise("12").alias("maybe"),
        (F.col("o_custkey") + 2**31 - 3).alias("wide"),
    )
    records = route_records(landing(orders, "orders", "o_orderkey", to_body(F.array(record))))
    columns = [
        ("id", "BIGINT"), ("half_int", "INTEGER"), ("half_text", "INTEGER"), ("price_text", "DOUBLE"),
        ("flag_text", "BOOLEAN"), ("bool_int", "INTEGER"), ("int_text", "TEXT"), ("zoned", "TIMESTAMP"),
        ("maybe", "INTEGER"), ("wide", "INTEGER"),
    ]
    cast = cast_record(records, columns)
    return cast.withColumn("problems", F.coalesce(F.array_join("problems", ","), F.lit(""))).drop("found")


@query
def U5_json_column(spark, sf):
    """Nested values as JSON text, read back by field."""
    body = F.concat(F.lit('[{"id":'), F.col("event_id"), F.lit(',"props":'), F.col("props"), F.lit(',"tags":[1,{"a":2}]}]'))
    records = route_records(landing(load(spark, sf, "events"), "events", "event_id", body))
    rows = cast_record(records, [("id", "BIGINT"), ("props", "JSON"), ("tags", "JSON")])
    return rows.select(
        "id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.get_json_object("tags", "$[1].a").cast("bigint").alias("a"),
    )


def _flag_landing(spark, sf):
    """Line items of one return flag each as a response list of a copied record."""
    items = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    record = F.struct(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").alias("shipped"),
    )
    return landing(items, "lines", "l_orderkey", to_body(F.array(record, record)))


@query
def U6_batch_count(spark, sf):
    """Records written, not distinct keys."""
    store = new_store(spark)
    counts = ingest(store, _flag_landing(spark, sf), LONG, init=True)
    return store.table("lines").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_written", F.lit(counts["lines"]).cast("bigint")
    )


@query
def U7_ingest(spark, sf):
    """Two loads of several tables; the second changes half of the customers."""
    store = new_store(spark)
    ingest(store, customer_landing(spark, sf), LONG, init=True)
    changed = customer_landing(spark, sf).filter("entity_id % 2 = 0").withColumn(
        "body", F.replace(F.col("body"), F.lit('"segment":"'), F.lit('"extra":1,"segment":"new '))
    ).withColumn("seq", F.col("seq") + 10**12)
    ingest(store, changed, LONG)
    accounts = store.table("customer_accounts").select(
        F.lit("accounts").alias("table_name"), "customer_id", "id", "balance", F.lit(None).cast("string").alias("segment")
    )
    profile = store.table("customer_profile").select(
        F.lit("profile").alias("table_name"), "customer_id", "id", F.lit(None).cast("double").alias("balance"), "segment"
    )
    return accounts.unionByName(profile).withColumn("customer_id", F.col("customer_id").cast("bigint"))


@query
def U8_ingest_simple(spark, sf):
    """A bare array, and an object that becomes a one-row table."""
    store = new_store(spark)
    settings = landing(
        load(spark, sf, "supplier"), "settings", "s_suppkey",
        to_body(F.struct(F.struct(F.col("s_name").alias("owner"), F.col("s_acctbal").alias("limit")).alias("settings"))),
    )
    ingest(store, order_landing(spark, sf).union(settings.withColumn("seq", F.col("seq") + 10**12)), LONG, init=True)
    single = store.table("settings").select(
        F.lit("settings").alias("table_name"), F.col("id").cast("bigint").alias("id"), F.col("owner").alias("status"),
        F.col("limit").alias("price"), F.lit(None).cast("timestamp_ntz").alias("dt"),
    )
    return store.table("orders").select(F.lit("orders").alias("table_name"), "id", "status", "price", "dt").union(single)


@query
def U7_field_names(spark, sf):
    """Fields called like our own columns; the second load lacks one of them in some records."""
    store = new_store(spark)
    record = lambda *more: F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("pos"), F.col("o_custkey").alias("seq"),
        F.col("o_orderstatus").alias("endpoint"), (F.col("o_custkey") % 7).alias("entity_id"),
        F.lower("o_orderstatus").alias("found"), F.col("o_orderpriority").alias("problems"), *more,
    )
    problem = F.concat(F.lit("p"), F.col("o_custkey")).alias("problem")
    orders = load(spark, sf, "orders")
    ingest(store, landing(orders, "orders", "o_orderkey", to_body(F.array(record(problem)))), LONG, init=True)
    body = F.when(F.col("o_orderkey") % 4 == 0, to_body(F.array(record()))).otherwise(
        to_body(F.array(record(F.lit("again").alias("problem"))))
    )
    again = orders.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    ingest(store, landing(again, "orders", "o_orderkey", body), LONG)
    return store.table("orders")


@query
def U9_two_endpoints(spark, sf):
    """Responses of two endpoints in one landing, each with parents of its own."""
    store = new_store(spark)
    endpoints = (
        Endpoint("customer-orders/{id}", prefix="sales", parent_column="customer_id", parent_table="customers"),
        Endpoint("supplier-notes/{id}", prefix="supplier", parent_column="supplier_id", parent_table="suppliers"),
    )
    options = Options(endpoints=endpoints, long_ints=True)
    owner = lambda key: to_body(F.array(F.struct(F.col(key).alias("id"))))
    customers = load(spark, sf, "customer").filter("c_custkey % 3 <> 0")
    suppliers = load(spark, sf, "supplier").filter("s_suppkey % 2 = 0")
    ingest(store, landing(customers, "customers", "c_custkey", owner("c_custkey")).union(
        landing(suppliers.withColumn("n", F.col("s_suppkey") + 10**12), "suppliers", "n", owner("s_suppkey"))
    ), options, init=True)
    note = F.struct(F.array(F.struct(F.lit(1).alias("id"), F.col("s_acctbal").alias("price"))).alias("notes"))
    notes = landing(
        load(spark, sf, "supplier").withColumn("n", F.col("s_suppkey") + 10**12), "supplier-notes/{id}", "n", to_body(note),
        "s_suppkey",
    )
    ingest_fanout(store, fanout_landing(spark, sf).union(notes), options=options, init=True)
    sales = store.table("sales_lines").select(F.lit("sales").alias("kind"), "customer_id", "id", "price")
    return sales.union(store.table("supplier_notes").select(F.lit("notes"), "supplier_id", "id", "price")).select(
        "kind", F.col("customer_id").cast("bigint").alias("parent_id"), "id", "price"
    )


def _fanout(spark, sf, options):
    store = new_store(spark)
    customers = load(spark, sf, "customer").select("c_custkey").filter("c_custkey % 3 <> 0")
    ingest_fanout(store, fanout_landing(spark, sf), customers, options, init=True)
    return store.table("sales_lines").select("id", "orderkey", "price", F.col("customer_id").cast("bigint").alias("customer_id"))


@query
def U9_ingest_fanout(spark, sf):
    """All customers but a third, in one go; records are kept per customer."""
    return _fanout(spark, sf, LONG)


@query
def U9_ingest_fanout_by_id(spark, sf):
    """Keyed by id alone, the last response of any parent stays."""
    return _fanout(spark, sf, Options(endpoints=ENDPOINTS, long_ints=True, faithful=True))


@query
def U9_partitioned(spark, sf):
    """Parents as partitions: a second load rewrites only those it touches."""
    store = new_store(spark, partition_by={"sales_lines": ["region"]})
    endpoint = ENDPOINTS[1].__class__("region/{id}", prefix="sales", parent_column="region")
    options = Options(endpoints=(endpoint,), long_ints=True)
    orders = load(spark, sf, "orders").withColumn("region", F.col("o_custkey") % 5)
    body = to_body(F.struct(F.array(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))).alias("lines")))
    first = landing(orders, "region/{id}", "o_orderkey", body, "region")
    ingest(store, first, options, init=True)
    second = orders.filter("region = 2").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    ingest(store, landing(second, "region/{id}", "o_orderkey", body, "region"), options)
    return store.table("sales_lines").select("id", "price", F.col("region").cast("bigint").alias("region"))


@query
def U10_ingest_stream(spark, sf):
    """Four landings with overlaps, taken up by two runs of one stream."""
    store, path = new_store(spark), shared_dir(spark, "landing")
    orders = load(spark, sf, "orders")
    checkpoint = shared_dir(spark, "stream")
    for n in range(4):
        part = orders.filter(F.col("o_orderkey") % 5 >= n).withColumns({
            "o_totalprice": F.col("o_totalprice") + n, "o_seq": F.col("o_orderkey") + n * 10**12,
        })
        landing(part, "orders", "o_seq", to_body(F.array(order_record()))).write.mode("append").parquet(path)
        if n % 2:
            ingest_stream(store, path, checkpoint, LONG).awaitTermination()
    return store.table("orders").select("id", "status", "price", "dt")


# Reads


@query
def Q1_fetch_column(spark, sf):
    items = load(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") > 1, F.col("l_suppkey")).alias("suppkey"))
    return fetch_column(items, "suppkey")


@query
def Q2_capped_ids(spark, sf):
    return capped_ids(load(spark, sf, "customer"), "c_custkey", 100)


@query
def Q3_sql(spark, sf):
    store = _stored(spark, load(spark, sf, "part").select("p_partkey", "p_brand"), "parts", "p_partkey")
    table = store.qualify("parts")
    return sql(spark, f"SELECT p_brand, count(*) AS n FROM {table} GROUP BY p_brand")


# Run-log analytics


@query
def R1_run_summary(spark, sf):
    return run_summary(run_events(spark, sf))


@query
def R2_latest_state(spark, sf):
    return latest_state(run_events(spark, sf).select("run_id", "task", "status", "time", "error"))


@query
def R3_progress(spark, sf):
    return progress(run_events(spark, sf))


@query
def R3_progress_from_log(spark, sf):
    """As read back from a log that the events were appended to."""
    path = shared_dir(spark, "runs")
    log = run_events(spark, sf).withColumns({
        "time": F.col("time").cast("timestamp"), "current_id": F.col("current_id").cast("string")
    })
    append_run_events(log, path)
    return progress(read_run_events(spark, path)).withColumn("current_id", F.col("current_id").cast("bigint"))


@query
def R4_task_durations(spark, sf):
    return task_durations(run_events(spark, sf))


@query
def R5_drift_report(spark, sf):
    events = _discovery(spark, sf).withColumn("time", F.col("time").cast("timestamp_ntz"))
    return drift_report(events)


@query
def R6_failures(spark, sf):
    return failures(run_events(spark, sf)).select("run_id", "task", "time", "error")


# Stored layouts, replays, references, large bodies, streams over the log


@query
def U1_touched_parts(spark, sf):
    """A table in sixteen key parts; the second load reads and writes only the parts of its orders."""
    store = new_store(spark, parts={"orders": 16})
    ingest(store, order_landing(spark, sf), LONG, init=True)
    few = load(spark, sf, "orders").filter("o_custkey % 100 = 7").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    ingest(store, landing(few, "orders", "o_orderkey", to_body(F.array(order_record()))), LONG)
    return store.table("orders")


@query
def U10_replay(spark, sf):
    """A stream whose last batch is run again after its tables were committed; views have no key."""
    store, path, checkpoint = new_store(spark), shared_dir(spark, "landing"), shared_dir(spark, "stream")
    events = load(spark, sf, "events")
    record = F.struct(
        F.when(F.col("event_type") != "view", F.col("user_id")).alias("user"), F.col("event_id").alias("event"), "value"
    )
    landing(events, "clicks", "event_id", to_body(F.array(record))).write.parquet(path)
    options = Options(endpoints=ENDPOINTS, keys={"clicks": ["user"]}, long_ints=True)
    ingest_stream(store, path, checkpoint, options).awaitTermination()
    remove_dir(spark, f"{checkpoint}/commits/0")  # as if the driver had died before the stream noted the batch
    ingest_stream(store, path, checkpoint, options).awaitTermination()
    return store.table("clicks").select(
        F.col("event").alias("event_id"), F.col("value").cast("double").alias("value"), F.col("user").alias("user_id")
    )


@query
def K6_check_unique_merge(spark, sf):
    """Codes that two orders would share after a batch; the batch moves a third of the orders to new codes."""
    orders = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("code"))
    stored = orders.filter("o_orderkey % 2 = 0")
    batch = orders.filter("o_orderkey % 3 = 0").withColumn("code", F.when(F.col("o_orderkey") % 5 > 0, F.col("code") + 4))
    return check_unique_merge(stored, batch, ["o_orderkey"], "code").distinct()


@query
def K8_ingest_references(spark, sf):
    """Orders of customers that are not stored become rejects of the ingest."""
    store = new_store(spark)
    customers = load(spark, sf, "customer").filter("c_custkey % 3 <> 0")
    owner = to_body(F.array(F.struct(F.col("c_custkey").alias("id"))))
    order = to_body(F.array(F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"))))
    options = Options(endpoints=ENDPOINTS, long_ints=True, references={"orders": {"customer": ("customers", "id")}})
    both = landing(customers, "customers", "c_custkey", owner).union(
        landing(load(spark, sf, "orders").withColumn("n", F.col("o_orderkey") + 10**12), "orders", "n", order)
    )
    ingest(store, both, options, init=True)
    rejects = spark.read.parquet(store.path("_rejects")).select(
        F.get_json_object("rejected_text", "$.id").cast("bigint").alias("id"),
        F.get_json_object("rejected_text", "$.customer").cast("bigint").alias("customer"), "problem",
    )
    return store.table("orders").withColumn("problem", F.lit(None).cast("string")).unionByName(rejects)


@query
def L3_large_body(spark, sf):
    """Responses split as text, as those too large for a variant are: one per order, with its line items."""
    items = load(spark, sf, "lineitem").select("l_orderkey", F.struct("l_partkey", "l_quantity", "l_returnflag").alias("line"))
    orders = items.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    body = to_body(F.struct("lines", F.struct(F.size("lines").alias("n")).alias("total"), F.lit(1).alias("page")))
    routed = route_large(landing(orders, "orders/{id}", "l_orderkey", body, "l_orderkey"))
    return routed.select(
        "seq", "table_name", "problem", F.try_variant_get("record", "$.l_partkey", "bigint").alias("partkey"),
        F.try_variant_get("record", "$.l_quantity", "double").alias("quantity"),
        F.try_variant_get("record", "$.l_returnflag", "string").alias("flag"), F.try_variant_get("record", "$.n", "bigint").alias("n"),
    )


@query
def L4_alike_names(spark, sf):
    """Two members of a response whose names differ in a hyphen only."""
    first, second = (F.array(F.struct((F.col("o_orderkey") + n).alias("id"))) for n in (0, 1))
    body = to_body(F.struct(first.alias("part-list"), second.alias("part_list")))
    routed = route_records(landing(load(spark, sf, "orders"), "orders/{id}", "o_orderkey", body))
    return routed.select("table_name", "seq", F.try_variant_get("record", "$.id", "bigint").alias("id"))


@query
def L8_snapshot_store(spark, sf):
    """Two tables are held, changed by a load, and brought back."""
    store = new_store(spark, parts={"orders": 8})
    ingest(store, order_landing(spark, sf), LONG, init=True)
    settings = landing(
        load(spark, sf, "supplier"), "suppliers", "s_suppkey",
        to_body(F.array(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))),
    )
    ingest(store, settings, LONG, init=True)
    label = snapshot_store(store, ["orders", "suppliers"])
    doubled = load(spark, sf, "orders").filter("o_orderkey % 4 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    ingest(store, landing(doubled, "orders", "o_orderkey", to_body(F.array(order_record()))), LONG)
    ingest(store, settings.withColumn("body", F.replace("body", F.lit("Supplier"), F.lit("None"))), LONG)
    after = store.table("orders").select(F.lit("after").alias("kind"), "id", "price", F.lit(None).cast("string").alias("name"))
    after = spark.createDataFrame(after.agg(F.count("*").alias("id"), F.sum("price").alias("price")).collect(), "id long, price double").select(
        F.lit("changed").alias("kind"), "id", F.round("price", 2).alias("price"), F.lit(None).cast("string").alias("name")
    )
    restore_store(store, label)
    orders = store.table("orders").select(F.lit("order").alias("kind"), "id", "price", F.lit(None).cast("string").alias("name"))
    suppliers = store.table("suppliers").select(F.lit("supplier"), "id", F.lit(None).cast("double"), "name")
    return after.union(orders).union(suppliers)


@query
def S2_infer_responses(spark, sf):
    """Each response by itself, where it is parsed."""
    lists = landing(
        load(spark, sf, "orders"), "orders", "o_orderkey",
        to_body(F.array(
            F.struct(F.col("o_orderkey").alias("id"), F.lit(None).cast("bigint").alias("v")),
            F.struct(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("v")),
        )),
    )
    return infer_responses(lists).select("seq", "ordinal", "name", "type", "nullable")


@query
def T5_extra_columns(spark, sf):
    """Further columns of several types, given by value and by expression."""
    store = new_store(spark)
    extra = {"orders": {
        "origin": "landing", "weight": 0.5, "checked": True, "tags": {"a": [1]}, "loaded_at": dt.datetime(2024, 1, 2, 3, 4, 5),
        "response": ("BIGINT", F.col("seq") * 10),
    }}
    ingest(store, order_landing(spark, sf), Options(endpoints=ENDPOINTS, long_ints=True, extra_columns=extra), init=True)
    return store.table("orders").drop("dt")


@query
def U7_rejected_values(spark, sf):
    """Records whose value does not fit its column are kept with their text; the others are stored."""
    store = new_store(spark)
    orders = load(spark, sf, "orders")
    record = lambda value: to_body(F.array(F.struct(F.col("o_orderkey").alias("id"), value.alias("customer"))))
    ingest(store, landing(orders.filter("o_orderkey % 5 = 0"), "orders", "o_orderkey", record(F.col("o_custkey"))), LONG, init=True)
    text = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat(F.lit("c-"), "o_custkey"))
    ingest(store, landing(orders.filter("o_orderkey % 5 <> 0"), "orders", "o_orderkey", record(text)), LONG)
    rejects = spark.read.parquet(store.path("_rejects")).select(
        F.get_json_object("rejected_text", "$.id").cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("customer"),
        F.concat_ws(" ", "problem", F.get_json_object("rejected_text", "$.customer")).alias("problem"),
    )
    return store.table("orders").withColumn("problem", F.lit(None).cast("string")).unionByName(rejects)


@query
def R2_task_state_stream(spark, sf):
    """The last state and progress of each task, kept by a stream over a log that grows twice."""
    store, path, checkpoint = new_store(spark), shared_dir(spark, "runs"), shared_dir(spark, "run-stream")
    log = run_events(spark, sf).withColumns({
        "time": F.col("time").cast("timestamp"), "current_id": F.col("current_id").cast("string")
    })
    for half in (0, 1):
        append_run_events(log.filter(F.second("time") % 2 == half), path)
        run_log_stream(store, path, checkpoint).awaitTermination()
    return store.table("task_state").select(
        "run_id", "task", "status", "time", "error", "current", "total", "pct", F.col("current_id").cast("bigint").alias("current_id")
    )


@query
def R1_run_state_stream(spark, sf):
    """Succeeded and failed tasks of each run, kept by a stream over the log."""
    store, path = new_store(spark), shared_dir(spark, "runs")
    append_run_events(run_events(spark, sf).withColumns({
        "time": F.col("time").cast("timestamp"), "current_id": F.col("current_id").cast("string")
    }), path)
    run_log_stream(store, path, shared_dir(spark, "run-stream"), by_run=True).awaitTermination()
    return store.table("run_state")


@query
def R3_progress_of_nothing(spark, sf):
    """A total of zero has no percentage."""
    log = run_events(spark, sf).withColumn("total", F.when(F.col("task") == "task-3", 0).otherwise(F.col("total")))
    return progress(log).select("run_id", "task", "current", "total", "pct")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, infer, create, load, reload, read back: the whole way once."""
    return U7_ingest(prepare(spark), sf_dir)
