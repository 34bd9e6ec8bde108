"""Init and ingest: from landed responses to stored tables.

All responses of all entities go through together. The bodies are parsed once
into staged records; the driver sees only schema metadata. The only loop is
over tables.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from landfall.functions.names import quoted
from landfall.functions.values import SPARK_TYPES
from landfall.operators.checks import check_unique, check_unique_merge, orphans
from landfall.operators.drift import detect_drift
from landfall.operators.infer import infer_record_schema, infer_with_heads, map_types
from landfall.operators.keys import add_parents, apply_key_map, detect_keys, first_rows, key_map
from landfall.operators.reads import capped_ids
from landfall.operators.commits import CommitConflict, TableState
from landfall.operators.registry import SINGLETON, RegistryConflict, current_version, load_registry, resolve_schema, save_registry
from landfall.operators.tables import (
    KEY_PART,
    Store,
    TableColumn,
    TableSchema,
    column_defaults,
    create_table,
    evolve_table,
    in_partitions,
    key_part,
    open_state,
    replace_partitions,
    replace_table,
    table_exists,
    table_schemas,
)
from landfall.operators.upsert import ORDER, as_rows, last_wins, project_records, upsert
from landfall.plans.endpoints import ENDPOINTS, TABLE_KEYS, Endpoint
from landfall.session import local_frame, prepare, remove_dir, shared_dir
from landfall.sources.landing import (
    LARGEST_BODY,
    TOO_LARGE,
    inject_columns,
    normalize_response,
    route_all,
    route_large,
    with_endpoints,
)
from landfall.sources.logs import append_discovery, append_run_events

_COLUMN_SCHEMA = (
    "endpoint string, table_name string, ordinal int, name string, type string, "
    "nullable boolean, n_records bigint, n_present bigint"
)
_TABLES_AT_A_TIME = 4
# What a task that stages records holds at most: this many tables' open files, each with a row group of these bytes.
_OPEN_TABLES, _STAGED_GROUP = 32, 16 << 20


class IngestError(RuntimeError):
    """The batch cannot be stored as asked. A table takes a batch whole or not at all."""


@dataclass(frozen=True)
class Options:
    """How a batch is understood.

    ``extra``: fields that are not pinned are ignored (and logged), added to
    the table (``evolve``), or an error (``fail``). ``missing``: a field that a
    record lacks leaves the stored value (``null``) or is an error (``fail``).
    ``rejects``: bad bodies and values are kept aside (``keep``) or an error
    (``fail``). ``wide_parents`` stores parent ids as BIGINT; as INTEGER, an id
    that does not fit is a reject. ``faithful`` keys fan-out tables by ``id`` alone.
    ``references`` maps a table's columns to parent table and column; rows whose
    reference has no parent are kept (``keep``), become rejects (``reject``) or
    are an error (``fail``), as ``orphans`` says. ``extra_columns`` gives the
    tables of an endpoint further columns: a value, or (storage type, Column) over
    ``endpoint``, ``entity_id``, ``seq`` and ``pos``; they replace fields of their
    name. Bodies of ``largest_body`` bytes or more are split as text.
    """

    endpoints: Sequence[Endpoint] = ENDPOINTS
    keys: Mapping[str, object] = field(default_factory=lambda: dict(TABLE_KEYS))
    long_ints: bool = False
    wide_parents: bool = False
    faithful: bool = False
    extra: str = "ignore"
    missing: str = "null"
    rejects: str = "keep"
    infer: Mapping[str, bool] = field(default_factory=dict)
    references: Mapping[str, Mapping[str, tuple[str, str]]] = field(default_factory=dict)
    orphans: str = "reject"
    extra_columns: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    largest_body: int = LARGEST_BODY

    def extras(self, path: str) -> dict[str, tuple[str, Column]]:
        """Storage type and value of each extra column of an endpoint's tables."""
        path = path.rstrip("/")
        own = next((c for e, c in self.extra_columns.items() if e.rstrip("/") == path), {})
        return {name: _typed_value(value, self.long_ints) for name, value in own.items()}

    @property
    def parent_type(self) -> str:
        return "BIGINT" if self.wide_parents else "INTEGER"

    def endpoint(self, path: str) -> Endpoint:
        path = path.rstrip("/")
        return next((e for e in self.endpoints if e.path.rstrip("/") == path), Endpoint(path))


def _typed_value(value: object, long_ints: bool) -> tuple[str, Column]:
    """Storage type and column of a value as it would be inferred, or of a pair that says them."""
    if isinstance(value, tuple):
        return value
    if isinstance(value, bool):
        data_type = "BOOLEAN"
    elif isinstance(value, int):
        data_type = "BIGINT" if long_ints or abs(value) >= 2**31 else "INTEGER"
    elif isinstance(value, float):
        data_type = "DOUBLE"
    elif isinstance(value, datetime):
        data_type = "TIMESTAMP"
    elif isinstance(value, dict | list):
        data_type, value = "JSON", json.dumps(value, separators=(",", ":"), ensure_ascii=False)
    else:
        data_type, value = "TEXT", None if value is None else str(value)
    return data_type, F.lit(value)


@dataclass
class Staged:
    """A parsed batch: its records, its rejects, and its inferred columns.

    ``path`` is the folder of the records; who staged the batch removes it.
    """

    records: DataFrame
    rejects: DataFrame
    inferred: DataFrame
    columns: list
    unusable: list
    path: str
    clear: bool = False  # known to have no rejects

    @property
    def tables(self) -> list[str]:
        return sorted({r["table_name"] for r in self.columns})

    def endpoint_of(self, table: str) -> str:
        return next(r["endpoint"] for r in self.columns if r["table_name"] == table)


@dataclass
class TablePlan:
    schema: TableSchema
    endpoint: str
    parent: str | None
    keys: list[str]
    is_primary: bool
    problem: str | None


def stage(landing: DataFrame, options: Options = Options()) -> Staged:
    """Parse a landing once and keep its records by table in the shared folder.

    Map-only: each task writes a file per table it meets, so a table with most
    of the records is spread as the landing is, and a body with a very long
    list becomes a file whose row groups are read apart. Later steps read only
    their table. The files are open side by side, so a task neither sorts its
    records by table nor holds them, however many it has; only what comes
    after the first record of one table too many is sorted.
    """
    if options.infer.get("per_response"):
        raise ValueError("per_response is for infer_schema; an ingest has the names of every response")
    spark = prepare(landing.sparkSession)
    landing = normalize_response(with_endpoints(landing, {e.path: e.prefix for e in options.endpoints}))
    # Key order needs the text; it is looked up below for first responses only.
    routed, seen = route_all(landing, options.largest_body).drop("response_key", "keys"), Observation()
    too_large = F.coalesce(F.col("problem") == TOO_LARGE, F.lit(False))
    path = shared_dir(spark, "records")
    _write_by_table(routed.withColumn("rejected_text", F.when(~too_large, F.col("rejected_text"))).observe(
        seen, F.count_if(too_large).alias("large"), F.count_if(F.col("problem").isNotNull()).alias("bad")
    ), path)
    large = landing.filter(F.octet_length("body") >= options.largest_body) if seen.get["large"] else None
    if large is not None:
        _write_by_table(route_large(large).drop("response_key", "keys"), path)
    rows = spark.read.schema(routed.schema).parquet(path)
    good = rows.filter(F.col("problem").isNull()).drop("problem", "rejected_text")
    bad = rows.filter(F.col("problem").isNotNull() & ~too_large).select(
        "endpoint", "entity_id", "seq", "table_name", "pos", "problem", "rejected_text"
    )
    found = infer_with_heads(good, **{"every_response": True, **options.infer}).collect()
    columns, unusable = _usable(_in_text_order(landing, [r.asDict() for r in found], options.largest_body, large is not None))
    rows = [tuple(c[n] for n in _names(_COLUMN_SCHEMA)) for c in columns]
    clear = seen.get["bad"] == 0
    return Staged(good, bad, local_frame(spark, rows, _COLUMN_SCHEMA), columns, unusable, path, clear)


def _write_by_table(records: DataFrame, path: str) -> None:
    """Append records to the folders of their tables, without a sort by table."""
    conf, key = records.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, _OPEN_TABLES)
    try:
        records.write.mode("append").option("parquet.block.size", _STAGED_GROUP).partitionBy("table_name").parquet(path)
    finally:
        conf.set(key, before)


def _usable(columns: list[dict]) -> tuple[list[dict], list[dict]]:
    """Columns a table can have, and those it cannot.

    Column names do not differ in case alone: the first one in order is the
    column. A name with both quote signs has no path in a record.
    """
    seen, good, bad = set(), [], []
    for c in sorted(columns, key=lambda c: (c["table_name"], c["ordinal"])):
        name = (c["table_name"], c["name"].lower())
        fits = name not in seen and not {'"', "'"} <= set(c["name"])
        seen.add(name)
        (good if fits else bad).append(c)
    return good, bad


def _in_text_order(landing: DataFrame, columns: list[dict], largest: int, any_large: bool) -> list[dict]:
    """Inferred columns in the order of the text of each table's first record.

    Reads the responses that hold first records, at most one per table; the
    filter on ``seq`` reaches a parquet landing.
    """
    heads = {(c["table_name"], c["table_seq"]) for c in columns}
    if not heads:
        return columns
    first = landing.filter(F.col("seq").isin(sorted({seq for _, seq in heads})))
    texts = route_all(first, largest).filter(F.col("problem").isNull() & F.col("keys").isNotNull())
    if any_large:
        of_large = route_large(first.filter(F.octet_length("body") >= largest))
        texts = texts.unionByName(of_large.filter(F.col("problem").isNull() & F.col("keys").isNotNull()))
    keys = {
        r["table_name"]: list(dict.fromkeys(r["keys"]))
        for r in texts.select("table_name", "seq", "keys").collect()
        if (r["table_name"], r["seq"]) in heads
    }
    tables: dict[str, list[dict]] = {}
    for c in columns:
        tables.setdefault(c["table_name"], []).append(c)
    for table, own in tables.items():
        position = {name: i for i, name in enumerate(keys.get(table, []))}
        own.sort(key=lambda c: (position.get(c["name"], len(position)), c["ordinal"]))
        for i, c in enumerate(own):
            c["ordinal"] = i
    return [c for own in tables.values() for c in own]


def _names(schema: str) -> list[str]:
    return [f.strip().split(" ")[0] for f in schema.split(",")]


@dataclass
class BatchPlan:
    """Plans of all tables, and the metadata they come from."""

    tables: dict[str, TablePlan]
    columns: DataFrame
    mapped: DataFrame
    registry: DataFrame
    version: int | None


def _plan(store: Store, staged: Staged, options: Options) -> BatchPlan:
    """Schema, keys and parent of every table of the batch; metadata only."""
    spark = store.spark
    alike: dict[str, list[str]] = {}
    for table in staged.tables:
        alike.setdefault(table.lower(), []).append(table)
    version = current_version(spark, store.registry_path)
    registry = load_registry(spark, store.registry_path)
    registry = local_frame(spark, registry.collect(), registry.schema)
    mapped = map_types(staged.inferred, options.long_ints)
    resolved = resolve_schema(mapped, registry)
    parents = {}
    for table in staged.tables:
        parent = options.endpoint(staged.endpoint_of(table)).parent_column
        if parent:
            parents[table] = parent
    keymap = key_map(spark, options.keys)
    columns = add_parents(resolved, parents, options.parent_type)
    extras = {t: options.extras(staged.endpoint_of(t)) for t in staged.tables}
    for name, data_type in sorted({(n, k) for own in extras.values() for n, (k, _) in own.items()}):
        columns = add_parents(columns, {t: name for t, own in extras.items() if own.get(name, ("",))[0] == data_type}, data_type, True)
    columns = apply_key_map(columns, keymap)
    columns = local_frame(spark, columns.collect(), columns.schema)
    keys = {
        r["table_name"]: r
        for r in detect_keys(columns, keymap, None if options.faithful else parents).collect()
    }
    plans = {}
    for table, schema in table_schemas(columns).items():
        k, same = keys[table], alike[table.lower()]
        problem = f"tables '{same[0]}' and '{same[1]}' differ in case only" if len(same) > 1 else k["problem"]
        plans[table] = TablePlan(
            schema, staged.endpoint_of(table), parents.get(table), list(k["key_columns"] or []), k["is_primary"], problem
        )
    return BatchPlan(plans, columns, mapped, registry, version)


def _pin(store: Store, batch: BatchPlan, columns: DataFrame) -> None:
    """Save the schemas of some tables, unless another writer has changed those since the batch was planned."""
    tables = F.col("table_name").isin(sorted({r[0] for r in columns.select("table_name").distinct().collect()}))
    while True:
        try:
            batch.version = save_registry(columns, store.registry_path, (batch.version or 0) + 1)
            return
        except RegistryConflict:
            now = load_registry(store.spark, store.registry_path)
            then = batch.registry.filter(tables)
            if now.filter(tables).exceptAll(then).take(1):
                raise
            batch.version = current_version(store.spark, store.registry_path)


def init_tables(store: Store, landing: DataFrame | Staged, options: Options = Options()) -> list[str]:
    """Create the tables of a landing that do not exist, and pin their schemas.

    Inference uses all responses, so that a list which is empty for one entity
    does not hide its table. Returns the names of the created tables.
    """
    with _staged(landing, options) as staged:
        batch = _plan(store, staged, options)
        _set_aside(store, staged, batch, options, uuid.uuid4().hex)
        return _create(store, batch)


@contextmanager
def _staged(landing: DataFrame | Staged, options: Options) -> Iterator[Staged]:
    """The batch as it is, or staged for the time of its use."""
    if isinstance(landing, Staged):
        yield landing
        return
    staged = stage(landing, options)
    try:
        yield staged
    finally:
        remove_dir(landing.sparkSession, staged.path)


def _create(store: Store, batch: BatchPlan) -> list[str]:
    created = [t for t in batch.tables if not table_exists(store, t)]
    for table in created:
        create_table(store, batch.tables[table].schema, execute=True, keys=batch.tables[table].keys)
    if created:
        new = batch.columns.filter(F.col("table_name").isin(created))
        drift = detect_drift(batch.mapped.filter(F.col("table_name").isin(created)), batch.registry)
        _pin(store, batch, new)
        events = new.groupBy("table_name").agg(F.first("endpoint").alias("endpoint")).select(
            "endpoint", F.col("table_name").alias("table"), F.lit("table_created").alias("event")
        )
        append_discovery(drift.unionByName(events, allowMissingColumns=True).coalesce(1), store.discovery_path)
    return created


def ingest(
    store: Store, landing: DataFrame | Staged, options: Options = Options(), init: bool = False,
    batch: tuple[str, int] | None = None,
) -> dict[str, int]:
    """Upsert all records of a landing into their tables.

    Returns the number of records written per table, not of distinct keys. A
    table that does not exist is an error, unless ``init`` creates it. Tables
    are independent, so a few are written at a time: the tail of one does not
    leave the cluster idle; only a table that others refer to is written before
    them. ``batch`` names a stream and its batch: a table that has committed it
    is not written again.
    """
    with _staged(landing, options) as staged:
        return _ingest(store, staged, options, init, batch)


def _ingest(
    store: Store, staged: Staged, options: Options, init: bool, source: tuple[str, int] | None = None
) -> dict[str, int]:
    # Rejects of a repeated batch take the place of the first ones.
    tag = uuid.uuid4().hex if source is None else f"{zlib.crc32(source[0].encode()):08x}-{source[1]}"
    batch = _plan(store, staged, options)
    _set_aside(store, staged, batch, options, tag)
    created = _create(store, batch) if init else []
    absent = [t for t in batch.tables if not table_exists(store, t)]
    if absent:
        raise IngestError(f"There is no table '{absent[0]}' yet: '{absent[0]}' does not exist; an init makes it.")
    if options.rejects == "fail":
        bad = staged.rejects.take(1)
        if bad:
            raise IngestError(f"{bad[0]['endpoint']}: {bad[0]['problem']}: {bad[0]['rejected_text']}")
    if options.rejects != "fail" and not staged.clear and not staged.rejects.isEmpty():
        _keep_rejects(store, tag, "responses", staged.rejects)
    if staged.unusable:
        _log_unusable(store, staged, options)
    if options.missing == "fail":
        _refuse_missing(staged)
    if len(created) < len(batch.tables):
        _handle_drift(store, batch, options)
    write = inheritable_thread_target(store.spark)(lambda plan: _ingest_table(store, staged, plan, options, tag, source))
    counts: dict[str, int] = {}
    for wave in _waves(sorted(batch.tables), options.references):
        with ThreadPoolExecutor(_TABLES_AT_A_TIME) as pool:
            counts |= zip(wave, pool.map(write, [batch.tables[t] for t in wave]), strict=True)
    return {t: counts[t] for t in sorted(counts)}


def _waves(tables: Sequence[str], references: Mapping[str, Mapping]) -> Iterator[list[str]]:
    """The tables in turns, each after those that it refers to; tables that refer to each other go together."""
    left = list(tables)
    while left:
        parents = {t: {p for p, _ in references.get(t, {}).values()} - {t} for t in left}
        ready = [t for t in left if not parents[t] & set(left)] or left
        yield ready
        left = [t for t in left if t not in ready]


def _set_aside(store: Store, staged: Staged, batch: BatchPlan, options: Options, tag: str) -> None:
    """Tables that cannot be stored become rejects, so that the others can; an error if there are no others."""
    bad = {t: p.problem for t, p in batch.tables.items() if p.problem}
    if not bad:
        return
    if options.rejects == "fail" or len(bad) == len(batch.tables):
        raise IngestError(next(iter(bad.values())))
    for table, problem in bad.items():
        del batch.tables[table]
        records = staged.records.filter(F.col("table_name") == table)
        _keep_rejects(store, tag, f"{table}-", records.withColumns({"problem": F.lit(problem), "rejected_text": F.to_json("record")}))


def _log_unusable(store: Store, staged: Staged, options: Options) -> None:
    """Fields that no column can hold are logged, or an error."""
    if options.extra == "fail":
        c = staged.unusable[0]
        raise IngestError(f"{c['table_name']}: no column can be called '{c['name']}'")
    rows = [(c["endpoint"], c["table_name"], "unusable_name", c["name"]) for c in staged.unusable]
    events = local_frame(store.spark, rows, "endpoint string, table string, event string, column string")
    append_discovery(events.coalesce(1), store.discovery_path)


def _refuse_missing(staged: Staged) -> None:
    """Every record of a response must have the fields of its first one."""
    lacking = infer_record_schema(staged.records, per_response=True).filter("n_present < n_records").take(1)
    if lacking:
        r = lacking[0]
        raise IngestError(f"{r['endpoint']}: a record of {r['table_name']} lacks '{r['name']}'")


def _handle_drift(store: Store, batch: BatchPlan, options: Options) -> None:
    events = detect_drift(batch.mapped, batch.registry)
    drift = events.collect()
    if not drift:
        return
    if options.extra == "fail":
        raise IngestError(f"{drift[0]['table']}: column '{drift[0]['column']}' is not pinned")
    append_discovery(local_frame(store.spark, drift, events.schema).coalesce(1), store.discovery_path)
    if options.extra != "evolve":
        return
    evolved = []
    for table in sorted({d["table"] for d in drift}):
        plan = batch.tables[table]
        added = [TableColumn(d["column"], d["type"]) for d in drift if d["table"] == table]
        evolve_table(store, table, added)
        plan.schema = TableSchema(table, (*plan.schema.columns, *added), plan.schema.table_key)
        evolved += [
            (plan.endpoint, table, i, c.name, c.data_type, c.nullable, c.primary_key, c.unique, c.default,
             plan.schema.table_key, *(c.references or (None, None)))
            for i, c in enumerate(plan.schema.columns)
        ]
    _pin(store, batch, local_frame(store.spark, evolved, batch.columns.schema))


def _ingest_table(
    store: Store, staged: Staged, plan: TablePlan, options: Options, tag: str, batch: tuple[str, int] | None
) -> int:
    spark, table, schema = store.spark, plan.schema.table_name, plan.schema
    state = open_state(store, table)
    if batch is not None and state.batches.get(batch[0], -1) >= batch[1]:
        return 0  # this table committed the batch before the stream failed
    arrived = {r["name"]: r for r in staged.columns if r["table_name"] == table}
    single = options.keys.get(table) == "singleton" or schema.table_key == SINGLETON
    injected = {plan.parent: (options.parent_type, F.col("entity_id"))} if plan.parent else {}
    injected |= options.extras(plan.endpoint)
    lacking = [TableColumn(n, t) for n, (t, _) in injected.items() if n not in store.table(table).columns]
    if lacking:
        evolve_table(store, table, lacking)
    stored = {c.lower() for c in store.table(table).columns}
    made = {*injected, *(["id"] if single else [])}
    columns = [
        c for c in schema.columns if c.name in arrived and c.name not in made and c.name.lower() in stored
    ]

    records = staged.records.filter(F.col("table_name") == table)
    # A field may be called like one of our own columns: the batch is known as c0, c1, ... until it is staged.
    names = [c.name for c in schema.columns if c.name in {*made, *(c.name for c in columns)}]
    own = {n: f"c{i}" for i, n in enumerate(names)}
    if not set(plan.keys) <= set(own):
        raise IngestError(f"{table}: the batch has no {', '.join(sorted(set(plan.keys) - set(own)))}")
    keys = [own[k] for k in plan.keys]
    # The record goes along, unread until it is asked for: the text of a reject is written from it.
    rows = project_records(
        records.withColumn("rejected_text", F.col("record")), [(c.name, c.data_type) for c in columns],
        carried=("endpoint", "entity_id", "seq", "pos", "rejected_text"), aliases=[own[c.name] for c in columns],
    )
    for name, (data_type, value) in injected.items():
        spark_type = next((c.spark_type for c in schema.columns if c.name == name), SPARK_TYPES[data_type])
        rows = inject_columns(rows, {own[name]: value.try_cast(spark_type)})
        unfit = value.isNotNull() & F.col(own[name]).isNull()
        rows = rows.withColumn("problem", F.coalesce("problem", F.when(unfit, F.lit(f"{name} does not fit"))))
    if single:
        rows = first_rows(rows, own["id"])
    required = {c.name for c in schema.columns if not c.nullable or c.primary_key} & set(names)
    required |= set(plan.keys) if plan.is_primary else set()
    problem = F.col("problem")
    for name in sorted(required):
        problem = F.coalesce(problem, F.when(F.col(own[name]).isNull(), F.lit(f"null in {name}")))
    rows = rows.withColumn("problem", problem)

    # One pass checks, counts and reduces the batch; nothing is stored before it is whole.
    seen = Observation()
    counted = rows.observe(
        seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("problem").isNotNull()).alias("n_bad")
    )
    good = counted.filter(F.col("problem").isNull())
    null_keys = not plan.is_primary
    uniform = all(arrived[c.name]["n_present"] == arrived[c.name]["n_records"] for c in columns)
    found = None if uniform else "found"
    if found:
        always = F.array(*[F.lit(own[n]) for n in names if n in made]).cast("array<string>")
        good = good.withColumn("found", F.array_union("found", always))
    reduced = last_wins(
        good.select(*own.values(), *ORDER, *([found] if found else [])), keys, ORDER, null_keys=null_keys, found=found
    )
    path = shared_dir(spark, f"batch-{table}")
    reduced, size = reduced.drop(*ORDER), Observation()
    hidden = KEY_PART in store.layout(table)
    if hidden:
        reduced = reduced.withColumn(KEY_PART, key_part(store, table, keys))
    reduced.observe(size, F.sum(_row_bytes(reduced)).alias("n")).write.parquet(path)
    counts = seen.get
    if counts["n_bad"]:
        bad = rows.filter(F.col("problem").isNotNull())
        if options.rejects == "fail":
            first = bad.select("seq", "pos", "problem").first()
            remove_dir(spark, path)
            raise IngestError(f"{table}: {first['problem']} (response {first['seq']}, record {first['pos']})")
        _keep_rejects(store, tag, table, bad.withColumn("table_name", F.lit(table)))

    incoming = spark.read.parquet(path).select(*[F.col(c).alias(n) for n, c in own.items()], *([KEY_PART] if hidden else []))
    optional = [n for n in names if n not in plan.keys] if found else []
    # What a broadcast of the batch takes in memory was measured as it was written.
    small = (size.get["n"] or 0) <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    try:
        incoming, n_orphans = _without_orphans(store, table, incoming, options, optional, small, tag)
        _merge(store, table, incoming, plan, null_keys, optional, small, state, batch)
    finally:
        remove_dir(spark, path)
    return counts["n"] - counts["n_bad"] - n_orphans


def _without_orphans(
    store: Store, table: str, incoming: DataFrame, options: Options, optional: list[str], small: bool, tag: str
) -> tuple[DataFrame, int]:
    """The batch without the rows whose references have no parent, which become rejects, and their number."""
    gone = 0
    for column, (parent, parent_column) in options.references.get(table, {}).items():
        if column not in incoming.columns or options.orphans == "keep":
            continue
        flat = incoming.withColumn(column, F.col(quoted(column))["v"]) if column in optional else incoming
        known = store.table(parent).select(quoted(parent_column)) if table_exists(store, parent) else None
        if known is None:
            raise IngestError(f"{table}: '{column}' refers to '{parent}', which does not exist")
        path = shared_dir(store.spark, f"orphans-{table}")
        lost = orphans(flat, column, known, parent_column, small)
        lost.write.parquet(path)
        lost = store.spark.read.schema(lost.schema).parquet(path)
        first = lost.take(1)
        if not first:
            remove_dir(store.spark, path)
            continue
        if options.orphans == "fail":
            remove_dir(store.spark, path)
            raise IngestError(f"{table}: {column} = {first[0][0]} has no {parent}.{parent_column}")
        # The orphaned references of a batch that fits a broadcast fit one, too.
        lost = F.broadcast(lost) if small else lost
        ours = flat.withColumn("orphaned", F.col(quoted(column)))
        bad = ours.join(lost, F.col("orphaned") == F.col("value"), "left_semi").drop("orphaned", KEY_PART)
        rejected = bad.select(
            F.lit(table).alias("table_name"), F.to_json(F.struct(*[F.col(quoted(c)) for c in bad.columns])).alias("rejected_text"),
            F.concat(F.lit(f"{column} has no {parent}.{parent_column}: "), F.col(quoted(column)).cast("string")).alias("problem"),
            *[F.lit(None).cast(t).alias(n) for n, t in (("endpoint", "string"), ("entity_id", "bigint"), ("seq", "bigint"), ("pos", "int"))],
        )
        _keep_rejects(store, tag, f"{table}.{column}", rejected)
        gone += bad.count()
        value = F.col(quoted(column))["v"] if column in optional else F.col(quoted(column))
        incoming = incoming.withColumn("orphaned", value).join(lost, F.col("orphaned") == F.col("value"), "left_anti").drop("orphaned")
    return incoming, gone


def _keep_rejects(store: Store, batch_id: str, part: str, bad: DataFrame) -> None:
    """Rejects of one batch and table, in a folder of their own: tables are written side by side."""
    if dict(bad.dtypes)["rejected_text"] == "variant":
        bad = bad.withColumn("rejected_text", F.to_json("rejected_text"))
    rows = bad.select("endpoint", "entity_id", "seq", "pos", "problem", "table_name", "rejected_text")
    rows.write.mode("overwrite").parquet(f"{store.path('_rejects')}/batch={batch_id}/part={part}")


def _row_bytes(rows: DataFrame) -> Column:
    """Bytes of a row in memory, at most: 16 a column, and its text."""
    total = F.lit(16 * (len(rows.columns) + 1))
    for f in rows.schema.fields:
        value, kind = F.col(quoted(f.name)), f.dataType
        if isinstance(kind, StructType):
            value, kind = value["v"], kind["v"].dataType
            total = total + 16
        if isinstance(kind, StringType):
            total = total + F.coalesce(F.octet_length(value), F.lit(0))
    return total.cast("long")


def _merge(
    store: Store, table: str, incoming: DataFrame, plan: TablePlan, null_keys: bool, optional: list[str], small: bool,
    state: TableState, batch: tuple[str, int] | None,
) -> None:
    """Write the next version of a table: what it holds, after a batch.

    Where a table has partitions or key parts, only those that the batch
    touches are read, by literals in the scan, and written again.
    """
    stored, defaults = store.stored(table), column_defaults(plan.schema)
    parts = store.layout(table)
    others = [c.name for c in plan.schema.columns if c.unique and [c.name] != plan.keys and c.name in stored.columns]
    first_load = state.version == 0 and stored.isEmpty()

    def refuse(name: str) -> None:
        raise IngestError(f"{table}: '{name}' is not unique")

    full = []
    for name in others:
        if name in defaults and (name not in incoming.columns or name in optional):
            full.append(name)  # inserted rows share the default
        elif name in incoming.columns:
            if check_unique_merge(stored, incoming, plan.keys, name, name in optional, small).take(1):
                refuse(name)

    def unique(version: DataFrame) -> None:
        for name in full:
            if check_unique(version, [name]).take(1):
                refuse(name)

    merge = lambda old: (
        as_rows(incoming, old, optional, defaults)
        if first_load
        else upsert(old, incoming, plan.keys, null_keys, small, optional, defaults)
    )
    if not parts:
        replace_table(store, table, merge(stored), plan.keys, unique if full else None, state, batch)
        return
    # As many as partitions that are written anew, each of which is an entry of the catalog.
    touched = [tuple(r) for r in incoming.select(*map(quoted, parts)).distinct().collect()]
    merged = merge(stored.filter(in_partitions(parts, touched)))
    if not small:
        # The join has spread the rows by key: a partition would else be a file of every task.
        merged = merged.hint("rebalance", *[F.col(quoted(p)) for p in parts])
    if full:
        rest = stored.filter(~F.coalesce(in_partitions(parts, touched), F.lit(False)))
        unique(merged.select(*full).unionByName(rest.select(*full)))
    replace_partitions(store, table, merged, plan.keys, base=state, batch=batch)


def ingest_fanout(
    store: Store,
    landing: DataFrame,
    parent_ids: DataFrame | None = None,
    options: Options = Options(),
    max_ids: int | None = None,
    init: bool = False,
) -> dict[str, int]:
    """Ingest the responses of a parameterised endpoint, all parents in one go.

    ``landing`` may hold several endpoints. Only responses of ``parent_ids``
    count, by default the ids in the parent table of their own endpoint;
    ``max_ids`` takes the first ids of each in order.
    """

    def ids_of(parents: DataFrame) -> DataFrame:
        ids = capped_ids(parents, parents.columns[0], max_ids) if max_ids else parents
        return ids.select(F.col(quoted(ids.columns[0])).cast("bigint").alias("entity_id"))

    if parent_ids is not None:
        return ingest(store, landing.join(ids_of(parent_ids), "entity_id", "left_semi"), options, init=init)
    name = F.rtrim(F.trim("endpoint"), F.lit("/"))
    paths = sorted(r[0] for r in landing.select(name).distinct().collect())  # endpoints are configuration
    endpoints = [options.endpoint(path) for path in paths]
    if not endpoints or any(e.parent_table is None for e in endpoints):
        raise IngestError("no parent table is known for this endpoint")
    known = [
        ids_of(store.table(e.parent_table).select(quoted(e.parent_key))).withColumn("own_path", F.lit(path))
        for path, e in zip(paths, endpoints, strict=True)
    ]
    wanted = landing.withColumn("own_path", name).join(reduce(DataFrame.union, known), ["own_path", "entity_id"], "left_semi")
    return ingest(store, wanted.drop("own_path"), options, init=init)


@contextmanager
def logged_task(store: Store, run_id: str, task: str) -> Iterator[Callable[..., None]]:
    """Log start and end of a task with its duration, and the error if it fails.

    Gives a function that logs progress: ``report(current, total, current_id)``.
    """

    def log(
        status: str, duration: float | None = None, error: str | None = None, current: int | None = None,
        total: int | None = None, current_id: object = None,
    ) -> None:
        shown = None if current_id is None else str(current_id)
        row = local_frame(
            store.spark,
            [(run_id, task, status, time.time_ns(), duration, error, current, total, shown)],
            "run_id string, task string, status string, number bigint, duration_s double, error string, "
            "current bigint, total bigint, current_id string",
        )
        append_run_events(row.coalesce(1), store.run_log_path)

    def report(current: int, total: int, current_id: object = None) -> None:
        log("running", current=current, total=total, current_id=current_id)

    log("started")
    begun = time.time()
    try:
        yield report
    except Exception as e:
        log("failed", round(time.time() - begun, 1), str(e))
        raise
    log("success", round(time.time() - begun, 1))
