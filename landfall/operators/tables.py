"""Tables: create, evolve, replace by version, snapshot and restore.

A table is an external parquet table. A write makes a new folder
``<root>/<table>/v<n>``, commits it (see ``commits``) and switches the catalog
to it; a task or job that fails leaves the table as it was. The folder holds
the whole table, or the partitions that the write touches: those of
``partition_by`` columns, or key parts (``parts``), into which a table's rows
are dealt by a hash of their key. An unpartitioned table is switched at once, so
that a reader sees all of a batch or nothing; partitions are switched one by
one, and ``read_version`` reads exactly one commit of either. A table may
be bucketed by its key, which saves the merge the shuffle of the stored side.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.names import quoted
from landfall.functions.values import SPARK_TYPES
from landfall.operators import commits
from landfall.operators.commits import TableState
from landfall.operators.registry import DEFINITION_SCHEMA, load_definitions, load_registry, path_exists, registry_columns, save_registry
from landfall.session import local_frame

#: The hidden partition column of a table that is laid out by key parts.
KEY_PART = "_key_part"
_VERSION = "landfall.version"


@dataclass(frozen=True)
class TableColumn:
    name: str
    data_type: str
    nullable: bool = True
    primary_key: bool = False
    unique: bool = False
    default: str | None = None
    references: tuple[str, str] | None = None

    @property
    def spark_type(self) -> str:
        return SPARK_TYPES.get(self.data_type, "string")

    @property
    def ddl(self) -> str:
        """The column in a CREATE TABLE statement."""
        null = "" if self.nullable else " NOT NULL"
        default = "" if self.default is None else f" DEFAULT {self.default}"
        return f"{quoted(self.name)} {self.spark_type.upper()}{null}{default}"


@dataclass(frozen=True)
class TableSchema:
    table_name: str
    columns: tuple[TableColumn, ...]
    table_key: str | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.columns if c.primary_key]


def table_schemas(columns: DataFrame) -> dict[str, TableSchema]:
    """Table columns (as ``map_types`` gives them) on the driver: metadata only."""
    tables: dict[str, list] = {}
    keys: dict[str, str | None] = {}
    for r in sorted(columns.collect(), key=lambda r: (r["table_name"], r["ordinal"])):
        references = (r["references_table"], r["references_column"]) if r["references_table"] else None
        tables.setdefault(r["table_name"], []).append(
            TableColumn(
                r["name"], r["data_type"], r["nullable"], r["primary_key"], r["unique"], r["default_value"], references
            )
        )
        keys[r["table_name"]] = r["table_key"]
    return {t: TableSchema(t, tuple(cols), keys[t]) for t, cols in tables.items()}


@dataclass
class Store:
    """Where tables, registry and logs live.

    ``buckets`` maps a table to its number of key buckets and
    ``partition_by`` a table to its partition columns, which must be key
    columns, normally the injected parent id. ``parts`` maps a table without
    such columns to a number of key parts: a batch then reads and rewrites only
    the parts its keys fall in. A layout is chosen before the table is created.
    """

    spark: SparkSession
    root: str
    database: str | None = None
    buckets: dict[str, int] = field(default_factory=dict)
    partition_by: dict[str, list[str]] = field(default_factory=dict)
    parts: dict[str, int] = field(default_factory=dict)

    def layout(self, table: str) -> list[str]:
        """The columns by which a table's folders are apart."""
        return list(self.partition_by.get(table) or ([KEY_PART] if self.parts.get(table) else []))

    def qualify(self, table: str) -> str:
        return f"{quoted(self.database)}.{quoted(table)}" if self.database else quoted(table)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def registry_path(self) -> str:
        return self.path("_registry")

    @property
    def run_log_path(self) -> str:
        return self.path("_log", "runs")

    @property
    def discovery_path(self) -> str:
        return self.path("_log", "discovery")

    def stored(self, name: str) -> DataFrame:
        """The table with its hidden column, if it has one."""
        return self.spark.table(self.qualify(name))

    def table(self, name: str) -> DataFrame:
        return self.stored(name).drop(KEY_PART)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _layout(store: Store, name: str, keys: Sequence[str]) -> str:
    clauses, parts = [], store.layout(name)
    if parts:
        clauses.append("PARTITIONED BY (" + ", ".join(quoted(c) for c in parts) + ")")
    bucket_keys = [k for k in keys if k not in parts]
    if store.buckets.get(name) and bucket_keys:
        cols = ", ".join(quoted(k) for k in bucket_keys)
        clauses.append(f"CLUSTERED BY ({cols}) INTO {store.buckets[name]} BUCKETS")
    return "\n".join(clauses)


def create_table(
    store: Store, schema: TableSchema, execute: bool = False, if_not_exists: bool = True, keys: Sequence[str] = ()
) -> str:
    """The CREATE TABLE statement of a schema; run only when asked.

    NOT NULL and DEFAULT are part of the columns. Keys, unique columns and
    references become table properties: storage does not enforce them, the
    ingest and the checks do.
    """
    name = schema.table_name
    properties = {
        "primary_key": ", ".join(schema.primary_key),
        "unique": ", ".join(c.name for c in schema.columns if c.unique),
        "foreign_keys": ", ".join(f"{c.name} -> {c.references[0]}({c.references[1]})" for c in schema.columns if c.references),
        "json_columns": ", ".join(c.name for c in schema.columns if c.data_type == "JSON"),
    }
    shown = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items() if v)
    statement = "\n".join(
        part
        for part in [
            f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{store.qualify(name)} (",
            "  " + ",\n  ".join([*(c.ddl for c in schema.columns), *([f"{KEY_PART} INT"] if KEY_PART in store.layout(name) else [])]),
            ") USING parquet",
            _layout(store, name, keys or schema.primary_key),
            f"LOCATION {_literal(store.path(name, 'v0'))}",
            f"TBLPROPERTIES ({shown})" if shown else "",
        ]
        if part
    )
    if execute:
        if store.database:
            store.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {quoted(store.database)} LOCATION {_literal(store.path('_database'))}"
            )
        store.spark.sql(statement)
    return statement


def table_exists(store: Store, name: str) -> bool:
    return store.spark.catalog.tableExists(store.qualify(name))


def evolve_table(store: Store, name: str, columns: Sequence[TableColumn]) -> list[str]:
    """Add the columns the table lacks; old rows read null, or the default."""
    present = {c.lower() for c in store.table(name).columns}
    new = [c for c in columns if c.name.lower() not in present]
    if new:
        added = ", ".join(
            f"{quoted(c.name)} {c.spark_type}" + (f" DEFAULT {c.default}" if c.default is not None else "") for c in new
        )
        store.spark.sql(f"ALTER TABLE {store.qualify(name)} ADD COLUMNS ({added})")
    return [c.name for c in new]


def column_defaults(schema: TableSchema) -> dict[str, Column]:
    """What inserted rows get in columns they lack; a matched row keeps its value."""
    return {c.name: F.expr(c.default).cast(c.spark_type) for c in schema.columns if c.default is not None}


def table_location(store: Store, name: str) -> str:
    rows = store.spark.sql(f"DESCRIBE TABLE EXTENDED {store.qualify(name)}")
    return rows.filter("col_name = 'Location'").select("data_type").first()[0]


def open_state(store: Store, name: str) -> TableState:
    """The last commit of a table; the catalog is brought to it if a writer died before it did so."""
    spark, root = store.spark, store.path(name)
    state, _ = commits.last_commit(spark, root)
    if state is None:
        return _unwritten(store, name)
    shown = spark.sql(f"SHOW TBLPROPERTIES {store.qualify(name)}").filter(F.col("key") == _VERSION).collect()
    if not shown or int(shown[0]["value"]) != state.version:
        _publish(store, name, state, dict.fromkeys(_shown_partitions(store, name), ""))
    return state


def _unwritten(store: Store, name: str) -> TableState:
    """The state of a table without commits: as it was created, or written before there were any."""
    location = table_location(store, name).rstrip("/").rsplit("/", 1)[1]
    number = int(location.removeprefix("v")) if location.removeprefix("v").isdigit() else 0
    if not store.layout(name):
        return TableState(number, {"": location})
    return TableState(number, {p: f"{location}/{p}" for p in _shown_partitions(store, name)})


def _shown_partitions(store: Store, name: str) -> list[str]:
    if not store.layout(name):
        return []
    return [r[0] for r in store.spark.sql(f"SHOW PARTITIONS {store.qualify(name)}").collect()]


def _commit(store: Store, name: str, base: TableState, folders: Mapping[str, str], batch: tuple[str, int] | None) -> TableState:
    """Commit new folders on top of ``base`` and switch the catalog to them."""
    spark, root = store.spark, store.path(name)
    last, number = commits.last_commit(spark, root)
    if last is not None and last.version != base.version:
        raise commits.CommitConflict(f"{name}: version {last.version} was written by another writer")
    state = TableState(base.version + 1, dict(folders), dict(commits.stream_tag(batch, base)))
    commits.write_commit(spark, root, number, state)
    _publish(store, name, state, base.folders)
    return state


def _publish(store: Store, name: str, state: TableState, shown: Mapping[str, str]) -> None:
    """Switch the catalog from the folders it shows to those of a state; may be repeated."""
    spark, qualified = store.spark, store.qualify(name)
    if not store.layout(name):
        spark.sql(f"ALTER TABLE {qualified} SET LOCATION {_literal(store.path(name, state.folders['']))}")
    else:
        new = [p for p in state.folders if p not in shown]
        for at in range(0, len(new), 500):
            clauses = " ".join(f"PARTITION {_spec(p)} LOCATION {_literal(store.path(name, state.folders[p]))}" for p in new[at : at + 500])
            spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS {clauses}")
        for p, folder in state.folders.items():
            if p in shown and shown[p] != folder:
                spark.sql(f"ALTER TABLE {qualified} PARTITION {_spec(p)} SET LOCATION {_literal(store.path(name, folder))}")
        for p in shown:
            if p not in state.folders:
                spark.sql(f"ALTER TABLE {qualified} DROP IF EXISTS PARTITION {_spec(p)}")
    spark.sql(f"ALTER TABLE {qualified} SET TBLPROPERTIES ('{_VERSION}' = '{state.version}')")
    spark.catalog.refreshTable(qualified)


def _spec(label: str) -> str:
    """A partition in SQL."""
    pairs = [f"{quoted(k)} = {'null' if v is None else _literal(v)}" for k, v in commits.partition_values(label)]
    return "(" + ", ".join(pairs) + ")"


def _new_folder(store: Store, name: str, state: TableState) -> str:
    """A folder that no write has used."""
    folder = f"v{state.version + 1}"
    return f"{folder}-{uuid.uuid4().hex[:8]}" if path_exists(store.spark, store.path(name, folder)) else folder


def key_part(store: Store, name: str, keys: Sequence[str]) -> Column:
    """The key part of a row. Rows with a null key match nothing and are spread by all of their key columns and a number."""
    key_columns = [F.col(quoted(k)) for k in keys]
    unset = ~reduce(and_, [c.isNotNull() for c in key_columns])
    number = F.when(unset, F.monotonically_increasing_id())
    return F.pmod(F.xxhash64(*[c.cast("string") for c in key_columns], number), F.lit(store.parts[name])).cast("int")


def replace_table(
    store: Store,
    name: str,
    rows: DataFrame,
    keys: Sequence[str] = (),
    check: Callable[[DataFrame], None] | None = None,
    base: TableState | None = None,
    batch: tuple[str, int] | None = None,
) -> str:
    """Write ``rows`` as the next version and switch the table to it.

    The columns are written by name in the table's order. ``check`` sees the
    new version before the switch and may raise. ``base`` is the state that
    ``rows`` were made from, by default the last one; ``batch`` names a stream
    and its batch that the version holds. Returns the location.
    """
    spark = store.spark
    if store.layout(name):
        return replace_partitions(store, name, rows, keys, check=check, base=base, batch=batch, whole=True)
    state = base or open_state(store, name)
    folder = _new_folder(store, name, state)
    location = store.path(name, folder)
    rows = rows.select(*[F.col(quoted(c)) for c in store.table(name).columns])
    writer = rows.write.mode("overwrite")
    if store.buckets.get(name) and keys:
        # Only a catalog write can bucket; its entry goes again, the files stay.
        step = store.qualify(f"{name}__{folder.replace('-', '_')}")
        spark.sql(f"DROP TABLE IF EXISTS {step}")
        writer.bucketBy(store.buckets[name], *keys).option("path", location).format("parquet").saveAsTable(
            step.replace("`", "")
        )
        spark.sql(f"DROP TABLE {step}")
    else:
        writer.parquet(location)
    if check is not None:
        check(spark.read.schema(rows.schema).parquet(location))
    _commit(store, name, state, {"": folder}, batch)
    return location


def replace_partitions(
    store: Store,
    name: str,
    rows: DataFrame,
    keys: Sequence[str] = (),
    check: Callable[[DataFrame], None] | None = None,
    base: TableState | None = None,
    batch: tuple[str, int] | None = None,
    whole: bool = False,
) -> str:
    """Replace just the partitions that ``rows`` holds; with ``whole`` all others go.

    The new partitions are written into a folder of their own, so ``rows`` may
    come from the table itself; the old ones stay until ``drop_old_versions``.
    Arguments as those of ``replace_table``.
    """
    spark, parts = store.spark, store.layout(name)
    state = base or open_state(store, name)
    folder = _new_folder(store, name, state)
    location = store.path(name, folder)
    if parts == [KEY_PART] and KEY_PART not in rows.columns:
        rows = rows.withColumn(KEY_PART, key_part(store, name, keys))
    rows = rows.select(*[F.col(quoted(c)) for c in store.stored(name).columns])
    rows.write.mode("overwrite").partitionBy(*parts).parquet(location)
    if check is not None:
        check(spark.read.schema(rows.schema).parquet(location))
    written = {p: f"{folder}/{p}" for p in commits.partition_folders(spark, location, len(parts))}
    _commit(store, name, state, written if whole else {**state.folders, **written}, batch)
    return location


def in_partitions(columns: Sequence[str], values: Sequence[Sequence]) -> Column:
    """Whether a row lies in one of the partitions; literals, so that only those are read."""
    def one(column: str, wanted: set) -> Column:
        c = F.col(quoted(column))
        found = c.isin(sorted(v for v in wanted if v is not None)) if wanted - {None} else F.lit(False)
        return found | c.isNull() if None in wanted else found

    if not values:
        return F.lit(False)
    if len(columns) == 1 or len(values) > 500:
        return reduce(and_, [one(c, {v[i] for v in values}) for i, c in enumerate(columns)])
    return reduce(or_, [reduce(and_, [one(c, {x}) for c, x in zip(columns, v, strict=True)]) for v in values])


def read_version(store: Store, name: str, state: TableState | None = None) -> DataFrame:
    """Exactly one commit of a table, by default the last, whatever the catalog shows at the time."""
    spark, stored = store.spark, store.stored(name)
    state = state or open_state(store, name)
    if not store.layout(name):
        folder = store.path(name, state.folders[""])
        if not path_exists(spark, folder):
            return stored.limit(0)
        return spark.read.schema(stored.schema).parquet(folder)
    versions: dict[str, list[str]] = {}
    for label, folder in state.folders.items():
        versions.setdefault(folder.removesuffix(label).rstrip("/"), []).append(store.path(name, folder))
    read = [spark.read.schema(stored.schema).option("basePath", store.path(name, v)).parquet(*paths) for v, paths in versions.items()]
    columns = [F.col(quoted(c)) for c in stored.columns if c != KEY_PART]
    return reduce(DataFrame.unionByName, read, stored.limit(0)).select(*columns)


def drop_old_versions(store: Store, name: str, keep: int = 2) -> list[str]:
    """Delete the folders that only older versions than the last ``keep`` consist of.

    What a snapshot of the store holds stays. Returns the deleted folders.
    """
    spark, root = store.spark, store.path(name)
    current, found = open_state(store, name), commits.numbers(spark, root)
    recent = found[max(0, len(found) - keep) :]
    held = set(current.folders.values())
    held |= {f for n in recent if (s := commits.read_commit(spark, root, n)) for f in s.folders.values()}
    for label in snapshots(store):
        held |= set(_snapshot(store, label)["tables"].get(name, {}).get("folders", {}).values())
    depth, dropped = len(store.layout(name)), []
    for version in commits.names_in(spark, root):
        number = version.removeprefix("v").split("-")[0]
        # A later number is that of a write on its way.
        if not version.startswith("v") or not number.isdigit() or int(number) > current.version:
            continue
        inside = [f"{version}/{p}".rstrip("/") for p in commits.partition_folders(spark, f"{root}/{version}", depth)]
        gone = [f for f in inside if f not in held]
        if len(gone) == len(inside):
            gone = [version]
        for folder in gone:
            commits.remove_folder(spark, store.path(name, folder))
            dropped.append(store.path(name, folder))
    for n in found[: max(0, len(found) - keep)]:
        commits.remove_commit(spark, root, n)
    return dropped


def snapshot_store(store: Store, tables: Sequence[str], label: str | None = None) -> str:
    """Hold the tables and the registry as they are now, under a label; returns it.

    A snapshot is a manifest of immutable folders: it copies no data, and
    ``drop_old_versions`` leaves them alone.
    """
    label = label or datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    held = {}
    for name in tables:
        if table_exists(store, name):
            state = open_state(store, name)
            held[name] = {**asdict(state), "schema": store.stored(name).schema.json()}
    pinned = [r.asDict(recursive=True) for r in load_definitions(store.spark, store.registry_path).collect()]
    manifest = {"tables": held, "registry": pinned}
    if not commits.create_text(store.spark, store.path("_snapshots", f"{label}.json"), json.dumps(manifest)):
        raise ValueError(f"there is a snapshot '{label}' already")
    return label


def snapshots(store: Store) -> list[str]:
    return [n.removesuffix(".json") for n in commits.names_in(store.spark, store.path("_snapshots")) if n.endswith(".json")]


def _snapshot(store: Store, label: str) -> dict:
    return json.loads(commits.read_text(store.spark, store.path("_snapshots", f"{label}.json")))


def _held_state(store: Store, label: str, name: str) -> TableState:
    held = _snapshot(store, label)["tables"][name]
    return TableState(held["version"], held["folders"], held["batches"])


def read_snapshot(store: Store, label: str, name: str) -> DataFrame:
    """A table as a snapshot holds it; columns added since are null."""
    return read_version(store, name, _held_state(store, label, name))


def restore_store(store: Store, label: str) -> list[str]:
    """Bring the tables and the registry of a snapshot back, as new versions; returns the tables.

    Tables made since are left alone. Streams count as stored up to the batch
    that the snapshot holds, so what they brought since can be taken up again.
    """
    manifest = _snapshot(store, label)
    for name in manifest["tables"]:
        now, then = open_state(store, name), _held_state(store, label, name)
        _commit(store, name, TableState(now.version, now.folders, then.batches), then.folders, None)
    rows = [(d["name"], d["primary_key"], d["columns"], d["version"]) for d in manifest["registry"]]
    pinned = registry_columns(local_frame(store.spark, rows, DEFINITION_SCHEMA))
    names = F.col("table_name").isin([d["name"] for d in manifest["registry"]])
    now = load_registry(store.spark, store.registry_path).filter(names)
    if pinned.exceptAll(now).take(1) or now.exceptAll(pinned).take(1):
        save_registry(pinned, store.registry_path)
    return sorted(manifest["tables"])


def remove_snapshot(store: Store, label: str) -> None:
    commits.remove_folder(store.spark, store.path("_snapshots", f"{label}.json"))


def snapshot_table(store: Store, name: str, when: datetime | None = None, folder: str | None = None) -> str | None:
    """A timestamped copy of a table; None where it does not exist.

    Read it back with ``spark.read.parquet``.
    """
    if not table_exists(store, name):
        return None
    stamp = (when or datetime.now()).strftime("%Y%m%d_%H%M%S")
    target = f"{(folder or store.path('backups')).rstrip('/')}/{name}/{stamp}"
    store.table(name).write.mode("overwrite").parquet(target)
    return target


__all__ = [
    "KEY_PART", "Store", "TableColumn", "TableSchema", "column_defaults", "create_table", "drop_old_versions",
    "evolve_table", "in_partitions", "key_part", "open_state", "path_exists", "read_snapshot", "read_version",
    "remove_snapshot", "replace_partitions", "replace_table", "restore_store", "snapshot_store", "snapshot_table",
    "snapshots", "table_exists", "table_location", "table_schemas",
]
