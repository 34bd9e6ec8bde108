from landfall.operators.checks import (
    check_foreign_key,
    check_not_null,
    check_primary_key,
    check_unique,
    check_unique_merge,
    orphans,
)
from landfall.operators.commits import CommitConflict
from landfall.operators.drift import detect_drift, drift_report
from landfall.operators.infer import infer_record_schema, infer_responses, infer_schema, map_types
from landfall.operators.keys import apply_key_map, as_singleton, detect_keys, key_map
from landfall.operators.reads import capped_ids, fetch_column, sql
from landfall.operators.registry import (
    RegistryConflict,
    compact_registry,
    definitions_of,
    latest_definitions,
    load_registry,
    registry_columns,
    resolve_schema,
    save_registry,
)
from landfall.operators.runlog import failures, latest_state, progress, run_summary, task_durations, task_state
from landfall.operators.tables import (
    Store,
    TableColumn,
    TableSchema,
    create_table,
    drop_old_versions,
    evolve_table,
    open_state,
    read_snapshot,
    read_version,
    restore_store,
    snapshot_store,
    snapshot_table,
    table_exists,
)
from landfall.operators.upsert import cast_record, last_wins, project_records, upsert

__all__ = [
    "CommitConflict", "RegistryConflict", "Store", "TableColumn", "TableSchema", "apply_key_map", "as_singleton",
    "capped_ids", "cast_record", "check_foreign_key", "check_not_null", "check_primary_key", "check_unique",
    "check_unique_merge", "compact_registry", "create_table", "definitions_of", "detect_drift", "detect_keys",
    "drift_report", "drop_old_versions", "evolve_table", "failures", "fetch_column", "infer_record_schema",
    "infer_responses", "infer_schema", "key_map", "last_wins", "latest_definitions", "latest_state", "load_registry",
    "map_types", "open_state", "orphans", "progress", "project_records", "read_snapshot", "read_version",
    "registry_columns", "resolve_schema", "restore_store", "run_summary", "save_registry", "snapshot_store",
    "snapshot_table", "sql", "table_exists", "task_durations", "task_state", "upsert",
]
