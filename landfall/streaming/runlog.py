"""The state of all tasks, kept up to date as events are appended to a run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from landfall.operators.runlog import run_summary, task_state
from landfall.operators.tables import Store, TableColumn, TableSchema, create_table, open_state, replace_table
from landfall.operators.upsert import upsert
from landfall.session import prepare
from landfall.sources.logs import run_event_stream

TASKS = TableSchema("task_state", (
    TableColumn("run_id", "TEXT", False, True), TableColumn("task", "TEXT", False, True), TableColumn("status", "TEXT"),
    TableColumn("time", "TIMESTAMP"), TableColumn("duration_s", "DOUBLE"), TableColumn("error", "TEXT"),
    TableColumn("current", "BIGINT"), TableColumn("total", "BIGINT"), TableColumn("pct", "DOUBLE"),
    TableColumn("current_id", "TEXT"),
))
RUNS = TableSchema("run_state", (
    TableColumn("run_id", "TEXT", False, True), TableColumn("succeeded", "BIGINT"), TableColumn("failed", "BIGINT"),
))


def run_log_stream(
    store: Store, path: str, checkpoint: str, max_files: int | None = None, by_run: bool = False
) -> StreamingQuery:
    """Take up the events that have come to a log, then stop.

    Keeps the table ``task_state`` (``task_state`` of the whole log), or with
    ``by_run`` ``run_state`` (its ``run_summary``). The aggregation's state is in
    the checkpoint; a micro-batch gives the rows it changes, which are merged
    and committed with the batch's number, so that a replay changes nothing.
    """
    prepare(store.spark)
    schema = RUNS if by_run else TASKS
    name, keys = schema.table_name, schema.primary_key
    create_table(store, schema, execute=True, keys=keys)
    events = run_event_stream(store.spark, path, max_files)
    states = run_summary(events) if by_run else task_state(events)

    def merge(changed: DataFrame, batch_id: int) -> None:
        state = open_state(store, name)
        if state.batches.get(checkpoint, -1) >= batch_id:
            # Stored already; only the aggregation's own state has to be brought to the batch.
            changed.write.format("noop").mode("overwrite").save()
            return
        rows = changed.withColumns({c.name: changed[c.name].cast(c.spark_type) for c in schema.columns})
        replace_table(store, name, upsert(store.table(name), rows, keys, null_keys=True), keys, base=state, batch=(checkpoint, batch_id))

    writer = states.writeStream.outputMode("update").foreachBatch(merge)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
