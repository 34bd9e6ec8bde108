"""Run log and discovery log: append-only JSON lines.

Fields that are null are left out of a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "run_id string, task string, status string, time timestamp, number bigint, duration_s double, error string, "
    "current bigint, total bigint, current_id string"
)
DISCOVERY_SCHEMA = (
    "time timestamp, endpoint string, table string, event string, "
    "column string, type string, was string, now string"
)
_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
_OPTIONS = {"timestampFormat": _FORMAT, "timeZone": "UTC", "ignoreNullFields": "true"}


def _append(events: DataFrame, schema: str, path: str) -> None:
    if "time" not in events.columns:
        events = events.withColumn("time", F.current_timestamp())
    fields = [f.strip().split(" ")[0] for f in schema.split(",")]
    rows = events.select(*[f for f in fields if f in events.columns])
    rows.write.mode("append").options(**_OPTIONS).json(path)


def append_run_events(events: DataFrame, path: str) -> None:
    """Append task events: run_id, task, status, and duration_s or error.

    Events of progress have current, total and current_id. ``number`` orders
    events of equal time.
    """
    _append(events, RUN_SCHEMA, path)


def append_discovery(events: DataFrame, path: str) -> None:
    """Append discovery events: endpoint, table, event, and what it concerns."""
    _append(events, DISCOVERY_SCHEMA, path)


def read_run_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).options(**_OPTIONS).json(path)


def run_event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The run log as a stream of the events appended to it."""
    options = {**_OPTIONS, **({"maxFilesPerTrigger": max_files} if max_files else {})}
    return spark.readStream.schema(RUN_SCHEMA).options(**options).json(path)


def read_discovery(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DISCOVERY_SCHEMA).options(**_OPTIONS).json(path)
