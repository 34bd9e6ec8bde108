"""Run-log analytics over task events: one row per state of a task in a run.

Columns: run_id, task, status, time, and where known duration_s, error, and
for progress current, total, current_id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TASK = ["run_id", "task"]


def run_summary(events: DataFrame) -> DataFrame:
    """Number of tasks that succeeded and failed, per run; skipped count in neither."""
    return events.groupBy("run_id").agg(
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def _order(events: DataFrame, order: Sequence[str] | None) -> Column:
    """By time, and by number where the log has one."""
    return F.struct(*(order or [c for c in ("time", "number") if c in events.columns]))


def latest_state(events: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The last event of each task in a run, by time and number unless ``order`` is given."""
    rest = [c for c in events.columns if c not in _TASK]
    last = F.max_by(F.struct(*rest), _order(events, order))
    return events.groupBy(*_TASK).agg(last.alias("s")).select(*_TASK, "s.*")


def progress(events: DataFrame, order: Sequence[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """Latest progress of each task, with the percentage to one decimal.

    ``current_id`` is the last one given; of a total of zero there is no percentage. With ``known``, rows of (run_id,
    task), progress of other tasks is ignored.
    """
    position = _order(events, order)
    given = F.col("current_id").isNotNull()
    latest = events.filter(F.col("current").isNotNull()).groupBy(*_TASK).agg(
        F.max_by(F.struct("current", "total"), position).alias("s"),
        F.max_by(F.when(given, F.col("current_id")), F.when(given, position)).alias("current_id"),
    )
    if known is not None:
        latest = latest.join(known.select(*_TASK).distinct(), _TASK, "left_semi")
    return latest.select(
        *_TASK, "s.current", "s.total", F.bround(F.try_divide("s.current", "s.total") * 100, 1).alias("pct"), "current_id"
    )


def task_state(events: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Last status and last progress of each task in a run, by one aggregation.

    The columns of ``latest_state`` and ``progress``. It may be taken over a
    stream of the log, too: an event changes the row of its task only.
    """
    position, given, moved = _order(events, order), F.col("current_id").isNotNull(), F.col("current").isNotNull()
    state = events.groupBy(*_TASK).agg(
        F.max_by(F.struct("status", "time", "duration_s", "error"), position).alias("s"),
        F.max_by(F.when(moved, F.struct("current", "total")), F.when(moved, position)).alias("p"),
        F.max_by(F.when(moved & given, F.col("current_id")), F.when(moved & given, position)).alias("current_id"),
    )
    pct = F.bround(F.try_divide("p.current", "p.total") * 100, 1)
    return state.select(*_TASK, "s.*", "p.current", "p.total", pct.alias("pct"), "current_id")


def task_durations(events: DataFrame) -> DataFrame:
    """Seconds from the first start to the last end of each task, to 0.1 s.

    A task that failed has one as well; one that has not ended has none.
    """
    ended = F.col("status").isin("success", "failed")
    span = events.groupBy(*_TASK).agg(
        F.min(F.when(F.col("status") == "started", F.col("time"))).alias("started"),
        F.max(F.when(ended, F.col("time"))).alias("ended"),
        F.max_by(F.when(ended, F.col("status")), F.when(ended, F.col("time"))).alias("status"),
    )
    micros = F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))
    return span.filter("started is not null and ended is not null").select(
        *_TASK, "status", F.bround(micros / 1e6, 1).alias("duration_s")
    )


def failures(events: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The last failure of each task in a run, with its error text."""
    failed = events.filter(F.col("status") == "failed")
    return latest_state(failed, order)
