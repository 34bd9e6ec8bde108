"""Schema drift between what arrives and what is pinned."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def detect_drift(mapped: DataFrame, registry: DataFrame, full: bool = False) -> DataFrame:
    """Drift events of pinned tables.

    ``new_column`` for each arriving name that is not pinned, with its storage
    type. With ``full`` also ``missing_column`` for each pinned name that did
    not arrive, and ``type_change`` with the pinned and the arriving type.
    """
    sides = mapped.select(
        "endpoint", "table_name", "name", F.col("data_type").alias("now"), F.lit(None).cast("string").alias("was")
    ).unionByName(
        registry.select(
            F.lit(None).cast("string").alias("endpoint"), "table_name", "name",
            F.lit(None).cast("string").alias("now"), F.col("data_type").alias("was"),
        )
    )
    # Schema metadata: a window per table says whether it arrives and is pinned,
    # and the grouping by column reuses its partitioning.
    table = Window.partitionBy("table_name")
    columns = (
        sides.withColumns({
            "endpoint": F.max("endpoint").over(table),
            "arrives": F.max(F.col("now").isNotNull()).over(table),
            "is_pinned": F.max(F.col("was").isNotNull()).over(table),
        })
        .filter("arrives and is_pinned")
        .groupBy("endpoint", "table_name", "name")
        .agg(F.max("now").alias("now"), F.max("was").alias("was"))
    )
    event = F.when(F.col("was").isNull(), "new_column")
    if full:
        event = event.when(F.col("now").isNull(), "missing_column").when(F.col("now") != F.col("was"), "type_change")
    changed = F.col("event") == "type_change"
    return (
        columns.withColumn("event", event)
        .filter(F.col("event").isNotNull())
        .select(
            "endpoint",
            F.col("table_name").alias("table"),
            "event",
            F.col("name").alias("column"),
            F.when(~changed, F.coalesce("now", "was")).alias("type"),
            F.when(changed, F.col("was")).alias("was"),
            F.when(changed, F.col("now")).alias("now"),
        )
        .orderBy("table", "column")
    )


def drift_report(events: DataFrame) -> DataFrame:
    """How often each kind of drift was seen per table and column, and when."""
    return events.groupBy("table", "column", "event").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("time").alias("first_seen"),
        F.max("time").alias("last_seen"),
    )
