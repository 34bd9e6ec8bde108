"""Incremental ingest: landing files that arrive are upserted as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from landfall.operators.tables import Store
from landfall.plans.flow import Options, ingest
from landfall.session import prepare
from landfall.sources.landing import LANDING_SCHEMA


def ingest_stream(
    store: Store,
    path: str,
    checkpoint: str,
    options: Options = Options(),
    fmt: str = "parquet",
    max_files: int | None = None,
    init: bool = True,
) -> StreamingQuery:
    """Upsert every landing file under ``path`` once, then stop.

    Start it again for the files that came since. Every table commits the
    number of the batch with its rows, so a batch that is replayed after a
    failure is stored by the tables that lack it and by no others: exactly once,
    rows with a null key too. The stream is known by its checkpoint folder.
    """
    spark = prepare(store.spark)
    reader = spark.readStream.schema(LANDING_SCHEMA).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest(store, batch, options, init=init, batch=(checkpoint.rstrip("/"), batch_id))

    return (
        reader.load(path)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
