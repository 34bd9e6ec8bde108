"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the engine relies on.

    A JSON object that repeats a key keeps the last value, as most JSON
    readers do; Spark's default is to refuse the whole document.

    Stages whose generated method is beyond what HotSpot compiles run as
    separate operators instead, as Spark's documentation advises for HotSpot:
    parsing, routing and casting would else run interpreted.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder every executor can reach.

    On a cluster this is ``spark.checkpoint.dir``, which must be set. Only a
    local master may fall back to a folder of this machine.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="landfall-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a path made by ``shared_dir``, in whatever store it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def local_frame(spark: SparkSession, rows: Iterable[Sequence], schema: str | StructType) -> DataFrame:
    """Driver-side metadata as a DataFrame whose size the optimizer knows.

    Going through Arrow gives a local relation, so that joins with it need no
    shuffle; a list of rows would be an opaque RDD of unknown size.
    """
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = [dict(zip(struct.names, tuple(r), strict=True)) for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(struct)), schema=struct)
