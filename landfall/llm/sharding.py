"""Two-pass external shuffle into numbered shards of equal row counts.

First pass: a seeded hash of id and text scatters the rows uniformly into
buckets of ``bucket_bytes``, which fit in a task's memory. Second pass: each
bucket is put in an order that doesn't depend on how Spark dealt it, shuffled
by Fisher-Yates with a generator seeded by seed and bucket, and written. The
buckets laid end to end are one random order of all rows; shard s of n has its
s-th n-th, so counts differ by one at most. Equal seeds give equal shards.

Defined results: null texts and ids are rows like any other; equal rows (same
id, text and other columns) are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import quoted, ship, text_of, with_row
from landfall.session import shared_dir


def fisher_yates(n: int, generator: np.random.Generator) -> np.ndarray:
    """A uniformly random order of 0 to n - 1."""
    order = list(range(n))
    partners = generator.integers(0, np.arange(n, 1, -1)).tolist() if n > 1 else []
    for i, j in zip(range(n - 1, 0, -1), partners, strict=True):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def shuffle_into_shards(
    docs: DataFrame, path: str, shards: int = 16, seed: int = 7, bucket_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Writes ``path``/shard=s/ as Parquet: ``row`` (all columns), slot; and returns what it wrote."""
    spark = docs.sparkSession
    ship(spark)
    key = F.xxhash64(F.lit(seed), quoted(id_col), quoted(text_col))
    total = docs.agg(F.sum(F.octet_length(text_of(text_col)) + 64)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    dealt = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"), key.alias("mix"), F.pmod(key, F.lit(buckets)).cast("int").alias("bucket")
    )
    # One number for each bucket: its first place in the order of all rows.
    counts = np.zeros(buckets, np.int64)
    for r in dealt.groupBy("bucket").count().collect():
        counts[r.bucket] = r["count"]
    first = np.cumsum(counts) - counts
    rows = int(counts.sum())
    borders = np.array([-(-s * rows // shards) for s in range(shards)], np.int64)

    def write_bucket(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        mix = table.column("mix").to_numpy()
        given = np.argsort(mix, kind="stable")  # equal hashes are equal ids and texts
        order = given[fisher_yates(len(mix), np.random.default_rng([seed, bucket]))]
        place = first[bucket] + np.arange(len(order))
        shard = np.searchsorted(borders, place, side="right") - 1
        return pa.table({
            "row": table.column("row").take(pa.array(order)), "shard": pa.array(shard, pa.int32()), "slot": pa.array(place - borders[shard], pa.int64()),
        })

    done = dealt.groupBy("bucket").applyInArrow(write_bucket, with_row(dealt.schema["row"].dataType, "shard int, slot long"))
    done.write.partitionBy("shard").parquet(path)
    return spark.read.schema(done.schema).parquet(path)


def shards_in_shared_folder(docs: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    return shuffle_into_shards(docs, shared_dir(docs.sparkSession, "llm-shards"), shards, seed)
