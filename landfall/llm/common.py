"""What several corpus operators share: texts, words, staged tables, batch loops."""

from __future__ import annotations

import string
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from landfall.session import shared_dir

#: A word is a run of anything but these; ``bytes.split()`` splits at the same six.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def text_of(column: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def columns_of(docs: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, under our own names, whatever else there is."""
    return docs.select(*(F.col(quoted(c)).alias(name) for name, c in wanted.items()))


def staged(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """Written once to the shared folder and read back: cuts the lineage, outlives executors."""
    path = shared_dir(frame.sparkSession, f"llm-{label}")
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text_of(text)))).first()[0] or 0


def beside(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", small: int = 32 << 20, salts: int = 64) -> DataFrame:
    """``rows`` joined with a staged ``table`` that holds each key once, with no task for a frequent key's rows alone.

    A table measured as small goes to every task, so rows are not shuffled. In
    the join of a larger one every row gets one of ``salts`` numbers, and each
    row of the table all of them. Keys are not null.
    """
    if table.count() * 16 * (len(table.columns) + 2) <= small:
        return rows.join(F.broadcast(table), keys, how)
    number = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    spread = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", number).join(spread, [*keys, "salt"], how).drop("salt")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to the executors' Python once an application, as ``--py-files`` does."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="landfall-code-"), "landfall.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def with_row(row: DataType, rest: str) -> StructType:
    """A schema of the payload ``row``, whatever its names, and further columns."""
    return StructType([StructField("row", row), *StructType.fromDDL(rest)])


def per_batch(frame: DataFrame, schema: str | StructType, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` for a generator that takes batches and yields dicts of columns."""
    ship(frame.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type, from_pandas=False) for f in arrow], schema=arrow
            )

    return frame.mapInArrow(run, schema)


def by_size(batch: pa.RecordBatch, measure: str, most: int) -> Iterator[dict[str, list]]:
    """The batch's columns as lists, cut so that a part's ``measure`` column has few bytes."""
    sizes = [len(v.as_buffer()) for v in batch.column(measure)]
    at = 0
    while at < len(sizes):
        to, held = at + 1, sizes[at]
        while to < len(sizes) and held + sizes[to] <= most:
            held += sizes[to]
            to += 1
        yield batch.slice(at, to - at).to_pydict()
        at = to
