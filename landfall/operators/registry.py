"""The registry of pinned schemas: an append-only table of definitions.

One row is one definition of one table; the last one of a table holds. The
definition keeps what a pinned schema file keeps: a single key name, and per
column a storage type and its tests. Versions are numbered by the writers: each
claims its number with a file that is created only where there is none, so that
of two writers who both start from one version one saves and the other gets
``RegistryConflict``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.operators import commits
from landfall.session import local_frame

DEFINITION_SCHEMA = (
    "name string, primary_key string, "
    "columns array<struct<name:string,data_type:string,tests:array<string>>>, version bigint"
)
SINGLETON = "!singleton"  # fixed value: key name that marks a one-row table


def registry_columns(definitions: DataFrame) -> DataFrame:
    """Pinned definitions as table columns.

    A column is nullable unless it is tested ``not_null``, and the primary key
    only if its name is the definition's ``primary_key``.
    """
    rows = definitions.select(
        F.col("name").alias("table_name"),
        F.col("primary_key").alias("table_key"),
        F.posexplode("columns").alias("ordinal", "c"),
    )
    tested = lambda test: F.coalesce(F.array_contains(F.col("c.tests"), test), F.lit(False))
    return rows.select(
        F.lit(None).cast("string").alias("endpoint"),
        "table_name",
        "ordinal",
        F.col("c.name").alias("name"),
        F.col("c.data_type").alias("data_type"),
        (~tested("not_null")).alias("nullable"),
        F.coalesce(F.col("c.name") == F.col("table_key"), F.lit(False)).alias("primary_key"),
        tested("unique").alias("unique"),
        F.lit(None).cast("string").alias("default_value"),
        "table_key",
        F.lit(None).cast("string").alias("references_table"),
        F.lit(None).cast("string").alias("references_column"),
    )


def definitions_of(columns: DataFrame, version: int = 0) -> DataFrame:
    """Table columns as pinned definitions.

    What is kept is deliberately little: ``not_null`` for key columns only,
    ``unique``, and a key name where exactly one column is the key.
    """
    tests = F.filter(
        F.array(
            F.when(F.col("primary_key"), F.lit("not_null")),
            F.when(F.col("unique"), F.lit("unique")),
        ),
        lambda t: t.isNotNull(),
    )
    # The columns of one table: bounded by its schema, not by its data.
    grouped = columns.groupBy("table_name").agg(
        F.max("table_key").alias("table_key"),
        F.count_if(F.col("primary_key")).alias("n_keys"),
        F.max(F.when(F.col("primary_key"), F.col("name"))).alias("key_name"),
        F.array_sort(
            F.collect_list(F.struct("ordinal", "name", "data_type", tests.alias("tests")))
        ).alias("columns"),
    )
    return grouped.select(
        F.col("table_name").alias("name"),
        F.coalesce(F.col("table_key"), F.when(F.col("n_keys") == 1, F.col("key_name"))).alias("primary_key"),
        F.transform("columns", lambda c: F.struct(c["name"], c["data_type"], c["tests"])).cast(
            "array<struct<name:string,data_type:string,tests:array<string>>>"
        ).alias("columns"),
        F.lit(version).cast("bigint").alias("version"),
    )


def latest_definitions(definitions: DataFrame) -> DataFrame:
    """The last definition of every table, as a whole."""
    last = F.max_by(F.struct("primary_key", "columns", "version"), F.col("version"))
    return (
        definitions.filter(F.col("name").isNotNull())
        .groupBy("name").agg(last.alias("d"))
        .select("name", "d.primary_key", "d.columns", "d.version")
    )


class RegistryConflict(RuntimeError):
    """Another writer has pinned schemas since the version this one started from."""


def current_version(spark: SparkSession, path: str) -> int | None:
    """The number of the last saved version, None where nothing was ever pinned."""
    claimed = [int(n) for n in commits.names_in(spark, f"{path}/_versions") if n.isdigit()]
    if claimed:
        return max(claimed)
    if not path_exists(spark, path):
        return None
    return spark.read.schema(DEFINITION_SCHEMA).parquet(path).agg(F.max("version")).first()[0]


def save_registry(columns: DataFrame, path: str, version: int | None = None) -> int:
    """Pin the schemas of the tables in ``columns``; replaces older ones. Returns the version.

    ``version`` is the number that the writer takes to be free, by default the
    next one. A number that is not above the last one, or that another writer
    claims at the same time, is a conflict, and nothing is saved.
    """
    spark = columns.sparkSession
    last = current_version(spark, path)
    number = version if version is not None else (0 if last is None else last) + 1
    if last is not None and number <= last or not commits.create_text(spark, f"{path}/_versions/{number}", ""):
        raise RegistryConflict(f"version {number} of the registry was saved by another writer")
    definitions_of(columns, number).coalesce(1).write.mode("append").parquet(path)
    return number


def compact_registry(spark: SparkSession, path: str) -> int:
    """Leave only the last definition of every table; returns the number of files removed.

    The last definitions are written before the files read go, so a reader
    sees each at least once; what is saved meanwhile is in other files.
    """
    files = [n for n in commits.names_in(spark, path) if n.endswith(".parquet")]
    if not files:
        return 0
    definitions = spark.read.schema(DEFINITION_SCHEMA).parquet(*[f"{path}/{n}" for n in files])
    last = local_frame(spark, latest_definitions(definitions).collect(), DEFINITION_SCHEMA)
    last.coalesce(1).write.mode("append").parquet(path)
    for n in files:
        commits.remove_folder(spark, f"{path}/{n}")
    return len(files)


def load_definitions(spark: SparkSession, path: str) -> DataFrame:
    """The last definition of every pinned table."""
    if not path_exists(spark, path):
        return local_frame(spark, [], DEFINITION_SCHEMA)
    return latest_definitions(spark.read.schema(DEFINITION_SCHEMA).parquet(path))


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """All pinned table columns; none where nothing was ever pinned."""
    return registry_columns(load_definitions(spark, path))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def resolve_schema(mapped: DataFrame, registry: DataFrame) -> DataFrame:
    """The pinned schema of each arriving table, else the inferred one.

    Both sides are schema metadata; one window per table picks the side.
    """
    both = mapped.withColumn("pinned", F.lit(0)).unionByName(registry.withColumn("pinned", F.lit(1)))
    table = Window.partitionBy("table_name")
    return (
        both.withColumns({
            "arrives": F.min("pinned").over(table) == 0,
            "side": F.max("pinned").over(table),
            "endpoint": F.max("endpoint").over(table),
        })
        .filter(F.col("arrives") & (F.col("pinned") == F.col("side")))
        .select(*mapped.columns)
    )
