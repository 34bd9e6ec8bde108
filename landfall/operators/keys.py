"""Keys of tables: primary keys, the key map, singletons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.operators.registry import SINGLETON
from landfall.operators.upsert import ORDER, last_wins
from landfall.session import local_frame

KEY_MAP_SCHEMA = "table_name string, kind string, key_map_columns array<string>"


def key_map(spark: SparkSession, keys: Mapping[str, object]) -> DataFrame:
    """The configured key map as rows: ``"singleton"`` or a list of columns."""
    rows = [
        (table, "singleton", None) if key == "singleton" else (table, "unique_on", list(key))
        for table, key in keys.items()
    ]
    return local_frame(spark, rows, KEY_MAP_SCHEMA)


def _plus_row(columns: DataFrame, condition: Column, new: Mapping[str, Column]) -> DataFrame:
    """Emit, next to each row that meets the condition, a further column row.

    ``new`` gives its fields; table-wide ones are taken over, the rest is empty.
    """
    taken = ("endpoint", "table_name", "table_key")

    def value(field):
        made = new.get(field.name, F.col(field.name) if field.name in taken else F.lit(None))
        return made.cast(field.dataType).alias(field.name)

    names = columns.columns
    this = F.struct(*names)
    other = F.struct(*[value(f) for f in columns.schema.fields])
    rows = F.when(condition, F.array(this, other)).otherwise(F.array(this))
    return columns.select(F.explode(rows).alias("r")).select("r.*")


def add_parents(
    columns: DataFrame, parents: Mapping[str, str], data_type: str = "INTEGER", nullable: bool = False
) -> DataFrame:
    """Add each table's injected column at its end, NOT NULL unless ``nullable``, if it lacks it."""
    parent = by_table(parents)
    table = Window.partitionBy("table_name")
    flagged = columns.withColumns({
        "_last": F.max("ordinal").over(table) == F.col("ordinal"),
        "_has": F.max(F.coalesce((F.col("name") == parent), F.lit(True))).over(table),
    })
    new = {
        "ordinal": F.col("ordinal") + 1,
        "name": parent,
        "data_type": F.lit(data_type),
        "nullable": F.lit(nullable),
        "primary_key": F.lit(False),
        "unique": F.lit(False),
    }
    return _plus_row(flagged, F.col("_last") & ~F.col("_has"), new).select(*columns.columns)


def apply_key_map(columns: DataFrame, keymap: DataFrame) -> DataFrame:
    """Table columns with the key map applied.

    A singleton table without an ``id`` gets one as its first column and
    primary key. A table unique on one column has that column marked unique.
    The key map is fixed configuration, hence the broadcast.
    """
    table = Window.partitionBy("table_name")
    one_column = (F.col("kind") == "unique_on") & (F.size("key_map_columns") == 1)
    marked = F.coalesce(one_column & (F.col("name") == F.get("key_map_columns", F.lit(0))), F.lit(False))
    single = F.coalesce(F.col("table_key") == SINGLETON, F.lit(False)) | F.coalesce(
        F.col("kind") == "singleton", F.lit(False)
    )
    lacks_id = single & ~F.max(F.col("name") == "id").over(table)
    flagged = columns.join(F.broadcast(keymap), "table_name", "left").withColumns({
        "unique": F.col("unique") | marked,
        "_first": F.min("ordinal").over(table) == F.col("ordinal"),
        "_lacks_id": lacks_id,
    })
    flagged = flagged.withColumn("ordinal", F.col("ordinal") + F.col("_lacks_id").cast("int"))
    new = {
        "ordinal": F.lit(0),
        "name": F.lit("id"),
        "data_type": F.lit("INTEGER"),
        "nullable": F.lit(False),
        "primary_key": F.lit(True),
        "unique": F.lit(False),
    }
    return _plus_row(flagged, F.col("_first") & F.col("_lacks_id"), new).select(*columns.columns)


def by_table(names: Mapping[str, str]) -> Column:
    """The name configured for the row's table, else null."""
    result = F.lit(None).cast("string")
    for table, name in names.items():
        result = F.when(F.col("table_name") == table, name).otherwise(result)
    return result


def detect_keys(columns: DataFrame, keymap: DataFrame, parents: Mapping[str, str] | None = None) -> DataFrame:
    """Key columns per table: primary keys first, else the key map's.

    ``problem`` is set where a table has no key. ``parents`` names the injected
    parent id of tables; such a table keyed by ``id`` alone is keyed by both,
    so that the records of one parent do not replace those of another.
    """
    parent = by_table(parents or {})
    own = columns.groupBy("table_name").agg(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("primary_key"), F.struct("ordinal", "name")))),
            lambda c: c["name"],
        ).alias("own"),
        F.max((F.col("name") == parent).cast("int")).alias("has_parent"),
    )
    mapped = F.when(F.col("kind") == "unique_on", F.col("key_map_columns"))
    by_id = (F.size("own") == 1) & (F.col("own")[0] == "id") & (F.coalesce("has_parent", F.lit(0)) == 1)
    by_id = by_id & (F.coalesce("kind", F.lit("")) != "singleton")
    key = (
        F.when(by_id, F.array(parent, F.lit("id")))
        .when(F.size("own") > 0, F.col("own"))
        .otherwise(mapped)
    )
    return own.join(F.broadcast(keymap), "table_name", "left").select(
        "table_name",
        key.alias("key_columns"),
        (F.size("own") > 0).alias("is_primary"),
        F.when(key.isNull(), F.concat("table_name", F.lit(": neither an integer id nor a key in the key map"))).alias("problem"),
    )


def first_rows(rows: DataFrame, id_column: str = "id") -> DataFrame:
    """The first record of each response, with ``id`` 1 whatever it held."""
    return rows.filter(F.col("pos") == 0).withColumn(id_column, F.lit(1))


def as_singleton(rows: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """The first record of the latest response as the one row, with ``id`` 1.

    A partial maximum per task, so no window over the whole table. ``group``
    names columns to keep apart, such as the table.
    """
    order = [c for c in ORDER if c in rows.columns]
    return last_wins(first_rows(rows), [*group, "id"], order, null_keys=False)
