"""Schema inference: column names, order, types and nullability per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.functions.values import DEFAULT_STORAGE_TYPE, STORAGE_TYPES, value_kind, value_type
from landfall.sources.landing import member_lists, route_records

LOOK_AHEAD = 6  # fixed value: records searched for a first type within one response

_PER_RESPONSE = ["seq", "entity_id"]


def _field_stats(records: DataFrame, per_response: bool) -> DataFrame:
    """Counts and first positions per (table, field, type).

    The only shuffle of the inference, and it carries one row per table,
    field and type of each task. All buffers have a fixed width, so that it
    is a hash aggregation; hence the packed record order instead of a struct.
    """
    order = F.col("pos")
    if not per_response:
        order = F.col("seq").cast("decimal(19,0)") * F.lit(10**10).cast("decimal(11,0)") + order
    group = ["endpoint", "table_name", *(_PER_RESPONSE if per_response else [])]
    keys = F.col("keys") if "keys" in records.columns else F.lit(None).cast("array<string>")
    rows = records.select(
        *group, keys.alias("keys"), "record",
        F.when(F.col("pos") == 0, F.col("seq")).alias("head_seq"),
        order.alias("record_order"),
    )
    fields = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("record").outer()))
    kinds = fields.select(
        *group, F.col("key").alias("name"), "value", value_kind(F.col("value")).alias("kind"),
        "record_order", "head_seq",
        F.when(F.col("head_seq").isNotNull(), F.array_position(F.col("keys"), F.col("key")).cast("int")).alias("ordinal"),
        (F.coalesce(F.col("pos"), F.lit(0)) == 0).cast("int").alias("is_first_field"),
    )
    typed = kinds.withColumn("type", value_type(F.col("value"), F.col("kind")))
    return typed.groupBy(*group, "name", "type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_first_field").alias("n_heads"),
        F.min("record_order").alias("first_order"),
        F.min("head_seq").alias("head_seq"),
        F.min_by("ordinal", "head_seq").alias("ordinal"),
    )


def infer_record_schema(
    records: DataFrame,
    per_response: bool = False,
    union_keys: bool = False,
    widen: bool = False,
) -> DataFrame:
    """Columns of every table in routed records.

    Names and order are those of the table's first record. The type is that
    of the first value which is not JSON null, else ``str``. A column is
    nullable if it is null or missing in any record.

    ``per_response`` infers each response by itself and looks for a type only
    among its first six records. ``union_keys`` keeps names that appear only
    later; ``widen`` makes a mix of int and float a float.

    The record order is ``(seq, pos)``; ``seq`` is unique per response. Records
    without ``keys`` give the columns of a table in the order of their names.
    """
    return infer_with_heads(records, per_response, union_keys, widen).drop("table_seq")


def infer_with_heads(
    records: DataFrame, per_response: bool = False, union_keys: bool = False, widen: bool = False,
    every_response: bool = False,
) -> DataFrame:
    """``infer_record_schema`` with the ``seq`` of each table's first record.

    ``every_response`` takes the names of the first record of every response,
    in the order of the responses, and not of the table's first one only.
    """
    stats = _field_stats(records, per_response)
    group = ["table_name", *(_PER_RESPONSE if per_response else [])]
    known = F.col("type") != "null"
    if per_response:
        known = known & (F.col("first_order") < LOOK_AHEAD)
    names = stats.groupBy(*group, "name").agg(
        F.min_by("endpoint", "first_order").alias("endpoint"),
        F.min_by(F.when(known, F.col("type")), F.when(known, F.struct("first_order", "type"))).alias("first_type"),
        F.sum(F.when(F.col("type") != "null", F.col("n")).otherwise(0)).alias("n_values"),
        F.sum("n").alias("n_present"),
        F.sum("n_heads").alias("n_heads"),
        F.min("first_order").alias("first_order"),
        F.min("head_seq").alias("head_seq"),
        F.min_by("ordinal", "head_seq").alias("ordinal"),
        F.max((F.col("type") == "float").cast("int")).alias("has_float"),
        F.min(F.col("type").isin("int", "float", "null").cast("int")).alias("only_numbers"),
    )
    # From here on the data is schema metadata: one row per table and field.
    table = Window.partitionBy(*group)
    names = names.select(
        "*",
        F.sum("n_heads").over(table).alias("n_records"),
        F.min("head_seq").over(table).alias("table_seq"),
    ).withColumn("in_first", F.coalesce(F.col("head_seq") == F.col("table_seq"), F.lit(False))).filter(F.col("name").isNotNull())
    if not union_keys:
        # Names of the first record of any response, or of the table's first response only.
        names = names.filter("head_seq IS NOT NULL" if every_response else "in_first")
    column_type = F.coalesce(F.col("first_type"), F.lit("str"))
    if widen:
        column_type = F.when((F.col("has_float") == 1) & (F.col("only_numbers") == 1), "float").otherwise(column_type)
    position = table.orderBy(
        F.col("in_first").desc(), "ordinal", F.when(~F.col("in_first"), F.col("first_order")), "name"
    )
    return names.select(
        "endpoint",
        *group,
        (F.row_number().over(position) - 1).alias("ordinal"),
        "name",
        column_type.alias("type"),
        (F.col("n_values") < F.col("n_records")).alias("nullable"),
        "n_records",
        "n_present",
        "table_seq",
    )


def infer_schema(landing: DataFrame, **options) -> DataFrame:
    """Columns of all tables of all responses, in one job over the landing."""
    return infer_record_schema(route_records(landing), **options)


def infer_responses(landing: DataFrame) -> DataFrame:
    """Columns of every table of each response, inferred from that response alone.

    The rows of ``infer_record_schema(..., per_response=True)``, but folded over
    the elements of each response where it is parsed, without a shuffle: a job
    over any number of responses is one map stage, and each response's columns
    are at hand beside it.
    """
    lists = member_lists(landing)
    good = F.filter("records", lambda r: r.isNotNull())
    of = lambda key: lambda record: value_type(record[key])
    known = lambda t: t.isNotNull() & (t != "null")

    def column(key, ordinal):
        first = F.get(F.filter(F.transform(F.slice("records", 1, LOOK_AHEAD), of(key)), known), F.lit(0))
        empty = F.exists(good, lambda r: r[key].isNull() | F.is_variant_null(r[key]))
        return F.struct(
            ordinal.cast("int").alias("ordinal"), key.alias("name"), F.coalesce(first, F.lit("str")).alias("type"), empty.alias("nullable"),
            F.size(good).cast("bigint").alias("n_records"),
            F.size(F.filter(good, lambda r: r[key].isNotNull())).cast("bigint").alias("n_present"),
        )

    return lists.select("endpoint", "table_name", "seq", "entity_id", F.inline(F.transform("keys", column)))


def storage_type(inferred, long_ints: bool = False):
    """Storage type of an inferred type name; TEXT for one that is unknown."""
    names = dict(STORAGE_TYPES, int="BIGINT") if long_ints else STORAGE_TYPES
    result = F.lit(DEFAULT_STORAGE_TYPE)
    for name, stored in names.items():
        result = F.when(inferred == name, stored).otherwise(result)
    return result


def map_types(inferred: DataFrame, long_ints: bool = False) -> DataFrame:
    """Inferred columns as table columns.

    An ``id`` of type ``int`` is the primary key; every other column is
    nullable, whatever was seen. Foreign keys given as ``references_table``
    and ``references_column`` are carried through.
    """
    is_key = (F.col("name") == "id") & (F.col("type") == "int")
    carried = [
        F.col(c) if c in inferred.columns else F.lit(None).cast("string").alias(c)
        for c in ("endpoint", "references_table", "references_column")
    ]
    return inferred.select(
        carried[0],
        "table_name",
        "ordinal",
        "name",
        storage_type(F.col("type"), long_ints).alias("data_type"),
        (~is_key).alias("nullable"),
        is_key.alias("primary_key"),
        F.lit(False).alias("unique"),
        F.lit(None).cast("string").alias("default_value"),
        F.lit(None).cast("string").alias("table_key"),
        *carried[1:],
    )
