"""Value rules: the type of a JSON value, and its cast to a storage type.

All of it is built-in expressions over VARIANT, so that it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as a date with a time of day.
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"

# Storage type of each inferred type.
STORAGE_TYPES = {
    "str": "TEXT",
    "int": "INTEGER",
    "float": "DOUBLE",
    "bool": "BOOLEAN",
    "jsonb": "JSON",
    "datetime": "TIMESTAMP",
}
DEFAULT_STORAGE_TYPE = "TEXT"

# Storage type to Spark type. JSON is kept as its text.
SPARK_TYPES = {
    "TEXT": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "JSON": "string",
    "TIMESTAMP": "timestamp_ntz",
}

# Text accepted for a boolean column.
TRUE_TEXT = ["true", "t", "1", "yes", "y"]
FALSE_TEXT = ["false", "f", "0", "no", "n"]

NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_TEXT = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"
DATE_TEXT = r"^\s*\d{4,}-\d{1,2}-\d{1,2}"
WIDE_INTEGER = r"^DECIMAL\((19|[23]\d),0\)"

def value_kind(v: Column) -> Column:
    """Spark's own type text of a variant value; null where it is absent."""
    return F.schema_of_variant(v)


def value_type(v: Column, kind: Column | None = None) -> Column:
    """One of bool, int, float, datetime, str, jsonb, or null for JSON null.

    Pass ``kind`` when ``value_kind(v)`` is already a column. A whole number
    written with a decimal point parses as a narrow ``DECIMAL(p,0)`` and is a
    float; only integers beyond 64 bits reach 19 digits there.
    """
    kind = value_kind(v) if kind is None else kind
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(kind == "BIGINT", "int")
        .when(kind == "STRING", F.when(text.rlike(ISO_DATETIME), "datetime").otherwise("str"))
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "VOID", "null")
        .when(kind.rlike(WIDE_INTEGER), "int")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "float")
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), "jsonb")
    )


def json_column(v: Column) -> Column:
    """Compact JSON text of a nested value."""
    return F.to_json(v)


def float_text(d: Column) -> Column:
    """Shortest text of a double: plain digits up to 1e16, else an exponent."""
    size = F.abs(d)
    plain = F.regexp_replace(d.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(d.cast("string"), "E", 1), r"\.0$", "")
    power = F.substring_index(d.cast("string"), "E", -1).cast("int")
    exponent = F.concat(
        mantissa,
        F.lit("e"),
        F.when(power < 0, "-").otherwise("+"),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), F.lit("0")),
    )
    return F.when((size == 0) | ((size >= 1e-4) & (size < 1e16)), plain).otherwise(exponent)


def _number_text(v: Column, kind: Column) -> Column:
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(kind.isin("DOUBLE", "FLOAT"), float_text(F.try_variant_get(v, "$", "double")))
        .when(kind.startswith("DECIMAL") & kind.endswith(",0)") & ~kind.rlike(WIDE_INTEGER), F.concat(text, F.lit(".0")))
        .otherwise(text)
    )


def _is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")


def _is_nested(kind: Column) -> Column:
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def _to_integer(v: Column, kind: Column, data_type: str) -> Column:
    spark_type = SPARK_TYPES[data_type]
    text = F.try_variant_get(v, "$", "string")
    # Digits enough for any 64-bit integer, and places enough to round once.
    number = F.coalesce(text.try_cast("decimal(38,18)"), text.try_cast("double").try_cast("decimal(38,18)"))
    # Floats round half to even, numeric text half up.
    return (
        F.when(kind == "STRING", F.when(text.rlike(NUMERIC_TEXT), F.round(number, 0).try_cast(spark_type)))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast(spark_type))
        .when(_is_number(kind), F.bround(number, 0).try_cast(spark_type))
    )


def _to_double(v: Column, kind: Column) -> Column:
    text = F.try_variant_get(v, "$", "string")
    return F.when(
        kind == "STRING", F.when(text.rlike(NUMERIC_TEXT) | text.rlike(SPECIAL_TEXT), text.try_cast("double"))
    ).when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast("double"))


def _to_boolean(v: Column, kind: Column) -> Column:
    text = F.lower(F.try_variant_get(v, "$", "string"))
    return F.when(_is_number(kind), F.try_variant_get(v, "$", "double") != 0).when(
        kind == "STRING", F.when(text.isin(TRUE_TEXT), True).when(text.isin(FALSE_TEXT), False)
    )


def _to_text(v: Column, kind: Column) -> Column:
    return (
        F.when(kind.isin("BIGINT", "BOOLEAN"), F.try_variant_get(v, "$", "string"))
        .when(_is_nested(kind), json_column(v))
        .when(_is_number(kind), _number_text(v, kind))
    )


def _to_json_text(v: Column, kind: Column) -> Column:
    text = F.try_variant_get(v, "$", "string")
    return F.when(kind == "STRING", F.when(F.try_parse_json(text).isNotNull(), text)).when(
        kind != "VOID", _to_text(v, kind)
    )


def _to_timestamp(v: Column, kind: Column) -> Column:
    text = F.try_variant_get(v, "$", "string")
    return F.when((kind == "STRING") & text.rlike(DATE_TEXT), text.try_cast("timestamp_ntz"))


def cast_value(v: Column, kind: Column, data_type: str) -> Column:
    """Value of a variant as ``data_type``; null where it cannot be stored.

    The rules are those of the storage: floats round half to even into an
    integer column, numeric text rounds half up, a time zone in a timestamp is
    dropped, 32-bit overflow is an error. A null result for a value that is
    present and not JSON null marks the error.
    """
    value = F.try_variant_get(v, "$", SPARK_TYPES.get(data_type, "string"))
    if data_type in ("INTEGER", "BIGINT"):
        return F.when(kind == "BIGINT", value).otherwise(_to_integer(v, kind, data_type))
    if data_type == "DOUBLE":
        return F.when(_is_number(kind), value).otherwise(_to_double(v, kind))
    if data_type == "BOOLEAN":
        return F.when(kind == "BOOLEAN", value).otherwise(_to_boolean(v, kind))
    if data_type == "TIMESTAMP":
        return _to_timestamp(v, kind)
    if data_type == "JSON":
        return F.when(_is_nested(kind), json_column(v)).otherwise(_to_json_text(v, kind))
    return F.when(kind == "STRING", value).otherwise(_to_text(v, kind))


def usual_value(record: Column, path: str, data_type: str) -> Column:
    """``cast_value`` of a field for values of the usual form, else null.

    Short, and without a look at the type of the value: only text casts to
    binary, and a whole number is the same as an integer and as a double.
    """
    get = lambda t: F.try_variant_get(record, path, t)
    if data_type in ("INTEGER", "BIGINT"):
        whole = get(SPARK_TYPES[data_type])
        return F.when((whole == get("double")) & whole.between(-(2**52), 2**52), whole)
    if data_type in ("DOUBLE", "BOOLEAN"):
        return F.when(get("binary").isNull(), get(SPARK_TYPES[data_type]))
    if data_type == "TIMESTAMP":
        return F.when(get("string").rlike(DATE_TEXT), get("string").try_cast("timestamp_ntz"))
    if data_type == "JSON":
        text = json_column(F.variant_get(record, path, "variant"))
        return F.when(F.ascii(text).isin(ord("{"), ord("[")), text)
    return F.when(get("binary").isNotNull(), get("string"))
