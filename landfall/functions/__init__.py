from landfall.functions.names import quoted, response_key_col, table_name_col, variant_path
from landfall.functions.values import SPARK_TYPES, cast_value, float_text, json_column, usual_value, value_kind, value_type

__all__ = [
    "SPARK_TYPES",
    "cast_value",
    "float_text",
    "json_column",
    "quoted",
    "response_key_col",
    "table_name_col",
    "usual_value",
    "value_kind",
    "value_type",
    "variant_path",
]
