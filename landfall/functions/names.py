"""Names: response keys to table names and back, quoting, variant paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def table_name_col(prefix: Column, key: Column, alike: Column | None = None) -> Column:
    """``prefix_key``, or ``key`` where there is no prefix; ``-`` becomes ``_``.

    A name with other characters than letters, digits and ``_``, which no
    catalog takes, has them replaced and the name's checksum added, so that it
    does not fall together with another. ``alike`` marks keys whose name with
    ``_`` is taken by another: those get the checksum of the name as it was.
    """
    whole = F.concat_ws("_", F.nullif(prefix, F.lit("")), key)
    name = F.translate(whole, "-", "_")
    with_sum = lambda text: F.concat_ws(
        "_", F.regexp_replace(name, "[^A-Za-z0-9_]", "_"), F.lpad(F.lower(F.hex(F.crc32(text))), 8, "0")
    )
    result = F.when(name.rlike("^$|[^A-Za-z0-9_]"), with_sum(name))
    if alike is not None:
        result = F.when(alike, with_sum(whole)).otherwise(result)
    return F.coalesce(result, name)


def response_key_col(table: Column, prefix: Column) -> Column:
    """The response key a table came from: its name without the prefix."""
    bare = F.substring(table, F.length(prefix) + 2, F.length(table))
    return F.when(F.coalesce(F.length(prefix), F.lit(0)) > 0, bare).otherwise(table)


def quoted(name: str) -> str:
    """Back-quoted identifier for SQL text and column references."""
    return "`" + name.replace("`", "``") + "`"


def variant_path(name: str) -> str:
    """Path of one object field, whatever characters its name holds."""
    if '"' not in name:
        return f'$["{name}"]'
    if "'" not in name:
        return f"$['{name}']"
    raise ValueError(f"field name holds both quote characters: {name}")
