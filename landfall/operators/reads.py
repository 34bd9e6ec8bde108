"""Reads: one ordered column, capped ids, SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.names import quoted


def fetch_column(df: DataFrame, column: str) -> DataFrame:
    """All values of one column, ascending, duplicates kept, nulls last."""
    return df.select(quoted(column)).orderBy(F.col(quoted(column)).asc_nulls_last())


def capped_ids(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """The first ``n`` values of a column in order; all of them if 0 or unset."""
    ids = fetch_column(df, column)
    return ids.limit(n) if n else ids


def sql(spark: SparkSession, text: str) -> DataFrame:
    """Result of a SQL statement over the registered tables.

    A failure names the statement.
    """
    try:
        return spark.sql(text)
    except Exception as e:
        raise RuntimeError(f"Failed to execute: {text}") from e
