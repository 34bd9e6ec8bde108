"""Integrity reports. Storage does not enforce constraints; these find breaches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.names import quoted


def _all_set(columns: list[str]):
    result = F.lit(True)
    for c in columns:
        result = result & F.col(quoted(c)).isNotNull()
    return result


def check_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values held by more than one row. Null keys are all distinct."""
    return (
        df.filter(_all_set(columns))
        .groupBy(*map(quoted, columns))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of nulls in each column, in one pass: (column, n_null)."""
    counts = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n_null")


def check_primary_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Breaches of a primary key: duplicated values, and keys with a null."""
    duplicated = check_unique(df, columns).withColumn("problem", F.lit("duplicate key"))
    nulls = (
        df.filter(~_all_set(columns))
        .groupBy(*map(quoted, columns))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("problem", F.lit("null key"))
    )
    return duplicated.unionByName(nulls)


def check_foreign_key(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, rows: bool = False
) -> DataFrame:
    """References that are set but have no parent: (column, n).

    The child is counted per reference first, with a partial aggregation, so
    that a hot reference is one row per task in the shuffle. With ``rows`` the
    offending child rows themselves; there run-time skew splitting serves.
    """
    parents = parent.select(F.col(quoted(parent_column)).alias(column)).filter(F.col(quoted(column)).isNotNull())
    present = child.filter(F.col(quoted(column)).isNotNull())
    if not rows:
        present = present.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("n"))
    return present.join(parents, column, "left_anti")


def check_unique_merge(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str], column: str, optional: bool = False, small: bool = False
) -> DataFrame:
    """Values of ``column`` that two rows would hold after a merge: (value).

    ``stored`` holds each value once, ``incoming`` each set key once. Only the
    batch is aggregated: its values are compared with each other, and with the
    stored ones under other keys, but for those that the batch replaces. With
    ``optional`` the column is a struct ``{v}``, null where a row leaves the
    stored value; ``small`` says that the batch fits a broadcast.
    """
    sent = F.col(quoted(column))
    value = sent["v"] if optional else sent
    on = [f"k{i}" for i in range(len(keys))]
    named = [F.col(quoted(k)).alias(n) for k, n in zip(keys, on, strict=True)]
    changed = incoming.filter(sent.isNotNull()) if optional else incoming
    replaced = changed.select(*named)
    batch = changed.select(*[F.col(quoted(k)).alias(f"b{n}") for k, n in zip(keys, on, strict=True)], value.alias("value"))
    batch = batch.filter("value is not null")
    twice = batch.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("value")
    old = stored.select(*named, F.col(quoted(column)).alias("value")).filter("value is not null")
    same = F.lit(True)
    for n in on:
        same = same & (F.col(n) == F.col(f"b{n}"))
    hint = F.broadcast if small else (lambda df: df)
    taken = old.join(hint(batch), "value").filter(~F.coalesce(same, F.lit(False)))
    taken = taken.join(hint(replaced), on, "left_anti").select("value")
    return twice.unionByName(taken)


def orphans(incoming: DataFrame, column: str, parent: DataFrame, parent_column: str, small: bool = False) -> DataFrame:
    """References of a batch that are set but have no parent: (value), each once.

    The parent is first cut to the batch's references: by broadcasting them
    where they are ``small``, else by a join that a Bloom filter of theirs can
    precede at run time. Only what is found is compared with the batch.
    """
    wanted = incoming.select(F.col(quoted(column)).alias("value")).filter("value is not null").distinct()
    parents = parent.select(F.col(quoted(parent_column)).alias("value"))
    found = parents.join(F.broadcast(wanted) if small else wanted, "value", "left_semi")
    return wanted.join(found, "value", "left_anti")
