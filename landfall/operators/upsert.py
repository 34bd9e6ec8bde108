"""Row writing: typed projection of records, last row wins, keyed merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.names import quoted, variant_path
from landfall.functions.values import SPARK_TYPES, cast_value, usual_value, value_kind

ORDER = ["seq", "entity_id", "pos"]


def cast_record(
    records: DataFrame, columns: Sequence[tuple[str, str]], carried: Sequence[str] = (),
    aliases: Sequence[str] | None = None,
) -> DataFrame:
    """Records as typed columns, with what could not be stored.

    ``columns`` is ``(name, storage type)`` pairs. ``aliases`` names the typed
    columns, where fields may be called like one of our own; by default they
    bear the names of the fields. Adds ``problems``, the names of the fields
    whose value does not fit, and ``found``, the typed columns present in the
    record, where a JSON null is present. ``found`` is null where all
    are, and ``problems`` may be null where there are none: the common case
    then costs nothing. Nested values become compact JSON.

    A record whose values all have the usual form, or are JSON null, is done
    with short generated code. Any other goes through the full rules, which
    stand in a lambda: that is not inlined, so the method stays small enough
    to be compiled however many columns there are.
    """
    names = [n for n, _ in columns]
    aliases = names if aliases is None else list(aliases)
    usual = records.select(
        *carried, "record",
        *[usual_value(F.col("record"), variant_path(n), t).alias(f"u{i}") for i, (n, t) in enumerate(columns)],
    )
    clear = [
        F.col(f"u{i}").isNotNull() | F.is_variant_null(F.variant_get(F.col("record"), variant_path(n), "variant"))
        for i, n in enumerate(names)
    ]
    full = F.when(~F.coalesce(_all(clear), F.lit(False)), _full_cast(F.col("record"), columns, aliases))
    done = usual.withColumn("full", full)
    return done.select(
        *carried,
        *[
            F.when(F.col("full").isNull(), F.col(f"u{i}")).otherwise(F.col("full")[f"c{i}"]).alias(n)
            for i, n in enumerate(aliases)
        ],
        F.col("full")["problems"].alias("problems"),
        F.col("full")["found"].alias("found"),
    )


def _full_cast(record: Column, columns: Sequence[tuple[str, str]], aliases: Sequence[str]) -> Column:
    """Struct of all columns by the full rules, with problems and found."""
    names = [n for n, _ in columns]
    n = range(len(columns))
    raw = lambda r: F.struct(
        *[F.variant_get(r, variant_path(name), "variant").alias(f"v{i}") for i, name in enumerate(names)]
    )
    kinds = lambda x: F.struct(
        *[x[f"v{i}"].alias(f"v{i}") for i in n], *[value_kind(x[f"v{i}"]).alias(f"k{i}") for i in n]
    )
    typed = lambda x: F.struct(
        *[
            cast_value(x[f"v{i}"], x[f"k{i}"], t).cast(SPARK_TYPES.get(t, "string")).alias(f"c{i}")
            for i, (_, t) in enumerate(columns)
        ],
        *[x[f"k{i}"].alias(f"k{i}") for i in n],
    )
    checked = lambda x: F.struct(
        *[x[f"c{i}"].alias(f"c{i}") for i in n],
        _names_where([x[f"c{i}"].isNull() & (x[f"k{i}"] != "VOID") for i in n], names).alias("problems"),
        F.when(
            ~_all([x[f"k{i}"].isNotNull() for i in n]), _names_where([x[f"k{i}"].isNotNull() for i in n], aliases)
        ).alias("found"),
    )
    steps = F.array(record)
    for step in (raw, kinds, typed, checked):
        steps = F.transform(steps, step)
    return F.element_at(steps, 1)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _names_where(conditions: Sequence[Column], names: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in zip(conditions, names, strict=True)]))


def is_found(found: str, name: str) -> Column:
    """Whether the record had the field; a null list stands for all of them."""
    return F.col(found).isNull() | F.array_contains(F.col(found), name)


def project_records(
    records: DataFrame,
    columns: Sequence[tuple[str, str]],
    missing: str = "null",
    carried: Sequence[str] = ("endpoint", "entity_id", "seq", "pos"),
    aliases: Sequence[str] | None = None,
) -> DataFrame:
    """Records as rows of the column list; fields outside it are dropped.

    ``missing`` says what a field that a record lacks means: ``null``, or
    ``fail`` to mark the row as a reject. A row with ``problem`` set is one.
    ``aliases`` as in ``cast_record``.
    """
    rows = cast_record(records, columns, carried, aliases)
    shown = aliases or [n for n, _ in columns]
    lacking = _names_where([~is_found("found", a) for a in shown], [n for n, _ in columns])
    problem = F.when(F.size("problems") > 0, F.concat(F.lit("does not fit: "), F.array_join("problems", ", ")))
    problem = problem.when(F.col("found").isNotNull() & (F.size("found") == 0), F.lit("no known field"))
    if missing == "fail":
        problem = problem.when(F.col("found").isNotNull(), F.concat(F.lit("missing: "), F.array_join(lacking, ", ")))
    return rows.withColumn("problem", problem).drop("problems")


def _no_null(keys: Sequence[str]) -> Column:
    return _all([F.col(quoted(k)).isNotNull() for k in keys])


def _spread_null_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """A number that is 0 for set keys and distinct for rows with a null key.

    Rows with a null key are all distinct, and may be many; the number keeps
    them apart and spreads them over the partitions of a shuffle.
    """
    return df.withColumn(name, F.when(_no_null(keys), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1))


def last_wins(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], null_keys: bool = True, found: str | None = None
) -> DataFrame:
    """The last row of each key; rows with a null key all stay.

    A maximum with partial aggregation, not a window: a key that holds a large
    share of the rows is one row per task when it reaches the shuffle. With
    ``null_keys=False`` the keys are known to be set.

    With ``found``, a column of present column names (null: all), the result is
    taken per column: a later row that lacks a column leaves the earlier value. Each
    value column becomes a struct ``{v}``, null where no row had the column.
    """
    rest = [c for c in df.columns if c not in {*keys, found}]
    position = F.struct(*[F.col(quoted(c)) for c in order])
    spread = ["_spread"] if null_keys else []
    if null_keys:
        df = _spread_null_keys(df, keys, "_spread")
    grouped = df.groupBy(*[F.col(quoted(k)) for k in keys], *spread)
    if found is None:
        last = grouped.agg(F.max_by(F.struct(*[F.col(quoted(c)) for c in rest]), position).alias("_row"))
        return last.select(*[F.col(quoted(k)) for k in keys], *[F.col("_row")[c].alias(c) for c in rest])
    values = [c for c in rest if c not in order]
    has = lambda c: is_found(found, c)
    return grouped.agg(
        *[
            F.max_by(F.when(has(c), F.struct(F.col(quoted(c)).alias("v"))), F.when(has(c), position)).alias(c)
            for c in values
        ]
    ).drop(*spread)


def as_rows(
    incoming: DataFrame, base: DataFrame, optional: Sequence[str] = (), defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Incoming rows in the columns of ``base``; the default, or null, in those they lack."""
    defaults = defaults or {}

    def value(field) -> Column:
        default = defaults.get(field.name, F.lit(None)).cast(field.dataType)
        if field.name not in incoming.columns:
            return default
        column = F.col(quoted(field.name))
        return F.when(column.isNotNull(), column["v"]).otherwise(default) if field.name in optional else column

    return incoming.select(*[value(f).alias(f.name) for f in base.schema.fields])


def upsert(
    base: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    null_keys: bool = True,
    small: bool = False,
    optional: Sequence[str] = (),
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``base`` after ``incoming``, which holds each set key at most once.

    On a key match only the incoming columns are replaced, by null too;
    otherwise the row is inserted, with the default, or null, in columns it
    lacks. Rows with a null key match nothing. Columns in ``optional`` are
    structs ``{v}`` where a null struct leaves the old value.

    The general plan is one full outer join on the keys. ``small`` says the
    caller has measured ``incoming`` as fit to broadcast; then ``base`` is
    neither shuffled nor sorted. Columns may have any name: the join works
    with ``k``, ``o`` and ``n`` and a number for keys, old and new values.
    """
    keys, defaults = list(keys), defaults or {}
    columns = base.columns
    sent = [c for c in columns if c in incoming.columns and c not in keys]
    kept = [c for c in columns if c not in incoming.columns]
    on = [f"k{i}" for i in range(len(keys))]
    key_cols = [F.col(quoted(k)) for k in keys]
    named_keys = [c.alias(k) for c, k in zip(key_cols, on, strict=True)]
    at = {c: i for i, c in enumerate(columns)}

    old = base.select(
        *named_keys, *[F.col(quoted(c)).alias(f"o{i}") for c, i in at.items() if c not in keys], F.lit(1).alias("stored")
    )
    new = incoming.select(*named_keys, *[F.col(quoted(c)).alias(f"n{at[c]}") for c in sent], F.lit(1).alias("arrives"))

    def value(name: str) -> Column:
        if name in keys:
            return F.col(on[keys.index(name)])
        rest = F.col(f"o{at[name]}")
        if name in defaults:
            rest = F.when(F.col("stored").isNull(), defaults[name].cast(base.schema[name].dataType)).otherwise(rest)
        if name in kept:
            return rest
        arrived = F.col(f"n{at[name]}")
        if name in optional:
            return F.when(arrived.isNotNull(), arrived["v"]).otherwise(rest)
        return F.when(F.col("arrives") == 1, arrived).otherwise(rest)

    merged = [value(c).alias(c) for c in columns]

    if small:
        if not kept and not optional:
            # Every column arrives: matched rows are simply replaced.
            rest = base.join(F.broadcast(incoming.select(*key_cols)), keys, "left_anti")
            return rest.select(*[F.col(quoted(c)) for c in columns]).unionByName(as_rows(incoming, base))
        updated = old.join(F.broadcast(new), on, "left").select(*merged)
        matched = base.select(*key_cols).join(F.broadcast(incoming.select(*key_cols)), keys, "left_semi")
        return updated.unionByName(as_rows(incoming.join(matched, keys, "left_anti"), base, optional, defaults))

    if null_keys:
        # Equal numbers for set keys; negative against positive for null ones.
        old = _spread_null_keys(old, on, "spread")
        new = _spread_null_keys(new, on, "spread").withColumn("spread", -F.col("spread"))
        on = [*on, "spread"]
    return old.join(new, on, "full_outer").select(*merged)
