"""Landed responses: read them, bring them to one shape, route their records.

A landing row is one response: ``endpoint`` (its path, an id in it written as
``{id}``), ``entity_id`` (that id, null where there is none), ``seq`` (the
number of the response in landing order, unique per response) and ``body``.

A variant holds 128 MiB at most. ``route_all`` marks larger bodies; ``route_large``
splits their text into records, which are then parsed one by one in many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.names import table_name_col

LANDING_SCHEMA = "endpoint string, entity_id bigint, seq bigint, body string"

_BLANKS = " \t\r\n"
# Bodies that hold nothing: an empty object, null, false, zero, empty text.
_FALSY = r'^(\{\s*\}|null|false|-?0(\.0*)?([eE][+-]?\d+)?|"")$'
# A variant holds no more; a larger body parses to null.
LARGEST_BODY = 128 << 20
TOO_LARGE = "body too large"


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landing rows under ``path``.

    ``parquet`` and ``json`` hold landing rows as they are. ``files`` holds one
    body per file at ``<endpoint path>/<seq>.json``; a path segment that is a
    number is the entity id, and a file name without digits takes the file's time, in milliseconds, as ``seq``. Numbers
    are those of the folder: together with endpoint and id they are unique. Parquet is the layout for large
    volumes: columns are pruned and ``endpoint`` filters reach the scan.
    """
    if fmt == "files":
        text = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        full = F.col("_metadata.file_path")
        prefix = path.split("://", 1)[-1].removeprefix("file:").rstrip("/")
        inner = F.substring_index(full, prefix + "/", -1)
        folder = F.regexp_replace(inner, r"/[^/]*$", "")
        return text.select(
            F.regexp_replace(folder, r"(^|/)\d+(?=/|$)", r"$1{id}").alias("endpoint"),
            F.nullif(F.regexp_extract(folder, r"(?:^|/)(\d+)(?:/|$)", 1), F.lit("")).cast("bigint").alias("entity_id"),
            F.coalesce(
                F.nullif(F.regexp_extract(inner, r"(\d+)\.[^./]*$", 1), F.lit("")).cast("bigint"),
                F.unix_millis("_metadata.file_modification_time"),
            ).alias("seq"),
            F.col("value").alias("body"),
        )
    return spark.read.schema(LANDING_SCHEMA).format(fmt).load(path)


def normalize_response(landing: DataFrame) -> DataFrame:
    """Wrap a bare array as ``{last path segment: array}``; keep objects.

    Works on the text, so the body is parsed only once, later. A ``/`` at the
    end of the endpoint does not count.
    """
    body = F.btrim(F.col("body"), F.lit(_BLANKS))
    key = F.element_at(F.split(F.rtrim(F.col("endpoint"), F.lit("/")), "/"), -1)
    name = F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    wrapped = F.concat(F.lit('{"'), name, F.lit('":'), body, F.lit("}"))
    return landing.withColumn("body", F.when(body.startswith("["), wrapped).otherwise(body))


def with_endpoints(landing: DataFrame, prefixes: Mapping[str, str]) -> DataFrame:
    """Add the table prefix of each endpoint from the fixed configuration."""
    endpoint = F.trim(F.col("endpoint"))
    name = F.rtrim(endpoint, F.lit("/"))
    prefix = F.lit("")
    for path, value in prefixes.items():
        if value:
            prefix = F.when(name == path.rstrip("/"), value).otherwise(prefix)
    return landing.withColumn("prefix", prefix)


def _explode(df: DataFrame, column: str) -> DataFrame:
    """One row per member of a variant, adding pos, key, value; outer."""
    return df.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.col(column).outer()))


def _table_of(body: Column, prefix: Column, key: Column) -> Column:
    """The table of a response key; a key with ``-`` keeps apart from the response's own one with ``_``."""
    plain = F.translate(key, "-", "_")
    alike = F.when(key.contains("-"), F.array_contains(F.json_object_keys(body), plain))
    return table_name_col(prefix, key, alike)


def _head_keys(body: Column, key: Column, is_list: Column) -> Column:
    """Field names, in text order, of an object or of the first in a list."""
    member = F.concat(F.lit("$['"), key, F.lit("']"), F.when(is_list, "[0]").otherwise(""))
    return F.json_object_keys(F.call_function("get_json_object", body, member))


def route_all(landing: DataFrame, largest: int = LARGEST_BODY) -> DataFrame:
    """Every record of every response with its table, and every rejected one.

    A list whose first element is an object gives one record per element, an
    object gives one record; scalars, empty lists and lists of scalars give
    none. A row with ``problem`` set is a reject and holds the body or record
    it concerns. Map-only: one parse, and no shuffle. A body of ``largest``
    bytes or more is not parsed but marked ``TOO_LARGE``; ``route_large`` takes it.

    ``keys`` holds the field names in the order of the text, for the first
    record of a response only; it costs nothing where it is not selected.
    """
    members = _members(landing, largest)
    # The filter needs the position in all its parts, which keeps it up here: pushed
    # below the explode it would evaluate the casts of the members once more.
    rows = _explode(members, "list")
    single = F.col("is_object") | F.col("problem").isNotNull()
    kept = (F.col("is_list") & F.col("pos").isNotNull()) | (single & F.col("pos").isNull())
    rows = rows.filter(kept).select(
        "endpoint", "entity_id", "seq", "response_key", "table_name", "problem", "rejected_text",
        F.coalesce("pos", F.lit(0)).alias("pos"),
        F.when(F.col("is_list"), F.col("value")).otherwise(F.col("object")).alias("record"),
        F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("head_keys")).alias("keys"),
    )
    odd = F.col("problem").isNull() & F.try_variant_get(F.col("record"), "$", "struct<>").isNull()
    return rows.withColumn("odd", odd).select(
        "endpoint", "entity_id", "seq", "response_key", "table_name",
        F.when(F.col("odd"), "record is not an object").otherwise(F.col("problem")).alias("problem"),
        F.when(F.col("odd"), F.to_json("record")).otherwise(F.col("rejected_text")).alias("rejected_text"),
        "pos", "record", "keys",
    )


def _members(landing: DataFrame, largest: int) -> DataFrame:
    """One row per member of each response, as a list or an object where it is a table, and one per rejected body."""
    landing = normalize_response(landing)
    if "prefix" not in landing.columns:
        landing = landing.withColumn("prefix", F.lit(""))
    body = F.col("body")
    # In an array, text after the document makes the parse fail or adds an element.
    large = F.octet_length(body) >= largest
    whole = F.when(~large, F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))))
    parsed = landing.withColumn("whole", whole)
    malformed = F.col("whole").isNull() | F.variant_get(F.col("whole"), "$[1]", "variant").isNotNull()
    falsy = body.rlike(_FALSY)
    problem = (
        F.when(large, TOO_LARGE)
        .when(malformed, "malformed body")
        .when(falsy, "empty response")
        .when(~(body.startswith("{") & body.endswith("}")), "not an object")
    )
    base = ["endpoint", "entity_id", "seq", "prefix", "problem", "body"]
    parsed = parsed.withColumn("problem", problem).select(
        *base, F.when(F.col("problem").isNull(), F.col("whole")).alias("whole")
    )
    docs = _explode(parsed, "whole").select(*base, F.col("value").alias("doc"))

    # An empty struct is the cheapest cast that only an object allows.
    is_object = lambda path: F.try_variant_get(F.col("member"), path, "struct<>").isNotNull()
    members = _explode(docs, "doc").select(
        *base, F.col("key").alias("response_key"), F.col("value").alias("member")
    )
    members = members.withColumn("is_list", F.coalesce(is_object("$[0]"), F.lit(False)))
    members = members.withColumn("is_object", ~F.col("is_list") & F.coalesce(is_object("$"), F.lit(False)))
    return members.select(
        "endpoint", "entity_id", "seq", "problem", "response_key",
        F.when(F.col("problem").isNull(), _table_of(body, F.col("prefix"), F.col("response_key"))).alias("table_name"),
        F.when(F.col("problem").isNotNull(), body).alias("rejected_text"),
        _head_keys(body, F.col("response_key"), F.col("is_list")).alias("head_keys"),
        "is_list",
        "is_object",
        F.when(F.col("is_object"), F.col("member")).alias("object"),
        F.when(F.col("is_list"), F.col("member")).alias("list"),
    )


def member_lists(landing: DataFrame) -> DataFrame:
    """The tables of each response as they stand in it: their records as a list, and the fields of the first.

    Map-only, one row per response and table; records of a list that are no
    objects are null.
    """
    members = _members(landing, LARGEST_BODY).filter(F.col("problem").isNull() & (F.col("is_list") | F.col("is_object")))
    listed = F.when(F.col("is_list"), F.try_variant_get(F.col("list"), "$", "array<variant>")).otherwise(F.array("object"))
    return members.select(
        "endpoint", "entity_id", "seq", "table_name", F.array_distinct("head_keys").alias("keys"),
        F.transform(listed, lambda r: F.try_variant_get(r, "$", "map<string,variant>")).alias("records"),
    )


def route_large(landing: DataFrame) -> DataFrame:
    """``route_all`` for bodies too large for a variant.

    One task splits the text of a body into the texts of its records; those are
    dealt to tasks by position and parsed there, each by itself. An element of
    a list that is a text and reads as an object counts as that object.
    """
    landing = normalize_response(landing)
    if "prefix" not in landing.columns:
        landing = landing.withColumn("prefix", F.lit(""))
    # In an array, text after the document makes the parse fail or adds an element.
    whole = F.from_json(F.concat(F.lit("["), F.col("body"), F.lit("]")), "array<map<string,string>>")
    base = ["endpoint", "entity_id", "seq", "prefix"]
    bodies = landing.withColumn("whole", whole)
    bodies = bodies.select(*base, "body", F.when(F.size("whole") == 1, F.map_entries(F.col("whole")[0])).alias("entries"))
    # Of a repeated key the last value counts.
    again = lambda e, i: F.exists(F.slice("entries", i + 2, F.size("entries")), lambda o: o["key"] == e["key"])
    bad = F.col("entries").isNull()
    kept = F.when(bad, F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("body").alias("value")))).otherwise(
        F.filter("entries", lambda e, i: ~again(e, i))
    )
    plain = F.transform("entries", lambda e: e["key"])
    members = bodies.select(*base, bad.alias("bad"), plain.alias("names"), F.explode(kept).alias("m")).select(
        *base, "bad", "names", F.col("m.key").alias("response_key"), F.ltrim("m.value").alias("text"),
    )
    alike = F.array_contains("names", F.translate("response_key", "-", "_")) & F.col("response_key").contains("-")
    table = table_name_col(F.col("prefix"), F.col("response_key"), alike)
    listed = F.col("text").startswith("[") & ~F.col("bad")
    elements = F.when(listed, F.from_json("text", "array<string>")).otherwise(F.array("text"))
    members = members.select(
        "endpoint", "entity_id", "seq", "bad", "response_key", table.alias("table_name"), listed.alias("listed"), elements.alias("elements"),
    )
    is_object = lambda text: F.coalesce(F.ltrim(text).startswith("{"), F.lit(False))
    # Only a list whose first element is an object, or an object, has records.
    members = members.filter(F.col("bad") | is_object(F.get("elements", F.lit(0))))
    rows = members.select("*", F.posexplode("elements").alias("pos", "text")).drop("elements", "listed")
    # By number, or run-time coalescing would bring well compressed texts back into one task.
    tasks = int(landing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "seq", "response_key", "pos")
    parsed = rows.withColumn("record", F.when(~F.col("bad"), F.try_parse_json("text")))
    good = is_object(F.col("text")) & F.col("record").isNotNull()
    problem = F.when(F.col("bad"), "malformed body").when(~good, "record is not an object")
    return parsed.withColumn("problem", problem).select(
        "endpoint", "entity_id", "seq", "response_key", F.when(~F.col("bad"), F.col("table_name")).alias("table_name"), "problem",
        F.when(F.col("problem").isNotNull(), F.col("text")).alias("rejected_text"),
        "pos", "record", F.when(~F.col("bad") & (F.col("pos") == 0), F.json_object_keys("text")).alias("keys"),
    )


def route_records(landing: DataFrame) -> DataFrame:
    """The good records of ``route_all``."""
    return route_all(landing).filter(F.col("problem").isNull()).drop("problem", "rejected_text")


def rejected(landing: DataFrame) -> DataFrame:
    """What ``route_records`` leaves out because it cannot be a record."""
    return route_all(landing).filter(F.col("problem").isNotNull()).select(
        "endpoint", "entity_id", "seq", "table_name", "pos", "problem", "rejected_text"
    )


def inject_columns(df: DataFrame, columns: Mapping[str, Column] | Iterable[tuple[str, Column]]) -> DataFrame:
    """Add columns such as the parent id; they replace fields of that name."""
    return df.withColumns(dict(columns))
