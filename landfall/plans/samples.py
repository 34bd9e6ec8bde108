"""Landings made from base tables, for the registered queries.

Each row of a table becomes one response, so that building a landing needs no
shuffle and no row grows with its group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.tables import Store
from landfall.plans.endpoints import Endpoint
from landfall.session import prepare, shared_dir

_JSON = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

ENDPOINTS = (
    Endpoint("customer/{id}", prefix="customer", parent_column="customer_id"),
    Endpoint("customer-orders/{id}", prefix="sales", parent_column="customer_id", parent_table="customers"),
    Endpoint("parts"),
    Endpoint("orders"),
    Endpoint("settings"),
)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def new_store(spark: SparkSession, **layout) -> Store:
    """A store of its own in the shared folder."""
    prepare(spark)
    return Store(spark, shared_dir(spark, "store"), f"landfall_{uuid.uuid4().hex[:12]}", **layout)


def to_body(value: Column) -> Column:
    return F.to_json(value, _JSON)


def landing(df: DataFrame, endpoint: Column | str, seq: str, body: Column, entity: str | None = None) -> DataFrame:
    return df.select(
        (F.lit(endpoint) if isinstance(endpoint, str) else endpoint).alias("endpoint"),
        (F.col(entity) if entity else F.lit(None)).cast("bigint").alias("entity_id"),
        F.col(seq).cast("bigint").alias("seq"),
        body.alias("body"),
    )


def customer_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per customer: a list, an object, and members that are no table."""
    entry = lambda n, sign: F.struct(
        (F.col("c_custkey") * 2 + n).alias("id"), (F.col("c_acctbal") * sign).alias("balance")
    )
    body = to_body(F.struct(
        F.array(entry(0, 1), entry(1, -1)).alias("accounts"),
        F.struct(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
        ).alias("profile"),
        F.lit(2).alias("total"),
        F.array().cast("array<string>").alias("empty"),
        F.array(F.lit(1), F.lit(2)).alias("codes"),
        F.array(F.lit(5)).alias("note"),
    ))
    return landing(load(spark, sf_dir, "customer"), "customer/{id}", "c_custkey", body, "c_custkey")


def order_record(*more: Column) -> Column:
    return F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("dt"),
        *more,
    )


def order_landing(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """One response per order, a bare array of one record, parent the customer."""
    return landing(
        load(spark, sf_dir, "orders"), "orders", "o_orderkey", to_body(F.array(order_record(*more)))
    )


def fanout_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of customers: two records with ids that repeat per customer."""
    line = lambda n: F.struct(
        (F.col("o_orderkey") % 10 * 2 + n).alias("id"),
        F.col("o_orderkey").alias("orderkey"),
        (F.col("o_totalprice") + n).alias("price"),
        F.lit(-1).alias("customer_id"),
    )
    body = to_body(F.struct(F.array(line(0), line(1)).alias("lines")))
    return landing(load(spark, sf_dir, "orders"), "customer-orders/{id}", "o_orderkey", body, "o_custkey")


def lineitem_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per line item, with every column of the table."""
    items = load(spark, sf_dir, "lineitem")
    body = to_body(F.struct(F.array(F.struct(*items.columns)).alias("items")))
    return landing(items, "items", "l_orderkey", body)


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a run log: a run per user, seven tasks in each."""
    status = (
        F.when(F.col("event_type") == "purchase", "success")
        .when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "signup", "skipped")
        .otherwise("started")
    )
    return load(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.concat(F.lit("task-"), F.col("event_id") % 7).alias("task"),
        status.alias("status"),
        F.col("ts").alias("time"),
        F.when(status == "failed", F.concat(F.lit("event "), F.col("event_id"))).alias("error"),
        F.when(F.col("event_type") == "view", F.col("event_id") % 9 + 1).alias("current"),
        F.lit(9).cast("bigint").alias("total"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("current_id"),
    )


#: Tables of the events by type; key map of two of them.
ACTIVITY = Endpoint("activity", prefix="events")
ACTIVITY_KEYS = {"events_click": ["code"], "events_error": "singleton"}


def activity_landing(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """One response per event: its type names the table, its user a field, its id the type of that field's value.

    Types of an even number of letters have an ``id``, the others a ``code``.
    """
    key = F.when(F.length("event_type") % 2 == 0, "id").otherwise("code")
    value = F.element_at(
        F.array(*map(F.lit, ("null", "1.25", "true", '"word"')), F.col("user_id").cast("string")),
        (F.expr("event_id div 5") + F.length("event_type")).cast("int") % 5 + 1,
    )
    body = F.format_string(
        '{"%s":[{"%s":%d,"m%d":%s}]}', "event_type", key, F.col("event_id"), F.col("user_id") % 6 + shift, value
    )
    return landing(load(spark, sf_dir, "events"), ACTIVITY.path, "event_id", body)
