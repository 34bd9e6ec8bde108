"""The same results in plain SQL over the base tables."""

from __future__ import annotations

import zlib


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _status(column: str = "event_type") -> str:
    return (
        f"CASE {column} WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' "
        f"WHEN 'signup' THEN 'skipped' ELSE 'started' END"
    )


_RUNS = f"""
    SELECT CAST(user_id AS VARCHAR) AS run_id, 'task-' || CAST(event_id % 7 AS VARCHAR) AS task,
           {_status()} AS status, ts AS time,
           CASE WHEN event_type = 'error' THEN 'event ' || CAST(event_id AS VARCHAR) END AS error,
           CASE WHEN event_type = 'view' THEN event_id % 9 + 1 END AS current, 9 AS total,
           CASE WHEN event_id % 2 = 0 THEN event_id END AS current_id
    FROM events
"""

_DISCOVERY = """
    SELECT ts AS time, 'endpoint-' || CAST(user_id % 3 AS VARCHAR) AS endpoint,
           'table-' || CAST(user_id AS VARCHAR) AS "table",
           CASE WHEN event_type = 'error' THEN 'type_change' ELSE 'new_column' END AS event,
           event_type AS "column",
           CASE WHEN event_type <> 'error' THEN 'INTEGER' END AS type,
           CASE WHEN event_type = 'error' THEN 'TEXT' END AS was,
           CASE WHEN event_type = 'error' THEN 'JSON' END AS now
    FROM events
"""


def _values(columns: str, rows: list[tuple]) -> str:
    def text(v) -> str:
        if v is None:
            return "CAST(NULL AS VARCHAR)"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, str) and not v.startswith("("):
            return f"'{v}'"
        return str(v)

    body = ",\n".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES\n{body}\n) AS v({columns})"


_CUSTOMER_COLUMNS = [
    ("customer_accounts", 0, "id", "int", "INTEGER", True),
    ("customer_accounts", 1, "balance", "float", "DOUBLE", False),
    ("customer_profile", 0, "id", "int", "INTEGER", True),
    ("customer_profile", 1, "name", "str", "TEXT", False),
    ("customer_profile", 2, "segment", "str", "TEXT", False),
]
_DEFINITION = "table_name, ordinal, name, data_type, nullable, primary_key, \"unique\", table_key"


def _definitions(unique: set[tuple[str, str]] = frozenset(), key: str | None = None, types=None, drop=()) -> str:
    rows = [
        (t, n, c, (types or {}).get((t, c), d), not pk, pk, (t, c) in unique, key)
        for t, n, c, _, d, pk in _CUSTOMER_COLUMNS
        if (t, c) not in drop
    ]
    return "SELECT table_name, CAST(ordinal AS BIGINT) AS ordinal, name, data_type, nullable, primary_key, " \
        f"\"unique\", table_key FROM ({_values(_DEFINITION, rows)})"


_ORDER_UPSERT = "WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0"
_PRICE = "CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice"
_LINES = """
    SELECT o_orderkey % 10 * 2 + n AS id, o_orderkey AS orderkey, o_totalprice + n AS price, o_custkey AS customer_id, n
    FROM orders, (VALUES (0), (1)) AS t(n)
"""

_PROGRESS = f"""
        SELECT run_id, task, current, CAST(total AS BIGINT) AS total, round(current / total * 100, 1) AS pct, current_id
        FROM (
            SELECT run_id, task, arg_max(current, time) AS current, 9 AS total,
                   arg_max(current_id, time) FILTER (current_id IS NOT NULL) AS current_id
            FROM ({_RUNS}) WHERE current IS NOT NULL GROUP BY run_id, task
        )"""

ORACLES: dict[str, str] = {
    "L1_read_landing": """
        SELECT 'customer/{id}' AS endpoint, c_custkey AS entity_id, c_custkey AS seq, c_name AS name,
               c_custkey * 2 + 1 AS second_id
        FROM customer""",
    "L2_normalize_response": """
        SELECT s_suppkey AS seq,
               CASE WHEN s_suppkey % 5 = 0 THEN 'plain' WHEN s_suppkey % 2 = 0 THEN 'suppliers' ELSE 'set-suppliers' END
                   AS response_key,
               CAST(1 AS BIGINT) AS n
        FROM supplier""",
    "L3_route_records": _union(
        "SELECT 'accounts' AS table_name, c_custkey AS entity_id, CAST(n AS BIGINT) AS pos, c_custkey * 2 + n AS id "
        "FROM customer, (VALUES (0), (1)) AS t(n)",
        "SELECT 'profile', c_custkey, CAST(0 AS BIGINT), c_custkey FROM customer",
    ),
    "L3_rejected": """
        SELECT s_suppkey AS seq, CAST(CASE WHEN s_suppkey % 4 = 3 THEN 1 ELSE 0 END AS BIGINT) AS pos,
               CASE s_suppkey % 4 WHEN 0 THEN 'malformed body' WHEN 1 THEN 'not an object' WHEN 2 THEN 'empty response'
                    ELSE 'record is not an object' END AS problem,
               CASE s_suppkey % 4 WHEN 0 THEN '{oops' WHEN 1 THEN '5' WHEN 2 THEN '{}' ELSE '7' END AS rejected_text
        FROM supplier""",
    "L4_table_name": """
        SELECT event_id,
               CASE WHEN event_type = 'view' THEN '' ELSE event_type || '_' END || 'of_' || CAST(user_id AS VARCHAR)
                   AS table_name,
               'of_' || CAST(user_id AS VARCHAR) AS response_key
        FROM events""",
    "L5_inject_columns": f"SELECT orderkey, CAST(n AS BIGINT) AS pos, price, customer_id FROM ({_LINES})",
    "L6_append_run_events": f"SELECT run_id, task, status, time, error FROM ({_RUNS})",
    "L7_append_discovery": _DISCOVERY,
    "L8_snapshot_table": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "S1_value_type": _union(
        *[
            f"SELECT '{name}' AS name, '{kind}' AS type, count(*) AS n FROM documents"
            for name, kind in [
                ("id", "int"), ("half", "float"), ("long", "bool"), ("langs", "jsonb"), ("meta", "jsonb"),
                ("nothing", "null"),
            ]
        ],
        r"SELECT 'text', CASE WHEN regexp_matches(text, '^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}') THEN 'datetime' ELSE 'str' "
        "END, count(*) FROM documents GROUP BY 2",
        "SELECT 'source', CASE WHEN doc_id % 3 = 1 THEN 'str' ELSE 'null' END, count(*) FROM documents GROUP BY 2",
        "SELECT 'day', CASE WHEN doc_id % 2 = 0 THEN 'datetime' ELSE 'str' END, count(*) FROM documents GROUP BY 2",
    ),
    "S2_infer_record_schema": """
        SELECT 'documents' AS table_name, CAST(ordinal AS INTEGER) AS ordinal, name, type, nullable,
               (SELECT count(*) FROM documents) AS n_records, (SELECT count(*) FROM documents) AS n_present
        FROM (VALUES (0, 'id', 'int', false), (1, 'text', 'str', false), (2, 'half', 'float', false),
                     (3, 'long', 'bool', false), (4, 'source', 'str', true), (5, 'day', 'datetime', false),
                     (6, 'langs', 'jsonb', false), (7, 'meta', 'jsonb', false), (8, 'nothing', 'str', true))
             AS v(ordinal, name, type, nullable)""",
    "S2_infer_per_response": _union(
        "SELECT o_orderkey AS seq, CAST(0 AS INTEGER) AS ordinal, 'id' AS name, 'int' AS type, false AS nullable FROM orders",
        "SELECT o_orderkey, CAST(1 AS INTEGER), 'v', CASE WHEN o_orderkey % 2 = 0 THEN 'int' ELSE 'str' END, true FROM orders",
    ),
    "S3_infer_schema": """
        SELECT 'customer/{id}' AS endpoint, table_name, CAST(ordinal AS INTEGER) AS ordinal, name, type, false AS nullable,
               per * (SELECT count(*) FROM customer) AS n_records, per * (SELECT count(*) FROM customer) AS n_present
        FROM (VALUES ('customer_accounts', 0, 'id', 'int', 2), ('customer_accounts', 1, 'balance', 'float', 2),
                     ('customer_profile', 0, 'id', 'int', 1), ('customer_profile', 1, 'name', 'str', 1),
                     ('customer_profile', 2, 'segment', 'str', 1)) AS v(table_name, ordinal, name, type, per)""",
    "S4_map_types": f"SELECT table_name, ordinal, name, data_type, nullable, primary_key, \"unique\" FROM ({_definitions()})",
    "S5_registry_columns": _definitions({("customer_profile", "name")}, "id"),
    "S6_load_registry": _definitions(key="id", drop={("customer_profile", "segment")}),
    "S7_save_registry": "SELECT table_name, primary_key, CAST(version AS BIGINT) AS version, CAST(pos AS BIGINT) AS pos, "
        "name, data_type, tests FROM (" + _values(
            "table_name, primary_key, version, pos, name, data_type, tests",
            [
                (t, "id", 7, n, c, d, "not_null" if pk else "unique" if c == "name" else "")
                for t, n, c, _, d, pk in _CUSTOMER_COLUMNS
            ],
        ) + ")",
    "S8_resolve_schema": _definitions(types={("customer_accounts", "balance"): "TEXT"}),
    "S9_detect_drift": _values(
        'endpoint, "table", event, "column", type',
        [("orders", "orders", "new_column", "added", "BOOLEAN"), ("orders", "orders", "new_column", "tags", "JSON")],
    ),
    "S10_detect_drift_full": _values(
        'endpoint, "table", event, "column", type, was, now',
        [
            ("orders", "orders", "new_column", "added", "BOOLEAN", None, None),
            ("orders", "orders", "new_column", "tags", "JSON", None, None),
            ("orders", "orders", "missing_column", "dt", "TIMESTAMP", None, None),
            ("orders", "orders", "type_change", "price", None, "DOUBLE", "TEXT"),
        ],
    ),
    "K1_detect_keys": _values(
        "table_name, key_columns, is_primary, problem",
        [
            ("customer_accounts", "id", True, None),
            ("customer_profile", "id", True, None),
            ("parts", "brand", False, None),
            ("settings", "id", True, None),
            ("loose", None, False, "loose: neither an integer id nor a key in the key map"),
        ],
    ),
    "K3_as_singleton": """
        SELECT CAST(1 AS INTEGER) AS id, o_orderkey AS last, o_totalprice AS price
        FROM orders ORDER BY o_orderkey DESC LIMIT 1""",
    "K3_singleton_columns": """
        SELECT 'settings' AS table_name, CAST(ordinal AS BIGINT) AS ordinal, name, data_type, NOT key AS nullable,
               key AS primary_key, false AS "unique"
        FROM (VALUES (0, 'id', 'INTEGER', true), (1, 'owner', 'TEXT', false), (2, 'limit', 'DOUBLE', false))
             AS v(ordinal, name, data_type, key)""",
    "K4_unique_column": _values(
        'table_name, name, "unique"',
        [(t, c, c == "name") for t, _, c, *_ in _CUSTOMER_COLUMNS]
        + [
            ("parts", "brand", True), ("parts", "size", False), ("settings", "id", False),
            ("settings", "owner", False), ("settings", "limit", False), ("loose", "word", False),
        ],
    ),
    "K5_check_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "K6_check_primary_key": """
        WITH items AS (
            SELECT CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS l_orderkey, l_linenumber FROM lineitem
        )
        SELECT l_orderkey, l_linenumber, count(*) AS n,
               CASE WHEN l_orderkey IS NULL THEN 'null key' ELSE 'duplicate key' END AS problem
        FROM items GROUP BY 1, 2 HAVING count(*) > 1 OR l_orderkey IS NULL""",
    "K7_check_not_null": _union(
        "SELECT 'o_orderkey' AS \"column\", CAST(0 AS BIGINT) AS n_null",
        "SELECT 'o_custkey', count(*) FILTER (o_orderstatus = 'F') FROM orders",
        "SELECT 'o_orderdate', count(*) FILTER (o_totalprice <= 1000) FROM orders",
    ),
    "K8_check_foreign_key": """
        SELECT o_custkey, count(*) AS n FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) GROUP BY 1""",
    "K8_orphan_rows": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""",
    "K9_column_default": "SELECT o_orderkey, o_totalprice, 'new' AS state FROM orders",
    "K9_default_keeps_stored": """
        SELECT o_orderkey, o_totalprice + 1 AS o_totalprice,
               CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderstatus) ELSE 'new' END AS state
        FROM orders""",
    "T1_create_table": "SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part",
    "T3_table_exists": "SELECT count(*) AS n, true AS parts, false AS absent FROM part",
    "T4_init_tables": """
        SELECT table_name, name, data_type, nullable, 'table_created' AS event
        FROM (VALUES ('customer_accounts', 'id', 'BIGINT', false), ('customer_accounts', 'balance', 'DOUBLE', true),
                     ('customer_accounts', 'customer_id', 'INTEGER', true), ('customer_profile', 'id', 'BIGINT', false),
                     ('customer_profile', 'name', 'TEXT', true), ('customer_profile', 'segment', 'TEXT', true),
                     ('customer_profile', 'customer_id', 'INTEGER', true)) AS v(table_name, name, data_type, nullable)""",
    "T5_evolve_table": """
        SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS o_custkey FROM orders""",
    "U1_upsert_full": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, {_PRICE}, o_orderdate, o_orderpriority
        FROM orders {_ORDER_UPSERT}""",
    "U1_upsert_partial": f"""
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS o_custkey,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus, {_PRICE},
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS o_orderdate,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS o_orderpriority
        FROM orders {_ORDER_UPSERT}""",
    "U1_upsert_null_key": """
        WITH e AS (
            SELECT event_id, value, CASE WHEN event_type <> 'view' THEN user_id END AS user_id FROM events
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, event_id DESC) AS r
            FROM e WHERE user_id IS NOT NULL
        )
        SELECT event_id, value, user_id FROM ranked WHERE r = 1
        UNION ALL
        SELECT event_id, value, user_id FROM e WHERE user_id IS NULL""",
    "U1_upsert_optional": """
        SELECT o_orderkey AS id, o_orderstatus AS status,
               CASE WHEN o_orderkey % 2 <> 0 THEN o_totalprice END AS price,
               CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_custkey END AS customer
        FROM orders""",
    "U2_last_wins": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r
            FROM lineitem
        ) WHERE r = 1""",
    "U3_project_records": """
        SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status, o_totalprice AS price,
               CASE WHEN o_orderkey % 2 = 1 THEN 'missing: status' END AS problem
        FROM orders""",
    "U4_cast_record": """
        SELECT o_orderkey AS id,
               CAST(n + 0.5 + CASE WHEN n % 2 = 0 THEN -0.5 ELSE 0.5 END AS INTEGER) AS half_int,
               CAST(n + 1 AS INTEGER) AS half_text,
               o_totalprice AS price_text,
               n <> 0 AS flag_text,
               CAST(CASE WHEN n > 3 THEN 1 ELSE 0 END AS INTEGER) AS bool_int,
               CAST(o_custkey AS VARCHAR) AS int_text,
               o_orderdate AS zoned,
               CAST(CASE WHEN n >= 3 THEN 12 END AS INTEGER) AS maybe,
               CAST(CASE WHEN o_custkey < 3 THEN o_custkey + 2147483645 END AS INTEGER) AS wide,
               concat_ws(',', CASE WHEN n < 3 THEN 'maybe' END, CASE WHEN o_custkey >= 3 THEN 'wide' END) AS problems
        FROM (SELECT *, o_orderkey % 7 AS n FROM orders)""",
    "U5_json_column": """
        SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(2 AS BIGINT) AS a FROM events""",
    "U6_batch_count": """
        SELECT count(DISTINCT l_orderkey * 100 + l_linenumber) AS n_rows, 2 * count(*) AS n_written FROM lineitem""",
    "U7_ingest": """
        SELECT 'accounts' AS table_name, c_custkey AS customer_id, c_custkey * 2 + n AS id,
               CASE WHEN n = 0 THEN c_acctbal ELSE -c_acctbal END AS balance, CAST(NULL AS VARCHAR) AS segment
        FROM customer, (VALUES (0), (1)) AS t(n)
        UNION ALL
        SELECT 'profile', c_custkey, c_custkey, CAST(NULL AS DOUBLE),
               CASE WHEN c_custkey % 2 = 0 THEN 'new ' ELSE '' END || c_mktsegment
        FROM customer""",
    "U7_field_names": """
        SELECT o_orderkey AS id, o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS pos, o_custkey AS seq,
               o_orderstatus AS endpoint, o_custkey % 7 AS entity_id, lower(o_orderstatus) AS found,
               o_orderpriority AS problems, CASE WHEN o_orderkey % 4 = 2 THEN 'again' ELSE 'p' || o_custkey END AS problem
        FROM orders""",
    "U8_ingest_simple": """
        SELECT 'orders' AS table_name, o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS dt
        FROM orders
        UNION ALL
        SELECT * FROM (SELECT 'settings', CAST(1 AS BIGINT), s_name, s_acctbal, CAST(NULL AS TIMESTAMP)
                       FROM supplier ORDER BY s_suppkey DESC LIMIT 1)""",
    "U9_ingest_fanout": f"""
        SELECT id, orderkey, price, customer_id FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id, id ORDER BY orderkey DESC) AS r
            FROM ({_LINES}) WHERE customer_id % 3 <> 0
        ) WHERE r = 1""",
    "U9_ingest_fanout_by_id": f"""
        SELECT id, orderkey, price, customer_id FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY orderkey DESC) AS r
            FROM ({_LINES}) WHERE customer_id % 3 <> 0
        ) WHERE r = 1""",
    "U9_two_endpoints": f"""
        SELECT 'sales' AS kind, customer_id AS parent_id, id, price FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id, id ORDER BY orderkey DESC) AS r
            FROM ({_LINES}) WHERE customer_id % 3 <> 0 AND customer_id IN (SELECT c_custkey FROM customer)
        ) WHERE r = 1
        UNION ALL
        SELECT 'notes', s_suppkey, 1, s_acctbal FROM supplier WHERE s_suppkey % 2 = 0""",
    "U9_partitioned": """
        SELECT o_orderkey AS id, o_totalprice + CASE WHEN o_custkey % 5 = 2 THEN 1 ELSE 0 END AS price,
               o_custkey % 5 AS region
        FROM orders""",
    "U10_ingest_stream": """
        SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice + least(o_orderkey % 5, 3) AS price,
               o_orderdate AS dt
        FROM orders""",
    "Q1_fetch_column": """
        SELECT CASE WHEN l_linenumber > 1 THEN l_suppkey END AS suppkey FROM lineitem ORDER BY 1 NULLS LAST""",
    "Q2_capped_ids": "SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 100",
    "Q3_sql": "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand",
    "R1_run_summary": f"""
        SELECT run_id, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status = 'failed') AS failed
        FROM ({_RUNS}) GROUP BY run_id""",
    "R2_latest_state": f"""
        SELECT run_id, task, status, time, error FROM (
            SELECT *, row_number() OVER (PARTITION BY run_id, task ORDER BY time DESC) AS r FROM ({_RUNS})
        ) WHERE r = 1""",
    "R3_progress": _PROGRESS,
    "R3_progress_from_log": _PROGRESS,
    "R4_task_durations": f"""
        SELECT run_id, task, status, round_even((epoch_us(ended) - epoch_us(begun)) / 1e6, 1) AS duration_s
        FROM (
            SELECT run_id, task,
                   min(time) FILTER (status = 'started') AS begun,
                   max(time) FILTER (status IN ('success', 'failed')) AS ended,
                   arg_max(status, time) FILTER (status IN ('success', 'failed')) AS status
            FROM ({_RUNS}) GROUP BY run_id, task
        ) WHERE begun IS NOT NULL AND ended IS NOT NULL""",
    "R5_drift_report": f"""
        SELECT "table", "column", event, count(*) AS n_events, min(time) AS first_seen, max(time) AS last_seen
        FROM ({_DISCOVERY}) GROUP BY 1, 2, 3""",
    "R6_failures": f"""
        SELECT run_id, task, time, error FROM (
            SELECT *, row_number() OVER (PARTITION BY run_id, task ORDER BY time DESC) AS r
            FROM ({_RUNS}) WHERE status = 'failed'
        ) WHERE r = 1""",
    "U1_touched_parts": """
        SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice + CASE WHEN o_custkey % 100 = 7 THEN 1 ELSE 0 END AS price,
               o_orderdate AS dt
        FROM orders""",
    "U10_replay": """
        SELECT event_id, value, user_id FROM events WHERE event_type <> 'view'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
        UNION ALL
        SELECT event_id, value, NULL FROM events WHERE event_type = 'view'""",
    "K6_check_unique_merge": """
        WITH stored AS (SELECT o_orderkey, o_orderkey AS code FROM orders WHERE o_orderkey % 2 = 0),
        batch AS (
            SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey + 4 END AS code FROM orders WHERE o_orderkey % 3 = 0
        ), merged AS (
            SELECT code FROM batch UNION ALL SELECT code FROM stored WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
        )
        SELECT code AS value FROM merged WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1""",
    "K8_ingest_references": """
        SELECT o_orderkey AS id, o_custkey AS customer,
               CASE WHEN o_custkey % 3 = 0 THEN 'customer has no customers.id: ' || CAST(o_custkey AS VARCHAR) END AS problem
        FROM orders""",
    "L3_large_body": """
        SELECT l_orderkey AS seq, 'lines' AS table_name, CAST(NULL AS VARCHAR) AS problem, l_partkey AS partkey,
               l_quantity AS quantity, l_returnflag AS flag, CAST(NULL AS BIGINT) AS n
        FROM lineitem
        UNION ALL
        SELECT l_orderkey, 'total', NULL, NULL, NULL, NULL, count(*) FROM lineitem GROUP BY l_orderkey""",
    "L4_alike_names": f"""
        SELECT 'part_list_{zlib.crc32(b"part-list"):08x}' AS table_name, o_orderkey AS seq, o_orderkey AS id FROM orders
        UNION ALL
        SELECT 'part_list', o_orderkey, o_orderkey + 1 FROM orders""",
    "L8_snapshot_store": """
        SELECT 'changed' AS kind, count(*) AS id,
               round(sum(o_totalprice * CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 1 END), 2) AS price, CAST(NULL AS VARCHAR) AS name
        FROM orders
        UNION ALL
        SELECT 'order', o_orderkey, o_totalprice, NULL FROM orders
        UNION ALL
        SELECT 'supplier', s_suppkey, NULL, s_name FROM supplier""",
    "T5_extra_columns": """
        SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, 'landing' AS origin, 0.5::DOUBLE AS weight,
               true AS checked, '{"a":[1]}' AS tags, TIMESTAMP '2024-01-02 03:04:05' AS loaded_at, o_orderkey * 10 AS response
        FROM orders""",
    "U7_rejected_values": """
        SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN o_custkey END AS customer,
               CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0
                    THEN 'does not fit: customer c-' || CAST(o_custkey AS VARCHAR) END AS problem
        FROM orders""",
    "R2_task_state_stream": f"""
        WITH runs AS ({_RUNS}), last AS (
            SELECT run_id, task, status, time, error FROM runs
            QUALIFY row_number() OVER (PARTITION BY run_id, task ORDER BY time DESC) = 1
        ), moved AS (
            SELECT run_id, task, arg_max(current, time) AS current, arg_max(total, time) AS total,
                   arg_max(current_id, time) FILTER (current_id IS NOT NULL) AS current_id
            FROM runs WHERE current IS NOT NULL GROUP BY run_id, task
        )
        SELECT run_id, task, status, time, error, current, total, round_even(current / total * 100, 1) AS pct, current_id
        FROM last LEFT JOIN moved USING (run_id, task)""",
    "R3_progress_of_nothing": f"""
        SELECT run_id, task, arg_max(current, time) AS current, CASE WHEN task = 'task-3' THEN 0 ELSE 9 END AS total,
               CASE WHEN task <> 'task-3' THEN round_even(arg_max(current, time) / 9 * 100, 1) END AS pct
        FROM ({_RUNS}) WHERE current IS NOT NULL GROUP BY run_id, task""",
}

# Columns of the tables of events by type. A field stands where it is first seen; its type is its first value's.


def _activity(shift: int = 0) -> str:
    return f"""
        SELECT 'events_' || event_type AS table_name, name, data_type, name = 'id' AS key,
               row_number() OVER (PARTITION BY event_type ORDER BY first_seen, place) - 1 AS ordinal
        FROM (
            SELECT event_type, name, min(event_id) AS first_seen, min(place) AS place,
                   coalesce(arg_min(type, event_id) FILTER (type IS NOT NULL), 'TEXT') AS data_type
            FROM (
                SELECT event_type, event_id, 0 AS place, 'INTEGER' AS type,
                       CASE WHEN length(event_type) % 2 = 0 THEN 'id' ELSE 'code' END AS name FROM events
                UNION ALL
                SELECT event_type, event_id, 1, [NULL, 'DOUBLE', 'BOOLEAN', 'TEXT', 'INTEGER'][(event_id // 5 + length(event_type)) % 5 + 1],
                       'm' || (user_id % 6 + {shift}) FROM events
            ) GROUP BY event_type, name
        )"""


def _activity_rows(columns: str, source: str, table_key: str = "CAST(NULL AS VARCHAR)", unique: str = "false") -> str:
    return f"""
        SELECT table_name, CAST(ordinal AS BIGINT) AS ordinal, name, data_type, NOT key AS nullable, key AS primary_key,
               {unique} AS "unique"{f", {table_key} AS table_key" if columns == "all" else ""}
        FROM ({source})"""


#: An ``id`` before the columns of the one table that is a singleton and has none.
_KEYED = f"""
    SELECT table_name, name, data_type, key, ordinal + CASE WHEN table_name = 'events_error' THEN 1 ELSE 0 END AS ordinal
    FROM ({_activity()})
    UNION ALL SELECT DISTINCT 'events_error', 'id', 'INTEGER', true, 0 FROM events WHERE event_type = 'error'
"""
_IS_CLICK_CODE = "(table_name = 'events_click' AND name = 'code')"
_ID_OF_TABLE = "max(CASE WHEN key THEN name END) OVER (PARTITION BY table_name)"
_REPINNED = f"""
    SELECT * FROM ({_activity(1)}) WHERE table_name IN ('events_click', 'events_view')
    UNION ALL SELECT * FROM ({_activity()}) WHERE table_name NOT IN ('events_click', 'events_view')
"""
_DRIFT = f"""
    SELECT 'activity' AS endpoint, coalesce(a.table_name, p.table_name) AS "table",
           CASE WHEN p.name IS NULL THEN 'new_column' WHEN a.name IS NULL THEN 'missing_column' ELSE 'type_change' END AS event,
           coalesce(a.name, p.name) AS "column", CASE WHEN p.name IS NULL THEN a.data_type WHEN a.name IS NULL THEN p.data_type END AS type,
           CASE WHEN a.name = p.name THEN p.data_type END AS was, CASE WHEN a.name = p.name THEN a.data_type END AS now
    FROM ({_activity(1)}) a FULL JOIN ({_activity()}) p ON a.table_name = p.table_name AND a.name = p.name
    WHERE a.data_type IS DISTINCT FROM p.data_type
"""
ORACLES |= {
    "S4_map_event_types": _activity_rows("", _activity()),
    "S5_event_registry_columns": _activity_rows("all", _KEYED, _ID_OF_TABLE, _IS_CLICK_CODE),
    "S6_load_event_registry": _activity_rows("all", _REPINNED, _ID_OF_TABLE),
    "S7_save_event_registry": f"""
        SELECT table_name, {_ID_OF_TABLE} AS primary_key, CAST(3 AS BIGINT) AS version, CAST(ordinal AS BIGINT) AS pos, name, data_type,
               CASE WHEN key THEN 'not_null' WHEN {_IS_CLICK_CODE} THEN 'unique' ELSE '' END AS tests
        FROM ({_KEYED})""",
    "S8_resolve_event_schema": _activity_rows("all", _REPINNED),
    "S9_event_drift": f"SELECT endpoint, \"table\", event, \"column\", type FROM ({_DRIFT}) WHERE event = 'new_column'",
    "S10_event_drift_full": _DRIFT,
    "K1_detect_event_keys": f"""
        SELECT table_name, CASE WHEN bool_or(key) THEN 'id' WHEN table_name = 'events_click' THEN 'code' END AS key_columns,
               bool_or(key) AS is_primary, NOT bool_or(key) AND table_name <> 'events_click' AS no_key
        FROM ({_activity()}) GROUP BY table_name""",
    "K3_event_singleton_columns": f"SELECT * FROM ({_activity_rows('', _KEYED)}) WHERE table_name = 'events_error'",
    "K4_event_unique_column": f"SELECT table_name, name, {_IS_CLICK_CODE} AS \"unique\" FROM ({_KEYED})",
    "T4_init_event_tables": f"""
        SELECT table_name, name, CASE WHEN data_type = 'INTEGER' AND NOT (table_name = 'events_error' AND key) THEN 'BIGINT' ELSE data_type END AS data_type, NOT key AS nullable, 'table_created' AS event
        FROM ({_KEYED})""",
}
ORACLES["S2_infer_responses"] = ORACLES["S2_infer_per_response"]
ORACLES["R1_run_state_stream"] = ORACLES["R1_run_summary"]
