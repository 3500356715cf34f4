"""Entities of the pipeline bound to the given tables. One list of expressions serves Spark and the DuckDB oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"
#: Cuts of the lifetime value that reach every tier of the given orders.
CUTS = (4_000_000, 2_500_000, 1_000_000)

#: name: (source, expressions, condition); expressions read alike in both engines.
ENTITIES: dict[str, tuple[str, list[str], str]] = {
    "customers": ("customer", [
        "c_custkey AS customer_id", "split_part(c_name, '#', 1) AS first_name", "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name", "concat(lower(c_name), '@x.io') AS email",
        "CASE c_nationkey % 3 WHEN 0 THEN 'Acme Corp' WHEN 1 THEN 'Startup Labs' ELSE 'Solutions' END AS company_name", "c_mktsegment AS segment",
        "CAST(c_acctbal * 1000 AS DECIMAL(15,2)) AS annual_revenue",
        "CASE WHEN c_acctbal >= 7000 THEN 'GOLD' WHEN c_acctbal >= 3000 THEN 'SILVER' ELSE 'BRONZE' END AS loyalty_tier",
        "c_nationkey % 4 <> 0 AS is_active", "DATE '1995-01-01' + CAST(c_custkey % 1000 AS INT) AS created_at",
        "concat('+1-555-', CAST(c_custkey AS STRING)) AS phone", "DATE '1998-01-01' + CAST(c_nationkey AS INT) AS updated_at", "CASE WHEN c_acctbal < -900 THEN true WHEN c_acctbal > 9900 THEN NULL ELSE false END AS is_deleted",
    ], "true"),
    "products": ("part", [
        "p_partkey AS product_id", "p_name AS product_name", "p_type AS category", "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
        "CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size * 10 AS DECIMAL(10,2)) END AS cost", "concat(p_brand, '-', CAST(p_partkey AS STRING)) AS sku", "p_size <= 40 AS active",
        "DATE '1996-01-01' + CAST(p_size AS INT) AS updated_at", "CASE WHEN p_size = 50 THEN true WHEN p_size = 49 THEN NULL ELSE false END AS is_deleted",
    ], "true"),
    "sales": ("orders", [
        "o_orderkey AS order_id", "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS order_date",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'processing' END AS status", "CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount",
    ], "true"),
    "items": ("lineitem", [
        "l_orderkey * 10 + l_linenumber AS item_id", "l_orderkey AS order_id", "l_linenumber AS line_number", "l_partkey AS product_id", "CAST(l_quantity AS INT) AS quantity",
        "CAST(floor(l_extendedprice / l_quantity) AS DECIMAL(10,2)) AS unit_price", "CAST(l_extendedprice AS DECIMAL(12,2)) AS line_total", "CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_percent",
    ], "true"),
    "user_events": ("events", [
        "event_id", "user_id", "event_type", "ts",
        "min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS resolved_at",
        "min(CASE WHEN event_type <> 'error' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS first_response_at",
    ], "true"),
    "tickets": ("user_events", [
        "event_id AS ticket_id", "user_id AS customer_id", "ts AS created_at", "resolved_at", "first_response_at", "CASE WHEN resolved_at IS NULL THEN 'open' ELSE 'resolved' END AS status",
        "CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS priority",
    ], "event_type = 'error'"),
    # soft-delete change log: a later version of a line per ship date, removed ones flagged
    "line_changes": ("lineitem", [
        "l_orderkey AS order_id", "l_linenumber AS line_number", "l_partkey AS product_id", "l_suppkey AS supplier_id", "CAST(l_extendedprice AS DECIMAL(12,2)) AS line_total",
        "CAST(l_shipdate AS DATE) AS _updated_at", "l_returnflag = 'R' AS _deleted",
    ], "true"),
    # op-coded change log
    "event_log": ("events", [
        "event_id", "user_id", "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS _cdc_operation", "ts AS _cdc_timestamp",
        "concat('0/', lpad(hex(event_id), 8, '0')) AS _cdc_lsn", "event_type", "CAST(value AS DECIMAL(12,2)) AS amount",
    ], "true"),
    "payloads": ("events", ["event_id", "event_type", "ts", "props AS payload_json"], "true"),
}


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bound entity, or a table as it is. Paths are left to Spark's readers."""
    if name not in ENTITIES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    source, columns, condition = ENTITIES[name]
    return entity(spark, sf_dir, source).filter(condition).selectExpr(*columns)


def oracle(sql: str) -> str:
    """sql, with the entities that it names put before it as common tables. It may itself be a WITH query."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name, (source, _, _) in ENTITIES.items():
            if name not in need and re.search(rf"\b{name}\b", text):
                visit(source)
                need.append(name)

    visit(sql)
    if not need:
        return sql
    parts = ", ".join(f"{n} AS (SELECT {', '.join(ENTITIES[n][1])} FROM {ENTITIES[n][0]} WHERE {ENTITIES[n][2]})" for n in need)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {parts}, {body[4:].strip()}"
    return f"WITH {parts} {body}"
