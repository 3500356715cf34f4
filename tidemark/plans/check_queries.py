"""Queries of quality checks, schema evolution, graphs and streams."""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import functions as F

from tidemark.operators import cdc, evolve, graph, joins, quality
from tidemark.plans.base import query, scratch
from tidemark.plans.bindings import entity
from tidemark.plans.silver_queries import KEYS, LIVE, TOTAL
from tidemark.sources import landing
from tidemark.streaming import pipelines as streaming
from tidemark.streaming.store import HistoryStore


@query("q1_quality_summary", "SELECT count(*) AS total_rows, count(*) FILTER (event_id % 11 = 0) AS null_payloads, min(event_id) AS earliest_load, max(event_id) AS latest_load FROM events")
def q1(spark, d):
    e = entity(spark, d, "events").select(F.when(F.col("event_id") % 11 != 0, F.col("props")).alias("payload"), F.col("event_id").alias("ingested_at"))
    return quality.quality_summary(e)


@query("q2_field_profile", " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS total_rows, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS cardinality FROM products" for c in ("product_id", "category", "cost", "active")))
def q2(spark, d):
    return quality.field_profile(entity(spark, d, "products"), ["product_id", "category", "cost", "active"])


@query("q3_check_row_count", """WITH p AS (SELECT o_orderstatus AS table_name, count(*) AS s, count(*) FILTER (o_orderkey % 20 <> 0 OR o_orderstatus = 'F') AS t FROM orders GROUP BY 1)
SELECT table_name, s AS source_rows, t AS target_rows, round(CAST(abs(s - t) AS DOUBLE) * 100 / nullif(s, 0), 4) AS variance_pct, round(CAST(abs(s - t) AS DOUBLE) * 100 / nullif(s, 0), 4) < 5 AS passed FROM p""")
def q3(spark, d):
    o = entity(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("table_name")).agg(F.count("*").alias("source_rows"), F.count_if(F.expr("o_orderkey % 20 <> 0 OR o_orderstatus = 'F'")).alias("target_rows"))
    return quality.check_row_count(o)


@query("q4_check_schema", "SELECT * FROM (VALUES ('o_orderkey', 'bigint', 'bigint', 'MATCH'), ('o_totalprice', 'decimal(12,2)', 'double', 'TYPE_MISMATCH'), ('o_comment', 'string', NULL, 'MISSING'), ('o_custkey', NULL, 'bigint', 'EXTRA'), ('o_orderstatus', NULL, 'string', 'EXTRA'), ('o_orderdate', NULL, 'timestamp_ntz', 'EXTRA'), ('o_orderpriority', NULL, 'string', 'EXTRA')) v(name, expected_type, actual_type, state)")
def q4(spark, d):
    contract = spark.createDataFrame([("o_orderkey", "bigint"), ("o_totalprice", "decimal(12,2)"), ("o_comment", "string")], "name string, type string")
    return quality.check_schema(entity(spark, d, "orders"), contract)


@query("q5_check_quality", """WITH c AS (SELECT count(*) AS n, count(*) FILTER (cost IS NULL) AS a, count(*) FILTER (TRY_CAST(category AS INT) IS NULL) AS b FROM products)
SELECT 'cost' AS column_name, 'decimal(10,2)' AS expected_type, a AS failures, round(CAST(a AS DOUBLE) / n, 6) AS failure_rate, round(CAST(a AS DOUBLE) / n, 6) <= 0.2 AS passed FROM c UNION ALL SELECT 'category', 'int', b, round(CAST(b AS DOUBLE) / n, 6), round(CAST(b AS DOUBLE) / n, 6) <= 0.1 FROM c""")
def q5(spark, d):
    return quality.check_quality(entity(spark, d, "products"), {"cost": ("decimal(10,2)", 0.2), "category": ("int", 0.1)})


@query("q6_check_fk", """WITH c AS (SELECT count(l_partkey) AS n, count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)) AS o FROM lineitem)
SELECT n AS children, o AS orphans, round(CAST((n - o) * 100 AS DOUBLE) / n, 4) AS match_pct, o = 0 AS passed FROM c""")
def q6(spark, d):
    return quality.check_fk(entity(spark, d, "lineitem"), entity(spark, d, "part").filter("p_size > 5"), "l_partkey", "p_partkey")


@query("q7_enforce_constraints", "SELECT product_id, substr(product_name, 1, 8) AS product_name, CASE WHEN cost IS NULL THEN 'cost' ELSE '' END AS violations FROM products")
def q7(spark, d):
    p = entity(spark, d, "products").select("product_id", "product_name", "cost")
    return quality.enforce_constraints(p, {"product_name": 8}, ["product_id", "cost"]).select("product_id", "product_name", "violations")


def _batches(spark, d):
    return entity(spark, d, "products").select("category", "product_id", F.expr("CASE WHEN category LIKE 'S%' AND product_id % 3 = 0 THEN NULL ELSE cost END").alias("cost"), F.expr("nullif(sku, '')").alias("sku"))


RATES = "WITH b AS (SELECT category, CASE WHEN category LIKE 'S%' AND product_id % 3 = 0 THEN NULL ELSE cost END AS cost FROM products), r AS (SELECT category, round(CAST(count(*) FILTER (cost IS NULL) AS DOUBLE) / count(*), 6) AS null_rate FROM b GROUP BY 1)"


@query("q8_null_rate_alerts", f"{RATES} SELECT category, 'cost' AS field, null_rate, 0.1 AS base_rate FROM r WHERE null_rate > 0.2")
def q8(spark, d):
    baseline = spark.createDataFrame([("cost", 0.1), ("sku", 0.01)], "field string, base_rate double")
    return quality.null_rate_alerts(_batches(spark, d), "category", ["cost", "sku"], baseline)


@query("q8_split_quarantine", f"{RATES} SELECT category, CASE WHEN null_rate > 0.2 THEN 'quarantined' ELSE 'clean' END AS state, count(*) AS n FROM products JOIN r USING (category) GROUP BY 1, 2")
def q8_split(spark, d):
    clean, held = quality.split_quarantine(_batches(spark, d), q8(spark, d), "category")
    n = lambda x, s: x.groupBy("category").agg(F.count("*").alias("n")).select("category", F.lit(s).alias("state"), "n")
    return n(clean, "clean").union(n(held, "quarantined"))


@query("q9_check_unique", "SELECT order_id, line_number, count(*) AS occurrences FROM line_changes GROUP BY 1, 2 HAVING count(*) > 1")
def q9(spark, d):
    return quality.check_unique(entity(spark, d, "line_changes"), KEYS)


@query("q10_validation_summary", "WITH p AS (SELECT o_custkey, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey % 5 <> 0 END AS passed FROM orders) SELECT count(*) AS checks, count(*) FILTER (passed) AS passed, count(*) - count(*) FILTER (passed) AS failed, CASE WHEN count(*) = count(*) FILTER (passed) THEN 'PASSED' ELSE 'FAILED' END AS overall FROM p")
def q10(spark, d):
    return quality.validation_summary(entity(spark, d, "orders").select(F.expr("CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey % 5 <> 0 END").alias("passed")))


@query("l2_key_candidates", "SELECT 'o_orderkey' AS key_column, (SELECT CAST(count(DISTINCT o_orderkey) = count(*) AS BIGINT) + CAST(count(DISTINCT o_totalprice) = count(*) AS BIGINT) FROM orders) AS candidates")
def l2(spark, d):
    return quality.key_candidates(entity(spark, d, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey", "o_custkey"))


#: Columns among which keys are looked for, and the SQL that counts each set of one or two of them.
KEYED = {"lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"), "orders": ("o_orderkey", "o_custkey", "o_orderdate"), "events": ("user_id", "ts", "event_type")}


def _sets(table: str) -> str:
    pairs = [(c,) for c in KEYED[table]] + list(itertools.combinations(KEYED[table], 2))
    return " UNION ALL ".join(f"SELECT '{table}' AS table_name, '{','.join(p)}' AS key_columns, {len(p)} AS size, (SELECT count(*) = (SELECT count(*) FROM {table}) FROM (SELECT DISTINCT {', '.join(p)} FROM {table})) AS is_key" for p in pairs)


@query("l2_key_sets", f"""WITH s AS ({' UNION ALL '.join(map(_sets, KEYED))}) SELECT table_name, key_columns, size FROM s WHERE is_key AND NOT (size = 2 AND EXISTS (SELECT 1 FROM s t WHERE t.is_key AND t.size = 1 AND t.table_name = s.table_name AND list_contains(string_split(s.key_columns, ','), t.key_columns)))""")
def l2_sets(spark, d):
    rows = [(t, ",".join(k), len(k)) for t, cols in KEYED.items() for k in quality.key_sets(entity(spark, d, t).select(*cols))]
    return spark.createDataFrame(rows, "table_name string, key_columns string, size int")


@query("l3_sample_rows")
def l3(spark, d):
    return quality.sample_rows(entity(spark, d, "payloads"), 100)


@query("l4_recent_log", "SELECT order_id, status, order_date FROM sales WHERE status IN ('pending', 'processing') ORDER BY order_date DESC, order_id LIMIT 50")
def l4(spark, d):
    return entity(spark, d, "sales").filter(F.col("status").isin("pending", "processing")).orderBy(F.col("order_date").desc(), "order_id").select("order_id", "status", "order_date").limit(50)


def _packed(spark, d, name="products"):
    return landing.pack_bronze(entity(spark, d, name), name, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query("d1_discover_schema", "SELECT 'k' AS key, 'BIGINT' AS value_type, count(*) AS occurrences, min(json_extract_string(props, '$.k')) AS sample_value, count(DISTINCT json_extract_string(props, '$.k')) AS distinct_values, 0.0 AS null_pct FROM events")
def d1(spark, d):
    return evolve.discover_schema(entity(spark, d, "payloads").select(F.try_parse_json("payload_json").alias("payload")))


@query("d1_discover_schema_packed", " UNION ALL ".join(f"SELECT '{c}' AS key, count({c}) AS occurrences, count(DISTINCT {c}) AS distinct_values, round((1 - CAST(count({c}) AS DOUBLE) / count(*)) * 100, 4) AS null_pct FROM products" for c in ("product_id", "product_name", "category", "price", "cost", "sku", "active", "updated_at", "is_deleted")))
def d1_packed(spark, d):
    got = evolve.discover_schema(_packed(spark, d))
    # a decimal without a fraction reads as an integer, so a key can have two kinds
    return got.groupBy("key").agg(F.sum("occurrences").alias("occurrences"), F.sum("distinct_values").alias("distinct_values"), F.round(100 - F.sum(100 - F.col("null_pct")), 4).alias("null_pct"))


#: Payloads nested up to twelve deep, with empty containers, lists of objects, and a key that is a number here and an object there; alike in both engines.
DEEP = """concat('{"id":', CAST(event_id AS STRING), ',"type":"', event_type, '","empty":', CASE WHEN event_id % 2 = 0 THEN '{}' ELSE '[]' END, ',"list":[1,{"x":"y"},[]],"mixed":', CASE WHEN event_id % 3 = 0 THEN '7' WHEN event_id % 3 = 1 THEN concat('{"in":', props, '}') ELSE 'null' END, ',"deep":', repeat('{"d":', CAST(event_id % 11 AS INT)), props, repeat('}', CAST(event_id % 11 AS INT)), '}')"""
#: Leaves of json texts by DuckDB: scalars, nulls and containers that hold nothing.
LEAVES = """SELECT regexp_replace(fullkey, '\\[[0-9]+\\]', '[*]', 'g') AS path, CASE type WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID' WHEN 'DOUBLE' THEN 'DECIMAL' ELSE type END AS value_type, count(*) AS occurrences
 FROM t, json_tree(t.j) WHERE type NOT IN ('OBJECT', 'ARRAY') OR value IN ('{}', '[]') GROUP BY 1, 2"""


@query("d2_discover_paths", f"WITH t AS (SELECT {DEEP} AS j FROM events) {LEAVES}")
def d2(spark, d):
    return evolve.discover_paths(entity(spark, d, "events").select(F.parse_json(F.expr(DEEP)).alias("payload")))


@query("d2_discover_paths_packed", f"""WITH o AS (SELECT l_orderkey, l_orderkey % 7 AS m, json_group_array(json_object('line', l_linenumber, 'part', l_partkey, 'flag', l_returnflag)) AS lines FROM lineitem GROUP BY 1),
t AS (SELECT CASE WHEN m = 0 THEN json_object('order', l_orderkey, 'lines', json_array()) ELSE json_object('order', l_orderkey, 'lines', lines) END AS j FROM o) {LEAVES}""")
def d2_packed(spark, d):
    line = F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"))
    orders = entity(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    lines = F.when(F.col("l_orderkey") % 7 == 0, F.slice("lines", 1, 0)).otherwise(F.col("lines"))
    return evolve.discover_paths(landing.pack_bronze(orders.select(F.col("l_orderkey").alias("order"), lines.alias("lines")), "orders", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")))


@query("d8_infer_payload_schema_events", """SELECT 'OBJECT<event_id: BIGINT, event_type: STRING' || CASE WHEN count(*) FILTER (json_type(json_extract(props, '$.k')) NOT IN ('UBIGINT', 'BIGINT')) > 0 THEN ', props: VARIANT' ELSE ', props: OBJECT<k: BIGINT>' END || '>' AS payload_schema FROM events""")
def d8_bound(spark, d):
    e = entity(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    return evolve.infer_payload_schema(landing.pack_bronze(e, "events", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")))


SCHEMA_ROWS = "(VALUES ('T', 'ID'), ('T', 'NAME'), ('T', 'EXTRA'), ('T', '_SYS_A')) a(table_name, name)"


@query("d3_schema_diff", """WITH a AS (SELECT 'events' AS table_name, upper(unnest(json_keys(props))) AS name FROM events UNION SELECT 'events', upper(c) FROM (VALUES ('event_id'), ('_load_ts')) v(c)), b AS (SELECT 'events' AS table_name, upper(c) AS name FROM (VALUES ('event_id'), ('dropped_one'), ('_sys')) v(c))
SELECT coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.name, b.name) AS name, CASE WHEN b.name IS NULL THEN 'NEW' ELSE 'DROPPED' END AS change FROM (SELECT DISTINCT * FROM a) a FULL OUTER JOIN b ON a.name = b.name WHERE (a.name IS NULL OR b.name IS NULL) AND coalesce(a.name, b.name) NOT LIKE '\\_%' ESCAPE '\\'""")
def d3(spark, d):
    found = evolve.discover_schema(entity(spark, d, "payloads").select(F.try_parse_json("payload_json").alias("payload"))).select(F.lit("events").alias("table_name"), F.col("key").alias("name"))
    more = spark.createDataFrame([("events", "event_id"), ("events", "_load_ts")], "table_name string, name string")
    cols = spark.createDataFrame([("events", c) for c in ("event_id", "dropped_one", "_sys")], "table_name string, name string")
    ignore = spark.createDataFrame([(r"\_%",)], "column_pattern string")
    return evolve.schema_diff(found.union(more), cols, ignore)


@query("d4_tables_needing_work", "WITH t AS (SELECT DISTINCT p_type AS table_name FROM part), f AS (SELECT p_type AS table_name, count(*) AS n FROM part WHERE p_size = 1 AND p_partkey % 2 = 0 GROUP BY 1) SELECT table_name, CASE WHEN table_name LIKE 'S%' THEN 'NEW_TABLE' WHEN n > 0 THEN 'SCHEMA_CHANGED' ELSE 'UP_TO_DATE' END AS state, coalesce(n, 0) AS differences FROM t LEFT JOIN f USING (table_name)")
def d4(spark, d):
    p = entity(spark, d, "part").withColumnRenamed("p_type", "table_name")
    tables = p.select("table_name").distinct()
    return evolve.tables_needing_work(tables, tables.filter("table_name not like 'S%'"), p.filter("p_size = 1 and p_partkey % 2 = 0"))


@query("d5_gold_drift", "SELECT 'orders' AS source_table, 'gold_orders' AS target_table, upper(c) AS column_name, upper(t) AS data_type, 'AUTO_ADD' AS action FROM (VALUES ('o_orderstatus', 'string'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')) v(c, t)")
def d5(spark, d):
    o = entity(spark, d, "orders")
    columns = evolve.column_catalog({"orders": o, "gold_orders": o.select("o_orderkey", "o_custkey")})
    lineage = spark.createDataFrame([("orders", "gold_orders")], "source_table string, target_table string")
    return evolve.gold_drift(lineage, columns, spark.createDataFrame([("%PRICE",)], "column_pattern string"))


@query("d6_propagate_columns", "SELECT c.customer_id, count(s.order_id) AS orders, c.segment AS segment, c.loyalty_tier AS loyalty_tier FROM customers c LEFT JOIN sales s ON s.customer_id = c.customer_id GROUP BY ALL")
def d6(spark, d):
    c, s = entity(spark, d, "customers"), entity(spark, d, "sales")
    gold = joins.child_counts(c.select("customer_id"), s, "customer_id", "orders")
    return evolve.propagate_columns(gold, c, "customer_id", ["segment", "loyalty_tier"])


@query("d7_choose_strategy", """WITH p AS (SELECT 'line_changes' AS table_name, 0 AS nested, (SELECT count(*) FROM (SELECT 1 FROM line_changes GROUP BY order_id, line_number HAVING count(*) > 1)) AS dup, 0 AS v UNION ALL SELECT 'nested_orders', 1, 0, 0 UNION ALL SELECT 'orders', 0, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)), 0)
SELECT table_name, CASE WHEN nested > 0 THEN 'normalize' WHEN v > 0 THEN 'scd2' WHEN dup > 0 THEN 'deduplicate' ELSE 'flatten' END AS strategy, CASE WHEN nested > 0 THEN 0.9 WHEN v > 0 THEN 0.85 WHEN dup > 0 THEN 0.8 ELSE 0.95 END AS confidence FROM p""")
def d7(spark, d):
    n = lambda name, nested, df: df.agg(F.count("*").alias("duplicate_keys")).select(F.lit(name).alias("table_name"), F.lit(nested).alias("nested_arrays"), "duplicate_keys", F.lit(0).alias("versions"))
    lines = quality.check_unique(entity(spark, d, "line_changes"), KEYS)
    orders = quality.check_unique(entity(spark, d, "orders"), ["o_orderkey"])
    return evolve.choose_strategy(n("line_changes", 0, lines).union(n("orders", 0, orders)).union(n("nested_orders", 1, orders)))


@query("d8_infer_payload_schema")
def d8(spark, d):
    return evolve.infer_payload_schema(_packed(spark, d))


@query("d9_contract_violations", "SELECT 'cost' AS column_name, 'INVALID' AS reason, count(*) FILTER (cost IS NULL) AS rows FROM products UNION ALL SELECT 'weight', 'MISSING', count(*) FROM products UNION ALL SELECT 'category', 'INVALID', count(*) FROM products")
def d9(spark, d):
    return evolve.apply_contract(entity(spark, d, "products"), [("product_id", "bigint", True), ("cost", "decimal(10,2)", True), ("weight", "double", True), ("category", "int", True), ("sku", "string", False)])[1]


@query("d9_contract_rows", "SELECT product_id, CAST(price AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS weight FROM products")
def d9_rows(spark, d):
    return evolve.apply_contract(entity(spark, d, "products"), [("product_id", "bigint", True), ("price", "double", True), ("weight", "double", False)])[0]


def _graph(spark, d):
    """Customers to orders to parts, and suppliers to parts."""
    o, l = entity(spark, d, "orders"), entity(spark, d, "lineitem")
    named = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    edge = lambda df, a, b, kind: df.select(a.alias("source_node_id"), b.alias("target_node_id"), F.lit(kind).alias("edge_type"))
    return edge(o, named("c", "o_custkey"), named("o", "o_orderkey"), "PLACED").unionByName(edge(l, named("o", "l_orderkey"), named("p", "l_partkey"), "HOLDS")).unionByName(edge(l, named("s", "l_suppkey"), named("p", "l_partkey"), "SUPPLIES"))


EDGES = "ed AS (SELECT 'c' || o_custkey AS a, 'o' || o_orderkey AS b, 'PLACED' AS kind FROM orders UNION ALL SELECT 'o' || l_orderkey, 'p' || l_partkey, 'HOLDS' FROM lineitem UNION ALL SELECT 's' || l_suppkey, 'p' || l_partkey, 'SUPPLIES' FROM lineitem)"


def _nodes(edges):
    ids = edges.select(F.col("source_node_id").alias("node_id")).union(edges.select("target_node_id")).distinct()
    kind = F.when(F.col("node_id").startswith("c"), "CUSTOMER").when(F.col("node_id").startswith("o"), "ORDER").when(F.col("node_id").startswith("p"), "PART").otherwise("SUPPLIER")
    return ids.select("node_id", kind.alias("node_type"), F.upper("node_id").alias("name"))


def _catalog(spark, d):
    tables = {("SILVER", "CUSTOMERS"): "customers", ("SILVER", "ORDERS"): "sales", ("BRONZE", "PRODUCTS"): "products"}
    rows = [(s, t, entity(spark, d, n)) for (s, t), n in tables.items()]
    counts = None
    for s, t, df in rows:
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), "row_count")
        counts = one if counts is None else counts.union(one)
    cols = evolve.column_catalog({f"{s}.{t}": df for s, t, df in rows})
    return counts, cols.select(F.split_part("table_name", F.lit("."), F.lit(1)).alias("schema_name"), F.split_part("table_name", F.lit("."), F.lit(2)).alias("table_name"), F.upper("column_name").alias("column_name"), "data_type", "ordinal")


NODE_COUNTS = "SELECT 'DATABASE' AS node_type, 1 AS n UNION ALL SELECT 'SCHEMA', 2 UNION ALL SELECT 'TABLE', 3 UNION ALL SELECT 'COLUMN', 27"


@query("g1_build_nodes", f"{NODE_COUNTS}")
def g1(spark, d):
    return graph.build_nodes(*_catalog(spark, d), "ANALYTICS").groupBy("node_type").agg(F.count("*").alias("n"))


@query("g1_table_properties", "SELECT 'TABLE:SILVER.CUSTOMERS' AS node_id, 'silver' AS layer, count(*) AS row_count FROM customers UNION ALL SELECT 'TABLE:SILVER.ORDERS', 'silver', count(*) FROM sales UNION ALL SELECT 'TABLE:BRONZE.PRODUCTS', 'bronze', count(*) FROM products")
def g1_props(spark, d):
    n = graph.build_nodes(*_catalog(spark, d), "ANALYTICS").filter("node_type = 'TABLE'")
    return n.select("node_id", F.get_json_object("properties", "$.layer").alias("layer"), F.get_json_object("properties", "$.row_count").cast("long").alias("row_count"))


@query("g2_build_edges", "SELECT 'CONTAINS' AS edge_type, 3 AS n UNION ALL SELECT 'HAS_COLUMN', 27")
def g2(spark, d):
    return graph.build_edges(graph.build_nodes(*_catalog(spark, d), "ANALYTICS")).groupBy("edge_type").agg(F.count("*").alias("n"))


#: The given tables, and the types of their columns as DuckDB names them beside Spark's names.
TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part", "region", "supplier")
CATALOG = f"cat AS (SELECT upper(table_name) AS table_name, upper(column_name) AS column_name FROM duckdb_columns() WHERE table_name IN ({', '.join(repr(t) for t in TABLES)}) AND schema_name = 'main')"


def _whole_catalog(spark, d):
    """Tables with their rows, and columns, of all given tables: names that begin alike lie in one schema."""
    frames = {t.upper(): entity(spark, d, t) for t in TABLES}
    rows = functools.reduce(lambda a, b: a.union(b), (f.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t, f in frames.items()))
    schema = F.when(F.col("table_name") < "D", "BRONZE").when(F.col("table_name") < "O", "SILVER").otherwise("GOLD")
    columns = evolve.column_catalog(frames).withColumn("column_name", F.upper("column_name"))
    return rows.withColumn("schema_name", schema), columns.withColumn("schema_name", schema)


IN_SCHEMA = "CASE WHEN table_name < 'D' THEN 'BRONZE' WHEN table_name < 'O' THEN 'SILVER' ELSE 'GOLD' END"


@query("g1_nodes_of_all_tables", f"""WITH {CATALOG}, c AS (SELECT *, {IN_SCHEMA} AS s FROM cat), n AS ({' UNION ALL '.join(f"SELECT '{t.upper()}' AS t, count(*) AS row_count FROM {t}" for t in TABLES)})
SELECT 'DB:LAKE' AS node_id, 'DATABASE' AS node_type, 'LAKE' AS name, NULL AS layer, NULL AS row_count UNION ALL SELECT DISTINCT 'SCHEMA:' || s, 'SCHEMA', s, lower(s), NULL FROM c
UNION ALL SELECT DISTINCT 'TABLE:' || s || '.' || table_name, 'TABLE', table_name, lower(s), row_count FROM c JOIN n ON t = table_name UNION ALL SELECT 'COLUMN:' || s || '.' || table_name || '.' || column_name, 'COLUMN', column_name, NULL, NULL FROM c""")
def g1_all(spark, d):
    nodes = graph.build_nodes(*_whole_catalog(spark, d), "LAKE")
    of = lambda k: F.get_json_object("properties", f"$.{k}")
    return nodes.select("node_id", "node_type", "name", of("layer").alias("layer"), of("row_count").cast("long").alias("row_count"))


@query("g2_edges_of_all_tables", f"""WITH {CATALOG}, c AS (SELECT *, {IN_SCHEMA} AS s FROM cat)
SELECT DISTINCT 'SCHEMA:' || s AS source_node_id, 'TABLE:' || s || '.' || table_name AS target_node_id, 'CONTAINS' AS edge_type FROM c UNION ALL SELECT 'TABLE:' || s || '.' || table_name, 'COLUMN:' || s || '.' || table_name || '.' || column_name, 'HAS_COLUMN' FROM c""")
def g2_all(spark, d):
    return graph.build_edges(graph.build_nodes(*_whole_catalog(spark, d), "LAKE"))


@query("g3_lineage_edges", "SELECT 'TABLE:BRONZE.PRODUCTS' AS source_node_id, 'TABLE:SILVER.ORDERS' AS target_node_id, 'FEEDS' AS edge_type")
def g3(spark, d):
    lineage = spark.createDataFrame([("BRONZE", "PRODUCTS", "SILVER", "ORDERS", "FEEDS"), ("SILVER", "ORDERS", "GOLD", "NONE", "FEEDS")], "source_schema string, source_table string, target_schema string, target_table string, edge_type string")
    return graph.lineage_edges(lineage, graph.build_nodes(*_catalog(spark, d), "ANALYTICS"))


@query("g4_lineage_closure", f"""WITH {EDGES}, u AS (SELECT DISTINCT a, b FROM ed), h1 AS (SELECT b AS node_id, min(a || '>' || b) AS path FROM u WHERE a IN ('c1', 'c2') GROUP BY 1), h2 AS (SELECT u.b AS node_id, min(path || '>' || u.b) AS path FROM h1 JOIN u ON u.a = h1.node_id GROUP BY 1)
SELECT node_id, 1 AS hop, path FROM h1 UNION ALL SELECT node_id, 2, path FROM h2 WHERE node_id NOT IN (SELECT node_id FROM h1)""")
def g4(spark, d):
    return graph.lineage_closure(_graph(spark, d), ["c1", "c2"], "downstream", 5)


@query("g4_upstream_closure", f"""WITH {EDGES}, u AS (SELECT DISTINCT a, b FROM ed), h1 AS (SELECT a AS node_id, min('p5>' || a) AS path FROM u WHERE b = 'p5' GROUP BY 1), h2 AS (SELECT u.a AS node_id, min(path || '>' || u.a) AS path FROM h1 JOIN u ON u.b = h1.node_id GROUP BY 1)
SELECT node_id, 1 AS hop, path FROM h1 UNION ALL SELECT node_id, 2, path FROM h2 WHERE node_id NOT IN (SELECT node_id FROM h1)""")
def g4_up(spark, d):
    return graph.lineage_closure(_graph(spark, d), ["p5"], "upstream", 5)


@query("g5_impact", f"WITH {EDGES}, u AS (SELECT DISTINCT a, b FROM ed), h1 AS (SELECT DISTINCT b FROM u WHERE a = 'c1'), h2 AS (SELECT DISTINCT u.b FROM h1 JOIN u ON u.a = h1.b UNION SELECT b FROM h1) SELECT 'c1' AS table_name, count(*) AS downstream, CASE WHEN count(*) > 5 THEN 'HIGH_IMPACT' WHEN count(*) > 0 THEN 'HAS_DEPENDENTS' ELSE 'NONE' END AS warning FROM h2")
def g5(spark, d):
    return graph.impact(spark.createDataFrame([("c1",)], "table_name string"), graph.lineage_closure(_graph(spark, d), ["c1"], "downstream", 5))


@query("g5_impact_of_all", f"""WITH {EDGES}, u AS (SELECT DISTINCT a, b FROM ed), r AS (SELECT a, b FROM u UNION SELECT x.a, y.b FROM u x JOIN u y ON y.a = x.b), n AS (SELECT a AS node_id FROM u UNION SELECT b FROM u)
SELECT node_id, count(b) AS downstream, true AS exact, CASE WHEN count(b) > 5 THEN 'HIGH_IMPACT' WHEN count(b) > 0 THEN 'HAS_DEPENDENTS' ELSE 'NONE' END AS warning FROM n LEFT JOIN r ON r.a = node_id GROUP BY 1""")
def g5_all(spark, d):
    return graph.impact_of_all(_graph(spark, d))


@query("g6_neighbours", f"WITH {EDGES} SELECT b AS neighbour_id, upper(b) AS neighbour_name, kind AS edge_type, 'OUTGOING' AS direction FROM ed WHERE a = 'o7' UNION ALL SELECT a, upper(a), kind, 'INCOMING' FROM ed WHERE b = 'o7'")
def g6(spark, d):
    e = _graph(spark, d)
    return graph.neighbours(_nodes(e), e, "o7")


@query("g7_suggest_joins", "SELECT 'sales' AS source_table, 'customer_id' AS column_name, 'customers' AS target_table, 'HIGH' AS confidence UNION ALL SELECT * FROM (VALUES ('items', 'product_id', 'products', 'MEDIUM'), ('tickets', 'customer_id', 'customers', 'MEDIUM')) v(source_table, column_name, target_table, confidence)")
def g7(spark, d):
    columns = evolve.column_catalog({n: entity(spark, d, n) for n in ("customers", "products", "sales", "items", "tickets")})
    fks = spark.createDataFrame([("sales", "customer_id", "customers")], "source_table string, column_name string, target_table string")
    return graph.suggest_joins(columns, fks)


@query("g8_graph_stats", f"""WITH {EDGES}, n AS (SELECT a AS i FROM ed UNION SELECT b FROM ed)
SELECT 'edge' AS element, kind AS type, count(*) AS n FROM ed GROUP BY 2 UNION ALL SELECT 'node', CASE substr(i, 1, 1) WHEN 'c' THEN 'CUSTOMER' WHEN 'o' THEN 'ORDER' WHEN 'p' THEN 'PART' ELSE 'SUPPLIER' END, count(*) FROM n GROUP BY 2""")
def g8(spark, d):
    e = _graph(spark, d)
    return graph.graph_stats(_nodes(e), e)


def _statements(spark, d):
    """A statement log made of the orders: each reads the table of its status, and of its priority."""
    o = entity(spark, d, "orders")
    return o.select("o_orderkey", F.concat(F.lit("WITH picked AS (SELECT * FROM raw."), "o_orderstatus", F.lit(" r /* FROM hidden */ WHERE note = 'read FROM text') SELECT * FROM picked x, \"dim_"), F.substring("o_orderpriority", 1, 1), F.lit("\" y -- JOIN nothing\nWHERE x.k = y.k AND extract(year FROM x.day) > 2000")).alias("sql_text"))


REFS = "rf AS (SELECT o_orderkey, upper('raw.' || o_orderstatus) AS table_name FROM orders UNION SELECT o_orderkey, upper('dim_' || substr(o_orderpriority, 1, 1)) FROM orders)"


@query("g9_extract_refs", f"WITH {REFS} SELECT * FROM rf")
def g9(spark, d):
    return graph.extract_refs(_statements(spark, d), "sql_text", "o_orderkey")


@query("g10_validate_refs", f"WITH {REFS} SELECT DISTINCT table_name, CASE WHEN table_name = 'RAW.F' THEN 'RAW.F_OLD' ELSE '' END AS suggestions FROM rf WHERE table_name NOT IN ('RAW.O', 'RAW.P', 'DIM_1', 'DIM_2')")
def g10(spark, d):
    tables = spark.createDataFrame([(t,) for t in ("raw.o", "raw.p", "dim_1", "dim_2", "raw.f_old")], "table_name string")
    return graph.validate_refs(graph.extract_refs(_statements(spark, d), "sql_text", "o_orderkey"), tables)


@query("g11_register_lineage", f"WITH {REFS} SELECT DISTINCT table_name AS source_table, 'GOLD_ORDERS' AS target_table FROM rf")
def g11(spark, d):
    refs = graph.extract_refs(_statements(spark, d), "sql_text", "o_orderkey")
    known = spark.createDataFrame([("RAW.F", "GOLD_ORDERS")], "source_table string, target_table string")
    return graph.register_lineage(refs, known, "GOLD_ORDERS")


@query("g12_coverage_gaps", "SELECT 'GOLD_X' AS table_name, 'MISSING_TARGET' AS gap, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS detail FROM part WHERE p_type LIKE 'S%' UNION ALL SELECT DISTINCT p_type, 'UNCOVERED_SOURCE', 'no downstream' FROM part WHERE p_type NOT LIKE 'S%'")
def g12(spark, d):
    tables = entity(spark, d, "part").select(F.col("p_type").alias("table_name")).distinct()
    lineage = tables.filter("table_name like 'S%'").select(F.col("table_name").alias("source_table"), F.lit("GOLD_X").alias("target_table"))
    return graph.coverage_gaps(lineage, tables)


@query("g14_merge_learnings", """WITH n AS (SELECT user_id, event_id, CAST(event_id % 100 AS DOUBLE) / 100 AS c, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, count(*) OVER (PARTITION BY user_id) AS k FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'),
b AS (SELECT user_id, max(k) AS k, sum(c / pow(2, k - i + 1)) AS s, max(CASE WHEN i = 1 THEN c END) AS f FROM n GROUP BY 1), t AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00')
SELECT 'u' || coalesce(t.user_id, b.user_id) AS pattern_signature, coalesce(CASE WHEN t.user_id IS NOT NULL THEN 3 END, 0) + coalesce(b.k, 0) AS times_observed,
 round(CASE WHEN b.user_id IS NULL THEN 0.5 WHEN t.user_id IS NULL THEN s + f / pow(2, k) ELSE 0.5 / pow(2, k) + s END, 6) AS confidence_score FROM t FULL OUTER JOIN b ON t.user_id = b.user_id""")
def g14(spark, d):
    e = entity(spark, d, "events")
    sign = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("pattern_signature")
    target = e.filter("ts < timestamp_ntz'2024-01-10 00:00:00'").select(sign).distinct().select("pattern_signature", F.lit(3).cast("long").alias("times_observed"), F.lit(0.5).alias("confidence_score"))
    new = e.filter("ts >= timestamp_ntz'2024-01-10 00:00:00'").select(sign, ((F.col("event_id") % 100).cast("double") / 100).alias("confidence_score"), F.col("event_id").alias("seq"))
    return graph.merge_learnings(target, new)


@query("g15_active_directives", """SELECT 'd1' AS directive_id, 'gold' AS target_layer, 1 AS priority, count(DISTINCT p_type) AS tables, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS matched_tables FROM part UNION ALL
SELECT 'd2', 'gold', 2, count(DISTINCT p_type), string_agg(DISTINCT p_type, ', ' ORDER BY p_type) FROM part WHERE p_type LIKE 'S%'""")
def g15(spark, d):
    directives = spark.createDataFrame([("d1", "%", "gold", 1, True), ("d2", "S%", "gold", 2, True), ("d3", "%", "silver", 3, False)], "directive_id string, source_table_pattern string, target_layer string, priority int, is_active boolean")
    return graph.active_directives(directives, entity(spark, d, "part").select(F.col("p_type").alias("table_name")).distinct())


@query("g16_run_dashboard", """SELECT ticket_id AS execution_id, 'workflow' AS workflow_name, priority AS trigger_type, status, 'reflect' AS current_phase, customer_id AS tables_triggered, ticket_id % 7 AS executions_succeeded, ticket_id % 3 AS executions_failed, CAST(NULL AS BIGINT) AS validations_passed, CAST(NULL AS BIGINT) AS validations_failed,
 ticket_id % 5 AS learnings_captured, CAST(ticket_id % 4 AS INT) AS retry_count, CAST(date_diff('second', created_at, coalesce(resolved_at, TIMESTAMP '2024-01-31 00:00:00')) AS BIGINT) AS duration_seconds, created_at AS started_at, resolved_at AS completed_at, CAST(NULL AS STRING) AS last_error FROM tickets""")
def g16(spark, d):
    t, n = entity(spark, d, "tickets"), F.col("ticket_id")
    runs = t.select(
        n.alias("execution_id"), F.lit("workflow").alias("workflow_name"), F.col("priority").alias("trigger_type"), "status", F.lit("reflect").alias("current_phase"), F.to_json(F.struct(F.col("customer_id").alias("tables_planned"))).alias("planner_output"),
        F.to_json(F.struct((n % 7).alias("success_count"), (n % 3).alias("fail_count"))).alias("executor_output"), F.lit("not json").alias("validator_output"), F.to_json(F.struct((n % 5).alias("learnings_count"))).alias("reflector_output"),
        (n % 4).cast("int").alias("retry_count"), F.col("created_at").alias("started_at"), F.col("resolved_at").alias("completed_at"), F.lit(None).cast("string").alias("last_error"))
    return graph.run_dashboard(runs, "2024-01-31 00:00:00")


@query("v1_similar_items", """WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC NULLS LAST, vec_id) AS INT) AS rank FROM s) SELECT query_id, vec_id, round(similarity, 4) AS similarity, rank FROM r WHERE rank <= 5""")
def v1(spark, d):
    e = entity(spark, d, "embeddings").select("vec_id", "embedding")
    return graph.similar_items(e, e.filter("vec_id % 50 = 0"), 5).withColumn("similarity", F.round("similarity", 4))


def _folder(spark, d, parts):
    """The change log written as files, for the streams, by tasks over parts of it; batches by supplier, so that versions come late and out of order. Also how many files make
    a batch (there are about `parts` batches), and a number of buckets that grows with the log: a task of a store holds one."""
    at = scratch(spark)
    log = entity(spark, d, "line_changes")
    batch = F.coalesce(F.pmod("supplier_id", F.lit(parts)), F.lit(0))  # a change without a supplier is one, too
    for i in range(parts):
        log.filter(batch == i).write.mode("append").parquet(f"{at}/in")
    files = len(spark.read.schema(log.schema).parquet(f"{at}/in").inputFiles())
    return at, log.schema, -(-files // parts), max(16, files)


@query("r1_stream_changes", "SELECT count(*) AS n, sum(line_total) AS total FROM line_changes")
def r1(spark, d):
    at, schema, files, _ = _folder(spark, d, 3)
    streaming.append_available(streaming.stream_changes(spark, f"{at}/in", schema, files), f"{at}/cp", f"{at}/out")
    return spark.read.parquet(f"{at}/out").agg(F.count("*").alias("n"), F.sum("line_total").alias("total"))


@query("r2_pending_rows", "SELECT count(*) AS pending, count(*) > 0 AS has_data FROM line_changes WHERE _updated_at >= DATE '1998-01-01'")
def r2(spark, d):
    import datetime

    return streaming.pending_rows(entity(spark, d, "line_changes"), datetime.date(1998, 1, 1), "_updated_at")


@query("r3_stream_bronze", "SELECT 'line_changes' AS source_table, count(*) AS n, count(DISTINCT order_id) AS orders FROM line_changes")
def r3(spark, d):
    at, schema, files, _ = _folder(spark, d, 2)
    streaming.append_available(streaming.stream_bronze(streaming.stream_changes(spark, f"{at}/in", schema, files), "line_changes"), f"{at}/cp", f"{at}/out")
    return spark.read.parquet(f"{at}/out").groupBy("source_table").agg(F.count("*").alias("n"), F.countDistinct(F.get_json_object("payload_json", "$.order_id")).alias("orders"))


@query("r4_stream_latest", LIVE)
def r4(spark, d):
    at, schema, files, buckets = _folder(spark, d, 4)
    got = streaming.stream_latest(streaming.stream_changes(spark, f"{at}/in", schema, files), KEYS, TOTAL, f"{at}/snap", f"{at}/cp", buckets)
    return cdc.live(got.latest()).drop("_deleted")


@query("r6_stream_gold", """SELECT CAST(date_trunc('month', _updated_at) AS DATE) AS month, count(*) AS n, CAST(sum(line_total) AS DECIMAL(18,2)) AS total, min(line_total) AS least, max(_updated_at) AS last_change, round(avg(CAST(line_total AS DOUBLE)), 6) AS mean, count(DISTINCT product_id) AS products, count(DISTINCT supplier_id) AS suppliers FROM line_changes GROUP BY 1""")
def r6(spark, d):
    at, schema, files, buckets = _folder(spark, d, 3)
    stream = streaming.stream_changes(spark, f"{at}/in", schema, files).withColumn("month", F.trunc("_updated_at", "month"))
    measures = {"n": ("count", "*"), "total": ("sum", "line_total"), "least": ("min", "line_total"), "last_change": ("max", "_updated_at"), "mean": ("avg", "line_total"), "products": ("count_distinct", "product_id"), "suppliers": ("count_distinct", "supplier_id")}
    got = streaming.stream_gold(stream, ["month"], measures, f"{at}/gold", f"{at}/cp", buckets).latest()
    return got.withColumns({"total": F.col("total").cast("decimal(18,2)"), "mean": F.round("mean", 6)})


@query("c5_scd2_by_batches", """WITH o AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events), k AS (SELECT * FROM o WHERE b IS NULL OR b <> event_type)
SELECT user_id, event_type, event_id AS valid_from, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) IS NULL AS is_current FROM k""")
def c5_batches(spark, d):
    log = entity(spark, d, "events").select("user_id", "event_id", "event_type")
    history = HistoryStore(spark, scratch(spark), log.schema, ["user_id"], "event_id", ["event_type"], 8)
    for n, condition in enumerate(("event_id % 3 = 2", "event_id % 3 = 0", "event_id % 3 = 1")):  # each batch comes late for the one before
        history.apply(log.filter(condition), n)
    return history.latest().select("user_id", "event_type", "valid_from", "valid_to", "is_current")


@query("r5_stream_latest_stateful", LIVE)
def r5(spark, d):
    at, schema, files, buckets = _folder(spark, d, 4)
    got = streaming.latest_stateful(streaming.stream_changes(spark, f"{at}/in", schema, files), KEYS, TOTAL, f"{at}/out", f"{at}/cp", buckets)
    return cdc.live(got).drop("_deleted")


@query("r7_process_incremental", "SELECT 'lines' AS table_name, max(_updated_at) AS last_ts, 100 + count(*) FILTER (_updated_at >= DATE '1998-01-01') AS rows_processed FROM line_changes")
def r7(spark, d):
    marks = spark.createDataFrame([("lines", 100)], "table_name string, rows_processed long").select("table_name", F.lit("1998-01-01").cast("date").alias("last_ts"), F.array().cast("array<long>").alias("seen"), "rows_processed")
    return streaming.process_incremental(entity(spark, d, "line_changes"), marks, "lines", "_updated_at", lambda x: x)[1].drop("seen")


@query("r8_stage_latency", "WITH s AS (SELECT 0 AS position, 'landing' AS stage, max(ts) AS t FROM events UNION ALL SELECT 1, 'bronze', max(ts) FROM events WHERE event_type <> 'signup' UNION ALL SELECT 2, 'silver', max(ts) FROM events WHERE event_type = 'purchase') SELECT position, stage, CAST(date_diff('second', t, lag(t) OVER (ORDER BY position)) AS BIGINT) AS lag_s FROM s")
def r8(spark, d):
    return streaming.stage_latency({n: (df, "ts") for n, df in _layers(spark, d).items()})


def _layers(spark, d):
    e = entity(spark, d, "events")
    bronze = e.filter("event_type <> 'signup'")
    return {"landing": e, "bronze": bronze, "silver": bronze.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("ts"))}


@query("r8_freshness", "SELECT CAST(date_diff('second', (SELECT max(ts) FROM events WHERE event_type = 'purchase'), max(ts)) AS BIGINT) AS lag_s, date_diff('second', (SELECT max(ts) FROM events WHERE event_type = 'purchase'), max(ts)) <= 300 AS within_sla FROM events")
def r8_fresh(spark, d):
    layers = _layers(spark, d)
    return streaming.freshness(layers["landing"], layers["silver"], "ts")
