"""Queries of sources, sinks, silver rules, change capture and joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeutil import cosine, day_diff, hour_diff, lsn_value, month_diff
from tidemark.operators import cdc, joins, silver
from tidemark.plans.base import query, scratch
from tidemark.plans.bindings import AS_OF, entity
from tidemark.sources import landing


def loaded():
    """The load time of all rows; a function, as columns need a running session, and importing must not."""
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


#: Landing entity to the bound one that stands for it, and its key.
LANDED = {"customers": ("customers", "customer_id"), "products": ("products", "product_id"), "orders": ("sales", "order_id"), "order_items": ("items", "item_id"), "support_tickets": ("tickets", "ticket_id")}


def _landed(spark, d, name):
    """The bound entity written as a landing table, and read as one."""
    at = scratch(spark)
    landing.reconcile_to_schema(entity(spark, d, LANDED[name][0]), T._parse_datatype_string(landing.SCHEMAS[name])).write.parquet(at)
    return landing.read_landing(spark, at, name)


@query("s1_read_landing", """SELECT customer_id, first_name, last_name, email, phone, company_name, CAST(NULL AS STRING) AS industry, segment, annual_revenue, loyalty_tier, is_active, CAST(created_at AS TIMESTAMP) AS created_at, CAST(updated_at AS TIMESTAMP) AS updated_at FROM customers""")
def s1(spark, d):
    return _landed(spark, d, "customers").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})


@query("s1_read_landing_entities", " UNION ALL ".join(f"SELECT '{n}' AS entity, count(*) AS n, CAST(sum({k}) AS BIGINT) AS keys FROM {e}" for n, (e, k) in LANDED.items()))
def s1_all(spark, d):
    one = lambda n: _landed(spark, d, n).agg(F.count("*").alias("n"), F.sum(LANDED[n][1]).alias("keys")).select(F.lit(n).alias("entity"), "n", "keys")
    return landing.union_bronze(*map(one, LANDED))


@query("s3_read_changelog", "SELECT event_id, user_id, _cdc_operation, _cdc_lsn, amount, event_id % 10 = 3 AS malformed FROM (SELECT CASE WHEN event_id % 10 = 3 THEN NULL ELSE event_id END AS event_id, CASE WHEN event_id % 10 = 3 THEN NULL ELSE user_id END AS user_id, _cdc_operation, _cdc_lsn, CASE WHEN event_id % 10 = 3 THEN NULL ELSE amount END AS amount, event_id AS e FROM event_log) t(event_id, user_id, _cdc_operation, _cdc_lsn, amount, e)".replace("event_id % 10 = 3 AS malformed", "e % 10 = 3 AS malformed", 1))
def s3(spark, d):
    at, log = scratch(spark), entity(spark, d, "event_log")
    payload = F.when(F.col("event_id") % 10 == 3, F.lit("{cut off")).otherwise(F.to_json(F.struct("event_id", "user_id", F.col("amount").cast("string").alias("amount"))))
    log.select("_cdc_operation", F.col("_cdc_timestamp").cast("timestamp").alias("_cdc_timestamp"), F.lit("app").alias("_cdc_source"), "_cdc_lsn", F.col("_cdc_timestamp").cast("timestamp").alias("_metadata_load_ts"), payload.alias("raw_payload")).write.parquet(at)
    got, of = landing.read_changelog(spark, at), lambda k, t: F.try_variant_get("payload", f"$.{k}", t)
    return got.select(of("event_id", "long").alias("event_id"), of("user_id", "long").alias("user_id"), "_cdc_operation", "_cdc_lsn", of("amount", "string").cast("decimal(12,2)").alias("amount"), F.col("payload").isNull().alias("malformed"))


@query("s4_read_soft_delete", "SELECT order_id, line_number, product_id, _updated_at, coalesce(_deleted, false) AS _deleted FROM line_changes")
def s4(spark, d):
    at = scratch(spark)
    entity(spark, d, "line_changes").withColumn("_deleted", F.when(F.col("_deleted"), "Y").when(F.col("line_number") == 1, "n")).write.parquet(at)
    return landing.read_soft_delete(spark, at).select("order_id", "line_number", "product_id", "_updated_at", "_deleted")


@query("s5_ingest_json", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, 'events' AS source FROM events GROUP BY 1")
def s5(spark, d):
    rows = landing.ingest_json(entity(spark, d, "payloads"), "payload_json", "events", loaded())
    return rows.groupBy(F.try_variant_get("raw_payload", "$.k", "long").alias("k")).agg(F.count("*").alias("n"), F.first("_metadata_source").alias("source"))


@query("s6_pack_bronze", "SELECT product_id, cost, CAST(9 - (cost IS NULL)::INT - (is_deleted IS NULL)::INT AS INT) AS n_keys FROM products")
def s6(spark, d):
    packed = landing.pack_bronze(entity(spark, d, "products"), "products", loaded())
    return packed.select(F.variant_get("payload", "$.product_id", "long").alias("product_id"), F.try_variant_get("payload", "$.cost", "decimal(10,2)").alias("cost"), F.size(F.json_object_keys("payload_json")).alias("n_keys"))


@query("s7_union_bronze", "SELECT 'customers' AS source_table, count(*) AS n FROM customers UNION ALL SELECT 'products', count(*) FROM products")
def s7(spark, d):
    packed = [landing.pack_bronze(entity(spark, d, t), t, loaded()) for t in ("customers", "products")]
    return landing.union_bronze(*packed).groupBy("source_table").agg(F.count("*").alias("n"))


@query("s8_materialize", "SELECT status, count(*) AS n, sum(total_amount) AS amount FROM sales GROUP BY status")
def s8(spark, d):
    stored = landing.materialize(entity(spark, d, "sales"), scratch(spark), ["status"])
    return stored.groupBy("status").agg(F.count("*").alias("n"), F.sum("total_amount").alias("amount"))


UPDATES = """
u AS (SELECT customer_id, CAST(annual_revenue + 100 AS DECIMAL(15,2)) AS annual_revenue, segment FROM customers WHERE customer_id % 5 = 0
      UNION ALL SELECT customer_id + 10000000, annual_revenue, segment FROM customers WHERE customer_id % 7 = 0)"""


def _updates(spark, d):
    c = entity(spark, d, "customers").select("customer_id", "annual_revenue", "segment")
    up = c.filter("customer_id % 5 = 0").withColumn("annual_revenue", (F.col("annual_revenue") + 100).cast("decimal(15,2)"))
    return c, up.unionByName(c.filter("customer_id % 7 = 0").withColumn("customer_id", F.col("customer_id") + 10_000_000))


@query("s9_upsert", f"""WITH {UPDATES}
SELECT coalesce(u.customer_id, c.customer_id) AS customer_id, coalesce(u.annual_revenue, c.annual_revenue) AS annual_revenue, coalesce(u.segment, c.segment) AS segment
FROM customers c FULL OUTER JOIN u ON c.customer_id = u.customer_id""")
def s9(spark, d):
    target, updates = _updates(spark, d)
    return landing.upsert(target, updates, ["customer_id"])


@query("s10_insert_absent", f"""WITH {UPDATES}
SELECT customer_id, annual_revenue, segment FROM customers UNION ALL SELECT * FROM u WHERE customer_id NOT IN (SELECT customer_id FROM customers)""")
def s10(spark, d):
    target, updates = _updates(spark, d)
    return landing.insert_absent(target, updates, ["customer_id"])


@query("s11_reconcile_to_schema", "SELECT customer_id, CAST(NULL AS STRING) AS fax, CAST(annual_revenue AS DOUBLE) AS annual_revenue, CAST(NULL AS INT) AS segment FROM customers")
def s11(spark, d):
    target = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("fax", T.StringType()), T.StructField("annual_revenue", T.DoubleType()), T.StructField("segment", T.IntegerType())])
    return landing.reconcile_to_schema(entity(spark, d, "customers"), target)


@query("p1_flatten_and_type", "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS STRING) AS absent FROM events")
def p1(spark, d):
    rows = entity(spark, d, "payloads").withColumn("payload", F.try_parse_json("payload_json"))
    return silver.flatten_and_type(rows, [("k", "$.k", "long"), ("absent", "$.absent", "string")], keep=["event_id", "event_type"])


@query("p2_safe_cast", "SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INT) AS brand_number, TRY_CAST(p_name AS DOUBLE) AS bad_number, TRY_CAST(p_type AS DATE) AS bad_date FROM part")
def p2(spark, d):
    return entity(spark, d, "part").select("p_partkey", silver.safe_cast(F.split_part("p_brand", F.lit("#"), F.lit(2)), "int").alias("brand_number"), silver.safe_cast("p_name", "double").alias("bad_number"), silver.safe_cast("p_type", "date").alias("bad_date"))


@query("p3_fill_defaults", "SELECT product_id, coalesce(cost, 0) AS cost FROM products")
def p3(spark, d):
    return silver.fill_defaults(entity(spark, d, "products").select("product_id", "cost"), {"cost": 0})


@query("p4_full_name", "SELECT customer_id, first_name || ' ' || last_name AS full_name, coalesce(first_name, '') || ' ' || coalesce(CASE WHEN customer_id % 3 = 0 THEN NULL ELSE last_name END, '') AS safe_name FROM customers")
def p4(spark, d):
    c = entity(spark, d, "customers").withColumn("other", F.expr("CASE WHEN customer_id % 3 = 0 THEN NULL ELSE last_name END"))
    return c.select("customer_id", silver.full_name("first_name", "last_name").alias("full_name"), silver.full_name("first_name", "other", True).alias("safe_name"))


@query("p5_derive_segment", "SELECT customer_id, CASE WHEN company_name ILIKE '%enterprise%' OR company_name ILIKE '%corp%' THEN 'ENTERPRISE' WHEN company_name ILIKE '%startup%' OR company_name ILIKE '%labs%' THEN 'STARTUP' ELSE 'MID-MARKET' END AS derived FROM customers")
def p5(spark, d):
    return entity(spark, d, "customers").select("customer_id", silver.derive_segment("company_name").alias("derived"))


@query("p6_revenue_tier", "SELECT customer_id, CASE WHEN annual_revenue >= 1000000 THEN 'ENTERPRISE' WHEN annual_revenue >= 100000 THEN 'MID-MARKET' ELSE 'SMB' END AS tier FROM customers")
def p6(spark, d):
    return entity(spark, d, "customers").select("customer_id", silver.revenue_tier("annual_revenue").alias("tier"))


@query("p7_order_calendar", f"SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS order_month, CAST(date_diff('day', order_date, DATE '{AS_OF}') AS INT) AS days_since_order FROM sales")
def p7(spark, d):
    return silver.order_calendar(entity(spark, d, "sales"), AS_OF).select("order_id", "order_month", "days_since_order")


#: Percentages of whole cents, rounded half away from zero to hundredths, in integers.
PCT_ON_PRICE = "CASE WHEN price > 0 THEN CAST(sign(price - cost) * ((abs(CAST((price - cost) * 100 AS BIGINT)) * 20000 + CAST(price * 100 AS BIGINT)) // (2 * CAST(price * 100 AS BIGINT))) AS DECIMAL(18,2)) / 100 ELSE 0 END"


@query("p8_product_margin", f"""SELECT product_id, price - coalesce(cost, 0) AS margin, price - cost AS list_margin,
 CAST(CASE WHEN cost > 0 THEN round(round(CAST(price - cost AS DOUBLE) / CAST(cost AS DOUBLE) * 100, 4), 2) ELSE 0 END AS DOUBLE) AS pct_on_cost, CAST({PCT_ON_PRICE} AS DOUBLE) AS pct_on_price FROM products""")
def p8(spark, d):
    p = entity(spark, d, "products")
    a = silver.product_margin(p).select("product_id", "margin", F.round(F.col("margin_pct").cast("double"), 2).alias("pct_on_cost"))
    b = silver.product_margin(p, "price").select("product_id", F.col("margin").alias("list_margin"), F.col("margin_pct").cast("double").alias("pct_on_price"))
    return a.join(b, "product_id")


@query("p9_line_totals", "SELECT item_id, CAST(quantity * unit_price AS DECIMAL(18,2)) AS gross_total, CAST(round(quantity * unit_price * (100 - discount_percent) / 100.0, 4) AS DECIMAL(18,4)) AS net_total FROM items")
def p9(spark, d):
    return silver.line_totals(entity(spark, d, "items")).select("item_id", "gross_total", "net_total")


@query("p10_resolution_hours", "SELECT ticket_id, CAST(date_diff('hour', created_at, resolved_at) AS BIGINT) AS hours FROM tickets")
def p10(spark, d):
    return entity(spark, d, "tickets").select("ticket_id", silver.resolution_hours("created_at", "resolved_at").alias("hours"))


@query("p11_require_keys", "SELECT product_id, cost FROM products WHERE cost IS NOT NULL AND product_id IS NOT NULL")
def p11(spark, d):
    return silver.require_keys(entity(spark, d, "products"), ["product_id", "cost"]).select("product_id", "cost")


@query("p12_normalize_case", "SELECT customer_id, upper(company_name) AS company_name, lower(segment) AS segment FROM customers")
def p12(spark, d):
    return silver.normalize_case(entity(spark, d, "customers"), ["company_name"], ["segment"]).select("customer_id", "company_name", "segment")


@query("p13_flag_and_nested_path", "SELECT event_id, event_type IN ('purchase', 'signup') AS is_conversion, CAST(json_extract_string(props, '$.k') AS BIGINT) AS nested_k FROM events")
def p13(spark, d):
    e = entity(spark, d, "payloads").select("event_id", "event_type", F.parse_json(F.concat(F.lit('{"owner":'), "payload_json", F.lit("}"))).alias("payload"))
    return e.select("event_id", silver.flag_in("event_type", ["purchase", "signup"]).alias("is_conversion"), F.variant_get("payload", "$.owner.k", "long").alias("nested_k"))


def _nested(spark, d):
    """Orders with their lines as a JSON array."""
    item = F.struct("line_number", "product_id", "quantity", F.col("line_total").cast("string").alias("line_total"))
    return entity(spark, d, "items").groupBy("order_id").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("items_json"))


@query("p14_array_len", "SELECT order_id, CAST(count(*) AS INT) AS n_items FROM items GROUP BY order_id")
def p14(spark, d):
    return _nested(spark, d).select("order_id", silver.array_len(F.col("items_json")).alias("n_items"))


@query("p15_explode_children", "SELECT order_id, line_number, product_id, quantity, line_total FROM items")
def p15(spark, d):
    return silver.explode_children(_nested(spark, d), "order_id", "items_json", "line_number:int,product_id:bigint,quantity:int,line_total:decimal(12,2)")


@query("p16_layered_filters", """WITH f AS (SELECT order_id, line_number, CASE WHEN line_number % 3 = 0 THEN NULL ELSE _deleted END AS flag FROM line_changes)
SELECT 'strict' AS form, count(*) AS n FROM f WHERE NOT flag UNION ALL SELECT 'loose', count(*) FROM f WHERE NOT coalesce(flag, false) UNION ALL SELECT 'active', count(*) FROM customers WHERE is_active""")
def p16(spark, d):
    f = entity(spark, d, "line_changes").select(F.expr("CASE WHEN line_number % 3 = 0 THEN NULL ELSE _deleted END").alias("_deleted"))
    n = lambda x, form: x.agg(F.count("*").alias("n")).select(F.lit(form).alias("form"), "n")
    return n(silver.not_deleted(f, strict=True), "strict").union(n(silver.not_deleted(f), "loose")).union(n(silver.active_only(entity(spark, d, "customers")), "active"))


#: Expressions for landing columns that the bound entities lack, alike in both engines.
EXTRA = {
    "customers": {"industry": "CASE WHEN customer_id % 5 = 0 THEN NULL ELSE lower(segment) END"},
    "sales": {"shipping_address": "concat('Road ', CAST(customer_id AS STRING))", "notes": "CASE WHEN order_id % 4 = 0 THEN 'call first' END"},
    "products": {"created_at": "updated_at - 30"},
    "items": {},
    "tickets": {"subject": "concat('Error ', CAST(ticket_id AS STRING))", "description": "CASE WHEN ticket_id % 3 = 0 THEN NULL ELSE concat(priority, ' case') END"},
}
#: Commit times of a row's versions, several on one day and not in the order of their values: which rows have them, and what they change; the last one deletes every tenth key.
VERSION_TIMES = ((1, "2001-09-01 17:00:00.000001"), (2, "2001-09-01 08:00:00"), (3, "2001-09-01 17:00:00.000002"))
VERSION_KEYS = {"customers": "customer_id", "sales": "order_id", "products": "product_id", "items": "item_id", "tickets": "ticket_id"}
CHANGED = {"customers": ("company_name", "concat('Zoe Global ', company_name)", "concat('Amy ', company_name)"), "sales": ("status", "'shipped'", "'returned'"), "products": ("price", "CAST(price + 7 AS DECIMAL(10,2))", "CAST(price + 1 AS DECIMAL(10,2))"), "items": ("quantity", "CAST(quantity + 9 AS INT)", "CAST(quantity + 1 AS INT)"), "tickets": ("status", "'waiting'", "'closed'")}


def _parts(name: str) -> list[tuple[str, str, str, str]]:
    """(condition, changed value, commit time, deleted) of the versions of an entity's rows."""
    key, (column, early, late) = VERSION_KEYS[name], CHANGED[name]
    times = dict(VERSION_TIMES)
    return [("true", column, times[1], "false"), (f"{key} % 2 = 0", early, times[2], f"{key} % 4 = 0"), (f"{key} % 3 = 0", late, times[3], f"{key} % 10 = 0")]


def _versions(name: str) -> str:
    column = CHANGED[name][0]
    more = "".join(f", {e} AS {c}" for c, e in EXTRA[name].items())
    return " UNION ALL ".join(f"SELECT * REPLACE ({value} AS {column}){more}, TIMESTAMP '{at}' AS _updated_at, {deleted} AS _deleted FROM {name} WHERE {condition}" for condition, value, at, deleted in _parts(name))


def _bronze(spark, d, name):
    column, base = CHANGED[name][0], entity(spark, d, name)
    wide = base.withColumns({c: F.expr(e) for c, e in EXTRA[name].items()})
    out = None
    for condition, value, at, deleted in _parts(name):
        one = wide.filter(condition).withColumns({column: F.expr(value).cast(base.schema[column].dataType), "_updated_at": F.lit(at).cast("timestamp_ntz"), "_deleted": F.expr(deleted)})
        out = one if out is None else out.unionByName(one)
    return landing.pack_bronze(out, name, loaded())


def _latest(name: str, columns: str, ties: str = "") -> str:
    """SQL over the live latest versions."""
    key = VERSION_KEYS[name]
    return f"WITH v AS ({_versions(name)}), r AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY _updated_at DESC NULLS FIRST{ties}) = 1) SELECT {columns} FROM r WHERE NOT _deleted"


#: item_id repeats in lineitem, and such rows have the same version time; as the operator, by the remaining columns.
ITEM_TIES = "".join(f", {c} DESC NULLS FIRST" for c in ("order_id", "product_id", "quantity", "unit_price", "discount_percent", "_deleted"))


@query("t1_silver_customers", _latest("customers", """customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email, phone, company_name, industry, annual_revenue, CAST(created_at AS TIMESTAMP) AS created_at, CAST(updated_at AS TIMESTAMP) AS updated_at, _updated_at AS cdc_timestamp,
 CASE WHEN company_name ILIKE '%enterprise%' OR company_name ILIKE '%corp%' THEN 'ENTERPRISE' WHEN company_name ILIKE '%startup%' OR company_name ILIKE '%labs%' THEN 'STARTUP' ELSE 'MID-MARKET' END AS customer_segment"""))
def t1(spark, d):
    return silver.silver_customers(_bronze(spark, d, "customers"))


@query("t2_silver_orders", _latest("sales", f"order_id, customer_id, CAST(order_date AS TIMESTAMP) AS order_date, status, total_amount, shipping_address, notes, _updated_at AS cdc_timestamp, CAST(date_trunc('month', order_date) AS DATE) AS order_month, CAST(date_diff('day', order_date, DATE '{AS_OF}') AS INT) AS days_since_order"))
def t2(spark, d):
    return silver.silver_orders(_bronze(spark, d, "sales"), AS_OF)


@query("t3_silver_products", _latest("products", "product_id, product_name, category, price, cost, sku, active, CAST(created_at AS TIMESTAMP) AS created_at, _updated_at AS cdc_timestamp, price - coalesce(cost, 0) AS margin, round(CASE WHEN cost > 0 THEN round(CAST(price - cost AS DOUBLE) / CAST(cost AS DOUBLE) * 100, 4) ELSE 0 END, 2) AS margin_pct"))
def t3(spark, d):
    return silver.silver_products(_bronze(spark, d, "products")).withColumn("margin_pct", F.round(F.col("margin_pct").cast("double"), 2))


@query("t4_silver_order_items", _latest("items", "item_id, order_id, product_id, quantity, unit_price, discount_percent, _updated_at AS cdc_timestamp, CAST(quantity * unit_price AS DECIMAL(18,2)) AS gross_total, CAST(round(quantity * unit_price * (100 - discount_percent) / 100.0, 4) AS DECIMAL(18,4)) AS net_total", ITEM_TIES))
def t4(spark, d):
    return silver.silver_items(_bronze(spark, d, "items"))


@query("t5_silver_tickets", _latest("tickets", "ticket_id, customer_id, subject, description, priority, status, created_at, resolved_at, _updated_at AS cdc_timestamp, CAST(date_diff('hour', created_at, resolved_at) AS BIGINT) AS resolution_hours"))
def t5(spark, d):
    return silver.silver_tickets(_bronze(spark, d, "tickets"))


LOG_LATEST = "SELECT * FROM event_log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _cdc_timestamp DESC NULLS FIRST, _cdc_lsn DESC NULLS FIRST) = 1"


@query("t6_silver_from_changelog", f"WITH r AS ({LOG_LATEST}) SELECT user_id, upper(event_type) AS event_type, coalesce(amount, 0) AS amount, CASE WHEN coalesce(amount, 0) >= 1000000 THEN 'ENTERPRISE' WHEN coalesce(amount, 0) >= 100000 THEN 'MID-MARKET' ELSE 'SMB' END AS revenue_tier FROM r WHERE _cdc_operation <> 'd'")
def t6(spark, d):
    return silver.silver_from_changelog(entity(spark, d, "event_log"), ["user_id"], {"amount": 0}, ["event_type"], [], "amount").select("user_id", "event_type", F.col("amount").cast("decimal(12,2)").alias("amount"), "revenue_tier")


@query("t7_silver_snapshot", "SELECT customer_id, coalesce(first_name, 'Unknown') AS first_name, upper(segment) AS segment, annual_revenue FROM customers WHERE customer_id IS NOT NULL")
def t7(spark, d):
    raw = landing.pack_bronze(entity(spark, d, "customers"), "customers", loaded())
    return silver.silver_snapshot(raw, [("customer_id", "$.customer_id", "long"), ("first_name", "$.first_name", "string"), ("segment", "$.segment", "string"), ("annual_revenue", "$.annual_revenue", "decimal(15,2)")], ["customer_id"], {"first_name": "Unknown"}, ["segment"])


KEYS = ["order_id", "line_number"]
TOTAL = ["_updated_at", "product_id", "supplier_id"]
CHANGES = "SELECT * FROM line_changes QUALIFY row_number() OVER (PARTITION BY order_id, line_number ORDER BY _updated_at DESC NULLS FIRST, product_id DESC NULLS FIRST, supplier_id DESC NULLS FIRST) = 1"
LIVE = f"WITH r AS ({CHANGES}) SELECT order_id, line_number, product_id, supplier_id, line_total, _updated_at FROM r WHERE NOT _deleted"


@query("c1_latest_by_key", LIVE)
def c1(spark, d):
    return cdc.latest_by_key(entity(spark, d, "line_changes"), KEYS, TOTAL).drop("_deleted")


@query("c2_apply_changelog", f"WITH r AS ({LOG_LATEST}) SELECT user_id, event_id, event_type, amount FROM r WHERE _cdc_operation <> 'd'")
def c2(spark, d):
    return cdc.apply_changelog(entity(spark, d, "event_log"), ["user_id"]).select("user_id", "event_id", "event_type", "amount")


@query("c3_latest_by_key_agg", LIVE)
def c3(spark, d):
    return cdc.latest_by_key_agg(entity(spark, d, "line_changes"), KEYS, TOTAL).drop("_deleted")


@query("c4_latest_by_commit_time", "WITH c AS (SELECT *, _updated_at + CAST(supplier_id % 30 AS INT) AS _commit FROM line_changes), r AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY order_id, line_number ORDER BY _commit DESC NULLS FIRST, product_id DESC NULLS FIRST, supplier_id DESC NULLS FIRST) = 1) SELECT order_id, line_number, product_id, _commit FROM r WHERE NOT _deleted")
def c4(spark, d):
    log = entity(spark, d, "line_changes").withColumn("_commit", F.expr("_updated_at + CAST(supplier_id % 30 AS INT)"))
    return cdc.latest_by_key(log, KEYS, ["_commit", "product_id", "supplier_id"]).select("order_id", "line_number", "product_id", "_commit")


@query("c5_scd2", """WITH o AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events), k AS (SELECT * FROM o WHERE b IS NULL OR b <> event_type)
SELECT user_id, event_type, event_id AS valid_from, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) IS NULL AS is_current FROM k""")
def c5(spark, d):
    return cdc.scd2(entity(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", ["event_type"]).select("user_id", "event_type", "valid_from", "valid_to", "is_current")


@query("c6_deduplicate", "SELECT order_id, line_number, product_id, line_total FROM line_changes QUALIFY row_number() OVER (PARTITION BY order_id, line_number ORDER BY _updated_at, product_id, supplier_id) = 1")
def c6(spark, d):
    return cdc.deduplicate(entity(spark, d, "line_changes"), KEYS, TOTAL).select("order_id", "line_number", "product_id", "line_total")


@query("c7_merge_changes", LIVE)
def c7(spark, d):
    log = entity(spark, d, "line_changes")
    old, new = log.filter("product_id % 2 = 0"), log.filter("product_id % 2 = 1")
    snapshot = cdc.merge_changes(old.limit(0), old, KEYS, TOTAL)
    return cdc.live(cdc.merge_changes(snapshot, new, KEYS, TOTAL)).drop("_deleted")


@query("c8_latest_run", """WITH h AS (SELECT user_id, event_type, event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND event_type IN ('click', 'view'))
SELECT user_id, event_type, event_id FROM h QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def c8(spark, d):
    catalog = spark.createDataFrame([("click",), ("view",)], "event_type string")
    history = entity(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    return cdc.latest_run(history, ["user_id", "event_type"], "ts", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), catalog, ["event_id"]).select("user_id", "event_type", "event_id")


@query("j5_missing", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def j5(spark, d):
    return joins.missing(entity(spark, d, "part").select("p_partkey"), entity(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), ["p_partkey"])


@query("j6_keep_existing", "SELECT o_custkey AS source_node_id, o_orderkey AS target_node_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND o_orderkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def j6(spark, d):
    edges = entity(spark, d, "orders").select(F.col("o_custkey").alias("source_node_id"), F.col("o_orderkey").alias("target_node_id"))
    return joins.keep_existing(edges, entity(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("node_id")))


@query("j7_suppress_recent", "SELECT customer_id, segment FROM customers WHERE customer_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND CAST(ts AS DATE) > DATE '2024-01-24')")
def j7(spark, d):
    log = entity(spark, d, "events").filter("event_type = 'signup'").select(F.col("user_id").alias("customer_id"), "ts")
    return joins.suppress_recent(entity(spark, d, "customers").select("customer_id", "segment"), log, "customer_id", "ts", 7, "2024-01-31")


RULES = [("r1", "%"), ("r2", "Customer#00000001%"), ("r3", "%7"), ("r4", "none%")]


@query("j8_pattern_join", "SELECT c.c_custkey, r.rule FROM customer c JOIN (VALUES ('r1', '%'), ('r2', 'Customer#00000001%'), ('r3', '%7'), ('r4', 'none%')) r(rule, pattern) ON c.c_name LIKE r.pattern")
def j8(spark, d):
    rules = spark.createDataFrame(RULES, "rule string, pattern string")
    return joins.pattern_join(entity(spark, d, "customer").select("c_custkey", "c_name"), rules, "c_name", "pattern").select("c_custkey", "rule")


@query("j10_key_diff", """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'NEW' ELSE 'DROPPED' END AS change FROM a FULL OUTER JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def j10(spark, d):
    return joins.key_diff(entity(spark, d, "orders").select(F.col("o_custkey").alias("k")), entity(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")), ["k"])


@query("j13_scalar_counts", "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM lineitem) AS items")
def j13(spark, d):
    return joins.scalar_counts(orders=entity(spark, d, "orders"), customers=entity(spark, d, "customer"), items=entity(spark, d, "lineitem"))


@query("j14_child_counts", "SELECT c.c_custkey, (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n_children FROM customer c")
def j14(spark, d):
    return joins.child_counts(entity(spark, d, "customer").select("c_custkey"), entity(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("u2_distinct_values", "SELECT DISTINCT segment, loyalty_tier FROM customers")
def u2(spark, d):
    return joins.distinct_values(entity(spark, d, "customers"), ["segment", "loyalty_tier"])


@query("w1_with_sequence", "SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS seq FROM orders")
def w1(spark, d):
    return joins.running_number(entity(spark, d, "orders"), ["o_orderdate", "o_orderkey"])


@query("scalar_string", """SELECT p_partkey, upper(p_type) AS u, lower(p_name) AS l, length(p_name) AS n, substr(p_brand, 1, 3) AS s, split_part(p_brand, '#', -1) AS last, replace(p_type, ' ', '_') AS r,
 trim('  ' || p_brand || ' ') AS t, regexp_replace(p_brand, '[0-9]+', 'N') AS rr, position('#' IN p_brand) AS pos, regexp_extract(p_brand, '([0-9]+)', 1) AS digits FROM part""")
def scalar_string(spark, d):
    return entity(spark, d, "part").select("p_partkey", F.upper("p_type").alias("u"), F.lower("p_name").alias("l"), F.length("p_name").cast("long").alias("n"), F.substring("p_brand", 1, 3).alias("s"), F.split_part("p_brand", F.lit("#"), F.lit(-1)).alias("last"), F.replace("p_type", F.lit(" "), F.lit("_")).alias("r"), F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("t"), F.regexp_replace("p_brand", "[0-9]+", "N").alias("rr"), F.expr("position('#', p_brand)").cast("long").alias("pos"), F.regexp_extract("p_brand", "([0-9]+)", 1).alias("digits"))


@query("scalar_date", f"""SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS m, CAST(date_diff('day', order_date, DATE '{AS_OF}') AS INT) AS days, CAST(date_diff('month', order_date, DATE '{AS_OF}') AS INT) AS months, order_date + 30 AS later, TRY_CAST('x' || CAST(order_id AS STRING) AS DATE) AS bad FROM sales""")
def scalar_date(spark, d):
    as_of = F.lit(AS_OF).cast("date")
    return entity(spark, d, "sales").select("order_id", F.trunc("order_date", "month").alias("m"), day_diff("order_date", as_of).alias("days"), month_diff("order_date", as_of).alias("months"), F.date_add("order_date", 30).alias("later"), F.try_to_date(F.concat(F.lit("x"), F.col("order_id").cast("string")), "yyyy-MM-dd").alias("bad"))


@query("scalar_math", """SELECT l_orderkey, l_linenumber, abs(l_discount - 0.05) < 0.0001 AS mid, CAST(floor(l_extendedprice / nullif(l_quantity, 0) * 1000) AS BIGINT) AS unit, round(log10(l_extendedprice + 1), 6) AS lg, CAST(floor(l_quantity) AS BIGINT) AS fl FROM lineitem""")
def scalar_math(spark, d):
    return entity(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.abs(F.col("l_discount") - 0.05) < 0.0001).alias("mid"), F.floor(F.try_divide("l_extendedprice", F.nullif("l_quantity", F.lit(0))) * 1000).alias("unit"), F.round(F.log10(F.col("l_extendedprice") + 1), 6).alias("lg"), F.floor("l_quantity").alias("fl"))


@query("scalar_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_type(json_extract(props, '$.k')) IN ('UBIGINT', 'BIGINT') AS is_number, '{"id":' || event_id || '}' AS packed FROM events""")
def scalar_json(spark, d):
    v = F.parse_json("props")
    return entity(spark, d, "events").select("event_id", F.variant_get(v, "$.k", "long").alias("k"), (F.schema_of_variant(F.variant_get(v, "$.k", "variant")) == "BIGINT").alias("is_number"), F.to_json(F.struct(F.col("event_id").alias("id"))).alias("packed"))


@query("scalar_array", "SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_linenumber AS STRING), ',' ORDER BY l_linenumber, l_partkey) AS numbers, max(l_linenumber) AS top FROM lineitem GROUP BY l_orderkey")
def scalar_array(spark, d):
    g = entity(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("a"))
    return g.select("l_orderkey", F.size("a").cast("long").alias("n"), F.array_join(F.transform("a", lambda x: x.cast("string")), ",").alias("numbers"), F.array_max("a").alias("top"))


@query("lsn_order", "SELECT event_id, CAST(event_id AS BIGINT) AS position FROM event_log")
def lsn_order(spark, d):
    return entity(spark, d, "event_log").select("event_id", lsn_value("_cdc_lsn").cast("long").alias("position"))


@query("boundary_differences", "SELECT ticket_id, date_diff('day', created_at, resolved_at) AS days, date_diff('hour', created_at, resolved_at) AS hours, date_diff('month', created_at, resolved_at) AS months FROM tickets WHERE resolved_at IS NOT NULL")
def boundary_differences(spark, d):
    t = entity(spark, d, "tickets").filter("resolved_at is not null")
    return t.select("ticket_id", day_diff("created_at", "resolved_at").cast("long").alias("days"), hour_diff("created_at", "resolved_at").alias("hours"), month_diff("created_at", "resolved_at").cast("long").alias("months"))


@query("vector_cosine", "SELECT a.vec_id AS vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 5) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def vector_cosine(spark, d):
    e = entity(spark, d, "embeddings").select("vec_id", "embedding")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("q"))
    return e.join(after, "vec_id").select("vec_id", F.round(cosine("embedding", "q"), 5).alias("similarity"))
