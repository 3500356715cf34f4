"""Queries of gold aggregates, series, rankings and metric views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import gold, joins, metrics, silver, windows
from tidemark.plans.base import query
from tidemark.plans.bindings import AS_OF, CUTS, EVENTS_AS_OF, entity
from tidemark.plans.silver_queries import PCT_ON_PRICE


def _e(spark, d, *names):
    return [entity(spark, d, n) for n in names]


def _c360(spark, d):
    return gold.customer_360(*_e(spark, d, "customers", "sales", "tickets"), AS_OF, CUTS)


#: Customers with the segment that silver derives from the company's name.
SEGMENT = "CASE WHEN company_name ILIKE '%enterprise%' OR company_name ILIKE '%corp%' THEN 'ENTERPRISE' WHEN company_name ILIKE '%startup%' OR company_name ILIKE '%labs%' THEN 'STARTUP' ELSE 'MID-MARKET' END"
#: Cuts of the annual revenue (in thousands, as it is bound) that reach every tier.
REVENUE = "CASE WHEN annual_revenue >= 1000000 THEN 'ENTERPRISE' WHEN annual_revenue >= 100000 THEN 'MID-MARKET' ELSE 'SMB' END"
TIER = f"CASE WHEN ltv >= {CUTS[0]} THEN 'PLATINUM' WHEN ltv >= {CUTS[1]} THEN 'GOLD' WHEN ltv >= {CUTS[2]} THEN 'SILVER' ELSE 'BRONZE' END"
NEAR = "CASE WHEN days <= 7 THEN 'HOT' WHEN days <= 30 THEN 'ACTIVE' WHEN days <= 90 THEN 'COOLING' ELSE 'DORMANT' END"
FAR = "CASE WHEN days > 90 THEN 'AT_RISK' WHEN days > 60 THEN 'COOLING' WHEN days > 30 THEN 'ACTIVE' ELSE 'HOT' END"
#: Common tables up to the customer 360 in its three forms; each arm is aggregated before the joins.
C360 = f"""oa AS (SELECT customer_id, count(*) AS n, CAST(sum(total_amount) AS DECIMAL(18,2)) AS ltv, min(order_date) AS f, max(order_date) AS l FROM sales GROUP BY 1),
ta AS (SELECT customer_id, count(*) AS n, count(*) FILTER (status = 'open') AS o, avg(date_diff('hour', created_at, resolved_at)) AS h FROM tickets GROUP BY 1),
w AS (SELECT c.*, coalesce(oa.n, 0) AS total_orders, coalesce(ta.n, 0) AS total_tickets, coalesce(ta.o, 0) AS open_tickets, ltv, CAST(ltv AS DOUBLE) / oa.n AS aov, f, l, h, CAST(date_diff('day', l, DATE '{AS_OF}') AS INT) AS days FROM customers c LEFT JOIN oa USING (customer_id) LEFT JOIN ta USING (customer_id)),
c360 AS (SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email, phone, company_name, segment, loyalty_tier, annual_revenue, created_at AS customer_since, total_orders, ltv AS lifetime_value, aov AS avg_order_value, f AS first_order_date, l AS last_order_date,
  days AS recency_days, total_orders AS frequency, ltv AS monetary_total, {TIER} AS revenue_tier, {NEAR} AS engagement_status, total_tickets, open_tickets FROM w WHERE is_deleted = false),
f360 AS (SELECT customer_id, concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name, email, company_name, segment, {REVENUE} AS revenue_tier, annual_revenue, is_active, created_at AS customer_since, total_orders, ltv AS lifetime_value, aov AS avg_order_value, f AS first_order_date, l AS last_order_date,
  days AS days_since_last_order, days AS recency_days, total_orders AS frequency_orders, ltv AS monetary_total, {FAR} AS engagement_status, updated_at AS last_updated, loyalty_tier, total_tickets, h AS avg_resolution_hours FROM w WHERE is_active)"""


@query("a1_customer_360", f"WITH {C360} SELECT * FROM c360")
def a1(spark, d):
    return _c360(spark, d)


@query("a1_customer_360_fanout", f"""WITH j AS (SELECT c.customer_id, s.order_id, s.total_amount, s.order_date, t.ticket_id, t.status FROM customers c LEFT JOIN sales s ON s.customer_id = c.customer_id LEFT JOIN tickets t ON t.customer_id = c.customer_id WHERE c.is_deleted = false),
w AS (SELECT customer_id, count(DISTINCT order_id) AS n, CAST(sum(total_amount) AS DECIMAL(18,2)) AS ltv, CAST(sum(total_amount) AS DOUBLE) / nullif(count(total_amount), 0) AS aov, min(order_date) AS f, max(order_date) AS l, count(DISTINCT ticket_id) AS t, count(*) FILTER (status = 'open') AS o, CAST(date_diff('day', max(order_date), DATE '{AS_OF}') AS INT) AS days FROM j GROUP BY 1)
SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email, phone, company_name, segment, loyalty_tier, annual_revenue, created_at AS customer_since, n AS total_orders, ltv AS lifetime_value, aov AS avg_order_value, f AS first_order_date, l AS last_order_date,
 days AS recency_days, n AS frequency, ltv AS monetary_total, {TIER} AS revenue_tier, {NEAR} AS engagement_status, t AS total_tickets, o AS open_tickets FROM w JOIN customers USING (customer_id)""")
def a1_fanout(spark, d):
    return gold.customer_360(*_e(spark, d, "customers", "sales", "tickets"), AS_OF, CUTS, fanout=True)


@query("a2_customer_360_recency", f"WITH {C360} SELECT * EXCLUDE (loyalty_tier, total_tickets, avg_resolution_hours) FROM f360")
def a2(spark, d):
    return gold.customer_360_recency(*_e(spark, d, "customers", "sales"), AS_OF)


@query("a3_customer_360_service", f"WITH {C360} SELECT f360.* REPLACE (first_name || ' ' || last_name AS full_name) FROM f360 JOIN customers USING (customer_id)")
def a3(spark, d):
    return gold.customer_360_service(*_e(spark, d, "customers", "sales", "tickets"), AS_OF)


@query("a4_sales_summary", f"""SELECT order_date, segment, {REVENUE} AS revenue_tier, count(DISTINCT order_id) AS order_count, count(DISTINCT customer_id) AS unique_customers, CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_revenue, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value
FROM sales JOIN customers USING (customer_id) GROUP BY 1, 2, 3""")
def a4(spark, d):
    return gold.sales_summary(*_e(spark, d, "sales", "customers"))


PRODUCT = """ia AS (SELECT product_id, count(DISTINCT order_id) AS orders, count(*) AS lines, sum(quantity) AS units_sold, CAST(sum(line_total) AS DECIMAL(18,2)) AS revenue FROM items GROUP BY 1),
ua AS (SELECT product_id, count(DISTINCT customer_id) AS unique_customers FROM items JOIN sales USING (order_id) GROUP BY 1)"""


@query("a5_product_performance", f"""WITH {PRODUCT} SELECT product_id, product_name, category, price AS list_price, cost AS cost_price, price - cost AS margin, CAST({PCT_ON_PRICE} AS DECIMAL(18,2)) AS margin_percent, sku, active AS is_active,
 coalesce(orders, 0) AS orders_count, CAST(units_sold AS BIGINT) AS units_sold, revenue AS total_revenue, coalesce(unique_customers, 0) AS unique_customers FROM products LEFT JOIN ia USING (product_id) LEFT JOIN ua USING (product_id) WHERE is_deleted = false""")
def a5(spark, d):
    return gold.product_performance(*_e(spark, d, "products", "items", "sales"))


@query("a6_product_performance_basic", f"""WITH {PRODUCT} SELECT product_id, sku, product_name, category, price AS list_price, active AS is_active, coalesce(orders, 0) AS orders_containing, CAST(units_sold AS BIGINT) AS total_units_sold, revenue AS total_revenue,
 CAST(units_sold AS DOUBLE) / lines AS avg_units_per_order, coalesce(unique_customers, 0) AS unique_customers, updated_at AS last_updated FROM products LEFT JOIN ia USING (product_id) LEFT JOIN ua USING (product_id)""")
def a6(spark, d):
    return gold.product_performance_basic(*_e(spark, d, "products", "items", "sales"))


@query("a7_category_metrics", """WITH j AS (SELECT p.*, i.order_id, i.quantity, i.line_total FROM products p LEFT JOIN items i USING (product_id) WHERE is_deleted = false)
SELECT category, count(DISTINCT product_id) AS total_products, count(DISTINCT CASE WHEN active THEN product_id END) AS active_products, CAST(sum(price) AS DOUBLE) / count(price) AS avg_list_price, CAST(sum(cost) AS DOUBLE) / count(cost) AS avg_cost_price, CAST(sum(price - cost) AS DOUBLE) / count(cost) AS avg_margin,
 CAST(sum(quantity) AS BIGINT) AS total_units_sold, CAST(sum(line_total) AS DECIMAL(18,2)) AS total_revenue, CAST(sum(line_total) AS DOUBLE) / nullif(sum(quantity), 0) AS avg_selling_price, count(DISTINCT order_id) AS orders_with_category FROM j GROUP BY 1""")
def a7(spark, d):
    return gold.category_metrics(*_e(spark, d, "products", "items"))


@query("a8_order_summary", """SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, segment AS customer_segment, count(DISTINCT order_id) AS order_count, count(DISTINCT customer_id) AS unique_customers, CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_revenue, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
 count(*) FILTER (status = 'completed') AS completed_orders, count(*) FILTER (status = 'pending') AS pending_orders, count(*) FILTER (status = 'processing') AS processing_orders FROM sales JOIN customers USING (customer_id) GROUP BY 1, 2""")
def a8(spark, d):
    return gold.order_summary(*_e(spark, d, "sales", "customers"))


@query("a9_customer_metrics", """WITH a AS (SELECT customer_id, count(*) AS n, sum(total_amount) AS amount FROM sales GROUP BY 1)
SELECT segment, loyalty_tier, count(DISTINCT customer_id) AS customer_count, CAST(sum(coalesce(n, 0)) AS BIGINT) AS total_orders, CAST(sum(coalesce(amount, 0)) AS DECIMAL(18,2)) AS total_revenue, avg(coalesce(n, 0)) AS avg_orders_per_customer FROM customers LEFT JOIN a USING (customer_id) WHERE is_deleted = false GROUP BY 1, 2""")
def a9(spark, d):
    return gold.customer_metrics(*_e(spark, d, "customers", "sales"))


def _silver_customers(spark, d):
    return entity(spark, d, "customers").withColumn("segment", silver.derive_segment("company_name"))


@query("a10_ml_customer_features", f"""WITH {C360} SELECT c.customer_id, {SEGMENT.replace('company_name', 'c.company_name')} AS segment, c.loyalty_tier, coalesce(total_orders, 0) AS total_orders, coalesce(lifetime_value, 0) AS lifetime_value, coalesce(avg_order_value, 0) AS avg_order_value, coalesce(recency_days, 999) AS recency_days, coalesce(total_tickets, 0) AS total_tickets,
 CASE {SEGMENT.replace('company_name', 'c.company_name')} WHEN 'ENTERPRISE' THEN 3 WHEN 'MID-MARKET' THEN 2 ELSE 1 END AS segment_encoded, CASE revenue_tier WHEN 'PLATINUM' THEN 4 WHEN 'GOLD' THEN 3 WHEN 'SILVER' THEN 2 ELSE 1 END AS tier_encoded, CASE WHEN engagement_status = 'DORMANT' THEN 1 ELSE 0 END AS is_churned
FROM customers c LEFT JOIN c360 ON c.customer_id = c360.customer_id WHERE c.is_deleted = false""")
def a10(spark, d):
    return gold.ml_customer_features(_silver_customers(spark, d), _c360(spark, d))


FEATURES = f"""pr AS (SELECT customer_id, count(DISTINCT product_id) AS p FROM items JOIN sales USING (order_id) GROUP BY 1),
sa AS (SELECT customer_id, count(*) AS n, CAST(sum(total_amount) AS DECIMAL(18,2)) AS s, max(total_amount) AS m, stddev_samp(CAST(total_amount AS DOUBLE)) AS sd, min(order_date) AS f, date_diff('day', max(order_date), DATE '{AS_OF}') AS days FROM sales GROUP BY 1),
fe AS (SELECT customer_id, segment, {REVENUE} AS revenue_tier, annual_revenue, CAST(date_diff('day', created_at, DATE '{AS_OF}') AS INT) AS customer_tenure_days, CAST(days AS INT) AS recency_days, coalesce(n, 0) AS order_count, CAST(coalesce(n, 0) AS DOUBLE) / nullif(date_diff('month', f, DATE '{AS_OF}'), 0) AS orders_per_month,
 s AS total_spend, CAST(s AS DOUBLE) / n AS avg_order_value, m AS max_order_value, round(round(sd, 3), 1) AS order_value_stddev, coalesce(p, 0) AS unique_products_purchased,
 round(round(1.0 / nullif(nullif(days, 1), 0) * 100 + coalesce(n, 0) * 10 + log10(nullif(CAST(s AS DOUBLE), 0) + 1) * 5, 6), 3) AS engagement_score, CASE WHEN days > 90 THEN 1 ELSE 0 END AS churn_flag FROM customers LEFT JOIN sa USING (customer_id) LEFT JOIN pr USING (customer_id) WHERE is_active)"""


def _features(spark, d):
    """Sums of floating-point numbers end in other digits in the other engine: both columns are rounded."""
    got = gold.sales_features(*_e(spark, d, "customers", "sales", "items"), AS_OF)
    return got.withColumn("order_value_stddev", F.round(F.round("order_value_stddev", 3), 1)).withColumn("engagement_score", F.round(F.round("engagement_score", 6), 3))


@query("a11_sales_features", f"WITH {FEATURES} SELECT * FROM fe")
def a11(spark, d):
    return _features(spark, d)


@query("a11_sales_features_fanout", f"""WITH j AS (SELECT c.customer_id, s.order_id, s.total_amount, s.order_date, i.product_id FROM customers c LEFT JOIN sales s ON s.customer_id = c.customer_id LEFT JOIN items i ON i.order_id = s.order_id WHERE is_active)
SELECT customer_id, count(DISTINCT order_id) AS order_count, CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_spend, CAST(sum(total_amount) AS DOUBLE) / nullif(count(total_amount), 0) AS avg_order_value, max(total_amount) AS max_order_value, count(DISTINCT product_id) AS unique_products_purchased, CAST(date_diff('day', max(order_date), DATE '{AS_OF}') AS INT) AS recency_days FROM j GROUP BY 1""")
def a11_fanout(spark, d):
    return gold.sales_features(*_e(spark, d, "customers", "sales", "items"), AS_OF, fanout=True).select("customer_id", "order_count", "total_spend", "avg_order_value", "max_order_value", "unique_products_purchased", "recency_days")


@query("a12_ml_feature_view", f"WITH {FEATURES}, {C360} SELECT fe.*, f360.engagement_status FROM fe LEFT JOIN f360 ON fe.customer_id = f360.customer_id")
def a12(spark, d):
    return gold.ml_feature_view(_features(spark, d), gold.customer_360_recency(*_e(spark, d, "customers", "sales"), AS_OF))


@query("a13_support_metrics", """WITH t AS (SELECT t.*, date_diff('hour', created_at, resolved_at) AS h, date_diff('hour', created_at, first_response_at) AS r, date_diff('hour', created_at, coalesce(resolved_at, TIMESTAMP '2024-01-20 12:00:00')) AS age FROM tickets t)
SELECT priority, segment, count(*) AS tickets, count(*) FILTER (status = 'open') AS open_tickets, avg(h) AS avg_resolution_hours, avg(r) AS avg_first_response_hours, count(*) FILTER ((priority = 'high' AND age > 4) OR (priority = 'medium' AND age > 24)) AS sla_breaches FROM t LEFT JOIN customers USING (customer_id) GROUP BY 1, 2""")
def a13(spark, d):
    return gold.support_metrics(*_e(spark, d, "tickets", "customers"), "2024-01-20 12:00:00")


@query("a14_product_and_category", f"""WITH {PRODUCT}, b AS (SELECT product_id, category, units_sold, revenue FROM products LEFT JOIN ia USING (product_id))
SELECT category, product_id, CASE WHEN grouping(category) = 1 THEN 'all' WHEN grouping(product_id) = 1 THEN 'category' ELSE 'product' END AS level, CAST(coalesce(sum(units_sold), 0) AS BIGINT) AS units_sold, CAST(coalesce(sum(revenue), 0) AS DECIMAL(18,2)) AS revenue FROM b GROUP BY ROLLUP (category, product_id)""")
def a14(spark, d):
    return gold.product_and_category(*_e(spark, d, "products", "items"))


@query("a15_pipeline_counts", "SELECT 'customers' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'items', count(*) FROM lineitem")
def a15(spark, d):
    return gold.pipeline_counts({"customers": entity(spark, d, "customer"), "orders": entity(spark, d, "orders"), "items": entity(spark, d, "lineitem")})


@query("a15_sync_status", """WITH s AS (SELECT 'orders' AS table_name, count(*) AS s, count(*) FILTER (status <> 'pending') AS t FROM sales UNION ALL SELECT 'customers', count(*), count(*) FROM customers)
SELECT table_name, s AS source_rows, t AS target_rows, round(CAST(t * 100 AS DOUBLE) / s, 2) AS sync_pct, s - t AS rows_behind FROM s""")
def a15_sync(spark, d):
    o, c = _e(spark, d, "sales", "customers")
    return gold.sync_status(gold.pipeline_counts({"orders": o, "customers": c}), gold.pipeline_counts({"orders": o.filter("status <> 'pending'"), "customers": c}))


@query("a16_status_counts", "SELECT status, count(*) AS runs FROM sales GROUP BY 1")
def a16(spark, d):
    return gold.status_counts(entity(spark, d, "sales"))


@query("a16_run_totals", "SELECT count(*) AS total, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'processing') AS processing FROM sales")
def a16_totals(spark, d):
    return gold.run_totals(entity(spark, d, "sales"))


@query("a17_ordered_listagg", "SELECT order_id, string_agg(CAST(product_id AS STRING), ', ' ORDER BY line_number, CAST(product_id AS STRING)) AS listed FROM items GROUP BY 1")
def a17(spark, d):
    return gold.ordered_listagg(entity(spark, d, "items"), ["order_id"], "product_id", ["line_number"])


@query("a18_collect_objects", """SELECT order_id, '[' || string_agg('{"line_number":' || line_number || ',"product_id":' || product_id || '}', ',' ORDER BY line_number, product_id) || ']' AS objects FROM items GROUP BY 1""")
def a18(spark, d):
    return gold.collect_objects(entity(spark, d, "items"), ["order_id"], ["line_number", "product_id"])


@query("a19_value_by_stage", "SELECT status, CAST(sum(total_amount) AS DECIMAL(18,2)) AS value FROM sales GROUP BY 1")
def a19(spark, d):
    return gold.value_by(entity(spark, d, "sales"), "status", "total_amount")


@query("l1_top_customers", f"WITH {C360} SELECT customer_id, segment, lifetime_value FROM c360 ORDER BY lifetime_value DESC NULLS LAST, customer_id LIMIT 10")
def l1(spark, d):
    return joins.top_k(_c360(spark, d), "lifetime_value", 10, ["customer_id"]).select("customer_id", "segment", "lifetime_value")


DAILY = "dl AS (SELECT order_date AS day, segment, count(*) AS n, sum(total_amount) AS total FROM sales JOIN customers USING (customer_id) GROUP BY 1, 2)"
SPINE = f"""{DAILY}, sp AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM dl), (SELECT max(day) FROM dl), INTERVAL 1 DAY)) AS DATE) AS day),
sg AS (SELECT g.segment, sp.day, coalesce(dl.n, 0) AS n, CAST(coalesce(dl.total, 0) AS DECIMAL(18,2)) AS total FROM sp CROSS JOIN (SELECT DISTINCT segment FROM dl) g LEFT JOIN dl ON dl.day = sp.day AND dl.segment = g.segment)"""


def _spine(spark, d):
    both = entity(spark, d, "sales").join(entity(spark, d, "customers").select("customer_id", "segment"), "customer_id")
    return windows.date_spine(windows.daily(both, "order_date", "segment", F.col("total_amount")), "segment", {"n": "long", "total": "decimal(18,2)"})


@query("w2_date_spine", f"WITH {SPINE} SELECT segment, day, n, total FROM sg")
def w2(spark, d):
    return _spine(spark, d)


@query("w3_rolling_averages", f"WITH {SPINE} SELECT segment, day, " + ", ".join(f"round(round(avg(CAST({c} AS DOUBLE)) OVER (PARTITION BY segment ORDER BY day ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW), 4), {r}) AS {c}_avg_{k}d" for c, r in (("n", 3), ("total", 1)) for k in (7, 14, 30)) + " FROM sg")
def w3(spark, d):
    got = windows.rolling_averages(_spine(spark, d), "segment")
    return got.select("segment", "day", *(F.round(c, 3 if c.startswith("n_") else 1).alias(c) for c in got.columns[2:]))


@query("w4_lag_features", f"WITH {SPINE} SELECT segment, day, total, lag(total, 1) OVER w AS total_lag_1, lag(total, 7) OVER w AS total_lag_7, CAST(dayofweek(day) + 1 AS INT) AS day_of_week, CAST(month(day) AS INT) AS month FROM sg WINDOW w AS (PARTITION BY segment ORDER BY day)")
def w4(spark, d):
    return windows.lag_features(_spine(spark, d), "segment")


@query("w5_ltv_percentile", f"WITH {C360} SELECT customer_id, lifetime_value, round(percent_rank() OVER (ORDER BY lifetime_value), 6) AS ltv_percentile FROM c360")
def w5(spark, d):
    return windows.ltv_percentile(_c360(spark, d))


@query("w6_rfm_score", f"""WITH {C360}, s AS (SELECT * FROM c360 WHERE last_order_date IS NOT NULL), t AS (SELECT customer_id, CAST(ntile(5) OVER (ORDER BY -recency_days, customer_id) AS INT) AS r, CAST(ntile(5) OVER (ORDER BY total_orders, customer_id) AS INT) AS f, CAST(ntile(5) OVER (ORDER BY lifetime_value, customer_id) AS INT) AS m FROM s)
SELECT customer_id, r, f, m, CAST(r AS STRING) || CAST(f AS STRING) || CAST(m AS STRING) AS rfm FROM t""")
def w6(spark, d):
    return windows.rfm_score(_c360(spark, d))


@query("w7_churn_signals", f"""WITH {C360}, t AS (SELECT customer_id, count(*) AS k FROM tickets WHERE CAST(created_at AS DATE) > DATE '{EVENTS_AS_OF}' - 30 GROUP BY 1)
SELECT customer_id, coalesce(recency_days >= 60, true) AS at_risk, coalesce(k, 0) AS tickets_30d, round(coalesce(exp(-recency_days / 30.0), 0), 6) AS engagement_decay FROM c360 LEFT JOIN t USING (customer_id)""")
def w7(spark, d):
    return windows.churn_signals(_c360(spark, d), entity(spark, d, "tickets"), AS_OF, EVENTS_AS_OF)


@query("w8_ticket_trend", """WITH s AS (SELECT CAST(created_at AS DATE) AS day, priority, count(*) AS n FROM tickets GROUP BY 1, 2), sp AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM s), (SELECT max(day) FROM s), INTERVAL 1 DAY)) AS DATE) AS day),
g AS (SELECT p.priority, sp.day, coalesce(s.n, 0) AS n FROM sp CROSS JOIN (SELECT DISTINCT priority FROM s) p LEFT JOIN s ON s.day = sp.day AND s.priority = p.priority)
SELECT priority, day, n, round(round(avg(n) OVER (PARTITION BY priority ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4), 3) AS moving_avg FROM g""")
def w8(spark, d):
    return windows.ticket_trend(entity(spark, d, "tickets")).withColumn("moving_avg", F.round("moving_avg", 3))


@query("w9_basket_lines", "SELECT item_id, order_id, product_id, category, line_total, round(CAST(line_total AS DOUBLE) / nullif(CAST(sum(line_total) OVER (PARTITION BY order_id) AS DOUBLE), 0), 6) AS order_share FROM items LEFT JOIN products USING (product_id)")
def w9(spark, d):
    return windows.basket_lines(*_e(spark, d, "items", "products"))


@query("w10_slow_movers", """WITH u AS (SELECT product_id, category, coalesce(sum(quantity), 0) AS units FROM products LEFT JOIN items USING (product_id) GROUP BY 1, 2), r AS (SELECT *, round(percent_rank() OVER (ORDER BY units), 6) AS unit_rank FROM u)
SELECT product_id, category, CAST(units AS BIGINT) AS units, unit_rank FROM r WHERE unit_rank <= 0.1""")
def w10(spark, d):
    return windows.slow_movers(*_e(spark, d, "products", "items"))


@query("w10_sell_through", f"""WITH a AS (SELECT product_id, sum(quantity) AS a, coalesce(sum(quantity) FILTER (order_date > DATE '{AS_OF}' - 30), 0) AS r FROM items JOIN sales USING (order_id) GROUP BY 1)
SELECT product_id, CAST(coalesce(r, 0) AS BIGINT) AS units_recent, coalesce(round(CAST(r AS DOUBLE) / a, 6), 0) AS sell_through FROM products LEFT JOIN a USING (product_id)""")
def w10_sell(spark, d):
    return windows.sell_through(*_e(spark, d, "products", "items", "sales"), AS_OF)


@query("w10_margin_trend", """WITH m AS (SELECT category, CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(sum(line_total - quantity * coalesce(cost, 0)) AS DECIMAL(18,2)) AS margin FROM items JOIN sales USING (order_id) JOIN products USING (product_id) GROUP BY 1, 2)
SELECT *, margin - lag(margin) OVER (PARTITION BY category ORDER BY month) AS change FROM m""")
def w10_margin(spark, d):
    return windows.margin_trend(*_e(spark, d, "products", "items", "sales"))


def _log(spark, d):
    """Insights given before: signups stand for upsell insights, all other events for churn ones."""
    e = entity(spark, d, "events")
    return e.select(F.col("user_id").alias("customer_id"), F.when(F.col("event_type") == "signup", metrics.UPSELL).otherwise(metrics.CHURN).alias("insight_type"), F.col("ts").alias("generated_at"))


def _f360(spark, d):
    return gold.customer_360_recency(*_e(spark, d, "customers", "sales"), AS_OF)


def _given(kind: str, days: int) -> str:
    return f"customer_id NOT IN (SELECT user_id FROM events WHERE event_type {kind} 'signup' AND CAST(ts AS DATE) > DATE '{EVENTS_AS_OF}' - {days})"


@query("i1_churn_insights", f"""WITH {C360} SELECT customer_id, 'CHURN_RISK' AS insight_type, CASE WHEN days_since_last_order > 90 AND lifetime_value > 2500000 THEN 'HIGH' WHEN days_since_last_order > 60 THEN 'MEDIUM' ELSE 'LOW' END AS insight_severity,
 CASE WHEN days_since_last_order > 90 THEN '{metrics.CHURN_TEXTS[0]}' WHEN days_since_last_order > 60 THEN '{metrics.CHURN_TEXTS[1]}' ELSE '{metrics.CHURN_TEXTS[2]}' END AS recommendation,
 '{{"days_inactive":' || days_since_last_order || ',"lifetime_value":' || lifetime_value || ',"segment":"' || segment || '"}}' AS supporting_data FROM f360 WHERE engagement_status IN ('AT_RISK', 'COOLING') AND {_given('<>', 7)}""")
def i1(spark, d):
    return metrics.churn_insights(_f360(spark, d), _log(spark, d), EVENTS_AS_OF, 2_500_000)


#: The average order in whole cents, rounded half up, in integers.
AOV_CENTS = "CAST((CAST(lifetime_value * 100 AS BIGINT) * 2 + total_orders) // (2 * total_orders) AS DECIMAL(18,2)) / 100"


@query("i2_upsell_insights", f"""WITH {C360} SELECT customer_id, 'UPSELL_OPPORTUNITY' AS insight_type, 'MEDIUM' AS insight_severity, '{metrics.UPSELL_TEXT}' AS recommendation,
 '{{"current_tier":"' || revenue_tier || '","order_frequency":' || total_orders || ',"avg_order_value":' || CAST({AOV_CENTS} AS DECIMAL(18,2)) || '}}' AS supporting_data FROM f360 WHERE engagement_status = 'HOT' AND revenue_tier = 'SMB' AND total_orders >= 3 AND {_given('=', 30)}""")
def i2(spark, d):
    return metrics.upsell_insights(_f360(spark, d), _log(spark, d), EVENTS_AS_OF)


#: The time of a run that makes both kinds of insights.
RUN_AT = f"{EVENTS_AS_OF} 09:30:00"


@query("i3_insight_rows", f"""WITH {C360}, i AS (SELECT customer_id, 'CHURN_RISK' AS insight_type, CASE WHEN days_since_last_order > 90 AND lifetime_value > 2500000 THEN 'HIGH' WHEN days_since_last_order > 60 THEN 'MEDIUM' ELSE 'LOW' END AS insight_severity, days_since_last_order AS days FROM f360 WHERE engagement_status IN ('AT_RISK', 'COOLING') AND {_given('<>', 7)}
 UNION ALL SELECT customer_id, 'UPSELL_OPPORTUNITY', 'MEDIUM', NULL FROM f360 WHERE engagement_status = 'HOT' AND revenue_tier = 'SMB' AND total_orders >= 3 AND {_given('=', 30)})
SELECT sha256(insight_type || '|' || customer_id || '|{RUN_AT}') AS insight_id, customer_id, insight_type, insight_severity, CASE WHEN days IS NULL THEN '{metrics.UPSELL_TEXT}' WHEN days > 90 THEN '{metrics.CHURN_TEXTS[0]}' WHEN days > 60 THEN '{metrics.CHURN_TEXTS[1]}' ELSE '{metrics.CHURN_TEXTS[2]}' END AS recommendation,
 'insight_rules' AS generated_by, TIMESTAMP '{RUN_AT}' AS generated_at, false AS synced_to_postgres, false AS actioned FROM i""")
def i3(spark, d):
    return metrics.generate_insights(_f360(spark, d), _log(spark, d), RUN_AT, 2_500_000).drop("supporting_data")  # i1 and i2 compare it


@query("i4_metric_view", "SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, status, count(order_id) AS orders, sum(total_amount) AS revenue, count(DISTINCT customer_id) AS customers FROM sales JOIN customers USING (customer_id) WHERE loyalty_tier = 'GOLD' GROUP BY 1, 2")
def i4(spark, d):
    return metrics.sales_view(*_e(spark, d, "sales", "customers")).query(["month", "status"], ["orders", "revenue", "customers"], "loyalty_tier = 'GOLD'")


@query("i4_proposed_view", "SELECT category, active, sum(cost) AS cost, round(avg(CAST(price AS DOUBLE)), 3) AS price FROM products GROUP BY 1, 2")
def i4_proposed(spark, d):
    view = metrics.MetricView.propose(entity(spark, d, "products").withColumn("price", F.col("price").cast("double")))
    return view.query(["category", "active"], ["cost", "price"]).withColumn("price", F.round("price", 3))


@query("i6_aov_by_segment", "SELECT segment, count(order_id) AS orders, round(avg(CAST(total_amount AS DOUBLE)), 2) AS aov FROM sales JOIN customers USING (customer_id) GROUP BY 1")
def i6_aov(spark, d):
    return metrics.question("aov_by_segment", metrics.sales_view(*_e(spark, d, "sales", "customers"))).withColumn("aov", F.round("aov", 2))


@query("i6_trend", "SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, segment, count(order_id) AS orders, sum(total_amount) AS revenue FROM sales JOIN customers USING (customer_id) GROUP BY 1, 2")
def i6_trend(spark, d):
    return metrics.question("trend", metrics.sales_view(*_e(spark, d, "sales", "customers")))


@query("i6_at_risk", f"WITH {C360} SELECT customer_id, segment, lifetime_value, recency_days FROM c360 WHERE engagement_status = 'DORMANT' AND lifetime_value > 0")
def i6_risk(spark, d):
    return metrics.question("at_risk", None, _c360(spark, d))


@query("i6_best_sellers", f"""WITH {PRODUCT} SELECT product_id, product_name, category, CAST(units_sold AS BIGINT) AS units_sold, revenue AS total_revenue, coalesce(unique_customers, 0) AS unique_customers FROM products LEFT JOIN ia USING (product_id) LEFT JOIN ua USING (product_id)
WHERE is_deleted = false AND active ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 10""")
def i6_best(spark, d):
    return metrics.question("best_sellers", None, None, gold.product_performance(*_e(spark, d, "products", "items", "sales")))


@query("l1_enterprise_at_risk", f"WITH {C360} SELECT customer_id, full_name, company_name, lifetime_value, days_since_last_order, engagement_status FROM f360 WHERE {SEGMENT} = 'ENTERPRISE' AND engagement_status = 'AT_RISK' ORDER BY lifetime_value DESC NULLS LAST, customer_id")
def l1_risk(spark, d):
    return metrics.question("enterprise_at_risk", None, gold.customer_360_recency(_silver_customers(spark, d), entity(spark, d, "sales"), AS_OF))


@query("i6_open_tickets", f"WITH {C360} SELECT customer_id, open_tickets FROM c360 WHERE open_tickets > 0")
def i6_open(spark, d):
    return metrics.question("open_tickets", None, _c360(spark, d))
