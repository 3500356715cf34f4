"""Hand-computed values of the rules, numbering at scale, sources against an embedded database, and streams batch by batch."""

from __future__ import annotations

import datetime
import json
import random
import re
import time
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, evolve, gold, graph, joins, metrics, quality, references, silver, windows
from tidemark.plans import check_queries
from tidemark.plans.bindings import entity
from tidemark.sources import landing
from tidemark.streaming import pipelines as streaming
from tidemark.streaming.store import HistoryStore

LARGE = "/root/testdata/sf0.1"
D = datetime.date


@pytest.fixture(scope="module")
def seed(spark):
    """A few customers, orders, products, items and tickets whose aggregates are easy to reckon."""
    rows = lambda data, schema: spark.createDataFrame(data, schema)
    customers = rows([
        (1, "Ann", "Lee", "Acme Corp", 1_500_000, "GOLD", True, False), (2, "Bo", None, "Startup Labs", 150_000, "SILVER", True, False), (3, "Cy", "Ito", "Bakery", 50_000, "BRONZE", True, None),
        (4, "Di", "Fox", "Big Enterprise", None, "GOLD", False, False), (5, "Ed", "Orr", "Old Inc", 10, "BRONZE", True, True)],
        "customer_id long, first_name string, last_name string, company_name string, annual_revenue int, loyalty_tier string, is_active boolean, is_deleted boolean")
    customers = customers.withColumns({"annual_revenue": F.col("annual_revenue").cast("decimal(15,2)"), "email": F.lit("x@y.io"), "phone": F.lit("1"), "segment": silver.derive_segment("company_name"), "created_at": F.lit("2024-01-01").cast("date"), "updated_at": F.lit("2024-01-02").cast("date")})
    orders = rows([(10, 1, D(2024, 6, 25), "completed", 60_000), (11, 1, D(2024, 6, 1), "pending", 45_000), (12, 2, D(2024, 4, 20), "completed", 100), (13, 4, D(2024, 1, 5), "processing", 20_000)], "order_id long, customer_id long, order_date date, status string, total_amount int").withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)"))
    products = rows([(100, "pen", "office", "10.00", "4.00", True, False), (101, "ink", "office", "5.00", None, False, False), (102, "cup", "home", "8.00", "0.00", True, True)], "product_id long, product_name string, category string, price string, cost string, active boolean, is_deleted boolean")
    products = products.withColumns({"price": F.col("price").cast("decimal(10,2)"), "cost": F.col("cost").cast("decimal(10,2)"), "sku": F.lit("s"), "updated_at": F.lit("2024-01-02").cast("date")})
    items = rows([(1, 10, 100, 2, "20.00"), (2, 11, 100, 4, "40.00"), (3, 12, 101, 1, "5.00")], "item_id long, order_id long, product_id long, quantity int, line_total string").withColumn("line_total", F.col("line_total").cast("decimal(12,2)"))
    t = datetime.datetime
    tickets = rows([(7, 1, t(2024, 6, 1, 23, 59), t(2024, 6, 2, 0, 1), t(2024, 6, 2, 0, 0), "resolved", "high"), (8, 1, t(2024, 6, 3), None, None, "open", "medium"), (9, 1, t(2024, 6, 3), t(2024, 6, 3, 5), t(2024, 6, 3, 2), "resolved", "high")],
                   "ticket_id long, customer_id long, created_at timestamp_ntz, resolved_at timestamp_ntz, first_response_at timestamp_ntz, status string, priority string")
    return customers, orders, products, items, tickets


AS_OF = "2024-07-01"


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_segments_and_tiers(seed):
    got = by(seed[0].select("customer_id", "segment", silver.revenue_tier("annual_revenue").alias("tier")), "customer_id")
    assert [got[i].segment for i in range(1, 6)] == ["ENTERPRISE", "STARTUP", "MID-MARKET", "ENTERPRISE", "MID-MARKET"]
    assert [got[i].tier for i in range(1, 6)] == ["ENTERPRISE", "MID-MARKET", "SMB", "SMB", "SMB"]


def test_margins(seed):
    on_cost, on_price = (by(silver.product_margin(seed[2], b), "product_id") for b in ("cost", "price"))
    assert [(float(on_cost[i].margin), float(on_cost[i].margin_pct)) for i in (100, 101, 102)] == [(6, 150), (5, 0), (8, 0)]
    assert [(None if on_price[i].margin is None else float(on_price[i].margin), None if on_price[i].margin_pct is None else float(on_price[i].margin_pct)) for i in (100, 101, 102)] == [(6, 60), (None, None), (8, 100)]


def test_customer_360(seed):
    c, o, _, _, t = seed
    got = by(gold.customer_360(c, o, t, AS_OF), "customer_id")
    assert set(got) == {1, 2, 4}  # deleted ones and those whose flag is null go
    one = got[1]
    assert (one.total_orders, one.lifetime_value, one.avg_order_value, one.first_order_date, one.recency_days, one.frequency, one.revenue_tier, one.engagement_status, one.total_tickets, one.open_tickets) == (2, 105_000, 52_500.0, D(2024, 6, 1), 6, 2, "PLATINUM", "HOT", 3, 1)
    assert (one.full_name, got[2].full_name) == ("Ann Lee", None)
    assert (got[2].recency_days, got[2].engagement_status, got[2].revenue_tier) == (72, "COOLING", "BRONZE") and got[4].engagement_status == "DORMANT"
    wide = by(gold.customer_360(c, o, t, AS_OF, fanout=True), "customer_id")[1]
    assert (wide.total_orders, wide.lifetime_value, wide.total_tickets, wide.open_tickets) == (2, 315_000, 3, 2)


def test_customer_360_of_active_customers(seed):
    c, o, _, _, t = seed
    got = by(gold.customer_360_service(c, o, t, AS_OF), "customer_id")
    assert set(got) == {1, 2, 3, 5}
    assert [(got[i].revenue_tier, got[i].engagement_status, got[i].total_orders, got[i].lifetime_value) for i in (1, 2, 3)] == [("ENTERPRISE", "HOT", 2, 105_000), ("MID-MARKET", "COOLING", 1, 100), ("SMB", "HOT", 0, None)]
    assert got[1].avg_resolution_hours == 3.0 and (got[1].full_name, got[2].full_name) == ("Ann Lee", None)  # one hour boundary, and five
    assert by(gold.customer_360_recency(c, o, AS_OF), "customer_id")[2].full_name == "Bo "
    assert "total_tickets" not in gold.customer_360_recency(c, o, AS_OF).columns


def test_summaries(seed):
    c, o, p, i, t = seed
    s = {(r.order_date, r.revenue_tier): r for r in gold.sales_summary(o, c).collect()}
    assert s[D(2024, 6, 25), "ENTERPRISE"].total_revenue == 60_000 and s[D(2024, 1, 5), "SMB"].avg_order_value == 20_000.0
    m = {(r.order_month, r.customer_segment): r for r in gold.order_summary(o, c).collect()}[D(2024, 6, 1), "ENTERPRISE"]
    assert (m.order_count, m.unique_customers, m.completed_orders, m.pending_orders, m.processing_orders, m.avg_order_value) == (2, 1, 1, 1, 0, 52_500.0)
    k = {(r.segment, r.loyalty_tier): r for r in gold.customer_metrics(c, o).collect()}["ENTERPRISE", "GOLD"]
    assert (k.customer_count, k.total_orders, k.avg_orders_per_customer) == (2, 3, 1.5)
    pp = by(gold.product_performance(p, i, o), "product_id")
    assert set(pp) == {100, 101} and (pp[100].orders_count, pp[100].units_sold, pp[100].total_revenue, pp[100].unique_customers, float(pp[100].margin_percent)) == (2, 6, 60, 1, 60.0)
    assert by(gold.product_performance_basic(p, i, o), "product_id")[102].total_units_sold is None
    cat = by(gold.category_metrics(p, i), "category")["office"]
    assert (cat.total_products, cat.active_products, cat.total_units_sold, cat.orders_with_category, cat.avg_list_price, cat.avg_cost_price, cat.avg_selling_price) == (2, 1, 7, 3, 25 / 3, 4.0, 65 / 7)
    sup = {r.priority: r for r in gold.support_metrics(t, c, "2024-06-04 01:00:00").collect()}
    early = {r.priority: r for r in gold.support_metrics(t, c, "2024-06-04 00:00:00").collect()}
    assert (sup["medium"].sla_breaches, early["medium"].sla_breaches) == (1, 0)  # open for 25 hours, and for 24
    assert (sup["high"].tickets, sup["high"].sla_breaches, sup["high"].avg_resolution_hours, sup["high"].avg_first_response_hours, sup["medium"].open_tickets) == (2, 1, 3.0, 1.5, 1)


def test_features(seed):
    c, o, _, i, t = seed
    f = by(gold.sales_features(c, o, i, AS_OF), "customer_id")
    assert set(f) == {1, 2, 3, 5} and (f[3].order_count, f[3].total_spend, f[3].engagement_score, f[3].churn_flag, f[3].unique_products_purchased) == (0, None, None, 0, 0)
    assert (f[1].customer_tenure_days, f[1].recency_days, f[1].orders_per_month, f[1].max_order_value) == (182, 6, 2.0, 60_000)
    assert abs(f[1].engagement_score - (100 / 6 + 20 + 5 * 5.021193)) < 1e-4
    ml = by(gold.ml_customer_features(c, gold.customer_360(c, o, t, AS_OF)), "customer_id")
    assert [(ml[k].segment_encoded, ml[k].tier_encoded, ml[k].recency_days, ml[k].is_churned) for k in (1, 2, 4)] == [(3, 4, 6, 0), (1, 1, 72, 0), (3, 2, 178, 1)]
    view = gold.ml_feature_view(gold.sales_features(c, o, i, AS_OF), gold.customer_360_recency(c, o, AS_OF))
    assert tuple(view.columns) == gold.FEATURES and len(gold.FEATURES) == 16


def test_insights(spark, seed):
    c, o, *_ = seed
    late = o.withColumn("order_date", F.when(F.col("customer_id") == 1, F.lit("2024-03-01").cast("date")).otherwise(F.col("order_date")))
    log = spark.createDataFrame([(2, metrics.CHURN, D(2024, 6, 30)), (1, metrics.CHURN, D(2024, 6, 1))], "customer_id long, insight_type string, generated_at date")
    got = metrics.churn_insights(gold.customer_360_recency(c, late, AS_OF), log, AS_OF).collect()
    assert [(r.customer_id, r.insight_severity, r.recommendation, r.supporting_data) for r in got] == [(1, "HIGH", metrics.CHURN_TEXTS[0], '{"days_inactive":122,"lifetime_value":105000.00,"segment":"ENTERPRISE"}')]
    small = c.withColumn("annual_revenue", F.lit(5).cast("decimal(15,2)"))
    up = metrics.upsell_insights(gold.customer_360_recency(small, o, AS_OF), log, AS_OF, least_orders=2).collect()
    assert [(r.customer_id, r.supporting_data) for r in up] == [(1, '{"current_tier":"SMB","order_frequency":2,"avg_order_value":52500.00}')]


def test_upsell_average_of_half_a_cent(spark, seed):
    small = seed[0].withColumn("annual_revenue", F.lit(5).cast("decimal(15,2)"))
    amounts = ["253043.19"] * 6 + ["253043.20"] * 6  # 253043.195 on the average; the nearest double lies below it
    o = spark.createDataFrame([(i, 1, D(2024, 6, 25), a) for i, a in enumerate(amounts)], "order_id long, customer_id long, order_date date, total_amount string").withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)"))
    log = spark.createDataFrame([], "customer_id long, insight_type string, generated_at date")
    got = metrics.upsell_insights(gold.customer_360_recency(small, o, AS_OF), log, AS_OF).collect()
    assert [json.loads(r.supporting_data, parse_float=str)["avg_order_value"] for r in got] == ["253043.20"]


def test_row_numbers_of_a_wide_table(spark):
    orders = entity(spark, LARGE, "orders")
    got = joins.running_number(orders, ["o_orderdate", "o_orderkey"])
    n = orders.count()
    assert got.agg(F.count("*"), F.countDistinct("seq"), F.min("seq"), F.max("seq")).first() == (n, n, 1, n)
    first = orders.orderBy("o_orderdate", "o_orderkey").limit(1000).select("o_orderkey").collect()
    assert [r.o_orderkey for r in got.filter("seq <= 1000").orderBy("seq").collect()] == [r.o_orderkey for r in first]


def test_percent_ranks_of_a_wide_table(spark):
    orders = entity(spark, LARGE, "orders").withColumn("v", F.floor(F.col("o_totalprice") / 100))
    got = windows.percent_ranks(orders, "v", "rank")
    values = sorted(r.v for r in orders.select("v").collect())
    for r in got.filter("o_orderkey % 5000 = 1").collect():
        assert abs(r.rank - values.index(r.v) / (len(values) - 1)) < 1e-6


def test_percent_ranks_with_nulls(spark):
    rows = [(1, 5), (2, None), (3, 5), (4, 9), (5, None), (6, 1)]
    got = by(windows.percent_ranks(spark.createDataFrame(rows, "i int, v int"), "v", "rank"), "i")
    assert {i: got[i]["rank"] for i in got} == {6: 0.0, 1: 0.2, 3: 0.2, 4: 0.6, 2: 0.8, 5: 0.8}  # nulls are rows and come last
    assert [r["rank"] for r in windows.percent_ranks(spark.createDataFrame([(1, None), (2, None)], "i int, v int"), "v", "rank").collect()] == [0.0, 0.0]


def test_streams_are_fed_by_many_tasks(spark, tmp_path):
    lines = entity(spark, "/root/testdata/sf0.001", "lineitem").withColumn("l_suppkey", F.when(F.col("l_linenumber") > 1, F.col("l_suppkey")))
    lines.repartition(5).write.parquet(f"{tmp_path}/lineitem.parquet")
    at, schema, files, buckets = check_queries._folder(spark, str(tmp_path), 3)
    fed = spark.read.schema(schema).parquet(f"{at}/in")
    assert fed.count() == lines.count()  # lines without a supplier, too
    assert len(fed.inputFiles()) > 3 and 3 * files >= len(fed.inputFiles()) and buckets >= 16


@pytest.mark.parametrize("share", [1, 1000])
def test_pattern_join_of_every_kind(spark, monkeypatch, share):
    monkeypatch.setattr(joins, "LIKE_SHARE", share)
    monkeypatch.setattr(joins.like_matches, "__defaults__", (share,))
    some = ["alpha_1", "alpha_1", "alpha%2", "beta", "", "a", "ab", "xaby", "a_b", "äöü", "back\\slash", None, None, "ALPHA_1", "zz top zz", "new\nline"]
    names = spark.createDataFrame([(i, n) for i, n in enumerate(some)], "i int, name string")
    pats = ["alpha%", "%a", "%", "%", "_", "__", "a%_", "%ab%", r"alpha\_%", r"alpha\%2", r"%\\%", "", "äö_", "zz%zz", "none%", "%h_1", None, "%\n%", "_%b%"]
    rules = spark.createDataFrame([(f"r{j}", p) for j, p in enumerate(pats)], "rule string, pat string")
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        want = names.join(F.broadcast(rules), F.expr("name LIKE pat"), how)
        got = joins.pattern_join(names, rules, "name", "pat", how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), how
    assert joins.pattern_join(names.limit(0), rules, "name", "pat").count() == 0 == joins.pattern_join(names, rules.limit(0), "name", "pat", "left_semi").count()
    assert joins.pattern_join(names, rules.limit(0), "name", "pat", "left_anti").count() == len(some)
    plan = joins.pattern_join(names, rules, "name", "pat")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def leaf_paths(value, path="$"):
    """Paths, kinds and occurrences of one decoded payload."""
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in leaf_paths(v, f"{path}.{k}")]
    if isinstance(value, list) and value:
        return [x for v in value for x in leaf_paths(v, f"{path}[*]")]
    names = {dict: "OBJECT", list: "ARRAY", str: "STRING", bool: "BOOLEAN", int: "BIGINT", type(None): "VOID"}
    return [(path, names[type(value)])]


def test_paths_of_any_depth(spark):
    deep = {"z": 1}
    for i in range(12):
        deep = {"d": deep, "e": {}} if i % 2 else {"d": [deep, [], {}]}
    payloads = [{"a": {"b": {"c": {"d": {"e": 1}}}}, "z": 1, "m": {}, "n": []}, deep, {"a": 3, "n": [[[["x"]]]]}, {"a": [{"b": None}, {"b": True}], "<": {"a<b": {">": {}}}, "nulls": [None, None]}, [1, "s"], "text", None]
    df = spark.createDataFrame([(json.dumps(p),) for p in payloads] + [(None,), ("{broken",)], "t string").select(F.try_parse_json("t").alias("payload"))
    want = Counter(x for p in payloads for x in leaf_paths(p))
    assert {(r.path, r.value_type): r.occurrences for r in evolve.discover_paths(df).collect()} == want
    shallow = {r.path: r.value_type for r in evolve.discover_paths(df, depth=1).collect()}
    assert shallow["$.m"] == "OBJECT" and shallow["$.z"] == "BIGINT" and "$.a.b" not in shallow
    assert evolve.discover_paths(df.limit(0)).count() == 0


def test_merged_schema(spark):
    df = lambda *texts: spark.createDataFrame([(t,) for t in texts], "t string").select(F.try_parse_json("t").alias("payload"))
    value = lambda d: evolve.infer_payload_schema(d).first()[0]
    assert value(df('{"a":1}', '{"b":[1.5],"a":null}', None, "{bad")) == "OBJECT<a: BIGINT, b: ARRAY<DECIMAL(2,1)>>"
    assert value(df('{"a":1}', '{"a":{"b":1}}')) == "OBJECT<a: VARIANT>"


def test_latest_version_within_a_day(spark):
    def log(*rows):
        return spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(F.parse_json("j").alias("payload"))

    base = {"customer_id": 1, "last_name": "Lee", "company_name": "Old Labs", "created_at": "2024-01-01T10:00:00.5", "updated_at": "2024-01-02", "phone": "1", "industry": "it"}
    day = "2024-05-01T"
    got = silver.silver_customers(log(base | {"first_name": "Zoe", "_updated_at": day + "08:00:00"}, base | {"first_name": "Amy", "_updated_at": day + "17:00:00"}, base | {"first_name": "Eve", "_updated_at": day + "16:59:59.999999"})).collect()
    assert [(r.first_name, r.full_name, r.phone, r.industry, r.cdc_timestamp, r.created_at, r.updated_at, r.customer_segment) for r in got] == [("Amy", "Amy Lee", "1", "it", datetime.datetime(2024, 5, 1, 17), datetime.datetime(2024, 1, 1, 10, 0, 0, 500000), datetime.datetime(2024, 1, 2), "STARTUP")]
    gone = log(base | {"first_name": "Amy", "_updated_at": day + "17:00:00"}, base | {"first_name": "Zoe", "_updated_at": day + "17:00:00.000001", "_deleted": True})
    assert silver.silver_customers(gone).count() == 0
    order = {"order_id": 7, "customer_id": 1, "order_date": "2024-03-30T23:30:00", "total_amount": "12.50", "shipping_address": "Road 1", "notes": None}
    got = silver.silver_orders(log(order | {"status": "new", "_updated_at": day + "09:00:00"}, order | {"status": "sent", "_updated_at": day + "10:00:00", "_deleted": False}), "2024-04-01").collect()
    assert [(r.status, r.order_date, r.order_month, r.days_since_order, r.shipping_address, r.notes, float(r.total_amount)) for r in got] == [("sent", datetime.datetime(2024, 3, 30, 23, 30), D(2024, 3, 1), 2, "Road 1", None, 12.5)]
    ticket = {"ticket_id": 3, "customer_id": 1, "subject": "s", "description": "d", "priority": "high", "status": "open", "created_at": "2024-05-01T23:59:00", "_updated_at": day + "01:00:00"}
    got = silver.silver_tickets(log(ticket, ticket | {"status": "resolved", "resolved_at": "2024-05-02T00:01:00", "_updated_at": day + "02:00:00"})).collect()
    assert [(r.status, r.subject, r.description, r.resolution_hours) for r in got] == [("resolved", "s", "d", 1)]
    product = {"product_id": 5, "price": "10", "cost": None, "sku": "k", "created_at": "not a time", "active": True}
    got = silver.silver_products(log(product | {"_updated_at": day + "01:00:00"}, product | {"price": "bad", "cost": "4", "_updated_at": day + "00:59:00"})).collect()
    assert [(float(r.price), float(r.margin), float(r.margin_pct), r.sku, r.created_at) for r in got] == [(10, 10, 0, "k", None)]
    item = {"item_id": 9, "order_id": 7, "product_id": 5, "quantity": 3, "unit_price": "2.50", "discount_percent": 10}
    got = silver.silver_items(log(item | {"_updated_at": day + "01:00:00"}, item | {"quantity": 4, "_updated_at": day + "01:00:01"})).collect()
    assert [(float(r.gross_total), float(r.net_total)) for r in got] == [(10, 9)]


def test_versions_of_one_time_by_log_position(spark):
    rows = [("Zoe", 2), ("Amy", 1)]
    df = spark.createDataFrame([(json.dumps({"customer_id": 1, "first_name": n, "_updated_at": "2024-05-01T08:00:00"}), p) for n, p in rows], "j string, lsn long").select(F.parse_json("j").alias("payload"), "lsn")
    assert [r.first_name for r in silver.silver_customers(df, "lsn").collect()] == ["Zoe"]
    assert "lsn" not in silver.silver_customers(df, "lsn").columns


def test_packed_times_keep_microseconds(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-05-01 08:00:00.000001' AS a, timestamp'2024-05-01 08:00:00.000002' AS b")
    got = landing.pack_bronze(df, "x").select(F.variant_get("payload", "$.a", "timestamp_ntz"), F.variant_get("payload", "$.b", "timestamp")).first()
    assert [t.microsecond for t in got] == [1, 2]


def test_closure_goes_on_until_nothing_is_new(spark):
    edges = spark.createDataFrame([(str(i), str(i + 1)) for i in range(14)] + [("3", "1")], "source_node_id string, target_node_id string")
    assert {r.node_id: r.hop for r in graph.lineage_closure(edges, ["0"]).collect()} == {str(i): i for i in range(1, 15)}
    assert graph.lineage_closure(edges, ["0"], max_hops=3).count() == 3


@pytest.mark.parametrize("at_once", [(7, 3), (1000, 1000)])
def test_similar_items_equal_all_pairs(spark, at_once):
    import random

    rng = random.Random(3)
    rows = [(i, [rng.gauss(0.3, 1) for _ in range(5)]) for i in range(80)] + [(80, [0.0] * 5), (81, [0.0] * 5), (82, None), (83, [1.0, 2.0]), (84, [2.0, 4.0]), (85, [])]
    rows += [(90 + i, rows[7][1]) for i in range(6)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    def cosine(a, b):
        if not a or not b or len(a) != len(b) or not any(a) or not any(b):
            return None
        return round(sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5, 6)

    asked = [r for r in rows if r[0] % 7 == 0 or r[0] in (80, 82, 83)]
    want = []
    for i, q in asked:
        best = sorted(((cosine(q, v), j) for j, v in rows if j != i), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))[:4]
        want += [(i, j, s, n) for n, (s, j) in enumerate(best, 1)]
    seen = {}
    got = graph.similar_items(df, df.filter(F.col("vec_id").isin([i for i, _ in asked])), 4, *at_once, seen=seen)
    assert sorted((r.query_id, r.vec_id, r.similarity, r["rank"]) for r in got.collect()) == sorted(want, key=lambda x: x[:2])
    assert seen["share"] < 0.3
    assert graph.similar_items(df.limit(0), df, 4).count() == 0 == graph.similar_items(df, df.limit(0), 4).count()


def test_similar_items_compares_few(spark):
    e, seen = entity(spark, LARGE, "embeddings").select("vec_id", "embedding"), {}
    got = graph.similar_items(e, e.filter("vec_id % 50 = 0"), 5, seen=seen)
    assert got.count() == 200 and seen["share"] < 0.02
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_near_names(spark):
    refs = spark.createDataFrame([(1, "RAW.F"), (1, "RAW.O"), (2, "NONE")], "k int, table_name string")
    tables = spark.createDataFrame([("raw.o",), ("raw.f_old",), ("f",), ("one",)], "table_name string")
    assert {r.table_name: r.suggestions for r in graph.validate_refs(refs, tables).collect()} == {"RAW.F": "F, RAW.F_OLD", "NONE": "ONE"}


def test_database_round_trip(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    rows = spark.range(100).select(F.col("id").alias("customer_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("recommendation"))
    rows.limit(0).write.format("jdbc").options(url=url, dbtable="insights").mode("overwrite").save()
    assert landing.read_jdbc(spark, url, "insights", "customer_id").count() == 0
    landing.write_back(rows, url, "insights")
    landing.write_back(rows.withColumn("customer_id", F.col("customer_id") + 100), url, "insights")
    got = landing.read_jdbc(spark, url, "insights", "customer_id", parts=7)
    assert got.rdd.getNumPartitions() == 7 and got.agg(F.count("*"), F.countDistinct("customer_id"), F.max("customer_id")).first() == (200, 200, 199)


def test_incremental_rows_of_an_equal_time_are_not_lost(spark):
    day = D(2024, 1, 1)
    rows = [(1, day), (2, day), (3, D(2024, 1, 2))]
    frame = lambda some: spark.createDataFrame(some, "id long, at date")
    marks = spark.createDataFrame([], "table_name string, last_ts date, seen array<long>, rows_processed long")
    seen, batches = [], [rows[:1], rows[:2], rows, rows + [(4, D(2024, 1, 2)), (5, day)]]
    for some in batches:
        new, marks = streaming.process_incremental(frame(some), marks, "t", "at", lambda df: df)
        seen += sorted(r.id for r in new.collect())
        marks = spark.createDataFrame(marks.collect(), marks.schema)
    assert seen == [1, 2, 3, 4]  # 5 lies before the mark
    assert marks.first().rows_processed == 4
    assert streaming.pending_rows(frame(rows), day, "at", [r.h for r in frame(rows[:2]).select(streaming.row_hash(frame(rows)).alias("h")).collect()]).first() == (1, True)


@pytest.mark.parametrize("parts", [1, 3])
def test_keyed_state_agrees_with_snapshots(spark, tmp_path, parts):
    rows = [(k % 7, D(2024, 1, 1 + (k * 5) % 28), k, k % 4 == 0) for k in range(60)]
    schema = "id long, _updated_at date, v long, _deleted boolean"
    for p in range(parts):
        spark.createDataFrame(rows[p::parts], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = lambda: streaming.stream_changes(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, 1)
    by_state = streaming.latest_stateful(stream(), ["id"], ["_updated_at", "v"], f"{tmp_path}/state", f"{tmp_path}/cp1")
    by_snapshot = streaming.stream_latest(stream(), ["id"], ["_updated_at", "v"], f"{tmp_path}/snap", f"{tmp_path}/cp2").latest()
    want = {k: max((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])) for k in range(7)}
    cols = ["id", "_updated_at", "v", "_deleted"]
    assert {r.id: tuple(r) for r in by_state.select(cols).collect()} == want == {r.id: tuple(r) for r in by_snapshot.select(cols).collect()}
    assert {r.id for r in cdc.live(by_state).collect()} == {k for k, r in want.items() if not r[3]}


def test_stream_without_what_was_there_before(spark, tmp_path):
    frame = spark.range(5)
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    time.sleep(1.1)
    now = datetime.datetime.now()
    time.sleep(1.1)
    spark.range(5, 8).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    streaming.append_available(streaming.stream_changes(spark, f"{tmp_path}/in", frame.schema, after=now), f"{tmp_path}/cp", f"{tmp_path}/out")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [5, 6, 7]


STATEMENTS = [
    ("SELECT * FROM a", "A"), ("select x from db.s.t t1 join u on t1.i = u.i", "DB.S.T U"), ("SELECT 1", ""), ("", ""), ("FROM a SELECT x", "A"),
    ("SELECT * FROM a, b c, d.e AS f WHERE a.x IN (1, 2)", "A B D.E"), ("SELECT * FROM a -- FROM b\nJOIN c USING (i)", "A C"), ("SELECT /* FROM x */ y FROM z", "Z"), ("SELECT 'a FROM b', y FROM c", "C"), ("SELECT 'it''s FROM b' FROM c", "C"),
    ('SELECT * FROM "My Table"', "MY TABLE"), ("SELECT * FROM `db`.`t`", "DB.T"), ('SELECT * FROM "a"."b""c"', 'A.B"C'), ("SELECT * FROM db . t", "DB.T"),
    ("WITH q AS (SELECT * FROM r) SELECT * FROM q JOIN s ON true", "R S"), ("WITH q AS (SELECT * FROM a), w AS (SELECT * FROM q) SELECT * FROM w, q", "A"), ("WITH q (i, j) AS (SELECT * FROM a) SELECT * FROM q", "A"), ("WITH t AS (SELECT * FROM t) SELECT * FROM t", "T"),
    ("WITH RECURSIVE n AS (SELECT 1 FROM seed UNION ALL SELECT i + 1 FROM n) SELECT * FROM n", "SEED"), ("SELECT * FROM (WITH q AS (SELECT * FROM a) SELECT * FROM q) x JOIN q ON true", "A Q"), ("WITH q AS (SELECT 1) SELECT * FROM db.q", "DB.Q"),
    ("SELECT * FROM (SELECT * FROM a WHERE x IN (SELECT y FROM b)) s, c", "A B C"), ("SELECT extract(year FROM d), trim(both FROM e) FROM f", "F"), ("SELECT * FROM a WHERE x IS NOT DISTINCT FROM y", "A"), ("SELECT * FROM range(10) r, LATERAL flatten(x) f, t", "T"),
    ("SELECT * FROM a LEFT OUTER JOIN LATERAL (SELECT * FROM b) x ON true CROSS JOIN c", "A B C"), ("SELECT f(a, b) FROM t GROUP BY x, y ORDER BY u, v", "T"), ("SELECT * FROM a UNION ALL SELECT * FROM b EXCEPT SELECT * FROM c", "A B C"), ("SELECT * FROM a; WITH b AS (SELECT 1) SELECT * FROM b; SELECT * FROM b", "A B"),
    ("INSERT INTO t SELECT * FROM s", "S"), ("MERGE INTO t USING s ON t.i = s.i WHEN MATCHED THEN UPDATE SET x = 1", ""), ("SELECT * FROM a JOIN b ON a.x = b.x, c", "A B C"), ("CREATE VIEW v AS SELECT * FROM a", "A"), ("SELECT * FROM a WHERE x = 'open FROM b", "A"), ("SELECT * FROM ((a JOIN b ON true) JOIN c ON true)", "A B C"),
]


@pytest.mark.parametrize("sql, want", STATEMENTS)
def test_tables_that_statements_read(sql, want):
    assert references.tables_read(sql) == set(re.findall(r"MY TABLE|\S+", want))


def test_references_of_a_log(spark):
    log = spark.createDataFrame([(1, "SELECT * FROM a, a"), (1, "SELECT * FROM a"), (2, None), (3, "")], "k int, sql string")
    assert [tuple(r) for r in graph.extract_refs(log, "sql", "k").collect()] == [(1, "A")]


@pytest.mark.parametrize("cuts", [(90,), (10, 11, 50, 90), (45, 90)])
def test_history_by_batches_in_any_order(spark, tmp_path, cuts):
    import random

    rows = [(None if i % 19 == 4 else i % 5, (i * 13) % 23, "xyz"[i % 7 % 3], i % 4) for i in range(90)]
    random.Random(len(cuts)).shuffle(rows)
    frame = lambda some: spark.createDataFrame(some, "id long, at int, state string, other int")
    history = HistoryStore(spark, f"{tmp_path}/h", frame([]).schema, ["id"], "at", ["state"], 3)
    assert history.latest() is None
    for n, (a, b) in enumerate(zip((0, *cuts), cuts)):
        history.apply(frame(rows[a:b]), n)
        if n == 1:
            history.apply(frame(rows[a:b]), n)  # a replay
    history.apply(frame(rows[:20]), len(cuts))  # what is known already
    want = cdc.scd2(frame(rows).distinct(), ["id"], "at", ["state"], ["state", "other"])
    assert sorted(map(str, history.latest().collect())) == sorted(map(str, want.collect()))


def test_keys_of_several_columns(spark):
    rows = [(i // 4, i % 4, "x", i if i else None, i // 2) for i in range(40)]
    df = spark.createDataFrame(rows, "a int, b int, c string, `d.e` int, f int")
    assert quality.key_sets(df) == [("a", "b"), ("b", "f")]
    assert quality.key_sets(df.filter("`d.e` is not null")) == [("d.e",), ("a", "b"), ("b", "f")]
    assert quality.key_sets(df.unionByName(df)) == [] == quality.key_sets(df.limit(0))
    assert quality.key_sets(df.drop("d.e", "f"), 1) == []
    three = spark.createDataFrame([(i // 9, i // 3 % 3, i % 3) for i in range(27)], "a int, b int, c int")
    assert quality.key_sets(three) == [] and quality.key_sets(three, 3) == [("a", "b", "c")]


def test_bounded_sample(spark):
    df = spark.range(500)
    got = quality.sample_rows(df, 100)
    assert got.count() == 100 and got.join(df, "id", "left_anti").count() == 0
    assert quality.sample_rows(df.limit(3)).count() == 3


def test_a_second_run_of_insights_is_suppressed_by_the_first(spark, seed):
    c, o, *_ = seed
    c360 = gold.customer_360_recency(c, o, "2024-10-20")
    none = spark.createDataFrame([], "customer_id long, insight_type string, generated_at timestamp_ntz")
    first = metrics.generate_insights(c360, none, "2024-10-20 08:00:00")
    rows = first.collect()
    assert rows and len({r.insight_id for r in rows}) == len(rows)
    assert {(r.generated_by, r.generated_at, r.synced_to_postgres, r.actioned) for r in rows} == {("insight_rules", datetime.datetime(2024, 10, 20, 8), False, False)}
    assert sorted(map(str, metrics.generate_insights(c360, none, "2024-10-20 08:00:00").collect())) == sorted(map(str, rows))
    assert metrics.generate_insights(c360, first, "2024-10-26 08:00:00").count() == 0
    again = metrics.generate_insights(c360, first, "2024-10-27 08:00:00").collect()
    assert {r.customer_id for r in again} == {r.customer_id for r in rows if r.insight_type == metrics.CHURN}


def test_a_hop_moves_no_edges(spark):
    edges = spark.createDataFrame([(str(i % 500), str(i * 7 % 501)) for i in range(3000)] + [(None, "1"), ("1", None)], "source_node_id string, target_node_id string")
    index = graph.edge_index(edges, buckets=4)
    assert index.count() == len({(i % 500, i * 7 % 501) for i in range(3000)})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = lambda steps: spark.range(50).select(F.col("id").cast("string").alias("_from")).join(steps, "_from")._jdf.queryExecution().executedPlan().toString()
        plan = shown(index)
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert "SelectedBucketsCount: 1 out of 4" in shown(index.filter(F.col("_from").isin(["7"])))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(graph.lineage_closure(edges, ["3"], index=index).collect()) == sorted(graph.lineage_closure(edges, ["3"]).collect())


def reached(edges):
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
        after.setdefault(b, set())
    out = {}
    for start in after:
        seen, todo = set(), [start]
        while todo:
            todo += (fresh := after[todo.pop()] - seen)
            seen |= fresh
        out[start] = len(seen - {start})
    return out


def test_impact_of_all_nodes(spark):
    rng = random.Random(5)
    pairs = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(70)] + [("x", "y"), ("y", "x"), ("z", "z"), ("x", "y")]
    edges = spark.createDataFrame(pairs + [(None, "q")], "source_node_id string, target_node_id string")
    want = reached(pairs)
    got = {r.node_id: r for r in graph.impact_of_all(edges).collect()}
    assert {k: r.downstream for k, r in got.items()} == want and all(r.exact for r in got.values())
    assert {r.warning for r in got.values()} == {"HIGH_IMPACT" if n > 5 else "HAS_DEPENDENTS" if n else "NONE" for n in want.values()}
    # beyond the bound sketches answer, and a chain shows that they go all the way
    some = {r.node_id: r for r in graph.impact_of_all(edges, exact_most=3).collect()}
    assert all(abs(r.downstream - want[k]) <= (0 if r.exact else max(1, 0.1 * want[k])) for k, r in some.items()) and len({r.exact for r in some.values()}) == 2
    empty = graph.impact_of_all(edges.limit(0))
    assert empty.count() == 0 and empty.columns == ["node_id", "downstream", "exact", "warning"]


def test_impact_of_all_without_sketches_where_walks_are_few(spark, monkeypatch):
    def none(*args, **kwargs):
        raise AssertionError("no node needs a sketch")

    monkeypatch.setattr(graph, "downstream_sketches", none)
    # three layers, repeated edges and an edge to itself: walks end, and no set is large
    pairs = [(f"c{i}", f"o{i * 3 + j}") for i in range(20) for j in range(3)] + [(f"o{i}", f"p{(i * 7 + j) % 40}") for i in range(60) for j in range(4)] + [("c1", "o1"), ("c1", "c1"), ("lone", "lone")] * 2
    got = {r.node_id: r for r in graph.impact_of_all(spark.createDataFrame(pairs, "source_node_id string, target_node_id string")).collect()}
    assert {k: r.downstream for k, r in got.items()} == reached(pairs) and all(r.exact for r in got.values())


def test_impact_of_all_beyond_the_walks_and_the_bound(spark):
    # more paths than nodes, a chain longer than the hops that walks are counted for, a cycle, and a set beyond the bound
    pairs = [(f"a{i}", f"a{j}") for i in range(12) for j in range(i + 1, 12)] + [(f"b{i}", f"b{i + 1}") for i in range(20)] + [("x", "y"), ("y", "x"), ("y", "a9")] + [("hub", f"z{i}") for i in range(60)] + [("up", "hub"), ("z0", "b18")]
    want = reached(pairs)
    got = {r.node_id: r for r in graph.impact_of_all(spark.createDataFrame(pairs, "source_node_id string, target_node_id string"), exact_most=30).collect()}
    assert got.keys() == want.keys() and all(r.downstream == want[k] for k, r in got.items() if r.exact)
    assert {k for k, r in got.items() if not r.exact} == {"hub", "up"} and all(abs(got[k].downstream - want[k]) <= 3 for k in ("hub", "up"))
    two = {r.node_id: r.downstream for r in graph.impact_of_all(spark.createDataFrame(pairs, "source_node_id string, target_node_id string"), max_hops=2).collect()}
    assert two["b0"] == 2 and two["x"] == 2 and two["a0"] == 11 and two["up"] == 61 and two["b20"] == 0


def test_payloads_packed_on_the_way_are_parsed_once(spark):
    rows = spark.createDataFrame([(1, 5, "a", False), (None, 6, "b", False), (2, None, "c", False)], "item_id long, quantity int, _updated_at string, _deleted boolean").withColumn("_updated_at", F.lit("2001-09-01 08:00:00").cast("timestamp_ntz"))
    got = silver.silver_items(landing.pack_bronze(rows, "items"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert sorted((r.item_id, r.quantity) for r in got.collect()) == [(1, 5), (2, None)]


def test_database_parts_of_like_size(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    # most keys lie close together, a few very far away
    rows = spark.range(4000).select(F.when(F.col("id") < 3900, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("k"), F.lit("v").alias("t"))
    rows.write.format("jdbc").options(url=url, dbtable="skewed").save()
    size = lambda df: [r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(size(landing.read_jdbc(spark, url, "skewed", "k", parts=8))) > 3000
    even = landing.read_jdbc_even(spark, url, "skewed", "k", parts=8)
    assert len(size(even)) == 8 and max(size(even)) < 2 * min(size(even)) and even.exceptAll(rows).count() == 0 == rows.exceptAll(even).count()
    # a third of the rows with one key, and rows without any
    hot = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 100 != 1, F.col("id")).alias("k"))
    landing.write_back(hot, url, "hot")
    assert landing.read_jdbc_even(spark, url, "hot", "k", parts=8).exceptAll(hot).count() == 0 and landing.read_jdbc_even(spark, url, "hot", "k", parts=8).count() == 900
    landing.write_back(hot.limit(0), url, "vacant")
    assert landing.read_jdbc_even(spark, url, "vacant", "k").count() == 0


def test_profiles_by_sketches(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("a.b"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("half"), F.lit(None).cast("string").alias("none"))
    exact = {r.field: r for r in quality.field_profile(df, df.columns).collect()}
    rough = quality.field_profile(df, df.columns, 0.02)
    for r in rough.collect():
        e = exact[r.field]
        assert (r.total_rows, r.null_count) == (e.total_rows, e.null_count) and abs(r.cardinality - e.cardinality) <= 0.12 * e.cardinality
    assert "hashpartitioning" not in rough._jdf.queryExecution().executedPlan().toString()
    assert quality.key_candidates(df).first() == ("id", 1) and quality.key_candidates(df.limit(0)).first() == (None, 0)
    assert quality.key_candidates(df.unionByName(df.limit(1))).first() == (None, 0)
