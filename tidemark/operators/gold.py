"""Gold aggregates: customers, products, orders, support, machine-learning features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeutil import as_date, day_diff, month_diff, ratio
from tidemark.operators.silver import active_only, full_name, not_deleted, product_margin, resolution_hours, revenue_tier

Cuts = tuple[float, float, float]
CUTS: Cuts = (100_000, 50_000, 10_000)


def value_tier(value: Column, cuts: Cuts = CUTS) -> Column:
    return F.when(value >= cuts[0], "PLATINUM").when(value >= cuts[1], "GOLD").when(value >= cuts[2], "SILVER").otherwise("BRONZE")


def engagement(days: Column) -> Column:
    """By days since the last order, closest first; no order is DORMANT."""
    return F.when(days <= 7, "HOT").when(days <= 30, "ACTIVE").when(days <= 90, "COOLING").otherwise("DORMANT")


def engagement_recency(days: Column) -> Column:
    """By days since the last order, farthest first; no order falls through to HOT."""
    return F.when(days > 90, "AT_RISK").when(days > 60, "COOLING").when(days > 30, "ACTIVE").otherwise("HOT")


def live(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    """Rows whose flag is false; a null flag goes. A table without the flag has no deleted rows."""
    return not_deleted(df, flag, strict=True) if flag in df.columns else df


def _mean(total: Column, n: Column) -> Column:
    """Total by number as a double; null for no rows."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def _order_arm(orders: DataFrame) -> DataFrame:
    arm = orders.groupBy("customer_id").agg(F.count("*").alias("total_orders"), F.sum("total_amount").alias("lifetime_value"), F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
    return arm.withColumn("avg_order_value", _mean(F.col("lifetime_value"), F.col("total_orders")))


def _ticket_arm(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("customer_id").agg(F.count("*").alias("total_tickets"), F.count_if(F.col("status") == "open").alias("open_tickets"), F.avg(resolution_hours("created_at", "resolved_at")).alias("avg_resolution_hours"))


_COUNTS = ("total_orders", "total_tickets", "open_tickets")
#: Value columns of every form; null for a customer without orders.
_VALUE = ("lifetime_value", "avg_order_value", "first_order_date", "last_order_date")


def _with_arms(customers: DataFrame, orders: DataFrame, tickets: DataFrame | None, as_of: str) -> DataFrame:
    """Customers with the sums of their orders and tickets, each arm aggregated before the join; counts are 0 where there is none."""
    out = customers.join(_order_arm(orders), "customer_id", "left")
    if tickets is not None:
        out = out.join(_ticket_arm(tickets), "customer_id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in _COUNTS if c in out.columns})
    return out.withColumn("recency_days", day_diff("last_order_date", as_date(as_of))).withColumn("lifetime_value", F.col("lifetime_value").cast("decimal(18,2)"))


def customer_360(customers: DataFrame, orders: DataFrame, tickets: DataFrame, as_of: str, cuts: Cuts = CUTS, fanout: bool = False) -> DataFrame:
    """Orders, value, recency, value tier, engagement and tickets of each customer that is not deleted.

    Each arm is aggregated before the join. fanout joins first, as the original does: amounts and open tickets then count once per pair.
    """
    customers = live(customers)
    if fanout:
        t = tickets.select("customer_id", "ticket_id", F.col("status").alias("ticket_status"))
        wide = customers.select("customer_id").join(orders.drop("status"), "customer_id", "left").join(t, "customer_id", "left")
        arm = wide.groupBy("customer_id").agg(
            F.countDistinct("order_id").alias("total_orders"), F.sum("total_amount").cast("decimal(18,2)").alias("lifetime_value"), _mean(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value"), F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"), F.countDistinct("ticket_id").alias("total_tickets"), F.count_if(F.col("ticket_status") == "open").alias("open_tickets"))
        out = customers.join(arm, "customer_id", "left").withColumn("recency_days", day_diff("last_order_date", as_date(as_of)))
    else:
        out = _with_arms(customers, orders, tickets, as_of)
    return out.select(
        "customer_id", "first_name", "last_name", full_name("first_name", "last_name").alias("full_name"), "email", "phone", "company_name", "segment", "loyalty_tier", "annual_revenue", F.col("created_at").alias("customer_since"), "total_orders", *_VALUE, "recency_days",
        F.col("total_orders").alias("frequency"), F.col("lifetime_value").alias("monetary_total"), value_tier(F.col("lifetime_value"), cuts).alias("revenue_tier"), engagement(F.col("recency_days")).alias("engagement_status"), "total_tickets", "open_tickets")


def _active_360(customers: DataFrame, orders: DataFrame, tickets: DataFrame | None, as_of: str, extra: list, more: list, null_safe: bool = True) -> DataFrame:
    out = _with_arms(active_only(customers), orders, tickets, as_of)
    return out.select(
        "customer_id", full_name("first_name", "last_name", null_safe).alias("full_name"), "email", "company_name", "segment", *extra, revenue_tier("annual_revenue").alias("revenue_tier"), "annual_revenue", "is_active", F.col("created_at").alias("customer_since"), "total_orders", *_VALUE,
        F.col("recency_days").alias("days_since_last_order"), "recency_days", F.col("total_orders").alias("frequency_orders"), F.col("lifetime_value").alias("monetary_total"), *more, engagement_recency(F.col("recency_days")).alias("engagement_status"), F.col("updated_at").alias("last_updated"))


def customer_360_recency(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """Active customers with their orders, the tier of their annual revenue, and recency read from its far end."""
    return _active_360(customers, orders, None, as_of, [], [])


def customer_360_service(customers: DataFrame, orders: DataFrame, tickets: DataFrame, as_of: str) -> DataFrame:
    """The same with loyalty tier, tickets and the average hours to resolution; a name of which a part is missing is null."""
    return _active_360(customers, orders, tickets, as_of, ["loyalty_tier"], ["total_tickets", "avg_resolution_hours"], null_safe=False)


def sales_summary(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """By day, segment and tier of the annual revenue."""
    both = orders.join(customers.select("customer_id", "segment", revenue_tier("annual_revenue").alias("revenue_tier")), "customer_id")
    sums = both.groupBy("order_date", "segment", "revenue_tier").agg(F.countDistinct("order_id").alias("order_count"), F.countDistinct("customer_id").alias("unique_customers"), F.sum("total_amount").cast("decimal(18,2)").alias("total_revenue"), F.count("total_amount").alias("_n"))
    return sums.withColumn("avg_order_value", _mean(F.col("total_revenue"), F.col("_n"))).drop("_n")


def _item_arm(items: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Sums per product. Distinct customers come from distinct pairs first, so that one pass needs no expansion."""
    sums = items.groupBy("product_id").agg(F.countDistinct("order_id").alias("orders"), F.count("*").alias("lines"), F.sum("quantity").alias("units_sold"), F.sum("line_total").alias("revenue"))
    if orders is None:
        return sums
    pairs = items.join(orders.select("order_id", "customer_id"), "order_id").select("product_id", "customer_id").distinct()
    return sums.join(pairs.groupBy("product_id").agg(F.count("customer_id").alias("unique_customers")), "product_id", "left")


def product_performance(products: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Margin on the list price, orders, units, revenue and distinct customers of each product that is not deleted; sums are null without a line."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    out = product_margin(live(products), "price").join(_item_arm(items, orders), "product_id", "left")
    return out.select(
        "product_id", "product_name", "category", F.col("price").alias("list_price"), F.col("cost").alias("cost_price"), "margin", F.col("margin_pct").alias("margin_percent"), "sku", F.col("active").alias("is_active"),
        zero("orders").alias("orders_count"), F.col("units_sold").cast("long").alias("units_sold"), F.col("revenue").cast("decimal(18,2)").alias("total_revenue"), zero("unique_customers").alias("unique_customers"))


def product_performance_basic(products: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """All products, with average units per order line."""
    out = products.join(_item_arm(items, orders), "product_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "product_id", "sku", "product_name", "category", F.col("price").alias("list_price"), F.col("active").alias("is_active"), zero("orders").alias("orders_containing"), F.col("units_sold").cast("long").alias("total_units_sold"),
        F.col("revenue").cast("decimal(18,2)").alias("total_revenue"), _mean(F.col("units_sold"), F.col("lines")).alias("avg_units_per_order"), zero("unique_customers").alias("unique_customers"), F.col("updated_at").alias("last_updated"))


def category_metrics(products: DataFrame, items: DataFrame) -> DataFrame:
    """Per category of products not deleted: products, active ones, average prices and costs (each product as often as it has lines), units, revenue, selling price, orders."""
    products = live(products)
    arm = items.groupBy("product_id").agg(F.count("*").alias("_lines"), F.sum("quantity").alias("_units"), F.sum("line_total").alias("_revenue"))
    each = products.join(arm, "product_id", "left").withColumn("_weight", F.coalesce("_lines", F.lit(1)))
    weighted = lambda c: _mean(F.sum(c * F.col("_weight")), F.sum(F.when(c.isNotNull(), F.col("_weight"))))
    price, cost = F.col("price"), F.col("cost")
    sums = each.groupBy("category").agg(
        F.count("product_id").alias("total_products"), F.count_if("active").alias("active_products"), weighted(price).alias("avg_list_price"), weighted(cost).alias("avg_cost_price"), weighted(price - cost).alias("avg_margin"),
        F.sum("_units").cast("long").alias("total_units_sold"), F.sum("_revenue").cast("decimal(18,2)").alias("total_revenue"), _mean(F.sum("_revenue"), F.sum("_units")).alias("avg_selling_price"))
    pairs = items.join(products.select("product_id", "category"), "product_id").select("category", "order_id").distinct()
    return sums.join(pairs.groupBy("category").agg(F.count("order_id").alias("orders_with_category")), "category", "left").withColumn("orders_with_category", F.coalesce("orders_with_category", F.lit(0)))


def order_summary(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """By month and segment, with the orders of each status side by side."""
    both = live(orders).join(customers.select("customer_id", F.col("segment").alias("customer_segment")), "customer_id").withColumn("order_month", F.trunc("order_date", "month"))
    of = lambda s: F.count_if(F.col("status") == s).alias(f"{s}_orders")
    sums = both.groupBy("order_month", "customer_segment").agg(F.countDistinct("order_id").alias("order_count"), F.countDistinct("customer_id").alias("unique_customers"), F.sum("total_amount").cast("decimal(18,2)").alias("total_revenue"), F.count("total_amount").alias("_n"), *(of(s) for s in ("completed", "pending", "processing")))
    return sums.withColumn("avg_order_value", _mean(F.col("total_revenue"), F.col("_n"))).drop("_n")


def customer_metrics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """By segment and loyalty tier of customers not deleted, over orders aggregated per customer first."""
    arm = live(orders).groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("total_amount").alias("amount"))
    both = live(customers).join(arm, "customer_id", "left")
    return both.groupBy("segment", "loyalty_tier").agg(
        F.countDistinct("customer_id").alias("customer_count"), F.sum(F.coalesce("n", F.lit(0))).alias("total_orders"), F.sum(F.coalesce("amount", F.lit(0))).cast("decimal(18,2)").alias("total_revenue"), F.avg(F.coalesce("n", F.lit(0))).alias("avg_orders_per_customer"))


def ml_customer_features(customers: DataFrame, c360: DataFrame) -> DataFrame:
    """Metrics with nulls filled, segment and tier as ordinals, churn label (no order within 90 days, or none at all), of customers not deleted."""
    segment = F.when(F.col("segment") == "ENTERPRISE", 3).when(F.col("segment") == "MID-MARKET", 2).otherwise(1)
    tier = F.when(F.col("revenue_tier") == "PLATINUM", 4).when(F.col("revenue_tier") == "GOLD", 3).when(F.col("revenue_tier") == "SILVER", 2).otherwise(1)
    both = live(customers).select("customer_id", "segment", "loyalty_tier").join(c360.drop("segment", "loyalty_tier"), "customer_id", "left")
    zero = lambda c, t: F.coalesce(c, F.lit(0)).cast(t).alias(c)
    return both.select(
        "customer_id", "segment", "loyalty_tier", zero("total_orders", "long"), zero("lifetime_value", "decimal(18,2)"), zero("avg_order_value", "double"), F.coalesce("recency_days", F.lit(999)).alias("recency_days"), zero("total_tickets", "long"),
        segment.alias("segment_encoded"), tier.alias("tier_encoded"), F.when(F.col("engagement_status") == "DORMANT", 1).otherwise(0).alias("is_churned"))


def sales_features(customers: DataFrame, orders: DataFrame, items: DataFrame, as_of: str, fanout: bool = False) -> DataFrame:
    """Tenure, recency, frequency, spend, spread, product diversity, engagement score and churn flag of active customers, with or without orders.

    fanout takes spend per order line, as a join of orders and lines would. The score is null without an order, and where the last order is today's or yesterday's.
    """
    pairs = orders.select("customer_id", "order_id").join(items.select("order_id", "product_id"), "order_id", "left" if fanout else "inner")
    products = pairs.filter("product_id is not null").select("customer_id", "product_id").distinct().groupBy("customer_id").agg(F.count("*").alias("unique_products_purchased"))
    spend = pairs.select("customer_id", "order_id").join(orders.select("order_id", "order_date", "total_amount"), "order_id") if fanout else orders
    amount = F.col("total_amount").cast("double")
    arm = spend.groupBy("customer_id").agg((F.countDistinct("order_id") if fanout else F.count("*")).alias("order_count"), F.sum("total_amount").cast("decimal(18,2)").alias("total_spend"), F.count("total_amount").alias("_n"), F.max("total_amount").alias("max_order_value"), F.stddev_samp(amount).alias("order_value_stddev"), F.min("order_date").alias("_first"), F.max("order_date").alias("_last"))
    both = active_only(customers).join(arm, "customer_id", "left").join(products, "customer_id", "left")
    recency, months, n = day_diff("_last", as_date(as_of)), month_diff("_first", as_date(as_of)), F.coalesce("order_count", F.lit(0))
    spent = F.nullif(F.col("total_spend").cast("double"), F.lit(0.0))
    score = F.try_divide(F.lit(1.0), F.nullif(recency, F.lit(1)).cast("double")) * 100 + n * 10 + F.log10(spent + 1) * 5
    return both.select(
        "customer_id", "segment", revenue_tier("annual_revenue").alias("revenue_tier"), "annual_revenue", day_diff("created_at", as_date(as_of)).alias("customer_tenure_days"), recency.alias("recency_days"), n.alias("order_count"), F.try_divide(n.cast("double"), F.nullif(months, F.lit(0)).cast("double")).alias("orders_per_month"),
        "total_spend", _mean(F.col("total_spend"), F.col("_n")).alias("avg_order_value"), "max_order_value", "order_value_stddev", F.coalesce("unique_products_purchased", F.lit(0)).alias("unique_products_purchased"), score.alias("engagement_score"), F.when(recency > 90, 1).otherwise(0).alias("churn_flag"))


#: Columns of the feature view: categories, numbers, target.
FEATURES = ("customer_id", "segment", "revenue_tier", "engagement_status", "annual_revenue", "customer_tenure_days", "recency_days", "order_count", "orders_per_month", "total_spend", "avg_order_value", "max_order_value", "order_value_stddev", "unique_products_purchased", "engagement_score", "churn_flag")


def ml_feature_view(features: DataFrame, c360: DataFrame) -> DataFrame:
    """All features, with the engagement status that only the 360 holds."""
    return features.join(c360.select("customer_id", "engagement_status"), "customer_id", "left").select(*FEATURES)


def support_metrics(tickets: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """By priority and segment: volume, open, hours to resolution and to the first response, and breaches: open for more than 4 hours (high) or 24 hours (medium),
    up to the resolution or, without one, up to as_of (a time)."""
    open_for = F.coalesce("_hours", resolution_hours("created_at", F.lit(as_of).cast("timestamp_ntz")))
    late = ((F.upper("priority") == "HIGH") & (open_for > 4)) | ((F.upper("priority") == "MEDIUM") & (open_for > 24))
    both = tickets.withColumn("_hours", resolution_hours("created_at", "resolved_at")).withColumn("_response", resolution_hours("created_at", "first_response_at"))
    both = both.join(customers.select("customer_id", "segment"), "customer_id", "left")
    return both.groupBy("priority", "segment").agg(
        F.count("*").alias("tickets"), F.count_if(F.col("status") == "open").alias("open_tickets"), F.avg("_hours").alias("avg_resolution_hours"), F.avg("_response").alias("avg_first_response_hours"), F.count_if(F.coalesce(late, F.lit(False))).alias("sla_breaches"))


def product_and_category(products: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue and units of each product, with a row for each category and one for all."""
    both = products.select("product_id", "category").join(_item_arm(items), "product_id", "left")
    rolled = both.rollup("category", "product_id").agg(F.coalesce(F.sum("units_sold"), F.lit(0)).alias("units_sold"), F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(18,2)").alias("revenue"), F.grouping_id().alias("_g"))
    level = F.when(F.col("_g") == 0, "product").when(F.col("_g") == 1, "category").otherwise("all")
    return rolled.select("category", "product_id", level.alias("level"), "units_sold", "revenue")


def pipeline_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, long form."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def sync_status(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts of two sides by table: share replicated, rows behind."""
    both = source.withColumnRenamed("row_count", "source_rows").join(target.withColumnRenamed("row_count", "target_rows"), "table_name", "left")
    there = F.coalesce("target_rows", F.lit(0))
    return both.select("table_name", "source_rows", there.alias("target_rows"), ratio(there * 100, F.col("source_rows"), 2).alias("sync_pct"), (F.col("source_rows") - there).alias("rows_behind"))


def status_counts(log: DataFrame, status: str = "status") -> DataFrame:
    return log.groupBy(status).agg(F.count("*").alias("runs"))


def run_totals(log: DataFrame, status: str = "status") -> DataFrame:
    of = lambda s: F.count_if(F.col(status) == s).alias(s)
    return log.agg(F.count("*").alias("total"), *(of(s) for s in ("completed", "pending", "processing")))


def ordered_listagg(df: DataFrame, keys: list[str], value: str, order: list[str], sep: str = ", ") -> DataFrame:
    """Values of each group as one text, in order."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct(*order, F.col(value).cast("string").alias("_v")))), lambda s: s["_v"])
    return df.groupBy(*keys).agg(F.array_join(listed, sep).alias("listed"))


def collect_objects(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Objects of each group as a JSON array, sorted by the fields."""
    return df.groupBy(*keys).agg(F.to_json(F.sort_array(F.collect_list(F.struct(*fields)))).alias("objects"))


def value_by(df: DataFrame, dim: str, measure: str) -> DataFrame:
    return df.groupBy(dim).agg(F.sum(measure).cast("decimal(18,2)").alias("value"))
