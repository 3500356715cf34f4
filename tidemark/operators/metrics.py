"""Metric views compiled to one aggregation, canned questions, and insight tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import suppress_recent

AGGREGATES = {"sum": F.sum, "avg": F.avg, "count": F.count, "count_distinct": F.countDistinct, "min": F.min, "max": F.max}


@dataclass
class MetricView:
    """Dimensions and time dimensions (name to SQL expression) and measures (name to aggregate and expression) over one DataFrame."""

    source: DataFrame
    dimensions: dict[str, str] = field(default_factory=dict)
    time_dimensions: dict[str, str] = field(default_factory=dict)
    measures: dict[str, tuple[str, str]] = field(default_factory=dict)

    @classmethod
    def propose(cls, df: DataFrame) -> "MetricView":
        """From the schema: dates and times are time dimensions, numbers that identify nothing are measures (averaged if the name says rate, price, pct or avg), the rest dimensions."""
        view = cls(df)
        for f in df.schema.fields:
            low = f.name.lower()
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                view.time_dimensions[f.name] = f.name
            elif isinstance(f.dataType, T.NumericType) and not low.endswith(("_id", "key")):
                view.measures[f.name] = ("avg" if any(x in low for x in ("rate", "price", "pct", "percent", "avg")) else "sum", f.name)
            else:
                view.dimensions[f.name] = f.name
        return view

    def describe(self) -> list[tuple[str, str, str]]:
        return sorted([(n, "dimension", "") for n in self.dimensions] + [(n, "time_dimension", "") for n in self.time_dimensions] + [(n, "measure", a) for n, (a, _) in self.measures.items()])

    def query(self, dims: list[str], measures: list[str], where: str | None = None, order: list | None = None, limit: int | None = None) -> DataFrame:
        """One groupBy; unknown names raise."""
        known = self.dimensions | self.time_dimensions
        rows = self.source.filter(where) if where else self.source
        keys = [F.expr(known[d]).alias(d) for d in dims]
        sums = [AGGREGATES[self.measures[m][0]](F.expr(self.measures[m][1])).alias(m) for m in measures]
        out = rows.groupBy(*keys).agg(*sums)
        if order:
            out = out.orderBy(*order)
        return out.limit(limit) if limit else out


def sales_view(orders: DataFrame, customers: DataFrame) -> MetricView:
    """Orders with the customer's segment and tier."""
    wide = orders.join(customers.select("customer_id", "segment", "loyalty_tier"), "customer_id")
    return MetricView(
        wide,
        {"segment": "segment", "loyalty_tier": "loyalty_tier", "status": "status"},
        {"month": "trunc(order_date, 'month')"},
        {"orders": ("count", "order_id"), "revenue": ("sum", "total_amount"), "aov": ("avg", "CAST(total_amount AS DOUBLE)"), "customers": ("count_distinct", "customer_id")},
    )


def question(name: str, sales: MetricView, c360: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Canned questions: aov_by_segment, trend, at_risk, best_sellers, enterprise_at_risk, open_tickets."""
    if name == "aov_by_segment":
        return sales.query(["segment"], ["orders", "aov"])
    if name == "trend":
        return sales.query(["month", "segment"], ["orders", "revenue"])
    if name == "at_risk":
        return c360.filter("engagement_status = 'DORMANT' and lifetime_value > 0").select("customer_id", "segment", "lifetime_value", "recency_days")
    if name == "best_sellers":
        return products.filter("is_active").orderBy(F.col("total_revenue").desc_nulls_last(), "product_id").select("product_id", "product_name", "category", "units_sold", "total_revenue", "unique_customers").limit(10)
    if name == "enterprise_at_risk":
        return c360.filter("segment = 'ENTERPRISE' and engagement_status = 'AT_RISK'").orderBy(F.col("lifetime_value").desc_nulls_last(), "customer_id").select("customer_id", "full_name", "company_name", "lifetime_value", "days_since_last_order", "engagement_status")
    if name == "open_tickets":
        return c360.filter("open_tickets > 0").select("customer_id", "open_tickets")
    raise KeyError(name)


# Insight types and texts.
CHURN, UPSELL = "CHURN_RISK", "UPSELL_OPPORTUNITY"
CHURN_TEXTS = ("URGENT: Schedule executive call - high value customer at risk", "Send personalized re-engagement email with special offer", "Monitor - proactive check-in recommended")
UPSELL_TEXT = "Customer shows growth potential - recommend premium tier upgrade"


def churn_insights(c360: DataFrame, log: DataFrame, as_of: str, value_cut: float = 50_000, quiet: int = 7) -> DataFrame:
    """Customers at risk or cooling: severity by days without an order and value, a text, and the figures as JSON; none with a churn insight in the last `quiet` days."""
    days, value = F.col("days_since_last_order"), F.col("lifetime_value")
    severity = F.when((days > 90) & (value > value_cut), "HIGH").when(days > 60, "MEDIUM").otherwise("LOW")
    text = F.when(days > 90, CHURN_TEXTS[0]).when(days > 60, CHURN_TEXTS[1]).otherwise(CHURN_TEXTS[2])
    data = F.to_json(F.struct(days.alias("days_inactive"), value.alias("lifetime_value"), "segment"))
    found = c360.filter(F.col("engagement_status").isin("AT_RISK", "COOLING")).select("customer_id", F.lit(CHURN).alias("insight_type"), severity.alias("insight_severity"), text.alias("recommendation"), data.alias("supporting_data"))
    return suppress_recent(found, log.filter(F.col("insight_type") == CHURN), "customer_id", "generated_at", quiet, as_of)


def _in_cents(total: Column, n: Column) -> Column:
    """Total by number to whole cents, half up, in integers: a double between two cents can lie on the wrong side of the half. Null for no rows."""
    cents = (total * 100).cast("long") * 2 + n
    return (F.call_function("div", cents, F.nullif(n * 2, F.lit(0))).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def upsell_insights(c360: DataFrame, log: DataFrame, as_of: str, tier: str = "SMB", least_orders: int = 3, quiet: int = 30) -> DataFrame:
    """Hot customers of the lowest revenue tier with enough orders; none with an upsell insight in the last `quiet` days."""
    found = c360.filter((F.col("engagement_status") == "HOT") & (F.col("revenue_tier") == tier) & (F.col("total_orders") >= least_orders))
    data = F.to_json(F.struct(F.col("revenue_tier").alias("current_tier"), F.col("total_orders").alias("order_frequency"), _in_cents(F.col("lifetime_value"), F.col("total_orders")).alias("avg_order_value")))
    out = found.select("customer_id", F.lit(UPSELL).alias("insight_type"), F.lit("MEDIUM").alias("insight_severity"), F.lit(UPSELL_TEXT).alias("recommendation"), data.alias("supporting_data"))
    return suppress_recent(out, log.filter(F.col("insight_type") == UPSELL), "customer_id", "generated_at", quiet, as_of)


def insight_rows(insights: DataFrame, at: str, by: str = "insight_rules") -> DataFrame:
    """Insights as they are stored: an id of their own, who made them and when, not written back and not acted on yet.

    The id follows from customer, kind and time, so that a run that is repeated after a failure gives the same rows.
    """
    made = F.lit(at).cast("timestamp_ntz")
    name = F.sha2(F.concat_ws("|", F.col("insight_type"), F.col("customer_id").cast("string"), F.lit(at)), 256)
    return insights.select(
        name.alias("insight_id"), "customer_id", "insight_type", "insight_severity", "recommendation", "supporting_data", F.lit(by).alias("generated_by"), made.alias("generated_at"),
        F.lit(False).alias("synced_to_postgres"), F.lit(False).alias("actioned"))


def generate_insights(c360: DataFrame, log: DataFrame, at: str, value_cut: float = 50_000) -> DataFrame:
    """Both kinds of insights of one run at a time, as stored rows; what the log (stored rows of earlier runs) suppresses is left out. Append the result to the log."""
    day = at[:10]
    return insight_rows(churn_insights(c360, log, day, value_cut).unionByName(upsell_insights(c360, log, day)), at)
