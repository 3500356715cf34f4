"""Silver rules: typing of payloads, derived columns, filters, child tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeutil import as_date, day_diff, hour_diff
from tidemark.operators.cdc import apply_changelog, latest_by_key

Spec = list[tuple[str, str, str]]


def flatten_and_type(df: DataFrame, spec: Spec, payload: str = "payload", keep: list[str] = (), required: list[str] = ()) -> DataFrame:
    """Payload paths to typed columns (name, path, type), in one projection; a value that does not fit is null. Rows without a required column give none.

    Decimals are read as text first: a variant drops trailing zeros, and whole hundreds would come back with another scale.
    """

    def one(name: str, path: str, kind: str) -> Column:
        if kind.startswith("decimal"):
            return F.try_variant_get(F.col(payload), path, "string").try_cast(kind).alias(name)
        return F.try_variant_get(F.col(payload), path, kind).alias(name)

    if not required:
        return df.select(*keep, *(one(*field) for field in spec))
    # a plain filter sinks below the payload; one that is packed or parsed on the way would then be made twice. The outcome of a generator stays where it is
    rows = F.array(F.struct(*keep, *(one(*field) for field in spec)))
    return require_keys(df.select(F.inline(rows)), list(required))


def safe_cast(col: Column | str, kind: str) -> Column:
    """A cast that gives null where the value does not fit."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(kind)


def fill_defaults(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def full_name(first: str, last: str, null_safe: bool = False) -> Column:
    """Both names with a space; null if one is, or with nothing in place of the missing one (the space stays)."""
    if null_safe:
        return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
    return F.concat(F.col(first), F.lit(" "), F.col(last))


# Company-name patterns and segments, first match wins.
SEGMENT_PATTERNS = (("%enterprise%", "ENTERPRISE"), ("%corp%", "ENTERPRISE"), ("%startup%", "STARTUP"), ("%labs%", "STARTUP"))


def derive_segment(col: str, patterns=SEGMENT_PATTERNS, default: str = "MID-MARKET") -> Column:
    first = F.when(F.col(col).ilike(patterns[0][0]), patterns[0][1])
    return reduce(lambda c, p: c.when(F.col(col).ilike(p[0]), p[1]), patterns[1:], first).otherwise(default)


def revenue_tier(col: str, cuts: tuple[int, int] = (1_000_000, 100_000), names=("ENTERPRISE", "MID-MARKET", "SMB")) -> Column:
    return F.when(F.col(col) >= cuts[0], names[0]).when(F.col(col) >= cuts[1], names[1]).otherwise(names[2])


def order_calendar(df: DataFrame, as_of: str, day: str = "order_date") -> DataFrame:
    """order_month and days_since_order (day boundaries)."""
    return df.withColumn("order_month", F.trunc(F.col(day).cast("date"), "month")).withColumn("days_since_order", day_diff(day, as_date(as_of)))


def product_margin(df: DataFrame, basis: str = "cost", price: str = "price", cost: str = "cost") -> DataFrame:
    """margin and margin_pct. On cost: a missing cost counts as none in the margin, and the percentage is 0 without a positive cost. On price: both null without a cost, the percentage rounded to cents, 0 without a positive price."""
    if basis == "cost":
        pct = F.when(F.col(cost) > 0, F.round((F.col(price) - F.col(cost)) / F.col(cost) * 100, 4)).otherwise(F.lit(0))
        return df.withColumn("margin", F.col(price) - F.coalesce(F.col(cost), F.lit(0).cast(df.schema[cost].dataType))).withColumn("margin_pct", pct.cast("decimal(18,4)"))
    margin = F.col(price) - F.col(cost)
    return df.withColumn("margin", margin).withColumn("margin_pct", F.when(F.col(price) > 0, F.round(margin * 100 / F.col(price), 2)).otherwise(F.lit(0)).cast("decimal(18,2)"))


def line_totals(df: DataFrame) -> DataFrame:
    """gross_total, and net_total after the percentage discount (none counts as 0)."""
    gross = F.col("quantity") * F.col("unit_price")
    net = gross * (1 - F.coalesce(F.col("discount_percent"), F.lit(0)) / 100)
    return df.withColumn("gross_total", gross.cast("decimal(18,2)")).withColumn("net_total", F.round(net, 4).cast("decimal(18,4)"))


def resolution_hours(created: str, resolved: str) -> Column:
    """Hour boundaries between opening and resolution; null while open."""
    return hour_diff(created, resolved)


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, (F.col(k).isNotNull() for k in keys)))


def normalize_case(df: DataFrame, upper: list[str] = (), lower: list[str] = ()) -> DataFrame:
    return df.withColumns({c: F.upper(c) for c in upper} | {c: F.lower(c) for c in lower})


def flag_in(col: str, values: list) -> Column:
    return F.coalesce(F.col(col).isin(*values), F.lit(False))


def array_len(text: Column, path: str = "$") -> Column:
    """Size of a JSON array; null if there is none."""
    return F.json_array_length(text if path == "$" else F.get_json_object(text, path))


def explode_children(df: DataFrame, key: str, items: str, schema: str) -> DataFrame:
    """A JSON array of objects to a child table with the parent's key; empty and missing arrays give no rows."""
    return df.select(key, F.explode(F.from_json(F.col(items), f"array<struct<{schema}>>")).alias("_item")).select(key, "_item.*")


def not_deleted(df: DataFrame, deleted: str = "_deleted", strict: bool = False) -> DataFrame:
    """Rows not flagged; a null flag goes under strict, and stays otherwise."""
    return df.filter(~F.col(deleted)) if strict else df.filter(~F.coalesce(F.col(deleted), F.lit(False)))


def active_only(df: DataFrame, flag: str = "is_active") -> DataFrame:
    return df.filter(F.col(flag))


def _spec(**fields: str) -> Spec:
    """A field for each keyword, from the payload key of the same name."""
    return [(name, f"$.{name}", kind) for name, kind in fields.items()]


#: What every change row carries: its commit time, to the microsecond, and whether it deletes.
_CHANGE = {"_updated_at": "timestamp_ntz", "_deleted": "boolean"}
CUSTOMER = _spec(customer_id="long", first_name="string", last_name="string", email="string", phone="string", company_name="string", industry="string", annual_revenue="decimal(15,2)", created_at="timestamp_ntz", updated_at="timestamp_ntz", **_CHANGE)
ORDER = _spec(order_id="long", customer_id="long", order_date="timestamp_ntz", status="string", total_amount="decimal(12,2)", shipping_address="string", notes="string", **_CHANGE)
PRODUCT = _spec(product_id="long", product_name="string", category="string", price="decimal(10,2)", cost="decimal(10,2)", sku="string", active="boolean", created_at="timestamp_ntz", **_CHANGE)
ITEM = _spec(item_id="long", order_id="long", product_id="long", quantity="int", unit_price="decimal(10,2)", discount_percent="decimal(5,2)", **_CHANGE)
TICKET = _spec(ticket_id="long", customer_id="long", subject="string", description="string", priority="string", status="string", created_at="timestamp_ntz", resolved_at="timestamp_ntz", **_CHANGE)


def _current(bronze: DataFrame, spec: Spec, key: str, position: str | None = None) -> DataFrame:
    """Typed payloads, the latest of each key by commit time, without deleted ones; the time comes out as cdc_timestamp.

    Versions of one time: by the log position, a column of bronze, if given; then by the remaining columns, so that the result does not depend on chance.
    """
    typed = flatten_and_type(bronze, spec, keep=[position] if position else (), required=[key])
    rest = [n for n, _, _ in spec if n not in (key, "_updated_at")]
    latest = latest_by_key(typed, [key], ["_updated_at", *([position] if position else []), *rest])
    return latest.withColumnRenamed("_updated_at", "cdc_timestamp").drop("_deleted", *([position] if position else []))


def silver_customers(bronze: DataFrame, position: str | None = None) -> DataFrame:
    return _current(bronze, CUSTOMER, "customer_id", position).withColumn("full_name", full_name("first_name", "last_name")).withColumn("customer_segment", derive_segment("company_name"))


def silver_orders(bronze: DataFrame, as_of: str, position: str | None = None) -> DataFrame:
    return order_calendar(_current(bronze, ORDER, "order_id", position), as_of)


def silver_products(bronze: DataFrame, position: str | None = None) -> DataFrame:
    return product_margin(_current(bronze, PRODUCT, "product_id", position))


def silver_items(bronze: DataFrame, position: str | None = None) -> DataFrame:
    return line_totals(_current(bronze, ITEM, "item_id", position))


def silver_tickets(bronze: DataFrame, position: str | None = None) -> DataFrame:
    return _current(bronze, TICKET, "ticket_id", position).withColumn("resolution_hours", resolution_hours("created_at", "resolved_at"))


def silver_from_changelog(log: DataFrame, keys: list[str], defaults: dict[str, object], upper: list[str] = (), lower: list[str] = (), tier_on: str | None = None) -> DataFrame:
    """Current rows of an op-coded log with filled defaults, normalised case and, if asked for, a revenue tier."""
    out = normalize_case(fill_defaults(apply_changelog(log, keys), defaults), upper, lower)
    return out.withColumn("revenue_tier", revenue_tier(tier_on)) if tier_on else out


def silver_snapshot(raw: DataFrame, spec: Spec, keys: list[str], defaults: dict[str, object], upper: list[str] = ()) -> DataFrame:
    """First-form silver: typed payloads of a snapshot, required keys, defaults, case; no deduplication."""
    return normalize_case(fill_defaults(flatten_and_type(raw, spec, required=keys), defaults), upper)
