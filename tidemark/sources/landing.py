"""Sources and sinks: landing tables, change logs, JSON payloads, keyed writes."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Landing schemas of the five entities, both forms united.
SCHEMAS: dict[str, str] = {
    "customers": "customer_id long, first_name string, last_name string, email string, phone string, company_name string, industry string, segment string, annual_revenue decimal(15,2), loyalty_tier string, is_active boolean, created_at timestamp, updated_at timestamp",
    "products": "product_id long, product_name string, category string, price decimal(10,2), cost decimal(10,2), sku string, active boolean, created_at timestamp",
    "orders": "order_id long, customer_id long, order_date timestamp, status string, total_amount decimal(12,2), shipping_address string, payment_method string, notes string",
    "order_items": "item_id long, order_id long, product_id long, quantity int, unit_price decimal(10,2), discount_percent decimal(5,2), line_total decimal(12,2)",
    "support_tickets": "ticket_id long, customer_id long, order_id long, subject string, description string, priority string, status string, created_at timestamp, resolved_at timestamp",
}
CHANGELOG = "_cdc_operation string, _cdc_timestamp timestamp, _cdc_source string, _cdc_lsn string, _metadata_load_ts timestamp, raw_payload string"


def read_landing(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """A landing table with its fixed schema, so that no file is read to infer one."""
    return spark.read.schema(SCHEMAS[entity]).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, parts: int = 16, **options: str) -> DataFrame:
    """A source table over JDBC, in ranges of a numeric key between its least and greatest value."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
    low, high = reader.option("query", f"SELECT min({name}) AS low, max({name}) AS high FROM {table}").load().first()
    whole = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if low is None:
        return whole.load()
    return whole.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high + 1), numPartitions=str(parts), fetchsize="10000").load()


def even_bounds(keys: DataFrame, key: str, parts: int, accuracy: int = 100) -> list:
    """Values of a numeric key that cut its rows into at most `parts` ranges of like size, from the quantiles of all rows; each range is off by about 1 / accuracy of a part.

    A value that holds more rows than a part stays whole, so there may be fewer ranges.
    """
    cuts = keys.agg(F.percentile_approx(key, F.array(*(F.lit(i / parts) for i in range(1, parts))), parts * accuracy).alias("q")).first().q if parts > 1 else None
    return sorted(set(cuts or []))


def read_jdbc_even(spark: SparkSession, url: str, table: str, key: str, parts: int = 16, **options: str) -> DataFrame:
    """A source table over JDBC, in ranges of a numeric key that hold like numbers of rows, however unevenly its values lie; rows without a key are in the first.

    The key column is read first, alone and in ranges of values; its quantiles are summed up on the executors, so only the bounds reach the driver.
    """
    name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
    cuts = even_bounds(read_jdbc(spark, url, table, key, parts, **options).select(key), key, parts)
    whole = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize="10000", **options)
    if not cuts:
        return whole.load()
    # a quantile is the last value of its range
    tests = [f"{name} <= {cuts[0]} OR {name} IS NULL", *(f"{name} > {a} AND {name} <= {b}" for a, b in zip(cuts, cuts[1:])), f"{name} > {cuts[-1]}"]
    return spark.read.jdbc(url, table, predicates=tests, properties={"fetchsize": "10000", **options})


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    """Op-coded change rows; the payload parsed, malformed ones null."""
    return spark.read.schema(CHANGELOG).parquet(path).withColumn("payload", F.try_parse_json("raw_payload"))


def normalize_flags(df: DataFrame, deleted: str = "_deleted") -> DataFrame:
    """A soft-delete flag of any common spelling as a boolean that is never null."""
    text = F.lower(F.col(deleted).cast("string"))
    return df.withColumn(deleted, F.coalesce(text.isin("true", "t", "1", "y", "yes"), F.lit(False)))


def read_soft_delete(spark: SparkSession, path: str, deleted: str = "_deleted") -> DataFrame:
    return normalize_flags(spark.read.parquet(path), deleted)


def ingest_json(df: DataFrame, col: str, source: str, loaded_at: Column | None = None) -> DataFrame:
    """JSON text to a variant payload stamped with load time and source; malformed text gives a null payload and stays in raw_text."""
    at = loaded_at if loaded_at is not None else F.current_timestamp()
    return df.select(at.alias("_metadata_load_ts"), F.lit(source).alias("_metadata_source"), F.col(col).alias("raw_text"), F.try_parse_json(col).alias("raw_payload"))


#: Times keep their microseconds in payloads: versions of one row may lie closer together than a millisecond.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def pack_bronze(df: DataFrame, source_table: str, ingested_at: Column | None = None) -> DataFrame:
    """Whole rows as payload, keys with null values left out; payload_json is the same as text."""
    at = ingested_at if ingested_at is not None else F.current_timestamp()
    text = F.to_json(F.struct(*df.columns), TIMES)
    return df.select(F.parse_json(text).alias("payload"), text.alias("payload_json"), F.lit(source_table).alias("source_table"), at.alias("ingested_at"))


def union_bronze(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create or replace a derivation. Rows of one partition value are dealt to one task first, so that no task opens a file per value."""
    out = df.repartition(*partition_by) if partition_by else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_versioned(df: DataFrame, root: str) -> DataFrame:
    """A new version under root, for derivations that read their own last version."""
    return materialize(df, f"{root}/v-{uuid.uuid4().hex}")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], set_exprs: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """Matched rows updated, others kept or inserted. set_exprs gives (old, new) to value for a column; by default the new value wins."""
    exprs = set_exprs or {}
    old, new = target.withColumn("_old", F.lit(True)).alias("o"), updates.withColumn("_new", F.lit(True)).alias("n")
    both = F.col("o._old") & F.col("n._new")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    cols = []
    for c in target.columns:
        o = F.col(f"o.{c}")
        if c not in updates.columns:
            cols.append(o.alias(c))
            continue
        n = F.col(f"n.{c}")
        value = exprs[c](o, n) if c in exprs else n
        cols.append(F.when(both, n if c in keys else value).when(F.col("n._new"), n).otherwise(o).alias(c))
    return old.join(new, on, "full_outer").select(*cols)


def insert_absent(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """target, and of the new rows one for each key that it lacks (the least by the other columns)."""
    rest = [c for c in new.columns if c not in keys]
    one = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest")).select(*keys, "_rest.*") if rest else new.distinct()
    return target.unionByName(one.join(target.select(*keys), keys, "left_anti").select(*new.columns), allowMissingColumns=True)


def reconcile_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """df in the target's columns, order and types: missing ones null, others dropped, values that do not fit null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*(F.col(have[f.name.lower()]).try_cast(f.dataType).alias(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target))


def write_back(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Insights to an operational store, appended."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize="5000", **options).mode("append").save()
