"""Schema discovery over all payload rows, differences, drift, contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import key_diff, pattern_join
from tidemark.sources.shared import written


def _kind(value: Column) -> Column:
    """The type of a variant without precision: one decimal column is one kind."""
    return F.regexp_replace(F.schema_of_variant(value), r"\(.*\)", "")


def _bare(schema: str) -> Column:
    """A type without its precision and its inner types."""
    return F.regexp_extract(schema, "^[A-Z_]+", 0)


def discover_schema(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Top-level keys of all payloads: type, least sample, rows with the key, share of rows without it, distinct values."""
    rows = df.select(F.col(payload).alias("_p"))
    keyed = rows.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_p").outer())).select("key", "value")
    text = F.coalesce(keyed["value"].cast("string"), F.lit("null"))
    each = keyed.filter("key is not null").select("key", _kind(keyed["value"]).alias("value_type"), text.alias("_text"))
    counts = each.groupBy("key", "value_type", "_text").agg(F.count("*").alias("_n"))
    out = counts.groupBy("key", "value_type").agg(F.sum("_n").alias("occurrences"), F.min("_text").alias("sample_value"), F.count("*").alias("distinct_values"))
    total = rows.agg(F.count("*").alias("_total"))
    return out.crossJoin(F.broadcast(total)).select("key", "value_type", "occurrences", "sample_value", "distinct_values", F.round((1 - F.col("occurrences") / F.col("_total")) * 100, 4).alias("null_pct"))


#: Levels that one pass unfolds: expressions nested deeper than this take the analyzer long.
LEVELS = 3


def _unfolded(rows: DataFrame, levels: int) -> DataFrame:
    """(path, value) rows with each object and array replaced by what it holds, `levels` times, by one explode; scalars and empty containers stay."""

    def inside(x: Column) -> Column:
        members = F.map_entries(F.try_variant_get(x["value"], "$", "map<string,variant>"))
        elements = F.try_variant_get(x["value"], "$", "array<variant>")
        one = lambda path, value: F.struct(path.alias("path"), value.alias("value"))
        return (
            F.when(F.size(members) > 0, F.transform(members, lambda m: one(F.concat(x["path"], F.lit("."), m["key"]), m["value"])))
            .when(F.size(elements) > 0, F.transform(elements, lambda e: one(F.concat(x["path"], F.lit("[*]")), e)))
            .otherwise(F.array(one(x["path"], x["value"])))
        )

    leaves = F.array(F.struct("path", "value"))
    for _ in range(levels):
        leaves = F.flatten(F.transform(leaves, inside))
    return rows.select(F.explode(leaves).alias("l")).select("l.path", "l.value")


def discover_paths(df: DataFrame, payload: str = "payload", depth: int | None = None) -> DataFrame:
    """Leaf paths of all payloads, however deep, with type and count; array places read [*]. Leaves are scalars, JSON nulls (VOID), and empty containers (OBJECT, ARRAY).

    A pass unfolds LEVELS levels of each row in place and counts what it finds over one explode; only where containers are left that hold something, these are written
    and go through another pass. depth, if given, is where to stop: deeper containers count as leaves of their own kind. Null payloads have no paths.
    """
    rows = df.filter(F.col(payload).isNotNull()).select(F.lit("$").alias("path"), F.col(payload).alias("value"))
    out, left = None, depth
    while True:
        levels = LEVELS if left is None else min(LEVELS, left)
        found = _unfolded(rows, levels).withColumn("_s", F.schema_of_variant("value"))
        deeper = left is None or left > levels
        # a list of nulls has the schema of an empty one: its size decides
        holds = F.col("_s").startswith("OBJECT<") & ~F.col("_s").startswith("OBJECT<>") | F.coalesce(F.size(F.try_variant_get("value", "$", "array<variant>")) > 0, F.lit(False))
        folded = holds if deeper else F.lit(False)
        counts = found.groupBy("path", _bare("_s").alias("value_type"), folded.alias("_folded")).agg(F.count("*").alias("occurrences"))
        counts = written(counts)
        done = counts.filter("not _folded").drop("_folded")
        out = done if out is None else out.unionByName(done)
        if not counts.filter("_folded").limit(1).count():
            return out.groupBy("path", "value_type").agg(F.sum("occurrences").alias("occurrences"))
        rows = written(found.filter(folded).select("path", "value"))
        left = None if left is None else left - levels


def infer_payload_schema(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row: the schema that all payloads fit, merged over all rows; null without any payload."""
    return df.agg(F.schema_of_variant_agg(payload).alias("payload_schema"))


def schema_diff(payload_keys: DataFrame, columns: DataFrame, ignore: DataFrame, key: str = "name", pattern: str = "column_pattern") -> DataFrame:
    """(table_name, name) of two sides, names without case: NEW in payloads, DROPPED from them; names that an ignore pattern fits are left out."""
    upper = lambda d: d.select("table_name", F.upper(key).alias(key))
    diff = key_diff(upper(payload_keys), upper(columns), ["table_name", key])
    return pattern_join(diff, ignore.select(F.upper(pattern).alias(pattern)), key, pattern, "left_anti")


def tables_needing_work(tables: DataFrame, silver: DataFrame, diffs: DataFrame) -> DataFrame:
    """NEW_TABLE without a silver table, SCHEMA_CHANGED with differences, else UP_TO_DATE."""
    changed = diffs.groupBy("table_name").agg(F.count("*").alias("_n"))
    both = tables.select("table_name").join(silver.select("table_name").distinct().withColumn("_there", F.lit(True)), "table_name", "left").join(changed, "table_name", "left")
    return both.select("table_name", F.when(F.col("_there").isNull(), "NEW_TABLE").when(F.col("_n") > 0, "SCHEMA_CHANGED").otherwise("UP_TO_DATE").alias("state"), F.coalesce("_n", F.lit(0)).alias("differences"))


SCALAR_TYPES = ("BIGINT", "INT", "DOUBLE", "DECIMAL", "STRING", "BOOLEAN", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ")


def gold_drift(lineage: DataFrame, columns: DataFrame, ignore: DataFrame) -> DataFrame:
    """Columns of an upstream table that its downstream table lacks. Scalars can pass through (AUTO_ADD); the rest needs REVIEW."""
    up = lineage.select("source_table", "target_table").distinct().join(columns.select(F.col("table_name").alias("source_table"), F.upper("column_name").alias("column_name"), F.upper("data_type").alias("data_type")), "source_table")
    down = columns.select(F.col("table_name").alias("target_table"), F.upper("column_name").alias("column_name")).distinct()
    lost = up.join(down, ["target_table", "column_name"], "left_anti")
    lost = pattern_join(lost, ignore.select(F.upper("column_pattern").alias("column_pattern")), "column_name", "column_pattern", "left_anti")
    return lost.withColumn("action", F.when(F.regexp_replace("data_type", r"\(.*\)", "").isin(*SCALAR_TYPES), "AUTO_ADD").otherwise("REVIEW")).select("source_table", "target_table", "column_name", "data_type", "action")


def propagate_columns(gold: DataFrame, silver: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Passthrough columns added to an aggregate of the entity's own grain; a coarser grain is refused."""
    if key not in gold.columns:
        raise ValueError(f"{key} is not in the aggregate: columns {cols} need a decision how to aggregate them")
    new = [c for c in cols if c not in gold.columns]
    return gold.join(silver.select(key, *new), key, "left")


def choose_strategy(profile: DataFrame) -> DataFrame:
    """(table_name, nested_arrays, duplicate_keys, versions) to a strategy and how sure it is."""
    strategy = F.when(F.col("nested_arrays") > 0, "normalize").when(F.col("versions") > 0, "scd2").when(F.col("duplicate_keys") > 0, "deduplicate").otherwise("flatten")
    sure = F.when(F.col("nested_arrays") > 0, 0.9).when(F.col("versions") > 0, 0.85).when(F.col("duplicate_keys") > 0, 0.8).otherwise(0.95)
    return profile.select("table_name", strategy.alias("strategy"), sure.alias("confidence"))


def apply_contract(df: DataFrame, contract: list[tuple[str, str, bool]]) -> tuple[DataFrame, DataFrame]:
    """(rows in the contract's names, order and types; violations). Violations: required columns that are absent, or values null or of another type, with counts."""
    have = {c.lower(): c for c in df.columns}
    typed = {n: F.col(have[n.lower()]).cast("string").try_cast(t) if n.lower() in have else F.lit(None).cast(t) for n, t, _ in contract}
    required = [n for n, _, need in contract if need]
    counts = df.agg(*(F.count_if(typed[n].isNull()).alias(n) for n in required))
    reason = {n: "INVALID" if n.lower() in have else "MISSING" for n in required}
    rows = F.array(*(F.struct(F.lit(n).alias("column_name"), F.lit(reason[n]).alias("reason"), F.col(n).alias("rows")) for n in required))
    found = counts.select(F.explode(rows).alias("r")).select("r.*").filter("rows > 0 or reason = 'MISSING'")
    return df.select(*(c.alias(n) for n, c in typed.items())), found


def column_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, data_type, ordinal) of the given tables, from their schemas."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, f.name, f.dataType.simpleString(), i) for t, d in tables.items() for i, f in enumerate(d.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int")


def nested_arrays(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
