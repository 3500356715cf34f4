"""Profiling, validation and quarantine."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeutil import ratio


def quality_summary(df: DataFrame, payload: str = "payload", loaded: str = "ingested_at") -> DataFrame:
    """Rows, null payloads, earliest and latest load, in one pass."""
    return df.agg(F.count("*").alias("total_rows"), F.count_if(F.col(payload).isNull()).alias("null_payloads"), F.min(loaded).alias("earliest_load"), F.max(loaded).alias("latest_load"))


def field_profile(df: DataFrame, fields: list[str], error: float | None = None) -> DataFrame:
    """Rows, nulls and distinct values of each field: exact, by one aggregation of (field, value) pairs; or, with an error, distinct values by sketches of that relative
    standard deviation, in one pass that shuffles a row for each task, however many fields and values there are."""
    if error is not None:
        cells = [F.struct(F.lit(f).alias("field"), F.count("*").alias("total_rows"), F.count_if(F.col(f"`{f}`").isNull()).alias("null_count"), F.approx_count_distinct(F.col(f"`{f}`").cast("string"), error).alias("cardinality")) for f in fields]
        return df.agg(F.array(*cells).alias("p")).select(F.explode("p").alias("p")).select("p.*")
    pairs = df.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields))).alias("p")).select("p.*")
    counts = pairs.groupBy("field", "value").agg(F.count("*").alias("_n"))
    return counts.groupBy("field").agg(F.sum("_n").alias("total_rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_n"))), F.lit(0)).alias("null_count"), F.count("value").alias("cardinality"))


def check_row_count(pairs: DataFrame, tolerance: float = 5.0) -> DataFrame:
    """(table_name, source_rows, target_rows): variance in percent, passed below the tolerance; without source rows both are null."""
    variance = F.round(F.abs(F.col("source_rows") - F.col("target_rows")).cast("double") * 100 / F.nullif(F.col("source_rows"), F.lit(0)).cast("double"), 4)
    return pairs.withColumn("variance_pct", variance).withColumn("passed", F.col("variance_pct") < tolerance)


def check_schema(df: DataFrame, contract: DataFrame) -> DataFrame:
    """Columns of df against a contract (name, type): MATCH, TYPE_MISMATCH, MISSING or EXTRA."""
    actual = df.sparkSession.createDataFrame([(n.lower(), t) for n, t in df.dtypes], "name string, actual_type string")
    both = contract.select(F.lower("name").alias("name"), F.col("type").alias("expected_type")).join(actual, "name", "full_outer")
    state = F.when(F.col("actual_type").isNull(), "MISSING").when(F.col("expected_type").isNull(), "EXTRA").when(F.col("actual_type") == F.col("expected_type"), "MATCH").otherwise("TYPE_MISMATCH")
    return both.withColumn("state", state)


def check_quality(df: DataFrame, rules: dict[str, tuple[str, float]]) -> DataFrame:
    """column: (type, greatest failure rate): failures are nulls and values that do not cast. One pass, one row a rule."""
    bad = [F.count_if(F.col(c).cast("string").try_cast(kind).isNull()).alias(c) for c, (kind, _) in rules.items()]
    one = df.agg(F.count("*").alias("_n"), *bad)
    rows = F.array(*(F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("expected_type"), F.col(c).alias("failures"), F.lit(most).alias("threshold")) for c, (kind, most) in rules.items()))
    out = one.select("_n", F.explode(rows).alias("r")).select("r.*", "_n")
    rate = ratio(F.col("failures"), F.col("_n"))
    return out.select("column_name", "expected_type", "failures", rate.alias("failure_rate"), F.coalesce(rate <= F.col("threshold"), F.lit(True)).alias("passed"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose key no parent has; a null key refers to nothing and is no orphan."""
    return child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def check_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children, orphans, share matched."""
    lost = orphans(child, parent, child_key, parent_key).agg(F.count("*").alias("orphans"))
    return child.agg(F.count(child_key).alias("children")).crossJoin(lost).withColumn("match_pct", ratio((F.col("children") - F.col("orphans")) * 100, F.col("children"), 4)).withColumn("passed", F.col("orphans") == 0)


def enforce_constraints(df: DataFrame, lengths: dict[str, int], required: list[str]) -> DataFrame:
    """Texts cut to their greatest length; `violations` lists required columns that are null."""
    cut = df.withColumns({c: F.when(F.length(c) > n, F.substring(c, 1, n)).otherwise(F.col(c)) for c, n in lengths.items()})
    return cut.withColumn("violations", F.array_join(F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required))), ","))


def null_rates(df: DataFrame, batch: str, fields: list[str]) -> DataFrame:
    wide = df.groupBy(batch).agg(*(F.round(F.count_if(F.col(f).isNull()) / F.count("*"), 6).alias(f) for f in fields))
    return wide.unpivot([batch], fields, "field", "null_rate")


def null_rate_alerts(df: DataFrame, batch: str, fields: list[str], baseline: DataFrame, factor: float = 2.0) -> DataFrame:
    """Batches and fields whose null rate exceeds factor times the baseline (field, base_rate)."""
    return null_rates(df, batch, fields).join(baseline, "field").filter(F.col("null_rate") > F.col("base_rate") * factor)


def split_quarantine(df: DataFrame, alerts: DataFrame, batch: str) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) rows: a batch with any alert is held back."""
    bad = alerts.select(batch).distinct()
    return df.join(bad, batch, "left_anti"), df.join(bad, batch, "left_semi")


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def validation_summary(results: DataFrame) -> DataFrame:
    """Checks, passed and failed (an unknown outcome is a failure), and the overall state."""
    ok = F.coalesce("passed", F.lit(False))
    return results.agg(F.count("*").alias("checks"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed")).withColumn("overall", F.when(F.col("failed") == 0, "PASSED").otherwise("FAILED"))


#: Relative standard deviation of the sketches that leave out what cannot be a key; six of them are allowed for.
ERROR = 0.02


def _may_be_unique(distinct: int, total: int) -> bool:
    return distinct * (1 + 6 * ERROR) + 1 >= total


def key_candidates(df: DataFrame) -> DataFrame:
    """The column that identifies rows: unique and not null, names ending in _id or key first, then by place; null, and no candidates, if there is none.

    One pass of sketches over all columns shuffles no rows; only columns that it cannot exclude are counted exactly.
    """
    cols = [f.name for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    left = [r.field for r in field_profile(df, cols, ERROR).collect() if r.total_rows and not r.null_count and _may_be_unique(r.cardinality, r.total_rows)]
    places = df.sparkSession.createDataFrame([(c, i, not c.lower().endswith(("_id", "key"))) for i, c in enumerate(cols) if c in left], "field string, ordinal int, unnamed boolean")
    profile = field_profile(df, left) if left else field_profile(df, cols[:1]).limit(0)
    unique = profile.join(places, "field").filter("null_count = 0 and cardinality = total_rows")
    return unique.agg(F.min_by("field", F.struct("unnamed", "ordinal")).alias("key_column"), F.count("*").alias("candidates"))


def key_sets(df: DataFrame, most: int = 2) -> list[tuple[str, ...]]:
    """The least sets of up to `most` columns that identify rows: no nulls, no two rows alike in them; by size, then by place. An empty table has none.

    Level by level. A set is tried only if none of its parts is a key and the product of its columns' distinct values can reach the number of rows; all sets of a level are
    counted by sketches in one pass, without a shuffle of rows, and only those that the sketch cannot exclude are counted exactly, each by one aggregation.
    """
    cols = [f.name for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    total, *counts = df.agg(F.count("*"), *(F.struct(F.count(F.col(f"`{c}`")).alias("n"), F.approx_count_distinct(F.col(f"`{c}`"), ERROR).alias("d")) for c in cols)).first()
    if not total:
        return []
    values = {c: r.d * (1 + 6 * ERROR) + 1 for c, r in zip(cols, counts) if r.n == total}
    usable, keys = [c for c in cols if c in values], []
    for size in range(1, most + 1):
        sets = [s for s in combinations(usable, size) if not any(set(k) <= set(s) for k in keys) and prod(values[c] for c in s) >= total]
        if not sets:
            continue
        named = [[F.col(f"`{c}`") for c in s] for s in sets]
        seen = df.agg(*(F.approx_count_distinct(F.struct(*s), ERROR).alias(str(i)) for i, s in enumerate(named))).first()
        for s, group, d in zip(sets, named, seen):
            if _may_be_unique(d, total) and df.groupBy(*group).count().filter("count > 1").limit(1).count() == 0:
                keys.append(s)
    return keys


def sample_rows(df: DataFrame, n: int = 100) -> DataFrame:
    """Any n rows (all, if fewer), for a first look."""
    return df.limit(n)
