"""Joins and set operations that the pipeline names: anti, semi, suppression, pattern and difference joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutil import as_date
from tidemark.sources.shared import written

#: Names of one index entry that a task compares with the patterns that look it up.
LIKE_SHARE = 200_000


def missing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of left without a partner."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def keep_existing(edges: DataFrame, nodes: DataFrame, ends: tuple[str, str] = ("source_node_id", "target_node_id"), node: str = "node_id") -> DataFrame:
    """Edges with both ends among the nodes."""
    for end in ends:
        edges = edges.join(nodes.select(F.col(node).alias(end)).distinct(), end, "left_semi")
    return edges


def suppress_recent(df: DataFrame, log: DataFrame, key: str, at: str, days: int, as_of: str) -> DataFrame:
    """Rows whose key has no log entry within the last days; null keys in the log suppress nothing."""
    recent = log.filter((F.col(at).cast("date") > F.date_sub(as_date(as_of), days)) & F.col(key).isNotNull())
    return missing(df, recent, [key])


def _literal_run(pattern: Column) -> Column:
    """The longest stretch of a LIKE pattern without wildcards, escapes undone; empty if there is none."""
    runs = F.transform(F.regexp_extract_all(pattern, F.lit(r"((?:[^%_\\]|\\.)+)"), F.lit(1)), lambda r: F.regexp_replace(r, r"\\(.)", "$1"))
    return F.coalesce(F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))["run"], F.lit(""))


def _grams(text: Column, size: int) -> Column:
    """Distinct stretches of `size` characters, marked with their size."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.concat(F.lit(f"{size}:"), F.substring(text, i, F.lit(size)))))


def like_matches(names: DataFrame, patterns: DataFrame, share: int = LIKE_SHARE) -> DataFrame:
    """(name, pattern) of all distinct names and the distinct LIKE patterns that fit them, by an inverted index instead of a comparison of all pairs.

    A name is listed under each stretch of 3 characters in it (shorter ones for patterns whose literal text is shorter); a pattern looks up that stretch of its longest
    literal run that the fewest names have, and the pairs found are verified. Patterns of wildcards alone look up the length that they ask for. Only entries that some
    pattern could look up are kept. An entry with more than `share` names is dealt to several parts, and the patterns that look it up are copied to each.
    """
    name = names.select(F.col(names.columns[0]).alias("name")).filter("name is not null").distinct()
    run = _literal_run(F.col("pattern"))
    pattern = patterns.select(F.col(patterns.columns[0]).alias("pattern")).filter("pattern is not null").distinct().withColumn("_run", run)
    singles = F.length(F.regexp_replace("pattern", "%", ""))
    shape = F.array(F.concat(F.when(F.col("pattern").contains("%"), "+").otherwise("="), singles.cast("string")))
    asked = F.when(F.length("_run") >= 3, _grams(F.col("_run"), 3)).when(F.length("_run") == 2, _grams(F.col("_run"), 2)).when(F.length("_run") == 1, _grams(F.col("_run"), 1)).otherwise(shape)
    wanted = written(pattern.select("pattern", F.explode(asked).alias("key")))
    lengths = F.concat(F.array(F.concat(F.lit("="), F.length("name").cast("string"))), F.transform(F.sequence(F.lit(0), F.length("name")), lambda i: F.concat(F.lit("+"), i.cast("string"))))
    all_keys = F.concat(_grams(F.col("name"), 3), _grams(F.col("name"), 2), _grams(F.col("name"), 1), lengths)
    listed = written(name.select("name", F.explode(all_keys).alias("key")).join(wanted.select("key").distinct(), "key", "left_semi"))
    sizes = listed.groupBy("key").agg(F.count("*").alias("n"))
    best = wanted.join(sizes, "key", "left").groupBy("pattern").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("key"))).alias("k")).select("pattern", "k.*").filter("n > 0")
    chosen = written(best.withColumn("parts", F.ceil(F.col("n") / share)))
    large = chosen.filter("parts > 1").select("key", "parts").distinct()
    dealt = listed.join(large, "key", "left").select("key", F.pmod(F.xxhash64("name"), F.coalesce("parts", F.lit(1))).alias("part"), "name")
    copied = chosen.select("pattern", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return dealt.join(copied, ["key", "part"]).filter(F.expr("name LIKE pattern")).select("name", "pattern")


def pattern_join(df: DataFrame, rules: DataFrame, name: str, pattern: str, how: str = "inner") -> DataFrame:
    """Names with the LIKE patterns that fit them, as a join of the given kind on `name LIKE pattern`: inner, left, right, full, left_semi or left_anti.

    The pairs of distinct names and patterns come from like_matches; everything else is equi-joins, alike at every size. Repeated rows stay repeated, null names and null patterns fit nothing.
    """
    met = like_matches(df.select(name), rules.select(pattern)).select(F.col("name").alias("_name"), F.col("pattern").alias("_pattern"))
    if how in ("left_semi", "left_anti"):
        return df.join(met.select("_name").distinct(), F.col(name) == F.col("_name"), how)
    if how == "inner":
        return df.join(met, F.col(name) == F.col("_name")).join(rules, F.col("_pattern") == F.col(pattern)).drop("_name", "_pattern")
    met = written(met)
    ruled = rules.join(met, F.col(pattern) == F.col("_pattern"))
    if how == "left":
        return df.join(ruled, F.col(name) == F.col("_name"), "left").select(*df.columns, *rules.columns)
    if how == "right":
        return rules.join(df.join(met, F.col(name) == F.col("_name")), F.col(pattern) == F.col("_pattern"), "left").select(*df.columns, *rules.columns)
    if how == "full":
        without = rules.join(met.select("_pattern").distinct(), F.col(pattern) == F.col("_pattern"), "left_anti")
        return df.join(ruled, F.col(name) == F.col("_name"), "left").select(*df.columns, *rules.columns).unionByName(without, allowMissingColumns=True)
    raise ValueError(how)


def key_diff(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Keys in one of two sets only: NEW (in a) or DROPPED (in b)."""
    left, right = a.select(*on).distinct().withColumn("_a", F.lit(True)), b.select(*on).distinct().withColumn("_b", F.lit(True))
    both = left.join(right, on, "full_outer").filter("_a IS NULL OR _b IS NULL")
    return both.select(*on, F.when(F.col("_b").isNull(), "NEW").otherwise("DROPPED").alias("change"))


def table_relationships(nodes: DataFrame, edges: DataFrame, node: str | int) -> DataFrame:
    """One-hop neighbours of a node: the other end's id and name, the edge's type and direction."""
    name = lambda side: nodes.select(F.col("node_id").alias(side), F.col("name").alias(f"{side}_name"))
    out = edges.filter(F.col("source_node_id") == node).select(F.col("target_node_id").alias("other"), "edge_type", F.lit("OUTGOING").alias("direction"))
    into = edges.filter(F.col("target_node_id") == node).select(F.col("source_node_id").alias("other"), "edge_type", F.lit("INCOMING").alias("direction"))
    return out.unionByName(into).join(name("other"), "other").select(F.col("other").alias("neighbour_id"), F.col("other_name").alias("neighbour_name"), "edge_type", "direction")


def child_counts(parents: DataFrame, children: DataFrame, on: str, alias: str = "n_children") -> DataFrame:
    """Each parent with its number of children, zero included."""
    return parents.join(children.groupBy(on).agg(F.count("*").alias(alias)), on, "left").withColumn(alias, F.coalesce(alias, F.lit(0)))


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def top_k(df: DataFrame, by: str, k: int, tiebreak: list[str]) -> DataFrame:
    """The k rows with the largest value, nulls last; ties by the given columns."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tiebreak).limit(k)


def running_number(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Row numbers over a total order without one sorting task: rows are dealt by range, numbered within, and offset by the sizes before.

    The dealt rows are written once: sizes and numbers must come from the same ranges, and a range exchange that is planned twice samples its bounds twice.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.join(F.broadcast(before), "_part").withColumn("seq", within.cast("long") + F.col("_before")).drop("_part", "_before")  # a row for each range


def scalar_counts(**tables: DataFrame) -> DataFrame:
    """Row counts of several tables on one row."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias(name))
        out = one if out is None else out.crossJoin(one)  # one row each
    return out
