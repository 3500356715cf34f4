"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import released, staged


def _toward_least(pairs: DataFrame, keep) -> DataFrame:
    """Links each kept neighbour of a node with the least of the node and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u").filter(keep).select(F.col("v").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node of the component.

    Each round links all larger neighbours of a node to its least neighbour, then all smaller ones;
    rounds go on until nothing changes, and their
    number grows with the logarithm of the longest path. Only least values per node are aggregated
    (with partial sums before the shuffle), so a node with very many links makes no large group. Links live in the
    shared folder between rounds; nothing is collected but a count and a checksum.
    """
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now[0] == 0 or tuple(now) == before:
            break
        before = tuple(now)
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _toward_least(both, F.col("v") > F.col("u")).filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        old, edges = edges, staged(small.filter("a <> b").distinct(), "links")
        released(old)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def classes(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(key, n, component_id) for nodes (key, first_id, n) and links (a, b) between keys: component_id is the smallest first_id that links reach, null if all are.

    The components are found over the ids themselves, so that their least node is the answer, and no class has to meet in one place. A node without an id counts as
    one beyond all ids: 2^64 and its key.
    """
    label = F.when(F.col("first_id").isNotNull(), F.col("first_id").cast("decimal(20,0)")).otherwise(_whole(1 << 64) + F.col("key") + _whole(1 << 63)).cast("decimal(21,0)")
    named = nodes.select("key", label.alias("label"))
    ends = links.join(named.withColumnRenamed("key", "a").withColumnRenamed("label", "one"), "a").join(named.withColumnRenamed("key", "b").withColumnRenamed("label", "two"), "b")
    roots = components(ends.select(F.col("one").alias("a"), F.col("two").alias("b")))
    found = nodes.withColumn("node", label).join(roots, "node", "left").select("key", "n", F.coalesce("root", "node").alias("root"))
    return found.select("key", "n", F.when(F.col("root") < _whole(1 << 63), F.col("root").cast("long")).alias("component_id"))
