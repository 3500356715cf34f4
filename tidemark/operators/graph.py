"""Lineage and relationship graphs over node and edge tables, and similarity of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutil import dot, unit
from tidemark.operators.references import extract_refs  # noqa: F401  (part of the graph's interface)
from tidemark.operators.joins import keep_existing, missing, table_relationships
from tidemark.sources.shared import scratch, written
from tidemark.sources.landing import insert_absent, upsert

neighbours = table_relationships


def build_nodes(tables: DataFrame, columns: DataFrame, database: str) -> DataFrame:
    """Nodes for the database, its schemas, tables and columns, with a property object as JSON."""
    layer = F.when(F.col("schema_name") == "BRONZE", "bronze").when(F.col("schema_name") == "SILVER", "silver").when(F.col("schema_name") == "GOLD", "gold").otherwise("source")
    node = lambda d, i, kind, name, props: d.select(i.alias("node_id"), F.lit(kind).alias("node_type"), name.alias("name"), F.to_json(props).alias("properties"))
    s, t, c = F.col("schema_name"), F.col("table_name"), F.col("column_name")
    spark = tables.sparkSession
    db = spark.range(1).select(F.lit(f"DB:{database}").alias("node_id"), F.lit("DATABASE").alias("node_type"), F.lit(database).alias("name"), F.to_json(F.struct(F.lit(database).alias("database"))).alias("properties"))
    schemas = node(tables.select("schema_name").distinct(), F.concat(F.lit("SCHEMA:"), s), "SCHEMA", s, F.struct(layer.alias("layer")))
    tabs = node(tables, F.concat(F.lit("TABLE:"), s, F.lit("."), t), "TABLE", t, F.struct(layer.alias("layer"), F.col("row_count")))
    cols = node(columns, F.concat(F.lit("COLUMN:"), s, F.lit("."), t, F.lit("."), c), "COLUMN", c, F.struct(t.alias("table_name"), s.alias("schema_name"), F.col("data_type"), F.col("ordinal")))
    return db.unionByName(schemas).unionByName(tabs).unionByName(cols)


def build_edges(nodes: DataFrame) -> DataFrame:
    """CONTAINS from schemas to tables, HAS_COLUMN from tables to columns, by the columns' properties."""
    tables = nodes.filter("node_type = 'TABLE'").select(F.col("node_id").alias("table_id"), F.regexp_extract("node_id", r"^TABLE:([^.]+)\.", 1).alias("schema_name"))
    contains = tables.select(F.concat(F.lit("SCHEMA:"), "schema_name").alias("source_node_id"), F.col("table_id").alias("target_node_id"), F.lit("CONTAINS").alias("edge_type"))
    props = F.try_parse_json("properties")
    cols = nodes.filter("node_type = 'COLUMN'").select(F.concat(F.lit("TABLE:"), F.variant_get(props, "$.schema_name", "string"), F.lit("."), F.variant_get(props, "$.table_name", "string")).alias("source_node_id"), F.col("node_id").alias("target_node_id"), F.lit("HAS_COLUMN").alias("edge_type"))
    return contains.unionByName(keep_existing(cols, nodes))


def lineage_edges(lineage: DataFrame, nodes: DataFrame) -> DataFrame:
    """Lineage map rows as edges, where both ends exist."""
    edges = lineage.select(F.concat(F.lit("TABLE:"), "source_schema", F.lit("."), "source_table").alias("source_node_id"), F.concat(F.lit("TABLE:"), "target_schema", F.lit("."), "target_table").alias("target_node_id"), "edge_type")
    return keep_existing(edges, nodes)


#: Frontiers of at most so many nodes are named to the scan of an edge index, which then opens their buckets only.
NAMED = 1_000


def edge_index(edges: DataFrame, direction: str = "downstream", buckets: int | None = None) -> DataFrame:
    """Distinct (_from, node_id) steps of one direction, as a table in the shared folder, in buckets and in order of _from.

    A join on _from then moves the other side alone, and the index serves any number of closures. Without a number there are as many buckets as shuffle partitions.
    Edges with a null end lead nowhere and are left out. Edges move once: repeats meet in the task that writes their bucket.
    """
    spark = edges.sparkSession
    a, b = ("source_node_id", "target_node_id") if direction == "downstream" else ("target_node_id", "source_node_id")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark)
    name = "edges_" + path.rsplit("-", 1)[1]
    step = edges.select(F.col(a).alias("_from"), F.col(b).alias("node_id")).dropna().repartition(n, "_from").distinct()
    step.write.bucketBy(n, "_from").sortBy("_from").option("path", path).saveAsTable(name)
    return spark.table(name)


def _inward(later: DataFrame) -> DataFrame:
    """(_from, node_id) of a downstream index by its later ends, in buckets of these: each node that has edges of its own with every node before it, any other node once, with null."""
    spark = later.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark)
    name = "edges_" + path.rsplit("-", 1)[1]
    goes_on = later.select(F.col("_from").alias("_inner")).distinct()
    ends = later.select(F.col("node_id").alias("_to"), F.col("_from").alias("_before")).repartition(n, "_to").join(goes_on.hint("merge"), F.col("_to") == F.col("_inner"), "left")
    step = ends.select(F.col("_to").alias("_from"), F.when(F.col("_inner").isNotNull(), F.col("_before")).alias("node_id")).distinct()
    step.write.bucketBy(n, "_from").sortBy("_from").option("path", path).saveAsTable(name)
    return spark.table(name)


def lineage_closure(edges: DataFrame, start: list, direction: str = "downstream", max_hops: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """Nodes reached from the start nodes, with the fewest hops and the least path of that length.

    One join of the frontier per hop, up to max_hops or, without it, until nothing new is reached; nodes already seen drop out, so cycles end. The edges lie in an
    `edge_index` of the direction (index, if given), so a hop moves its frontier only, and a small frontier reads its own buckets only. The frontier is written to the
    shared folder per hop, which keeps plans short.
    """
    spark = edges.sparkSession
    step = edge_index(edges, direction) if index is None else index
    kind = step.schema["_from"].dataType.simpleString()
    found = spark.createDataFrame([(x,) for x in start], f"node_id {kind}").select("node_id", F.lit(0).alias("hop"), F.col("node_id").cast("string").alias("path"))
    frontier, hop = found, 0
    while max_hops is None or hop < max_hops:
        hop += 1
        named = [r.node_id for r in frontier.select("node_id").limit(NAMED + 1).collect()]
        near = step.filter(F.col("_from").isin(named)) if len(named) <= NAMED else step
        reached = frontier.select(F.col("node_id").alias("_from"), "path").join(near, "_from").groupBy("node_id").agg(F.min(F.concat("path", F.lit(">"), F.col("node_id").cast("string"))).alias("path"))
        fresh = written(reached.join(found.select("node_id"), "node_id", "left_anti").select("node_id", F.lit(hop).alias("hop"), "path"))
        if fresh.isEmpty():
            break
        found, frontier = found.unionByName(fresh), fresh
    return found.filter("hop > 0")


def _warning(downstream: Column) -> Column:
    return F.when(downstream > 5, "HIGH_IMPACT").when(downstream > 0, "HAS_DEPENDENTS").otherwise("NONE")


def impact(changed: DataFrame, closure: DataFrame) -> DataFrame:
    """Number of downstream nodes of what changed, and a warning by their number."""
    return changed.crossJoin(closure.agg(F.count("*").alias("downstream"))).withColumn("warning", _warning(F.col("downstream")))


def downstream_sketches(edges: DataFrame, max_hops: int | None = None, bits: int = 12, index: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """(node_id, estimate): nodes that each node reaches, itself left out, for all nodes at once; an estimate, off by some 1.6 % at 12 bits and mostly exact below a few hundred.

    Every node holds a sketch of itself and what it reaches; a hop unites it with those of its successors, until none changes. A sketch has at most about 2 ** bits bytes,
    so a hop moves edges times that and never the reached sets, however large these are. known: (node_id, reached) pairs that nodes without edges here start with.
    """
    back = edge_index(edges, "upstream") if index is None else index  # _from: the later node, which passes its sketch to node_id before it
    kind = back.schema["_from"].dataType
    ids = back.select(F.col("_from").alias("node_id")).union(back.select(F.col("node_id").cast(kind))).distinct()
    held = ids.select("node_id", F.col("node_id").alias("reached"))
    if known is not None:
        held = held.unionByName(known.join(ids, "node_id", "left_semi"))
    now = written(held.groupBy("node_id").agg(F.hll_sketch_agg(F.col("reached").cast("string"), F.lit(bits)).alias("sketch")))
    hop = 0
    while max_hops is None or hop < max_hops:
        hop += 1
        passed = back.join(now.select(F.col("node_id").alias("_from"), "sketch"), "_from").select("node_id", "sketch")
        united = passed.unionByName(now.select("node_id", "sketch")).groupBy("node_id").agg(F.hll_union_agg("sketch").alias("sketch"))
        size = F.hll_sketch_estimate("sketch")
        after = written(united)
        changed = after.select("node_id", size.alias("_n")).join(now.select("node_id", size.alias("_was")), "node_id").filter("_n <> _was").limit(1).count()
        now = after
        if not changed:
            break
    return now.select("node_id", F.greatest(F.hll_sketch_estimate("sketch") - 1, F.lit(0)).alias("estimate"))


#: Hops over which walks are counted; what goes on after that (cycles do) is told by sketches.
WALKS = 16


def _walks(later: DataFrame, back: DataFrame, most: int, max_hops: int | None) -> tuple[DataFrame, int | None]:
    """(node_id) of the nodes with more than `most` walks of any length, or walks that go on beyond WALKS hops; and the length of the longest walk, None if some do.

    A node reaches at most as many nodes as walks start from it. A hop moves a number along each edge whose later end has edges of its own. Whoever comes before such a node is one too.
    """
    apart = F.col("_from") != F.col("node_id")
    inner = back.filter(apart).select("_from", F.col("node_id").alias("_before"))
    near = later.filter(apart).groupBy("_from").agg(F.count("*").alias("_walks"))
    front, more, hop, ended = near, [], 1, max_hops is not None
    while hop < (max_hops or WALKS):
        front = written(inner.join(front, "_from").groupBy(F.col("_before").alias("_from")).agg(F.least(F.sum("_walks"), F.lit(most + 1)).alias("_walks")))
        if front.isEmpty():
            ended = True
            break
        more.append(front)
        hop += 1
    total = F.col("_walks")
    if more:
        far = more[0]
        for df in more[1:]:
            far = far.unionByName(df)
        near = near.join(far.groupBy("_from").agg(F.sum("_walks").alias("_more")), "_from", "left")
        total = total + F.coalesce("_more", F.lit(0))
    many = near.filter(total > most).select(F.col("_from").alias("node_id"))
    return (many if ended else many.union(front.select("_from")).distinct()), hop if ended else None


def _further(ahead: DataFrame, near: DataFrame, later: DataFrame, max_hops: int | None) -> DataFrame:
    """(start, node_id) more than one hop apart. near: the pairs one hop apart, of the same starts; ahead: (start, _from), those of them that go on."""
    far, hop = near.filter(F.lit(False)), 1
    while max_hops is None or hop < max_hops:
        hop += 1
        reached = ahead.join(later, "_from").filter("start <> node_id").select("start", "node_id").distinct()
        fresh = written(reached.join(near.unionByName(far), ["start", "node_id"], "left_anti"))
        if fresh.isEmpty():
            break
        far, ahead = far.unionByName(fresh), fresh.select("start", F.col("node_id").alias("_from"))
    return far


def impact_of_all(edges: DataFrame, exact_most: int = 10_000, max_hops: int | None = None) -> DataFrame:
    """(node_id, downstream, exact, warning) of every node with an edge: how many other nodes it reaches.

    Walks bound the sizes first: a node with at most about exact_most of them is counted exactly from its pairs, all such starts at once. Their first hop is the edge index
    itself; a further one joins the new pairs with it, and pairs seen before drop out. Sketches tell the sizes of the nodes that are left, from those of what they meet, and such of
    these as reach about exact_most at most are counted from pairs as well. Pairs are at most exact_most for each node; larger sets stay estimates (exact is false), and no set is ever held by one task.
    """
    most = int(1.1 * exact_most)
    kind = edges.schema["target_node_id"].dataType
    later = edge_index(edges.select(F.col("source_node_id").cast(kind).alias("source_node_id"), "target_node_id"), "downstream")
    back = _inward(later)
    many, longest = _walks(later, back, most, max_hops)
    many = written(many)
    start = F.col("_from").alias("start")
    ahead = back.filter("node_id <> _from").select(F.col("node_id").alias("start"), "_from")
    first = later.filter("node_id <> _from").select(start, "node_id")
    some = not many.isEmpty()
    if some:
        ahead = ahead.join(many.select(F.col("node_id").alias("start")), "start", "left_anti")
    deep = ahead.select("start").distinct()
    far = _further(ahead, first.join(deep, "start", "left_semi"), later, longest)
    found = later.groupBy("_from").agg(F.sum((F.col("node_id") != F.col("_from")).cast("long")).alias("_near")).withColumnRenamed("_from", "node_id")
    exact, estimate = F.lit(True), F.lit(0).cast("long")
    if some:
        if max_hops is None:
            # what follows a node with few walks has few walks too, so its pairs are all there
            sub = later.join(many.withColumnRenamed("node_id", "_from"), "_from", "left_semi").select(F.col("_from").alias("source_node_id"), F.col("node_id").alias("target_node_id"))
            few = later.join(many.withColumnRenamed("node_id", "_from"), "_from", "left_anti").select(F.col("_from").alias("node_id"), F.col("node_id").alias("reached"))
            sizes = downstream_sketches(sub, known=few.unionByName(far.select(F.col("start").alias("node_id"), F.col("node_id").alias("reached"))))
        else:
            sizes = downstream_sketches(later.select(F.col("_from").alias("source_node_id"), F.col("node_id").alias("target_node_id")), max_hops)
        sizes = written(sizes.join(many, "node_id", "left_semi"))
        near = first.join(sizes.filter(F.col("estimate") <= most).select(F.col("node_id").alias("start")), "start", "left_semi")
        far = far.unionByName(_further(near.select("start", F.col("node_id").alias("_from")), near, later, max_hops))
        found = found.join(sizes, "node_id", "left")
        estimate, exact = F.col("estimate"), F.coalesce(F.col("estimate") <= most, F.lit(True))
    found = found.join(far.groupBy(F.col("start").alias("node_id")).agg(F.count("*").alias("_far")), "node_id", "left")
    n = F.when(exact, F.col("_near") + F.coalesce("_far", F.lit(0))).otherwise(estimate)
    rows = found.select("node_id", n.alias("downstream"), exact.alias("exact"))
    ends = back.filter("node_id IS NULL").select(F.col("_from").alias("node_id"), F.lit(0).cast("long").alias("downstream"), F.lit(True).alias("exact"))
    return rows.unionByName(ends).withColumn("warning", _warning(F.col("downstream")))


def suggest_joins(columns: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """Declared references (HIGH), and columns named <table>_id or <table>_key whose table exists (MEDIUM): an equi-join on the derived name."""
    names = columns.select(F.lower("table_name").alias("target_table")).distinct()
    base = F.regexp_replace(F.lower("column_name"), "_(id|key)$", "")
    by_name = columns.filter(F.lower("column_name").rlike("_(id|key)$")).select(F.lower("table_name").alias("source_table"), F.lower("column_name").alias("column_name"), base.alias("target_table"))
    plural = by_name.withColumn("target_table", F.concat("target_table", F.lit("s")))
    guessed = by_name.unionByName(plural).join(names, "target_table").filter("source_table <> target_table").withColumn("confidence", F.lit("MEDIUM"))
    known = foreign_keys.select(*(F.lower(c).alias(c) for c in ("source_table", "column_name", "target_table"))).withColumn("confidence", F.lit("HIGH"))
    rest = missing(guessed, known, ["source_table", "column_name", "target_table"])
    return known.unionByName(rest)


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Histogram of node types and edge types."""
    one = lambda d, c, kind: d.groupBy(F.col(c).alias("type")).agg(F.count("*").alias("n")).withColumn("element", F.lit(kind))
    return one(nodes, "node_type", "node").unionByName(one(edges, "edge_type", "edge")).select("element", "type", "n")


def validate_refs(refs: DataFrame, tables: DataFrame, most: int = 5) -> DataFrame:
    """Distinct references that no table has, with up to `most` tables whose name holds the other's, in order.

    Where one name holds the other, the whole of the shorter one is a stretch of the longer: each name is joined by equality with the stretches of the
    names on the other side, so no pair is looked at in vain. Names are short; a name of n characters has n (n + 1) / 2 stretches.
    """
    names = refs.select("table_name").distinct()
    lost = names.join(tables.select(F.upper("table_name").alias("table_name")), "table_name", "left_anti")
    near = tables.select(F.upper("table_name").alias("_c")).filter("length(_c) > 0").distinct()

    def stretches(df: DataFrame, name: str) -> DataFrame:
        n = F.length(name)
        starts = df.filter(n > 0).select(name, F.explode(F.sequence(F.lit(1), n)).alias("_s"))
        return starts.select(name, F.explode(F.sequence(F.lit(1), n - F.col("_s") + 1)).alias("_n"), "_s").select(name, F.substring(F.col(name), F.col("_s"), F.col("_n")).alias("_part")).distinct()

    inside = stretches(lost, "table_name").join(near.withColumn("_part", F.col("_c")), "_part").select("table_name", "_c")
    around = stretches(near, "_c").join(lost.withColumn("_part", F.col("table_name")), "_part").select("table_name", "_c")
    both = lost.join(inside.union(around).distinct(), "table_name", "left")
    return both.groupBy("table_name").agg(F.array_join(F.slice(F.sort_array(F.collect_set("_c")), 1, most), ", ").alias("suggestions"))


def register_lineage(refs: DataFrame, lineage: DataFrame, target: str) -> DataFrame:
    """Lineage with a row for each new reference of the target."""
    new = refs.select(F.col("table_name").alias("source_table"), F.lit(target).alias("target_table")).distinct()
    return insert_absent(lineage, new, ["source_table", "target_table"])


def coverage_gaps(lineage: DataFrame, tables: DataFrame) -> DataFrame:
    """Targets of the lineage that do not exist, with their sources; and existing tables that feed nothing."""
    there = tables.select("table_name").distinct()
    lost = lineage.join(there.withColumnRenamed("table_name", "target_table"), "target_table", "left_anti").groupBy("target_table").agg(F.array_join(F.sort_array(F.collect_set("source_table")), ", ").alias("detail"))
    unused = there.join(lineage.select(F.col("source_table").alias("table_name")).distinct(), "table_name", "left_anti").select(F.col("table_name").alias("target_table"), F.lit("no downstream").alias("detail"))
    return lost.withColumn("gap", F.lit("MISSING_TARGET")).unionByName(unused.withColumn("gap", F.lit("UNCOVERED_SOURCE"))).select(F.col("target_table").alias("table_name"), "gap", "detail")


def merge_learnings(target: DataFrame, new: DataFrame) -> DataFrame:
    """Observed patterns (pattern_signature, times_observed, confidence_score) merged with a batch (pattern_signature, confidence_score, seq).

    Each observation adds one and halves the distance of the confidence to its own; several of one batch are folded in order of seq.
    """
    w = Window.partitionBy("pattern_signature").orderBy("seq")
    # folding c -> (c + x) / 2 over x1..xn gives c / 2^n + sum of xi / 2^(n - i + 1)
    ranked = new.withColumn("_i", F.row_number().over(w)).withColumn("_k", F.count("*").over(Window.partitionBy("pattern_signature")))
    term = F.col("confidence_score") / F.pow(F.lit(2.0), F.col("_k") - F.col("_i") + 1)
    lead = F.max(F.when(F.col("_i") == 1, F.col("confidence_score")))
    batch = ranked.groupBy("pattern_signature").agg(F.count("*").alias("times_observed"), F.sum(term).alias("_terms"), lead.alias("_first"))
    shape = batch.select("pattern_signature", "times_observed", F.col("_terms").alias("confidence_score"), "_first")
    wide = target.withColumn("_first", F.lit(None).cast("double"))
    merged = upsert(wide, shape, ["pattern_signature"], {
        "times_observed": lambda o, n: o + n,
        "confidence_score": lambda o, n: o / F.pow(F.lit(2.0), F.col("n.times_observed")) + n,
    })
    # a new pattern starts at its first observation: the missing old part is first / 2^k
    start = F.col("_first") / F.pow(F.lit(2.0), F.col("times_observed"))
    fresh = merged.join(target.select("pattern_signature").distinct().withColumn("_old", F.lit(True)), "pattern_signature", "left")
    return fresh.withColumn("confidence_score", F.round(F.when(F.col("_old"), F.col("confidence_score")).otherwise(F.col("confidence_score") + start), 6)).drop("_first", "_old")


def active_directives(directives: DataFrame, tables: DataFrame) -> DataFrame:
    """Active directives with the tables that their pattern fits, as one text."""
    from tidemark.operators.joins import pattern_join

    fits = pattern_join(tables.select("table_name"), directives.filter("is_active"), "table_name", "source_table_pattern")
    return fits.groupBy("directive_id", "target_layer", "priority").agg(F.count("*").alias("tables"), F.array_join(F.sort_array(F.collect_set("table_name")), ", ").alias("matched_tables"))


def run_dashboard(executions: DataFrame, now: str) -> DataFrame:
    """Runs with the numbers of their JSON outputs, and seconds from start to end (or now)."""
    from tidemark.functions.timeutil import second_diff

    out = lambda c, k: F.try_variant_get(F.try_parse_json(c), f"$.{k}", "long")
    end = F.coalesce("completed_at", F.lit(now).cast("timestamp_ntz"))
    counts = {"tables_triggered": ("planner_output", "tables_planned"), "executions_succeeded": ("executor_output", "success_count"), "executions_failed": ("executor_output", "fail_count"), "validations_passed": ("validator_output", "passed_count"), "validations_failed": ("validator_output", "failed_count"), "learnings_captured": ("reflector_output", "learnings_count")}
    return executions.withColumn("_end", end).select("execution_id", "workflow_name", "trigger_type", "status", "current_phase", *(out(*v).alias(k) for k, v in counts.items()), "retry_count", second_diff("started_at", "_end").cast("long").alias("duration_seconds"), "started_at", "completed_at", "last_error")


#: Levels of an approximated component on either side of zero, and vectors and queries that a task compares.
LEVELS, VECTORS, QUERIES = 127, 65_536, 4_096


def approximated(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, code, scale, error): vectors of length one with a byte for each component (code times scale), and the length of what that leaves out. A vector
    without a length has no code; it is similar to none."""
    rows = vectors.select("vec_id", unit("embedding").alias("_v"))
    top = F.array_max(F.transform("_v", F.abs))
    rows = rows.withColumn("scale", top / LEVELS).withColumn("code", F.transform("_v", lambda x: F.round(x / F.col("scale")).cast("tinyint")))
    left = F.zip_with("_v", "code", lambda x, c: x - c * F.col("scale"))
    return rows.select("vec_id", F.size("_v").alias("dim"), "code", "scale", F.sqrt(F.aggregate(left, F.lit(0.0), lambda s, e: s + e * e)).alias("error"))


def _survivors(k: int):
    """Of a piece of approximated vectors, those that can be among the k best of each query of a block: (query_id, vec_id, low, high). Zero vectors count as -2."""

    def matrix(t: pa.Table, name: str) -> np.ndarray:
        flat = t.column(name).combine_chunks()
        return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            ids, sizes = left.column("vec_id").to_numpy(), left.column("dim").fill_null(0).to_numpy()
            asked, asked_sizes = right.column("query_id").to_numpy(), right.column("query_dim").fill_null(0).to_numpy()
            for size in np.unique(asked_sizes):
                same, who = np.flatnonzero(sizes == size) if size > 0 else np.empty(0, np.int64), np.flatnonzero(asked_sizes == size)
                if len(same):
                    part = left.take(pa.array(same))
                    codes = matrix(part, "code") * part.column("scale").to_numpy()[:, None]
                    slack = part.column("error").to_numpy() + 2e-6  # the answer is ranked by a rounded cosine
                    q = matrix(right.take(pa.array(who)), "q")
                for n, i in enumerate(who):
                    low, high = np.full(len(ids), -2.0), np.full(len(ids), -2.0)
                    if len(same):
                        near = codes @ q[n]
                        low[same], high[same] = near - slack, near + slack
                    at = np.flatnonzero(ids != asked[i])
                    if len(at) > k:
                        least = np.partition(low[at], len(at) - k)[len(at) - k]
                        at = at[high[at] >= least]
                        zero = at[high[at] == -2.0]
                        at = np.concatenate((at[high[at] > -2.0], zero[np.argsort(ids[zero], kind="stable")][:k]))
                    out.append((np.full(len(at), asked[i]), ids[at], low[at], high[at]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 2 + [np.empty(0)] * 2
        return pa.table(dict(zip(("query_id", "vec_id", "low", "high"), cols)))

    return run


def similar_items(vectors: DataFrame, queries: DataFrame, k: int, vectors_at_once: int = VECTORS, queries_at_once: int = QUERIES, seen: dict | None = None) -> DataFrame:
    """(query_id, vec_id, similarity, rank): the k most similar vectors of each query by cosine, rounded to six digits; ties by vec_id, no similarity last, the query itself left out. Vectors and queries: (vec_id, embedding).

    Exact, by approximation columns: a byte a component gives each cosine up to the length of what the bytes leave out, a query being of length one. A task holds a piece of
    the vectors and a block of the queries, drops what k others surely beat, and of the rest what k others of any piece surely beat goes too; only for the survivors
    are the vectors themselves read and compared. Needs no clusters. Ids are integers. seen, if given, takes "share": exact comparisons as a part of all pairs.
    """
    total, asked = vectors.count(), queries.count()
    pieces, blocks = max(1, -(-total // vectors_at_once)), max(1, -(-asked // queries_at_once))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    unit_of = lambda p, b: (p * blocks + b).cast("long")
    wanted = queries.select(F.col("vec_id").alias("query_id"), unit("embedding").alias("q"))
    left = approximated(vectors).withColumn("_b", spread(blocks)).withColumn("unit", unit_of(F.pmod(F.xxhash64("vec_id"), F.lit(pieces)), F.col("_b"))).drop("_b")
    right = wanted.withColumn("query_dim", F.size("q")).withColumn("_p", spread(pieces)).withColumn("asked", unit_of(F.col("_p"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)))).drop("_p")
    near = written(left.groupBy("unit").cogroup(right.groupBy("asked")).applyInArrow(_survivors(k), "query_id long, vec_id long, low double, high double"))
    by_low = Window.partitionBy("query_id").orderBy(F.desc("low"), "vec_id")
    least = near.withColumn("n", F.row_number().over(by_low)).filter(F.col("n") <= k).groupBy("query_id").agg(F.min("low").alias("least"))
    pairs = written(near.join(least, "query_id").filter("high >= least").select("query_id", "vec_id").distinct())
    if seen is not None:
        seen["share"] = pairs.count() / max(1, total * asked)
    exact = pairs.join(vectors.select("vec_id", unit("embedding").alias("_v")), "vec_id").join(wanted.distinct(), "query_id")
    best = Window.partitionBy("query_id").orderBy(F.col("similarity").desc_nulls_last(), "vec_id")
    scored = exact.select("query_id", "vec_id", F.round(dot("_v", "q"), 6).alias("similarity"))
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
