"""Hard negatives: rows of another label whose score lies in a window below a positive's, mined from disjoint slots of scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import HOT_PART, staged, table
from tidemark.llm.knn import quantized

#: Rows of a data piece and anchors of a block that one task holds.
PIECE, BLOCK = 16384, 2048


def first(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first; ties by place."""
    at = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        at = np.concatenate((above, np.flatnonzero(scores == least)[: k - len(above)]))
    return at[np.lexsort((at, -scores[at]))]


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    flat = lists.combine_chunks()
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(flat), -1)


def _scored(left: pa.Table, right: pa.Table):
    """Rows of a piece by id, and for each anchor of a block its place and its scores with all of them; ids of neither side may be its own."""
    left = left.take(pc.sort_indices(left, sort_keys=[("vec_id", "ascending")]))
    x, q, ids, own = _matrix(left.column("v")), _matrix(right.column("q")), left.column("vec_id").to_numpy(), right.column("anchor_id").to_numpy()
    for at in range(0, len(q), 256):
        scores = (q[at : at + 256] @ x.T).astype(np.int64)
        for i, s in enumerate(scores):
            yield at + i, own[at + i], left, ids, s


def _best(k: int):
    """The k best other rows of a piece for each anchor of a block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            for _, own, _, ids, s in _scored(left, right):
                at = np.flatnonzero(ids != own)
                at = at[first(s[at], k)]
                found.append((np.full(len(at), own), ids[at], s[at]))
        a, b, c = (np.concatenate(x) if found else np.empty(0, np.int64) for x in (zip(*found) if found else ((), (), ())))
        return pa.table({"anchor_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.int64())})

    return run


def _slotted(k: int):
    """The combiner: for each anchor of a block, the k best rows of another label that a piece has in each slot of its scores.

    `uppers` falls; slot i holds the scores up to its i-th value and above the next, the last one those down to `least`.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            label, uppers = right.column("anchor_label").to_pylist(), right.column("uppers").to_pylist()
            least = right.column("least").to_numpy()
            others = None
            for i, own, rows, ids, s in _scored(left, right):
                others = rows.column("label").to_numpy() if others is None else others
                at = np.flatnonzero((others != label[i]) & (ids != own) & (s <= uppers[i][0]) & (s >= least[i]))
                rising = np.array(uppers[i][::-1], np.int64)
                slot = len(rising) - 1 - np.searchsorted(rising, s[at], side="left")
                for j in np.unique(slot):
                    some = at[slot == j]
                    some = some[first(s[some], k)]
                    found.append((np.full(len(some), own), np.full(len(some), j), ids[some], s[some]))
        cols = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 4
        return pa.table({n: pa.array(c, pa.int32() if n == "slot" else pa.int64()) for n, c in zip(("anchor_id", "slot", "negative_id", "score"), cols)})

    return run


def _units(data: DataFrame, asks: DataFrame, on: list[str], piece: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt to units of one piece of a group's data and one block of its anchors. A group is cut by size, so a hot one makes more units, not larger ones.

    Groups with more than one row in HOT_PART reach the rows by broadcast (there are fewer than that), the others by a join.
    """
    loads = asks.groupBy(*on).agg(F.ceil(F.count("*") / block).alias("blocks")).join(data.groupBy(*on).agg(F.count("*").alias("n")), on)
    total = data.agg(F.count("*").alias("total"))
    sized = staged(loads.withColumn("pieces", F.ceil(F.col("n") / piece)).crossJoin(F.broadcast(total)), "loads")  # one row
    hot = F.col("n") > F.col("total") / HOT_PART
    hot_loads, cold_loads = (sized.filter(c).select(*on, "pieces", "blocks") for c in (hot, ~hot))

    def loaded(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(hot_loads), on).unionByName(rows.join(F.broadcast(hot_loads), on, "left_anti").join(cold_loads, on))

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    unit = F.concat_ws(":", *on, "piece", "block")
    left = loaded(data).withColumn("piece", F.pmod(F.xxhash64("vec_id"), "pieces")).withColumn("block", all_of("blocks"))
    right = loaded(asks).withColumn("block", F.pmod(F.xxhash64("anchor_id"), "blocks")).withColumn("piece", all_of("pieces"))
    return left.select(unit.alias("unit"), "vec_id", "label", "v"), right.select(unit.alias("asked_unit"), *[c for c in asks.columns if c not in ("dim", "label")])


def hard_negatives(vectors: DataFrame, anchors: Column, label: Column | None = None, positives: int = 5, k: int = 10, low: int = 30, high: int = 90, scale: int = 256, piece: int = PIECE, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (a condition on vec_id) and each of its `positives` best rows of
    the same label, the first k rows of other labels that score from low to high percent of the positive.

    label: the label to use, `label` itself if not given. Scores are inner products of floor(scale * x), exact while below 2^53; higher come first, ties by smaller
    vec_id. The upper limits of an anchor's positives cut its scores into disjoint slots. Each piece of the data keeps the k best of each slot; so does their union;
    and the slots from a positive's own one downwards, merged in falling order, answer its window, however windows overlap.
    Rows with a null id, label or vector, or with null or non-finite components, take no part; repeated rows count once, and of different rows of one id the least
    (by label, then vector) does. Vectors of different lengths do not meet. A positive without a positive score has an empty window, or scores of 0 for a score of 0.
    """
    label = F.col("label") if label is None else label
    labelled = vectors.select("vec_id", "embedding", label.cast("long").alias("label")).filter("label is not null")
    sound = quantized(labelled, scale, keep=("label",))
    rows = staged(sound.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", F.col("r.label").alias("label"), F.size("r.v").alias("dim"), F.col("r.v").alias("v")), "labelled")
    asked = staged(rows.filter(anchors).select(F.col("vec_id").alias("anchor_id"), F.col("label"), "dim", F.col("v").alias("q")), "anchors")

    left, right = _units(rows, asked, ["dim", "label"], piece, block)
    near = left.groupBy("unit").cogroup(right.groupBy("asked_unit")).applyInArrow(_best(positives), "anchor_id long, vec_id long, score long")
    of_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = near.withColumn("n", F.row_number().over(of_anchor)).filter((F.col("n") <= positives) & (F.col("score") >= 0))
    upper = F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100")
    chosen = staged(chosen.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), upper.alias("upper")), "positives")

    limits = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_set("upper"), asc=False).alias("uppers"), F.expr(f"min((positive_score * {low} + 99) div 100)").alias("least"))
    seekers = staged(asked.join(limits, "anchor_id").withColumnRenamed("label", "anchor_label"), "seekers")
    left, right = _units(rows, seekers, ["dim"], piece, block)
    combined = left.groupBy("unit").cogroup(right.groupBy("asked_unit")).applyInArrow(_slotted(k), "anchor_id long, slot int, negative_id long, score long")
    of_slot = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "negative_id")
    top = combined.withColumn("n", F.row_number().over(of_slot)).filter(F.col("n") <= k)
    entry = F.struct((-F.col("score")).alias("s"), F.col("negative_id").alias("negative_id"))
    slots = top.groupBy("anchor_id", "slot").agg(F.sort_array(F.collect_list(entry)).alias("best")).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "best"))).alias("slots"))

    wide = chosen.join(limits, "anchor_id").join(slots, "anchor_id")
    own = F.array_position("uppers", F.col("upper")).cast("int") - 1
    below = F.flatten(F.filter(F.transform(F.sequence(own, F.size("uppers") - 1), lambda i: F.try_element_at("slots", i)), lambda x: x.isNotNull()))
    answers = wide.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(below, 1, k)).alias("at", "b"))
    return answers.filter(-F.col("b.s") * 100 >= F.col("positive_score") * low).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("b.negative_id").alias("negative_id"), "positive_score", (-F.col("b.s")).alias("negative_score")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 100; ids divisible by 7 get the next of ten labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, d.vec_id AS other_id, a.label = d.label AS same, CAST(list_dot_product(a.v, d.v) AS BIGINT) AS score
  FROM e a JOIN e d ON a.vec_id <> d.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""
