"""Exact top-k search by inner product: a Voronoi join with bounds from cell summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

#: There are about as many pivots as the square root of the number of vectors, but no more than the driver can hold; rows of a data piece and queries of a block that one task holds.
PIVOTS, PIECE, BLOCK = 4096, 4096, 2048


def _vectors(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(col), -1)


def quantized(vectors: DataFrame, scale: int = 256, keep: tuple[str, ...] = ()) -> DataFrame:
    """(vec_id, kept columns, v): floor(scale * x) of each component. Null vectors, and those with null or non-finite components, take no part; repeated rows count once."""
    x = F.col("embedding").cast("array<double>")
    sound = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long"), *keep, "embedding").filter(sound & F.col("vec_id").isNotNull()).select("vec_id", *keep, F.transform(x, lambda e: F.floor(e * scale)).alias("v")).distinct()


def _nearest(pivots: dict[int, np.ndarray]):
    """Adds the cell (the nearest pivot of the vector's length) and the distance to its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            n = t.column("dim").to_numpy()
            for d in np.unique(n):
                part = t.filter(pa.array(n == d))
                x, p = _vectors(part.column("v")), pivots[int(d)]
                cell, dist = np.empty(len(x), np.int64), np.empty(len(x))
                for at in range(0, len(x), 1024):
                    some = x[at : at + 1024]
                    near = ((p * p).sum(1)[None] - 2 * some @ p.T).argmin(1)
                    cell[at : at + 1024], dist[at : at + 1024] = near, np.sqrt(((some - p[near]) ** 2).sum(1))
                part = part.append_column("cell", pa.array(cell)).append_column("dist", pa.array(dist))
                yield from part.to_batches()

    return run


def _routed(pivots: dict[int, np.ndarray], radius: dict[int, np.ndarray], later: bool):
    """Queries to the cells they go to: at first the one with the best pivot; later, with `least` to reach, all others that can hold such a score.

    For x within r of pivot p, q.x is q.p + |q| r at most. radius is -1 for a cell without rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            n = t.column("dim").to_numpy()
            for d in np.unique(n):
                if int(d) not in pivots:  # no vectors of that length
                    continue
                part = t.filter(pa.array(n == d))
                q, p, r = _vectors(part.column("v")), pivots[int(d)], radius[int(d)]
                for at in range(0, len(q), 1024):
                    some = q[at : at + 1024]
                    mid = some @ p.T
                    home = np.where(r >= 0, mid, -np.inf).argmax(1)
                    if later:
                        least = part.column("least").to_numpy(zero_copy_only=False)[at : at + 1024]
                        norm = np.sqrt((some * some).sum(1))[:, None]
                        top = mid + norm * r
                        ok = (r >= 0) & (top + 1e-9 * (np.abs(mid) + norm * r) + 1e-6 >= np.where(np.isnan(least), -np.inf, least)[:, None])
                        ok[np.arange(len(some)), home] = False
                        who, cell = np.nonzero(ok)
                    else:
                        who, cell = np.arange(len(some)), home
                    got = part.slice(at, 1024).select(["dim", "query_key", "v"]).take(pa.array(who))
                    yield from got.append_column("cell", pa.array(cell.astype(np.int64))).to_batches()

    return run


def _solve(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Data piece and query block to the best k rows for each query."""
        found: list[np.ndarray] = []
        if left.num_rows and right.num_rows:
            left = left.take(pc.sort_indices(left, sort_keys=[("first_id", "ascending")]))
            x, q, ids = _vectors(left.column("v")), _vectors(right.column("q")), left.column("ids").to_pylist()
            keys = right.column("query_key").to_numpy()
            for at in range(0, len(q), 256):
                s = q[at : at + 256] @ x.T
                n = s.shape[1]
                least = np.partition(s, n - k, axis=1)[:, n - k] if n > k else np.full(len(s), -np.inf)
                for i in range(len(s)):
                    hit = np.flatnonzero(s[i] >= least[i])
                    hit = hit[np.argsort(-s[i][hit], kind="stable")][:k]
                    rows = [(-int(s[i][j]), v) for j in hit for v in ids[j]]
                    found += [(keys[at + i], v, -m) for m, v in sorted(rows)[:k]]
        a = np.array(found, np.int64).reshape(-1, 3)
        return pa.table({"query_key": a[:, 0], "vec_id": a[:, 1], "score": a[:, 2]})

    return run


def _local(routes: DataFrame, celled: DataFrame, shape: DataFrame, k: int, piece: int, block: int) -> DataFrame:
    """(query_key, vec_id, score): the best k of each query in each piece of the cells it goes to. A cell's rows are dealt to pieces, its queries to blocks; a task holds one of each."""
    load = routes.groupBy("dim", "cell").agg(F.ceil(F.count("*") / block).alias("blocks")).join(shape, ["dim", "cell"]).select("dim", "cell", "blocks", F.ceil(F.col("n") / piece).alias("pieces"))
    unit, load = ["dim", "cell", "block", "piece"], F.broadcast(load)  # a row for each cell: at most as many as pivots
    left = celled.join(load, ["dim", "cell"]).withColumn("piece", F.pmod(F.xxhash64("first_id"), "pieces")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    right = routes.join(load, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("query_key"), "blocks")).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    left = left.select(F.concat_ws(":", *unit).alias("unit"), "first_id", "ids", "v")
    right = right.select(F.concat_ws(":", *unit).alias("asked_unit"), "query_key", F.col("v").alias("q"))
    return left.groupBy("unit").cogroup(right.groupBy("asked_unit")).applyInArrow(_solve(k), "query_key long, vec_id long, score long")


def top_k(vectors: DataFrame, asks, k: int = 5, scale: int = 256, pivots: int = PIVOTS, piece: int = PIECE, block: int = BLOCK, seen: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that `asks` (a condition on vec_id) selects, the k other rows with the largest inner product.

    Equal vectors are one, with the k + 1 smallest ids that any answer can use, so copies of a vector make no large cell. Data go to the cells of sampled pivots.
    Each distinct query is first solved in the cell of its best pivot; the score that it then has in k-th place and the radius of each other cell decide to which
    of these it is copied as well. Ties go to the smaller vec_id. Vectors are compared with those of their own length only. Scores are exact while |v|^2 stays below
    2^53. An empty table gives no rows. seen, if given, takes "share": compared pairs as a part of all pairs of a query and a vector.
    """
    more = k + 1
    rows = staged(quantized(vectors, scale), "vectors")
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("n") <= more)
    data = staged(ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.size("v").alias("dim"), F.col("ids")[0].alias("first_id"), "ids", "v"), "distinct")
    queries = rows.filter(asks)
    distinct = staged(queries.groupBy("v").agg(F.min("vec_id").alias("query_key")).select(F.size("v").alias("dim"), "query_key", "v"), "queries")

    spots = {}
    for r in data.groupBy("dim").agg(F.count("*").alias("n")).collect():
        chosen = data.filter(F.col("dim") == r.dim).orderBy(F.xxhash64("first_id"), "first_id").select("v").limit(min(pivots, max(1, int(r.n**0.5))))
        spots[r.dim] = np.array([x.v for x in chosen.collect()], np.float64).reshape(-1, r.dim)
    celled = staged(data.mapInArrow(_nearest(spots), "dim int, first_id long, ids array<long>, v array<long>, cell long, dist double"), "cells")
    shape = staged(celled.groupBy("dim", "cell").agg(F.max("dist").alias("r"), F.count("*").alias("n")), "shape")
    radius = {d: np.full(len(p), -1.0) for d, p in spots.items()}
    for r in shape.collect():
        radius[r.dim][r.cell] = r.r
    route = "dim int, query_key long, v array<long>, cell long"
    first = staged(distinct.mapInArrow(_routed(spots, radius, False), route), "first")
    near = staged(_local(first, celled, shape, more, piece, block), "near")
    best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= more).drop("n")
    least = near.groupBy("query_key").agg(F.min("score").alias("least"), F.count("*").alias("n")).select("query_key", F.when(F.col("n") >= more, F.col("least")).cast("double").alias("least"))
    others = staged(distinct.join(least, "query_key", "left").mapInArrow(_routed(spots, radius, True), route), "others")
    if seen is not None:
        pairs = first.select("dim", "cell").unionByName(others.select("dim", "cell")).join(F.broadcast(shape), ["dim", "cell"]).agg(F.sum("n").alias("n")).first().n or 0
        seen["share"] = pairs / max(1, data.count() * distinct.count())
    local = near.unionByName(_local(others, celled, shape, more, piece, block))
    answers = local.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= more).drop("n")
    named = queries.join(distinct.select("v", "query_key"), "v").select(F.col("vec_id").alias("query_id"), "query_key")
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = named.join(answers, "query_key").filter("vec_id <> query_id").withColumn("rank", F.row_number().over(of_query))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e q JOIN e d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""
