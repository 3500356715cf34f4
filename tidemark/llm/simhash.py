"""SimHash near-duplicates: sharded BK-trees over 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, columns, runs, staged, with_hot
from tidemark.llm.graph import classes

SHINGLE = 4
RADIUS = 4
#: Bits are dealt to six parts. Four flipped bits spoil four parts at most, so two fingerprints within the radius agree on two whole parts.
PARTS = RADIUS + 2
#: A shard with more fingerprints is dealt again by the bits that its members do not share.
SHARD_MOST = 2048


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of the XXH64 hashes (seed 42) of word shingles; no words: zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - size + 1)
    last = ends[len(words) - n :]
    h = np.fromiter((xxhash.xxh64_intdigest(joined[s : e - 1], 42) for s, e in zip(starts, last)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


class BKTree:
    """Children are keyed by their integer distance to the parent; a search follows the edges within the radius only."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        if len(self.values) == 1:
            return
        at = 0
        while True:
            d = (self.values[at] ^ value).bit_count()
            nxt = self.children[at].get(d)
            if nxt is None:
                self.children[at][d] = len(self.values) - 1
                return
            at = nxt

    def within(self, value: int, radius: int) -> list[int]:
        """Indices of all values within the radius."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            kids = children[at]
            if kids:
                todo += [c for e, c in kids.items() if d - radius <= e <= d + radius]
        return found


def spanning_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what lies within the radius, one for each merge of two groups."""
    tree, parent, links = BKTree(), list(range(len(values))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, v in enumerate(values):
        for j in tree.within(v, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((values[j], v))
        tree.add(v)
    return links


def _masks(used: int) -> list[int]:
    """The bits of each pair of parts, of those that `used` leaves."""
    free = [i for i in range(64) if not used >> i & 1]
    parts = [sum(1 << i for i in free[k::PARTS]) for k in range(PARTS)]
    return [a | b for a, b in combinations(parts, 2)]


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, used, fp) to the shards that the fingerprint belongs to at the next level."""
    for b in batches:
        shard, used, fp = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3))
        for m in np.unique(used):
            at = used == m
            for k, mask in enumerate(_masks(int(m))):
                bits = np.uint64(mask)
                with np.errstate(over="ignore"):
                    key = (shard[at] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)) * np.uint64(0xD6E8FEB86659FD93)
                    key = (key ^ (key >> np.uint64(32)) ^ (fp[at] & bits)) * np.uint64(0xBF58476D1CE4E5B9)
                    key ^= key >> np.uint64(29)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key, np.full(len(key), m | bits, np.uint64), fp[at])], names=["shard", "used", "fp"])


def _link(radius: int, most: int):
    """Rows sorted by shard to links (kind 0), and the rows of shards beyond `most` as they came (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, used, held, over = None, 0, [], False
        out: list[tuple[int, int, int, int]] = []

        def close() -> None:
            if not over and len(held) > 1:
                out.extend((0, a, b, 0) for a, b in spanning_links([v % (1 << 64) for v in held], radius))

        def flush() -> pa.RecordBatch:
            cols = np.array(out, dtype=object).reshape(-1, 4)
            cols = [np.array([x % (1 << 64) for x in cols[:, i]], np.uint64).view(np.int64) for i in range(4)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["kind", "a", "b", "c"])

        for batch in batches:
            keys, masks, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(keys):
                continue
            for s, e in zip(*runs(keys)):
                if e - s == 1 and keys[s] != shard and e < len(keys) and len(held) < 2:  # a shard of one
                    shard, used, held, over = keys[s], masks[s], [int(fps[s])], False
                    continue
                if keys[s] != shard:
                    close()
                    shard, used, held, over = keys[s], masks[s], [], False
                if not over and len(held) + e - s > most and 64 - int(used).bit_count() > PARTS:
                    over = True
                    out.extend((1, int(shard), int(used), v) for v in held)
                    held = []
                if over:
                    out.extend((1, int(shard), int(used), int(v)) for v in fps[s:e])
                else:
                    held.extend(map(int, fps[s:e]))
                if len(out) > 20_000:
                    yield flush()
        close()
        if out:
            yield flush()

    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) of every row of docs; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), size) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def near_links(marks: DataFrame, radius: int = RADIUS, shard_most: int = SHARD_MOST) -> DataFrame:
    """(a, b): links that span what distinct fingerprints (fp) lie within the radius of one another."""
    todo, links = marks.select(F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("used"), "fp"), None
    while True:
        dealt = todo.mapInArrow(_deal, "shard long, used long, fp long").repartition("shard").sortWithinPartitions("shard", "fp")
        got = staged(dealt.mapInArrow(_link(radius, shard_most), "kind long, a long, b long, c long"), "shards")
        found = got.filter("kind = 0").select("a", "b")
        links = found if links is None else links.union(found)
        todo = got.filter("kind = 1").select(F.col("a").alias("shard"), F.col("b").alias("used"), F.col("c").alias("fp"))
        if todo.isEmpty():
            return links


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, shard_most: int = SHARD_MOST) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs, with fingerprints linked at `radius` or fewer differing bits.

    Equal fingerprints are one node. Two fingerprints within the radius agree on two of six parts of their bits, so they meet
    in a shard; each shard's BK-tree gives links that span what it holds, never all pairs. A shard beyond `shard_most` is dealt
    again, by the bits its members do not share yet, until it fits or no bits are left. component_id is the smallest doc_id
    that links reach. Repeated rows stay, each with the same result; a null doc_id counts for no minimum; an empty table gives none.
    The parts are made for the given radius of four.
    """
    if radius > PARTS - 2:
        raise ValueError("parts of the fingerprint allow a radius of four at most")
    marks = staged(fingerprints(docs, size), "marks")
    nodes = staged(marks.groupBy(F.col("fp").alias("key")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "nodes")
    links = near_links(nodes.select(F.col("key").alias("fp")), radius, shard_most)
    found = staged(classes(nodes, links).withColumnRenamed("key", "fp"), "classes")
    return with_hot(marks, found, ["fp"], marks.count()).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, groups=near_duplicates, **how) -> DataFrame:
    """docs without all but one document of each group that `groups` finds: the one with the smallest doc_id stays.

    Of rows that repeat its id and text one stays, the least by a hash of its columns. Different texts under that id all stay: an id alone cannot tell which of them the group
    meant, and none may be lost. Rows without an id all stay as well: nothing can name the one to keep.
    """
    firsts = groups(docs, **how).filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(firsts, "doc_id", "left_semi").select(*columns(docs))
    hashed = [column(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    name = [F.col("doc_id"), F.xxhash64("text").alias("_a"), F.xxhash64(F.lit(1), F.col("text")).alias("_b"), F.col("text").isNull().alias("_none")]
    kept = named.groupBy(*name).agg(F.min_by(F.struct(*columns(docs)), F.xxhash64(*hashed)).alias("_row"))
    return kept.select(*(column(c, "_row") for c in docs.columns)).union(docs.filter("doc_id is null"))


def query(spark, sf_dir: str) -> DataFrame:
    from tidemark.llm.common import table

    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
