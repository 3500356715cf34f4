"""Near-duplicates by the Jaccard index of word shingles: SimHash in sharded BK-trees and MinHash find candidates, the whole sets decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.common import blocks, runs, staged, with_hot
from tidemark.llm.graph import classes, components
from tidemark.llm.lines import BLOCK_CHARS, _hashed, _mix, _sorted, has_slot, sieve_of

SHINGLE = 5
SIMILARITY = 0.8
#: Two sets of Jaccard index j agree on a whole band with 1 - (1 - j^4)^32: at 0.8, all but 5 pairs of 100 million do.
BANDS, ROWS = 32, 4
#: Members of a group that one task compares; a larger group is compared in pairs of parts.
GROUP_MOST = 256

_BASE = 0x9E3779B97F4A7C15
_SCALE, _SHIFT = np.random.default_rng(3).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
_SCALE |= np.uint64(1)


def shingled(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of lower-cased words, sorted within each text; where each text's begin (and the end); a hash of each set.

    A text with fewer words is one shingle; one without words has none.
    """
    lines = np.repeat(np.arange(len(texts)), [t.count("\n") + 1 for t in texts])
    word, line = _hashed(texts)
    owner, n = lines[line], len(word)
    many = np.bincount(owner, minlength=len(texts))
    place = np.arange(n) - np.concatenate([[0], np.cumsum(many)])[owner]
    with np.errstate(over="ignore"):
        sums = np.zeros(n, np.uint64)
        for k in range(min(size, n)):
            sums[: n - k] += np.where(owner[k:] == owner[: n - k], word[k:] * np.uint64(pow(_BASE, k, 1 << 64)), np.uint64(0))
        start = place <= np.maximum(many[owner] - size, 0)
        h, owner = _mix(sums[start]), owner[start]
        order = _sorted(owner, None, h)
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
        first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
        total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(h + np.uint64(0x51)), dtype=np.uint64)])
        sid = _mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)
    return h, first, sid


def bands(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A key for each band of each set; sets begin at `starts` and none is empty."""
    out = np.empty((len(starts), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(BANDS):
            key = np.full(len(starts), j + 1, np.uint64)
            for i in range(j * ROWS, (j + 1) * ROWS):
                key = _mix(key * np.uint64(_BASE) + np.minimum.reduceat(h * _SCALE[i] + _SHIFT[i], starts))
            out[:, j] = key
    return out.view(np.int64)


def _mark(size: int):
    """(doc_id, sid, fp, bands) of every row; a task sends the bands of a set once, and none of an empty one. fp: the SimHash fingerprint of op3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for b in batches:
            for s, e in blocks(_lengths(b.column(1)), BLOCK_CHARS):
                texts = [t or "" for t in b.column(1).slice(s, e - s).to_pylist()]
                h, first, sid = shingled(texts, size)
                full = np.flatnonzero(np.diff(first))
                keys: list[np.ndarray | None] = [None] * (e - s)
                if len(full):
                    for i, k in zip(full.tolist(), bands(h, first[full])):
                        if sid[i] not in sent:
                            if len(sent) < 100_000:
                                sent.add(sid[i])
                            keys[i] = k
                fp = np.fromiter(map(simhash.fingerprint, texts), np.uint64, len(texts)).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), pa.array(sid), pa.array(fp), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "sid", "fp", "bands"])

    return run


def _lengths(texts: pa.Array) -> list[int]:
    return pc.fill_null(pc.utf8_length(texts), 0).to_pylist()


def _groups(batches: Iterator[pa.RecordBatch], made) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column, dealt whole groups at a time to made(rows), which gives the columns of a table or nothing."""
    rest = None
    for b in batches:
        rows = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)])
        rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
        cut = np.searchsorted(rows[0], rows[0][-1]) if rows.shape[1] else 0  # the last group may go on
        rest = rows[:, cut:]
        if cut:
            yield from made(rows[:, :cut])
    if rest is not None and rest.shape[1]:
        yield from made(rest)


def _batch(names: list[str], cols: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by band and sid to (band, sid, lead): sets that share a band with another, beside the first of it."""

    def made(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
        band, sid = rows[:, new]
        a, b = runs(band)
        keep = np.repeat(b - a > 1, b - a)
        yield _batch(["band", "sid", "lead"], [band[keep], sid[keep], np.repeat(sid[a], b - a)[keep]])

    return _groups(batches, made)


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band, sid, root) sorted by band and sid to (team, sid, root) of bands of three or more sets that links do not join yet. Equal teams have one name."""

    def made(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, sid, root = rows
        for a, b in zip(*runs(rows[0])):
            if b - a > 2 and (root[a:b] != root[a]).any():
                team = int.from_bytes(hashlib.blake2b(sid[a:b].tobytes(), digest_size=8).digest(), "little", signed=True)
                yield _batch(["team", "sid", "root"], [np.full(b - a, team), sid[a:b], root[a:b]])

    return _groups(batches, made)


def _wanted(sieve: np.ndarray, size: int):
    """(sid, words): the sets whose slot of the sieve is set, each once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for b in batches:
            for s, e in blocks(_lengths(b.column(0)), BLOCK_CHARS):
                h, first, sid = shingled([t or "" for t in b.column(0).slice(s, e - s).to_pylist()], size)
                out = {}
                for i in np.flatnonzero(has_slot(sieve, sid) & (np.diff(first) > 0)).tolist():
                    if sid[i] not in sent:
                        if len(sent) < 100_000:
                            sent.add(sid[i])
                        out[int(sid[i])] = h[first[i] : first[i + 1]].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.binary())], names=["sid", "words"])

    return run


def spanning_links(members: list[tuple], similarity: float, across: bool) -> list[tuple[int, int]]:
    """Links that join what is similar of members (sid, root, part, set), one for each merge; equal roots are joined already. With across, only pairs of different parts count."""
    parent = {m[1]: m[1] for m in members}

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, (sid, root, part, x) in enumerate(members):
        for other, its, there, y in members[:i]:
            if across and part == there:
                continue
            small, large = min(len(x), len(y)), max(len(x), len(y))
            if small < similarity * large - 1e-9 or top(root) == top(its):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both >= similarity * (len(x) + len(y) - both) - 1e-9:
                parent[top(root)] = top(its)
                out.append((other, sid))
    return out


def _link(similarity: float):
    """Rows sorted by team and pair of parts to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, out = None, [], []

        def batch() -> pa.RecordBatch:
            got = np.array(out, np.int64).reshape(-1, 2)
            out.clear()
            return _batch(["a", "b"], [got[:, 0], got[:, 1]])

        for b in batches:
            for team, lo, hi, part, sid, root, words in zip(*(b.column(i).to_pylist() for i in range(7))):
                if (team, lo, hi) != at:
                    out.extend(spanning_links(held, similarity, at is not None and at[1] != at[2]))
                    at, held = (team, lo, hi), []
                held.append((sid, root, part, np.frombuffer(words, np.uint64)))
            yield batch()
        out.extend(spanning_links(held, similarity, at is not None and at[1] != at[2]))
        yield batch()

    return run


def _compared(teams: DataFrame, sets: DataFrame, similarity: float, most: int) -> DataFrame:
    """(a, b): links between the similar sets of each team, of (team, sid, root)."""
    parts = F.ceil(F.col("size") / most)
    members = teams.join(teams.groupBy("team").agg(F.count("*").alias("size")), "team").join(sets, "sid")
    members = members.withColumn("part", F.pmod(F.xxhash64("sid"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    members = members.select("team", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "sid", "root", "words")
    dealt = members.repartition("team", "lo", "hi").sortWithinPartitions("team", "lo", "hi", "sid")
    return staged(dealt.mapInArrow(_link(similarity), "a long, b long").distinct(), "similar")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, group_most: int = GROUP_MOST) -> DataFrame:
    """(doc_id, component_id) for every row of docs, with documents linked whose shingle sets have a Jaccard index of `similarity` or more.

    Equal sets are one node. Candidates are the sets whose fingerprints the BK-trees of op3 link or that are equal, and those that share a MinHash band: a pair at the
    least similarity often differs in more bits than the trees' radius. Either way they form a band, and no link is made without the whole sets: first, each set of a band is held against the
    band's first; then all pairs of the sets of a band that links do not join yet, a large band in pairs of parts. component_id is the smallest doc_id that links
    reach. Texts without words are equal. Repeated rows stay, each with the same result; a null doc_id counts for no minimum; an empty table gives none.
    """
    whole = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marks = staged(whole.mapInArrow(_mark(size), "doc_id long, sid long, fp long, bands array<long>"), "marks")
    digests = staged(marks.select("fp", "sid").distinct(), "digests")
    close = simhash.near_links(digests.select("fp").distinct()).select(F.xxhash64("a", "b", F.lit("fp")).alias("band"), F.explode(F.array("a", "b")).alias("fp"))
    by_link = close.join(digests.groupBy("fp").agg(F.min("sid").alias("sid")), "fp").select("band", "sid")  # a pair for each link of the trees
    by_digest = digests.select(F.xxhash64("fp", F.lit("fp")).alias("band"), "sid").union(by_link)
    dealt = marks.select(F.explode("bands").alias("band"), "sid").union(by_digest).repartition("band").sortWithinPartitions("band", "sid")
    shared = staged(dealt.mapInArrow(_shared, "band long, sid long, lead long"), "bands")
    needed = shared.select("sid").distinct()
    sets = whole.select("text").mapInArrow(_wanted(sieve_of(needed), size), "sid long, words binary").join(needed, "sid", "left_semi")
    sets = staged(sets.groupBy("sid").agg(F.first("words").alias("words")), "sets")

    pairs = shared.filter("sid <> lead").select("lead", "sid").distinct().withColumn("team", F.xxhash64("lead", "sid"))
    pairs = pairs.select("team", F.explode(F.array("lead", "sid")).alias("sid")).withColumn("root", F.col("sid"))
    links = _compared(pairs, sets, similarity, group_most)
    roots = staged(components(links), "roots")
    joined = shared.join(roots, shared.sid == roots.node, "left").select("band", "sid", F.coalesce("root", "sid").alias("root"))
    teams = joined.repartition("band").sortWithinPartitions("band", "sid").mapInArrow(_open, "team long, sid long, root long")
    teams = staged(teams.distinct(), "teams")
    if not teams.isEmpty():
        links = links.union(_compared(teams, sets, similarity, group_most))

    nodes = staged(marks.groupBy(F.col("sid").alias("key")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "nodes")
    found = staged(classes(nodes, links).withColumnRenamed("key", "sid"), "classes")
    return with_hot(marks.select("doc_id", "sid"), found, ["sid"], marks.count()).select("doc_id", "component_id")
