"""Benchmark decontamination: q-gram counts in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, filtered, table

Q = 10
#: Edits allowed, as a part of the item's length; less where the lemma would leave no shared q-gram.
BUDGET = 0.06
#: Characters of benchmark text in one index, which goes to every task; a larger benchmark is dealt to several indexes, one after another.
INDEX_CHARS = 8_000_000
BLOCK_CHARS = 1_000_000
#: Pairs of a gram in a text and its places in items that are looked at together; a gram that very many items hold makes more steps, not more memory.
EXPANDED = 2_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SLOTS = 22


def normal(text: str | None) -> str:
    """Lower case, with one space for each run of white space."""
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(x: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters from each position on."""
    if len(x) < q:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h, width, power = x.astype(np.uint64) + np.uint64(1), 1, BASE
        out, done, scale = None, 0, np.uint64(1)
        while True:
            if q >> (width.bit_length() - 1) & 1:
                part = h[done : len(x) - q + 1 + done] * scale
                out = part if out is None else out + part
                done += width
                scale = scale * power
            if done == q:
                break
            h = h[:-width] + power * h[width:]
            width, power = 2 * width, power * power
        out = out * np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))


@dataclass
class Index:
    items: list[tuple[int, str]]
    budget: np.ndarray
    least: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    known: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]], q: int = Q, budget: float = BUDGET) -> "Index":
        items = sorted(((i, t) for i, t in {(i, normal(t)) for i, t in rows} if t), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        size = np.array([len(t) for _, t in items], np.int64)
        k = np.maximum(0, np.minimum((budget * size).astype(np.int64), (size - q) // q))
        h, item, place = [], [], []
        for n, (_, t) in enumerate(items):
            g = gram_hashes(codes(t), q)
            h.append(g)
            item.append(np.full(len(g), n))
            place.append(np.arange(len(g)))
        h, item, place = (np.concatenate([np.zeros(0, np.uint64), *h]), *(np.concatenate([np.zeros(0, np.int64), *x]) for x in (item, place)))
        order = np.argsort(h, kind="stable")
        grams, first = np.unique(h[order], return_index=True)
        known = np.zeros(1 << SLOTS, bool)
        known[grams >> np.uint64(64 - SLOTS)] = True
        return cls(items, k, size + 1 - q - k * q, grams, np.append(first, len(h)), item[order], place[order], known)


def align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int]:
    """Fewest edits that turn the pattern into a stretch of text that starts at low to high, and the stretch's end; (most + 1, 0) if over `most`.

    The table holds the diagonals from low - most to high + most only.
    """
    none = most + 1
    shift = low - most
    width = high + most - shift + 1
    steps = np.arange(width)
    at = steps + shift  # text position before which the empty pattern ends
    row = np.where((at >= 0) & (at <= len(text)) & (at >= low) & (at <= high), 0, none).astype(np.int64)
    padded = np.concatenate([np.full(max(0, -shift), 0xFFFFFFFF, np.uint32), text, np.full(max(0, width + len(pattern) + shift - len(text)) + 1, 0xFFFFFFFF, np.uint32)])
    start = max(shift, 0) if shift >= 0 else 0
    for i, c in enumerate(pattern):
        here = padded[start + i : start + i + width]
        new = row + (here != c)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new = np.minimum.accumulate(new - steps) + steps
        row = np.minimum(new, none)
        if row.min() >= none:
            return none, 0
    ends = at + len(pattern)
    row = np.where((ends >= 0) & (ends <= len(text)), row, none)
    best = int(row.argmin())
    return int(row[best]), int(ends[best])


def matches(texts: list[str], index: Index, q: int = Q) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) in normalised texts: stretches within the budget, one for each place of an item."""
    out = []
    for n, (_, t) in enumerate(index.items):
        if len(t) < q:  # shorter than a gram: exact occurrences as whole words
            for i, x in enumerate(texts):
                at = x.find(t)
                while at >= 0:
                    end = at + len(t)
                    if not (t[0].isalnum() and x[at - 1 : at].isalnum() or t[-1].isalnum() and x[end : end + 1].isalnum()):
                        out.append((i, n, at, end, 0))
                    at = x.find(t, end)
    x = codes("\0".join(texts))
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    h = gram_hashes(x, q)
    hit = np.flatnonzero(index.known[h >> np.uint64(64 - SLOTS)])
    slot = np.minimum(np.searchsorted(index.grams, h[hit]), max(0, len(index.grams) - 1))
    same = index.grams[slot] == h[hit] if len(index.grams) else np.zeros(len(hit), bool)
    hit, slot = hit[same], slot[same]
    size = np.array([len(t) for _, t in index.items], np.int64)
    keys, counts, full = np.zeros(0, np.int64), np.zeros(0, np.int64), [np.zeros(0, np.int64)]
    many = index.first[slot + 1] - index.first[slot] if len(slot) else slot
    for s, e in blocks(many.tolist(), EXPANDED):
        n = many[s:e]
        flat = np.repeat(index.first[slot[s:e]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item, diagonal = index.item[flat], np.repeat(hit[s:e], n) - index.place[flat]
        band = diagonal // (2 * index.budget[item] + 1)
        key = (np.concatenate([item, item]) << 41) + np.concatenate([band, band - 1]) + (1 << 40)
        keys, at = np.unique(np.concatenate([keys, key]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, np.ones(len(key), np.int64)]), len(keys)).astype(np.int64)
        item, band = keys >> 41, (keys & ((1 << 41) - 1)) - (1 << 40)
        full.append(keys[counts >= index.least[item]])
        # a band whose last place has passed takes no more grams, and one that is full is known
        open_ = (counts < index.least[item]) & ((band + 2) * (2 * index.budget[item] + 1) + size[item] >= hit[e - 1])
        keys, counts = keys[open_], counts[open_]
    keys = np.unique(np.concatenate(full))
    item = keys >> 41
    done: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for n, j in zip(item.tolist(), ((keys & ((1 << 41) - 1)) - (1 << 40)).tolist()):
        k, t = int(index.budget[n]), index.items[n][1]
        width = 2 * k + 1
        low, high = j * width, (j + 2) * width - 1
        first, last = (int(np.searchsorted(bounds, min(max(p, 0), len(x)), "right")) - 1 for p in (low, high + k))
        for doc in range(first, min(last, len(texts) - 1) + 1):
            a, b = int(bounds[doc]), int(bounds[doc + 1]) - 1
            lo, hi = max(low, a - k) - a, min(high, b) - a
            if hi < lo:
                continue
            inside = texts[doc]
            at = inside.find(t, max(lo - k, 0), max(hi, 0) + len(t) + k)
            if at >= 0:
                found = (at, at + len(t), 0)
            else:
                edits, end = align(codes(t), x[a:b], lo, hi, k)
                if edits > k:
                    continue
                back, length = align(codes(t)[::-1], x[a : a + end][::-1], 0, 0, edits)
                found = (end - length, end, edits)
            near = done.setdefault((doc, n), [])
            clash = [f for f in near if f[0] < found[1] and found[0] < f[1]]
            if all(found[2] < f[2] for f in clash):
                done[doc, n] = [f for f in near if f not in clash] + [found]
    return sorted(out + [(d, n, *f) for (d, n), some in done.items() for f in some])


def _places(text: str) -> list[int]:
    """Position in the text of each character of its normalised form."""
    out: list[int] = []
    for i, c in enumerate(text):
        low = c.lower()
        if c.isspace():
            if out and out[-1] >= 0 and not text[out[-1]].isspace():
                out.append(i)
        else:
            out += [i] * len(low)
    return out


def _find(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ids, out = b.column(1).to_pylist(), b.column(0).to_pylist(), []
            plain = list(map(normal, texts))
            for s, e in blocks([len(t) for t in plain], BLOCK_CHARS):
                for i, n, start, end, edits in matches(plain[s:e], index):
                    where = _places(texts[s + i])
                    out.append((ids[s + i], index.items[n][0], where[start], where[end - 1] + 1, edits))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], names=["doc_id", "item_id", "start", "end", "edits"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, index_chars: int = INDEX_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): stretches of documents within the edit budget of a benchmark item, in code points of the text.

    Case and white space do not count. Whole texts are searched. An item of q characters or more is found if it differs by at most `BUDGET` of its length;
    a shorter one only as it stands, between word boundaries; an empty or null one never. Repeated documents give their rows again, repeated items (of one id) once. The benchmark's size is
    counted first: up to `index_chars` characters make one index, more are dealt by a hash of the id to as many as needed, each searched over all documents.
    """
    found = None
    for index in indexes(benchmark, index_chars):
        got = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("text is not null").mapInArrow(_find(index), "doc_id long, item_id long, start long, end long, edits long")
        found = got if found is None else found.union(got)
    return found


def indexes(benchmark: DataFrame, index_chars: int = INDEX_CHARS) -> Iterator[Index]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // index_chars))
    for p in range(parts):
        yield Index.of([(r.item_id, r.text) for r in rows.filter(F.pmod(F.coalesce(F.xxhash64("item_id"), F.lit(0)), F.lit(parts)) == p).collect()])


def keep_clean(docs: DataFrame, benchmark: DataFrame, index_chars: int = INDEX_CHARS) -> DataFrame:
    """docs without the documents that hold a benchmark item."""

    def without(index: Index):
        def keep(texts: list[str]) -> list[bool]:
            plain, out = list(map(normal, texts)), [True] * len(texts)
            for s, e in blocks([len(t) for t in plain], BLOCK_CHARS):
                for i, *_ in matches(plain[s:e], index):
                    out[s + i] = False
            return out

        return keep

    for index in indexes(benchmark, index_chars):
        docs = filtered(docs, without(index))
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "item_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "edits")
