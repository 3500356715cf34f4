"""Removal of repeated byte strings: longest-previous-factor arrays over the stretches that can repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, runs, staged

SPAN = 100
#: Each string of SPAN bytes belongs to its anchor, the gram in it with the least hash; equal strings have equal anchors.
GRAM = 36
SLICE = 1 << 20
#: Bytes of context whose suffixes are sorted at once; a group of one anchor beyond GROUP_BYTES is dealt again by more of its bytes.
CHUNK_BYTES, GROUP_BYTES = 1 << 20, 1 << 22
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)


def _rev(raw: bytes) -> int:
    """What tells rows of one id apart: 63 bits of a hash of the whole text."""
    return xxhash.xxh3_64_intdigest(raw) >> 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _slide(x: np.ndarray, width: int, join) -> np.ndarray:
    """join over each stretch of `width`, by doubling; join(left, right, shift) combines neighbours `shift` apart."""
    done, out, at = 1, x, x
    total, shift = None, 0
    while True:
        if width & done:
            part = at[shift : len(x) - width + 1 + shift]
            total = part if total is None else join(total, part, shift)
            shift += done
        if shift == width:
            return total
        at = join(at[:-done], at[done:], done)
        done *= 2


def contexts(raw: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, first start, last start, anchor's place) of stretches of starts that share an anchor; item tells the strings apart."""
    n = len(raw)
    if n < SPAN:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    with np.errstate(over="ignore"):
        byte = _BYTE[raw]
        powers = {}
        g = _mix(_slide(byte, GRAM, lambda a, b, k: a + powers.setdefault(k, np.uint64(pow(int(BASE), k, 1 << 64))) * b))
        low = np.uint64((1 << 24) - 1)
        key = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        anchor = (_slide(key, SPAN - GRAM + 1, lambda a, b, k: np.minimum(a, b)) & low).astype(np.int64)
        start = np.flatnonzero(item[: n - SPAN + 1] == item[SPAN - 1 :])
        if not len(start):
            return contexts(raw[:0], item[:0])
        at = anchor[start]
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
        s = start[new]
        e = start[np.concatenate([new[1:], [True]])]
        p = anchor[s]
        scale = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE)]))
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, INVERSE)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(byte * scale[:-1])])
        c = _mix((sums[e + SPAN] - sums[s]) * back[s] + (p - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        return g[p], c, s, e, p


def _items(ids: list, texts: list) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Blocks of (doc, rev, offset, bytes) with at least SPAN bytes, in order; long texts in slices that share SPAN - 1 bytes."""
    out = []
    for doc, text in zip(ids, texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        rev = _rev(raw)
        out += [(doc, rev, a, raw[a : a + SLICE + SPAN - 1]) for a in range(0, len(raw) - SPAN + 1, SLICE)]
    out.sort(key=lambda x: x[:3])
    for s, e in blocks([len(x[3]) for x in out], SLICE):
        yield out[s:e]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, context, doc, rev, place) of every stretch; place packs start, length and whether an equal context stands earlier in the same block.

    Such stretches are merged; `context` is then their end, and `anchor` spreads them.
    """
    for b in batches:
        for block in _items(b.column(0).to_pylist(), b.column(1).to_pylist()):
            size = [len(x[3]) for x in block]
            raw, item = np.frombuffer(b"".join(x[3] for x in block), np.uint8), np.repeat(np.arange(len(block)), size)
            h, c, s, e, _ = contexts(raw, item)
            if not len(h):
                continue
            of = item[s]
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            doc, rev = (np.array([x[k] for x in block], np.int64)[of] for k in (0, 1))
            begin = s - first[of] + np.array([x[2] for x in block], np.int64)[of]
            order = np.lexsort((np.arange(len(h)), c, h))
            new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])])
            lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
            same = (doc[lead] == doc[order]) & (rev[lead] == rev[order]) & (begin[lead] == begin[order])
            later = np.sort(order[~new & ~same])
            keep = order[new]
            place = lambda at, flag: begin[at] << 8 | np.where(flag, 0, e[at] - s[at]) << 1 | flag
            cols = [h[keep].view(np.int64), c[keep].view(np.int64), doc[keep], rev[keep], place(keep, 0)]
            if len(later):
                end = begin[later] + e[later] - s[later] + SPAN
                base = of[later] << 32
                top = np.maximum.accumulate(end + base) - base
                cut = np.concatenate([[True], (of[later][1:] != of[later][:-1]) | (begin[later][1:] > top[:-1])])
                head, tail = later[cut], top[np.concatenate([cut[1:], [True]])]
                with np.errstate(over="ignore"):
                    spread = _mix(doc[head].astype(np.uint64) * BASE + begin[head].astype(np.uint64)).view(np.int64)
                cols = [np.concatenate(x) for x in zip(cols, [spread, tail, doc[head], rev[head], place(head, 1)])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["anchor", "context", "doc", "rev", "place"])


_NAMES = ["kind", "key", "doc", "rev", "start", "end"]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, context, doc, rev and place to what is covered (kind 0) and to the first of each context of an anchor that has several (kind 1)."""
    held = None  # the last first-of-context, and whether one of the same anchor stood before it
    last = None

    def rows(kind: int, key, doc, rev, start, end) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in (key, doc, rev, start, end))], names=_NAMES)

    for b in batches:
        h, c, doc, rev, place = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        flag = (place & 1).astype(bool)
        if flag.any():
            yield rows(0, h[flag], doc[flag], rev[flag], place[flag] >> 8, c[flag])
        h, c, doc, rev, place = (x[~flag] for x in (h, c, doc, rev, place))
        if not len(h):
            continue
        before = last if last is not None else (~h[0], c[0])
        new = np.concatenate([[h[0] != before[0] or c[0] != before[1]], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        tied = (doc[lead] == doc) & (rev[lead] == rev) & (place[lead] == place)
        if not new[0]:
            run = lead == 0
            tied[run] = (doc[run] == held[1]) & (rev[run] == held[2]) & (place[run] == held[3])
        cover = ~new & ~tied
        start = place[cover] >> 8
        yield rows(0, h[cover], doc[cover], rev[cover], start, start + ((place[cover] >> 1) & 0x7F) + SPAN)
        firsts = [x[new] for x in (h, doc, rev, place)]
        if held is not None:
            firsts = [np.concatenate([[old], x]) for old, x in zip(held, firsts)]
        fh, fd, fr, fp = firsts
        if len(fh):
            after = np.concatenate([fh[1:] == fh[:-1], [False]])
            prior = np.concatenate([[held is not None and held[4]], fh[1:] == fh[:-1]])
            out = (after | prior)[:-1]
            start = fp[:-1][out] >> 8
            yield rows(1, fh[:-1][out], fd[:-1][out], fr[:-1][out], start, start + ((fp[:-1][out] >> 1) & 0x7F))
            held = (fh[-1], fd[-1], fr[-1], fp[-1], bool(prior[-1]))
        last = (h[-1], c[-1])
    if held is not None and held[4]:
        start = held[3] >> 8
        yield rows(1, [held[0]], [held[1]], [held[2]], [start], [start + ((held[3] >> 1) & 0x7F)])


def longest_previous_factors(text: np.ndarray, most: int = 112, least: int = 0) -> np.ndarray:
    """For each place of text (values 0 to 256), the length, up to `most` (7 times a power of two), of the longest string from there that also starts earlier.

    The suffix order comes from ranks of prefixes of doubled length; in it, the nearest neighbours on either side with smaller places hold the longest earlier match.
    Lengths below `least` may come out as 0: a place whose prefix of fewer bytes stands nowhere else is sorted no further, and only neighbours that share one are compared.
    """
    n = len(text)
    x = np.concatenate([text.astype(np.int64), np.zeros(most, np.int64)])
    packed = np.zeros(n + most - 6, np.int64)
    for k in range(7):
        packed = packed << 9 | x[k : n + most - 6 + k]
    width, order, at = 7, np.argsort(packed[:n]), np.arange(n)  # at: the places of the order that are still sorted
    rank = np.zeros(n + most, np.int64)
    here, keys, levels = order, packed[order], []

    def new_rank() -> np.ndarray:
        """Where another prefix begins; a rank is the place of the first of its prefix, so it stays comparable with those that are final."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        rank[here] = (at[new] + 1)[np.cumsum(new) - 1]
        levels.append((width, rank.copy()))
        return new

    new = new_rank()
    while width < most:
        if width < least:
            shared = ~(new & np.append(new[1:], True))
            at = at[shared]
            here = order[at]
        keys = rank[here] * (n + 2) + rank[here + width]
        by = np.argsort(keys)
        here, keys, width = here[by], keys[by], 2 * width
        order[at] = here
        new = new_rank()

    def common(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        length = np.zeros(len(i), np.int64)
        whole = levels[-1][1][i] == levels[-1][1][j]
        for w, r in reversed(levels[:-1]):
            same = r[np.minimum(i + length, n + most - 1)] == r[np.minimum(j + length, n + most - 1)]
            length[same] += w
        a, b = packed[np.minimum(i + length, len(packed) - 1)], packed[np.minimum(j + length, len(packed) - 1)]
        for k in range(6, -1, -1):
            same = (a >> 9 * k) == (b >> 9 * k)
            length[same & ~whole] += 1
        return np.where(whole, most, np.minimum(length, most))

    best, m = np.zeros(n, np.int64), len(here)
    prefix = next((r for w, r in reversed(levels) if w < least), None)
    for way in (-1, 1):
        near = np.arange(m) + way
        todo = np.flatnonzero((near >= 0) & (near < m))
        while True:
            todo = todo[(near[todo] >= 0) & (near[todo] < m)]
            todo = todo[here[near[todo]] > here[todo]]
            if not len(todo):
                break
            near[todo] = near[near[todo]]
        has = (near >= 0) & (near < m)
        i, j = here[has], here[near[has]]
        if prefix is not None:
            same = prefix[i] == prefix[j]
            i, j = i[same], j[same]
        best[i] = np.maximum(best[i], common(i, j))
    return best


def _repeats(rows: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """(doc, rev, start, end) covered in contexts (doc, rev, start, bytes) by strings that start earlier in one of them; a context that came twice is one."""
    rows = sorted(set(rows))
    text = np.zeros(sum(len(r[3]) + 1 for r in rows), np.int64)
    at, out, spots = 0, [], []
    for r in rows:
        text[at : at + len(r[3])] = np.frombuffer(r[3], np.uint8).astype(np.int64) + 1
        spots.append(at)
        at += len(r[3]) + 1
    factor = longest_previous_factors(text, least=SPAN)
    hit = np.flatnonzero(factor >= SPAN)
    if not len(hit):
        return out
    of = np.searchsorted(spots, hit, "right") - 1
    inside = hit - np.array(spots)[of]
    good = inside <= np.array([len(r[3]) for r in rows])[of] - SPAN
    of, inside = of[good], inside[good]
    cut = np.concatenate([[True], (of[1:] != of[:-1]) | (inside[1:] > inside[:-1] + SPAN)]) if len(of) else np.zeros(0, bool)
    for s, e in zip(np.flatnonzero(cut), np.append(np.flatnonzero(cut)[1:], len(of))):
        doc, rev, start, _ = rows[of[s]]
        out.append((doc, rev, start + int(inside[s]), start + int(inside[e - 1]) + SPAN))
    return out


_CONTEXT = "kind int, key long, doc long, rev long, start long, end long, off int, width int, body binary"
_CONTEXT_NAMES = [x.split()[0] for x in _CONTEXT.split(", ")]


def _batch(kind: int, rows: list[tuple]) -> pa.RecordBatch:
    """Rows (key, doc, rev, start, end, off, width, body)."""
    kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(rows), pa.int32()), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=_CONTEXT_NAMES)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined rows (doc, rev, blob, wanted) to contexts; off and width tell where in the context its anchor stands."""
    last = None
    for b in batches:
        out = []
        for doc, rev, blob, wanted in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (doc, rev, blob) == last:  # a repeated row
                continue
            last = (doc, rev, blob)
            raw = zstandard.decompress(blob)
            for w in wanted:
                a, z = w["start"], w["end"] + SPAN
                body = raw[a:z]
                out.append((w["key"], doc, rev, a, z, 0, 0, body))
            if len(out) > 20_000:
                yield _batch(1, out)
                out = []
        yield _batch(1, out)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of a large group to smaller ones. A string of SPAN bytes that holds the `width` known bytes also holds half of what is missing, on the left or on the right."""
    for b in batches:
        out = []
        for key, doc, rev, start, end, off, width, body in zip(*(b.column(i).to_pylist() for i in range(1, 9))):
            if not width:  # the anchor's place follows from the bytes
                raw = np.frombuffer(body, np.uint8)
                off, width = int(contexts(raw, np.zeros(len(raw), np.int64))[4][0]), GRAM
            more = (SPAN - width + 1) // 2
            for side, a, z in ((0, off, off + width + more), (1, off - more, off + width)):
                if a >= 0 and z <= len(body):
                    k = int.from_bytes(hashlib.blake2b(body[a:z] + bytes([side, width]), digest_size=8).digest(), "little", signed=True)
                    out.append((k, doc, rev, start, end, a, z - a, body))
        yield _batch(1, out)


def _factors(group_bytes: int):
    """Contexts sorted by key, doc, rev, start to what is covered (kind 0), and the contexts of groups beyond `group_bytes` as they came (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size = [], 0  # contexts of whole groups
        group, weight, over, at, lead = [], 0, False, None, None

        def covered(some: list[tuple]) -> pa.RecordBatch:
            return _batch(0, [(0, *r, 0, 0, b"") for r in some])

        for b in batches:
            large, whole = [], []
            for row in zip(*(b.column(i).to_pylist() for i in range(1, 9))):
                key, doc, rev, start, end, off, width, body = row
                if key != at:
                    if len(group) > 1:
                        ready += [r[1:4] + (r[7],) for r in group]
                        size += weight
                    group, weight, over, at, lead = [], 0, False, key, None
                    if size > CHUNK_BYTES:
                        yield covered(_repeats(ready))
                        ready, size = [], 0
                if width >= SPAN:  # all of a string is known: the first stays
                    spot = (doc, rev, start + off)
                    if lead is None:
                        lead = spot
                    elif spot != lead:
                        whole.append((*spot, spot[2] + SPAN))
                    continue
                group.append(row)
                weight += len(body)
                if not over and weight > group_bytes:
                    over = True
                if over:
                    large += group
                    group = []
            if large:
                yield _batch(1, large)
            if whole:
                yield covered(whole)
        if len(group) > 1:
            ready += [r[1:4] + (r[7],) for r in group]
        if ready:
            yield covered(_repeats(ready))

    return run


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(_rev, raw), pa.int64()), pa.array(map(press, raw), pa.binary())], names=["doc", "rev", "blob"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for blob, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            raw = zstandard.decompress(blob)
            merged: list[list[int]] = []
            for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                else:
                    merged.append([s, e])
            ends = [0, *(x for m in merged for x in m), len(raw)]
            kept = b"".join(raw[ends[i] : ends[i + 1]] for i in range(0, len(ends), 2))
            out.append((len(raw), merged, kept))
        spans = pa.array([[{"start": s, "end": e} for s, e in m] for _, m, _ in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays([b.column(2), pa.array([n for n, _, _ in out], pa.int64()), spans, pa.array([k for _, _, k in out], pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def covered_spans(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, DataFrame]:
    """(doc, rev, blob) of every row, and (doc, rev, start, end) stretches of bytes that strings of SPAN bytes with an earlier start cover."""
    whole = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.col("text").cast("string").alias("text"))
    met = whole.mapInArrow(_anchors, "anchor long, context long, doc long, rev long, place long").repartition("anchor").sortWithinPartitions("anchor", "context", "doc", "rev", "place")
    met = staged(met.mapInArrow(_meet, "kind int, key long, doc long, rev long, start long, end long"), "met")
    covered = met.filter("kind = 0").select("doc", "rev", "start", "end")
    blobs = whole.mapInArrow(_pressed, "doc long, rev long, blob binary")
    wanted = met.filter("kind = 1").groupBy("doc", "rev").agg(F.collect_set(F.struct("key", "start", "end")).alias("wanted"))
    todo = blobs.join(wanted, ["doc", "rev"]).select("doc", "rev", "blob", "wanted").mapInArrow(_cut, _CONTEXT)
    while True:
        dealt = todo.repartition("key").sortWithinPartitions("key", "doc", "rev", "start", "off")
        got = staged(dealt.mapInArrow(_factors(group_bytes), _CONTEXT), "factors")
        covered = covered.union(got.filter("kind = 0").select("doc", "rev", "start", "end"))
        todo = got.filter("kind = 1")
        if todo.isEmpty():
            return blobs, covered
        todo = todo.mapInArrow(_deal, _CONTEXT)


def remove_repeats(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: bytes of the whole text, maximal stretches removed, and what is left.

    A byte goes if a string of SPAN bytes that also starts earlier (smaller doc_id, or the same and an earlier start) covers it; strings are judged on the input.
    Strings meet by their anchors, so texts need no common sort: an anchor's contexts that are alike anywhere but in their first place are covered whole, and only the
    different contexts of one anchor go, a bounded chunk at a time, through longest-previous-factor arrays. A group with too many of those is dealt again by longer
    keys, down to whole strings, of which the first stays. Hashes are of 128 bits for contexts, 64 for anchors, where a clash costs time only.
    Null texts are empty; texts under SPAN bytes stay whole. Rows of one id count as one document where their texts are equal (all keep the same bytes), else in the order
    of a 63-bit hash of the text, which is what tells them apart; a null id comes last. An empty table gives no rows.
    """
    blobs, covered = covered_spans(docs, group_bytes)
    spans = covered.groupBy("doc", "rev").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    doc_id = F.when(F.col("doc") < (1 << 63) - 1, F.col("doc")).alias("doc_id")
    joined = blobs.join(spans, ["doc", "rev"], "left").select("blob", "spans", doc_id)
    return joined.mapInArrow(_kept, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def query(spark, sf_dir: str) -> DataFrame:
    from tidemark.llm.common import table

    got = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return got.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
