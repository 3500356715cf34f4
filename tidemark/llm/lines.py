"""Line deduplication: an exact set-similarity join with prefix, positional and length filters over tokens ordered by rarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, column, columns, released, runs, staged, table, with_hot

SIMILARITY = 0.8
BLOCK_CHARS = 250_000
#: Counters of word frequency, a byte each once they are summed: 4 MB, whatever the corpus. A counter is never below the count of one of its words.
COUNTERS = 1 << 22
COUNTER_BLOCK = 1 << 12
#: Words that a task collects before it adds them to its counters.
COUNTED = 1 << 19
#: Steps of a counter's byte to a doubling: 5 reach 2^51.
STEPS = 5
#: A word counted more often keys a set only together with the next word, from DEEPER on with the next two, so that common words make no large groups.
DEEP, DEEPER = 1 << 13, 1 << 21
#: Slots of the sieve that tells sets which may have a similar one from those that cannot; 4 MB, whatever the corpus.
SIEVE = 1 << 25
#: Sets that a task remembers having sent; a set that it forgets is sent again, which costs time only.
REMEMBERED = 100_000
#: Members of a group that one task compares; a larger group is compared in pairs of parts.
GROUP_MOST = 4096

_BYTE = np.random.default_rng(8).integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n + 1:
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word of the texts and number of its line, counted over all texts, in their order."""
    raw = np.frombuffer("\n".join(texts).lower().encode("utf-8", "surrogatepass"), np.uint8)
    solid = np.zeros(len(raw) + 2, bool)
    solid[1:-1] = (raw != 32) & (raw - np.uint8(9) > 4)  # white space: 9 to 13, and 32
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edge[::2], edge[1::2]
    scale, inverse = _powers(len(raw))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.take(_BYTE, raw, out=sums[1:])
        sums[1:] *= scale[: len(raw)]
        np.cumsum(sums[1:], out=sums[1:])
        word = _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return word, np.searchsorted(np.flatnonzero(raw == 10), starts)


def _sorted(owner: np.ndarray, rank: np.ndarray | None, word: np.ndarray) -> np.ndarray:
    """Order by owner, then rank of the word (a byte), then word: by one key, or by all where that one leaves ties of different words."""
    if len(owner) and owner[-1] < 1 << 24:
        rest = word >> np.uint64(24) if rank is None else (rank.astype(np.uint64) << np.uint64(32)) | (word >> np.uint64(32))
        key = (owner.astype(np.uint64) << np.uint64(40)) | rest
        order = np.argsort(key)
        key, put = key[order], word[order]
        if not ((key[1:] == key[:-1]) & (put[1:] != put[:-1])).any():
            return order
    return np.lexsort((word, owner) if rank is None else (word, rank, owner))


def _counter(word: np.ndarray) -> np.ndarray:
    return (word >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)


class Lines:
    """The lines of some texts with the hashes of their distinct lower-cased words.

    Of the lines with a word: text and number within it, words (rows of `word` from `first` on, by rank if there is one), and the name of the set in two halves,
    of which one is `parity`: which of 128 classes hold an odd number of its words, for the first 64 of them; `others`: for the other 64.
    """

    def __init__(self, texts: list[str], rank: np.ndarray | None = None) -> None:
        counts = [t.count("\n") + 1 for t in texts]
        self.text_of = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(sum(counts)) - np.repeat(np.cumsum([0, *counts[:-1]]), counts) if counts else np.zeros(0, np.int64)
        word, line = _hashed(texts)
        order = _sorted(line, None if rank is None else rank[_counter(word)], word)
        word, line = word[order], line[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (line[1:] != line[:-1])
        self.word, line = word[new], line[new]
        a, b = runs(line) if len(line) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.line, self.first = line[a], np.concatenate([[0], b])
        self.size = b - a
        if len(a):
            bit, low = np.uint64(1) << (self.word & np.uint64(63)), (self.word & np.uint64(64)) == 0
            self.parity, self.others = (np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), a).view(np.int64) for half in (low, ~low))
            with np.errstate(over="ignore"):
                self.name = _mix(np.add.reduceat(_mix(self.word + np.uint64(0x51)), a) + self.size.astype(np.uint64)).view(np.int64)
        else:
            self.parity = self.others = self.name = np.zeros(0, np.int64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[str]]]:
    """Blocks of the batches: the batch, where its block starts, texts (null: empty)."""
    for b in batches:
        texts = [t or "" for t in b.column("text").to_pylist()]
        for s, e in blocks([len(t) for t in texts], BLOCK_CHARS):
            yield b, s, texts[s:e]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, slots, counts): the counters above zero, in blocks."""
    total = np.zeros(COUNTERS, np.int32)
    held, n = [], 0

    def add() -> None:
        """Sorted first: the counters are then met in order."""
        slot = np.sort(np.concatenate(held))
        a, b = runs(slot)
        total[slot[a]] += (b - a).astype(np.int32)

    for _, _, texts in _texts(batches):
        word = _hashed(texts)[0]
        if len(word):
            held.append(_counter(word).astype(np.int32))
            n += len(word)
        if n > COUNTED:
            add()
            held, n = [], 0
    if held:
        add()
    slot = np.flatnonzero(total)
    if len(slot):
        a, b = runs(slot // COUNTER_BLOCK)
        rows = [((slot[s:e] % COUNTER_BLOCK).astype(np.uint16).tobytes(), total[slot[s:e]].astype(np.int64).tobytes()) for s, e in zip(a, b)]
        yield pa.RecordBatch.from_arrays([pa.array((slot[a] // COUNTER_BLOCK).astype(np.int32)), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "slots", "counts"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block to (block, bytes): the logarithm of each counter of the block, in steps; 0 is one occurrence or none."""
    at, total = None, np.zeros(COUNTER_BLOCK, np.int64)

    def close(found: list) -> None:
        if at is not None:
            found.append((at, np.minimum(255, np.round(STEPS * np.log2(np.maximum(total, 1)))).astype(np.uint8).tobytes()))

    for b in batches:
        found: list = []
        for block, slots, counts in zip(*(b.column(i).to_pylist() for i in range(3))):
            if block != at:
                close(found)
                at, total = block, np.zeros(COUNTER_BLOCK, np.int64)
            total[np.frombuffer(slots, np.uint16)] += np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())], names=["block", "bytes"])
    found = []
    close(found)
    yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())], names=["block", "bytes"])


def rarity(whole: DataFrame) -> np.ndarray:
    """A byte for each counter, larger for commoner words, counted over all texts; 4 MB reach the driver, whatever the corpus."""
    dealt = whole.mapInArrow(_count, "block int, slots binary, counts binary").repartition("block").sortWithinPartitions("block")
    out = np.zeros(COUNTERS, np.uint8)
    for r in dealt.mapInArrow(_sum, "block int, bytes binary").toLocalIterator():
        out[r.block * COUNTER_BLOCK : (r.block + 1) * COUNTER_BLOCK] = np.frombuffer(r.bytes, np.uint8)
    return out


def _prefixes(rank: np.ndarray, similarity: float):
    """(key, name, parity, others, shape): the rarest words of each set, as many as a similar set must share one of. A batch sends a set once.

    A common word is sent in pairs or triples with later words, over a prefix as much longer: sets that share the words they must share that many of the
    longer prefix, and the first ones in it begin with the same word. shape: size, and the most words that sets meeting in this key can share.
    A word counted once meets nothing and is not sent; neither is a set that is similar to no set of one word more (at 0.8, of one to three words): it is similar to its equals only.
    """
    limits = [int(round(STEPS * np.log2(n))) for n in (DEEP, DEEPER)] if similarity >= 0.75 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for _, _, texts in _texts(batches):
            got = Lines(texts, rank)
            fresh = np.zeros(len(got.name), bool)
            for i, k in enumerate(zip(got.name.tolist(), got.parity.tolist())):
                if k not in sent:
                    fresh[i] = True
                    sent.add(k)
            if len(sent) > REMEMBERED:
                sent.clear()
            size = got.size
            need = np.where(fresh & (size >= similarity * (size + 1) - 1e-9), size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1, 0)
            owner = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(owner)) - got.first[owner]
            at = np.flatnonzero(place < need[owner])
            byte = rank[_counter(got.word[at])]
            at, byte = at[byte > 0], byte[byte > 0]
            depth = np.searchsorted(limits, byte, side="left") + 1
            key, last = got.word[at], at
            out = []
            for d in range(1, 4):
                done = depth == d
                own = owner[last[done]]
                out.append((key[done], own, d + size[own] - place[last[done]] - 1))
                key, last, depth = key[~done], last[~done], depth[~done]
                if not len(key):
                    break
                more = need[owner[last]] + d - 1 - place[last]  # later words of the prefix that is longer by d
                step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
                last = np.repeat(last, more) + 1 + step
                depth = np.repeat(depth, more)
                with np.errstate(over="ignore"):
                    key = _mix(np.repeat(key, more) + got.word[last] * np.uint64(0x9E3779B97F4A7C15))
            key, own, most = (np.concatenate([o[i] for o in out]) for i in range(3))
            cols = [key.view(np.int64), got.name[own], got.parity[own], got.others[own], (size[own] << 32) | most]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["key", "name", "parity", "others", "shape"])

    return run


def _pairs_may(x: tuple, y: tuple, similarity: float):
    """Whether sets of (size, most words shared, both parities) can reach the similarity: length, positional and parity filters."""
    total = x[0] + y[0]
    need = np.ceil(similarity / (1 + similarity) * total - 1e-9)
    return (np.minimum(x[0], y[0]) >= need) & (np.minimum(x[1], y[1]) >= need) & (total - (np.bitwise_count((x[2] ^ y[2]).view(np.uint64)) + np.bitwise_count((x[3] ^ y[3]).view(np.uint64))) >= 2 * need)


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after links (i, j): the least row that links reach; label: what is joined already, which links each row with its label."""
    i, j = np.concatenate([i, np.arange(len(label))]), np.concatenate([j, label])
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        for at in (i, j, label[i], label[j]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


#: Links that are held before they are joined; what is joined already makes no more links.
LINKS = 200_000


def _linked(end: np.ndarray, size: np.ndarray, may, similarity: float) -> np.ndarray:
    """Labels of rows sorted by group and size: equal for rows of one group that pairs for which may(i, j) holds connect.

    Each row is held against those after it, step by step, until the group ends (at `end`) or the sizes lie too far apart.
    """
    label, one, two, held = np.arange(len(end)), [], [], 0
    i, step = np.arange(len(end)), 0
    while len(i):
        step += 1
        i = i[i + step < end[i]]
        i = i[size[i] >= similarity * size[i + step] - 1e-9]
        ok = i[label[i] != label[i + step]]
        ok = ok[may(ok, ok + step)]
        one.append(ok)
        two.append(ok + step)
        held += len(ok)
        if held > LINKS:
            label, one, two, held = _joined(label, np.concatenate(one), np.concatenate(two)), [], [], 0
    return _joined(label, np.concatenate(one), np.concatenate(two)) if one else label


def _by_size(rows: np.ndarray) -> np.ndarray:
    """Columns (key, name, parity, others, shape) sorted by key to those of keys with more than one, by key and size, equal ones side by side."""
    if not rows.shape[1]:
        return rows
    a, b = runs(rows[0])
    many = b - a
    rows, group = rows[:, np.repeat(many > 1, many)], np.repeat(np.arange((many > 1).sum()), many[many > 1])
    size = rows[4] >> 32
    if not len(size) or group[-1] >= 1 << 18 or size.max() >= 1 << 12:
        return rows[:, np.lexsort((rows[2], rows[1], rows[4], rows[0]))]
    # one key; equal sets share the bits of the name, and where others do too, equal ones may come apart, which costs time only
    return rows[:, np.argsort((group << 45) | (size << 33) | (rows[1].view(np.uint64) >> np.uint64(31)).view(np.int64))]


def _groups(similarity: float):
    """Rows sorted by key to (team, name, parity): sets that share a key and that pairs which pass the filters connect.

    A team is named by its least member, so that the teams which a cluster of sets forms under its many words are mostly one; their union holds all of their pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        made: set[tuple[int, int, int]] = set()

        def teams() -> pa.RecordBatch:
            rows = np.concatenate(held, axis=1) if held else np.zeros((5, 0), np.int64)
            held.clear()
            rows = _by_size(rows)
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)  # a set that more than one task sent
            key, name, parity, others, shape = rows[:, new]
            out: list[tuple[int, int, int]] = []
            if len(key):
                size, most = shape >> 32, shape & 0xFFFFFFFF
                starts, ends = runs(key)
                may = lambda i, j: _pairs_may(*((size[k], most[k], parity[k], others[k]) for k in (i, j)), similarity)
                label = _linked(np.repeat(ends, ends - starts), size, may, similarity)
                order = np.lexsort((parity, name, label))
                first, last = runs(label[order])
                first, last = first[last - first > 1], last[last - first > 1]
                many = last - first
                member = order[np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())] if len(many) else order[:0]
                for row in zip(name[np.repeat(order[first], many)].tolist(), name[member].tolist(), parity[member].tolist()):
                    if row not in made:
                        made.add(row)
                        out.append(row)
                if len(made) > REMEMBERED:
                    made.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["team", "name", "parity"])

        for b in batches:
            rows = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
            if not rows.shape[1]:
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last key may go on
            if cut or (held and held[0][0, 0] != rows[0, 0]):
                held.append(rows[:, :cut])
                yield teams()
                rows = rows[:, cut:]
            held.append(rows)
        yield teams()

    return run


def _sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, bits): the slots of the sets of some teams."""
    bits = np.zeros(SIEVE // 8, np.uint8)
    for b in batches:
        slot = _slot(b.column(0).to_numpy(zero_copy_only=False))
        np.bitwise_or.at(bits, slot >> 3, (128 >> (slot & 7)).astype(np.uint8))
    bits = bits.reshape(-1, COUNTER_BLOCK)
    full = np.flatnonzero(bits.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([bits[k].tobytes() for k in full], pa.binary())], names=["block", "bits"])


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of this task, of the bits of all of its rows; a bounded number of blocks."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for block, bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held[block] = held.get(block, 0) | np.frombuffer(bits, np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["block", "bits"])


def _slot(name: np.ndarray) -> np.ndarray:
    return (name.view(np.uint64) >> np.uint64(64 - (SIEVE.bit_length() - 1))).astype(np.int64)


def has_slot(sieve: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Whether the slot of each name is set."""
    slot = _slot(name)
    return (sieve[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def sieve_of(names: DataFrame) -> np.ndarray:
    """One bit for each slot: whether one of the names (the only column) falls into it; 4 MB reach the driver, whatever the corpus."""
    out = np.zeros((SIEVE // 8 // COUNTER_BLOCK, COUNTER_BLOCK), np.uint8)
    dealt = names.mapInArrow(_sieve, "block int, bits binary").repartition("block")
    for r in dealt.mapInArrow(_union, "block int, bits binary").toLocalIterator():
        out[r.block] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def _occurrences(sieve: np.ndarray):
    """(name, parity, doc, rev, line, maybe, words) of every line with a word. maybe: the slot of the sieve is set; then words, the set itself, once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for b, s, texts in _texts(batches):
            got = Lines(texts)
            words: list[bytes | None] = [None] * len(got.name)
            maybe = has_slot(sieve, got.name)
            for i in np.flatnonzero(maybe).tolist():
                k = (int(got.name[i]), int(got.parity[i]))
                if k not in sent:
                    if len(sent) < REMEMBERED:
                        sent.add(k)
                    words[i] = got.word[got.first[i] : got.first[i + 1]].tobytes()
            at = pa.array(s + got.text_of[got.line])
            yield pa.RecordBatch.from_arrays([pa.array(got.name), pa.array(got.parity), b.column("doc").take(at), b.column("rev").take(at), pa.array(got.number[got.line]), pa.array(maybe), pa.array(words, pa.binary())], names=["name", "parity", "doc", "rev", "line", "maybe", "words"])

    return run


def similar_earlier(sets: list[np.ndarray], similarity: float, part: list[int] | None = None) -> list[int]:
    """Indices of sets (word hashes; in order of first occurrence) that resemble an earlier one; with part, only pairs across the two parts count."""
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    words, code = np.unique(np.concatenate(sets), return_inverse=True)
    if len(sets) <= 512 and len(sets) * len(words) <= 1 << 22:  # all shared words at once
        has = np.zeros((len(sets), len(words)), np.float32)
        has[owner, code] = 1
        both = has @ has.T
        ok = np.tril(both >= similarity * (size[:, None] + size - both) - 1e-6, -1)
        if part is not None:
            ok &= np.not_equal.outer(part, part)
        return np.flatnonzero(ok.any(1)).tolist()
    order = np.argsort(code, kind="stable")
    where = owner[order]
    a, b = runs(code[order])
    ends = np.cumsum(size)
    out = []
    for i in range(1, len(sets)):
        holders = [where[a[k] : b[k]] for k in code[ends[i] - size[i] : ends[i]].tolist()]
        both = np.bincount(np.concatenate(holders), minlength=len(sets))[:i]
        ok = both >= similarity * (size[i] + size[:i] - both) - 1e-9
        if part is not None:
            ok &= np.array(part[:i]) != part[i]
        if ok.any():
            out.append(i)
    return out


def _pairs(one: list[np.ndarray], two: list[np.ndarray], similarity: float) -> np.ndarray:
    """Whether the sets of each pair are similar, all pairs at once."""
    n, m = np.array([len(x) for x in one]), np.array([len(x) for x in two])
    words = np.concatenate([*one, *two])
    pair = np.concatenate([np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)])
    order = np.lexsort((words, pair))
    words, pair = words[order], pair[order]
    both = np.bincount(pair[1:][(words[1:] == words[:-1]) & (pair[1:] == pair[:-1])], minlength=len(n))
    return both >= similarity * (n + m - both) - 1e-9


def _compare(similarity: float):
    """Rows sorted by team and pair of parts, then by first occurrence, to the sets that resemble an earlier one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, twos, out = None, [], [], []

        def close() -> None:
            if len(held) == 2 and (at[1] == at[2] or held[0][2] != held[1][2]):
                twos.append((held[0][3], held[1][3], held[1][:2]))
            elif len(held) > 2:
                part = [h[2] for h in held] if at[1] != at[2] else None
                out.extend(held[i][:2] for i in similar_earlier([h[3] for h in held], similarity, part))

        def batch() -> pa.RecordBatch:
            if twos:
                out.extend(x[2] for x, ok in zip(twos, _pairs([x[0] for x in twos], [x[1] for x in twos], similarity)) if ok)
            got = pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["name", "parity"])
            twos.clear()
            out.clear()
            return got

        for b in batches:
            for team, lo, hi, part, name, parity, words in zip(*(b.column(i).to_pylist() for i in range(7))):
                if (team, lo, hi) != at:
                    close()
                    at, held = (team, lo, hi), []
                held.append((name, parity, part, np.frombuffer(words, np.uint64)))
            yield batch()
        close()
        yield batch()

    return run


def _keyed(docs: DataFrame) -> tuple[Column, Column]:
    """Key of a row: its doc_id (null: last), and a hash of its text, which orders rows that share an id."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY, group_most: int = GROUP_MOST) -> DataFrame:
    """(doc, rev, lines): numbers of the lines that resemble an earlier line of the corpus, for rows that have such.

    Lines end at newlines; a line counts as the set of its lower-cased words (of ASCII white space). Every line with a word takes part; blank lines stay. Two lines
    are similar from a Jaccard index of `similarity` on; earlier means a smaller doc_id, or the same and an earlier line. Words are known by 64-bit hashes, sets by
    128-bit names. Equal sets are one set with its first occurrence, and a task sends each once, so a line that very many documents hold makes no large
    group; sets of common words are keyed by several of them at once. Only sets that pass every filter with another one have their words shuffled.
    """
    doc, rev = _keyed(docs)
    whole = docs.select(doc.alias("doc"), F.col("text").cast("string").alias("text"), rev.alias("rev"))
    key = ["name", "parity"]
    prefix = whole.mapInArrow(_prefixes(rarity(whole.select("text")), similarity), "key long, name long, parity long, others long, shape long").repartition("key").sortWithinPartitions("key")
    teams = staged(prefix.mapInArrow(_groups(similarity), "team long, name long, parity long").distinct(), "teams")
    found = staged(whole.mapInArrow(_occurrences(sieve_of(teams.select("name"))), "name long, parity long, doc long, rev long, line long, maybe boolean, words binary"), "occurrences")
    first = F.min(F.struct("doc", "rev", "line")).alias("first")
    sets = staged(found.filter("maybe").groupBy(*key).agg(first, F.min("words").alias("words")), "sets")

    parts = F.ceil(F.col("size") / group_most)
    members = teams.join(teams.groupBy("team").agg(F.count("*").alias("size")), "team").join(sets, key)
    members = members.withColumn("part", F.pmod(F.xxhash64("name"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    members = members.select("team", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", *key, "words", "first")
    dealt = members.repartition("team", "lo", "hi").sortWithinPartitions("team", "lo", "hi", "first", *key).drop("first")
    later = staged(dealt.mapInArrow(_compare(similarity), "name long, parity long").distinct(), "later")
    released(teams, sets)

    seen = found.select(*key, "doc", "rev", "line")
    marked = seen.groupBy(*key).agg(first, F.count("*").alias("n")).join(later.withColumn("later", F.lit(True)), key, "left").filter("n > 1 or later")
    gone = with_hot(seen, staged(marked, "marked"), key, found.count()).filter("later or struct(doc, rev, line) <> first")
    return gone.groupBy("doc", "rev").agg(F.collect_set("line").alias("lines"))


def without_repeats(docs: DataFrame, counts: bool = True, **how) -> DataFrame:
    """docs, each text without the lines that resemble an earlier one, n_chars (if there) renewed; with counts, _lines and _removed are the numbers of lines before and of lines that went.

    Null texts stay null, and count as one empty line. Repeated rows of one id and text are one document: none is earlier than the other, and both keep the same lines.
    Rows of one id with different texts come in the order of a hash of the text. An empty table gives an empty one. With counts, columns of docs that have their names give way.
    """
    doc, rev = _keyed(docs)
    gone = repeated_lines(docs, **how).select(F.col("doc").alias("_doc"), F.col("rev").alias("_rev"), F.col("lines").alias("_gone"))
    found = docs.select(doc.alias("_doc"), rev.alias("_rev"), F.struct(*columns(docs)).alias("_row")).join(gone.hint("shuffle_hash"), ["_doc", "_rev"], "left")  # no sort of whole texts; gone is unique by key
    text = F.col("_row.text")
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)
    kept = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("_gone", i.cast("long"))), "\n"))
    new = {"text": kept}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_gone").isNull(), F.col("_row.n_chars")).otherwise(F.length(kept).cast(docs.schema["n_chars"].dataType))
    body = F.coalesce(text.cast("string"), F.lit(""))
    added = {"_lines": (F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1).cast("int"), "_removed": F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone"))} if counts else {}
    return found.select(*(new.get(c, column(c, "_row")).alias(c) for c in docs.columns if c.lower() not in added), *(v.alias(k) for k, v in added.items()))


def query(spark, sf_dir: str) -> DataFrame:
    got = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
