"""Packing token sequences: minimum bin slack over the lengths that remain."""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, staged

WINDOW = 2048
END_ID = 1
#: Documents whose last pieces are packed together; their lengths fill all but the last few windows without a gap.
GROUP = 8192
#: Distinct words whose ids a worker remembers.
REMEMBERED = 400_000


def closest_fill(counts: Counter, lengths: list[int], capacity: int) -> list[int]:
    """The multiset of available lengths, the largest among them, whose sum comes closest to capacity from below.

    Reachable sums are the bits of an integer; counts enter by powers of two, and the bits before each step give the counts back.
    lengths: those with a count, ascending.
    """
    top = lengths[-1]
    room, mask = capacity - top, (1 << (capacity - top + 1)) - 1
    reach, steps = 1, []
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        if reach >> room & 1:
            break
        n = lengths[i]
        left, k = min(counts[n] - (n == top), room // n), 1
        while left > 0:
            k = min(k, left)
            steps.append((n, k, reach))
            reach |= (reach << n * k) & mask
            left -= k
            k *= 2
    at, out = reach.bit_length() - 1, [top]
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            at -= n * k
            out += [n] * k
    return out


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of sizes (1 to capacity), in windows, each filled as closely as what remains allows."""
    by_size: dict[int, list[int]] = {}
    for i in range(len(sizes) - 1, -1, -1):
        by_size.setdefault(sizes[i], []).append(i)
    counts = Counter({n: len(x) for n, x in by_size.items()})
    lengths, out = sorted(by_size), []
    while lengths:
        window = []
        for n in closest_fill(counts, lengths, capacity):
            window.append(by_size[n].pop())
            counts[n] -= 1
            if not counts[n]:
                del lengths[bisect_right(lengths, n) - 1]
        out.append(window)
    return out


#: Words that the tokenizer's own first steps (canonical composition, white space, lower case) treat character by character: printable ASCII and Latin letters and signs.
PLAIN = regex.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")
#: Signs that often follow a word of letters; such a word is cut without a search.
SIGNS = frozenset(".,;:!?")
# Fixed value: how the tokenizer cuts a word into the pieces that it encodes one by one.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class WordIds:
    """ids (as bytes) of words without ASCII white space, which always ends a token and gives none.

    Each distinct piece of a word is encoded once. A plain word is cut into pieces here, so that those which words share ("end." and "End") are one; any other word
    goes through the whole tokenizer, as do words that may hold one of its special tokens.
    """

    def __init__(self, tokenizer_path: str, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.path, self.remembered = tokenizer_path, remembered
        self.bare = Tokenizer.from_file(tokenizer_path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.bare.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(self.bare.model.end_of_word_suffix)]] = True
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    @cached_property
    def whole(self):
        """The tokenizer as it is; loaded only where a word needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def learn(self, words: set[bytes]) -> None:
        """Remembers the words; forgets all others first if they become too many."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > self.remembered:
            self.words, self.pieces, new = {}, {}, words
        single, cut, other = {}, {}, {}
        for raw in new:
            w = raw.decode()
            if w.isalpha() and (w.isascii() or PLAIN.fullmatch(w)):
                single[raw] = w.lower()
            elif w[-1] in SIGNS and w[:-1].isalpha() and (w.isascii() or PLAIN.fullmatch(w)):
                cut[raw] = w[:-1].lower(), w[-1]
            elif (w.isascii() and w.isprintable() or PLAIN.fullmatch(w)) and "<|" not in w:
                cut[raw] = PIECES.findall(w.lower())
            else:
                other[raw] = w
        self._encode_pieces(list({*single.values(), *chain.from_iterable(cut.values())}.difference(self.pieces)))
        ids = self.pieces
        self.words.update((raw, ids[p]) for raw, p in single.items())
        self.words.update((raw, b"".join([ids[x] for x in p])) for raw, p in cut.items())
        if other:
            self.words.update((raw, array("I", x.ids).tobytes()) for raw, x in zip(other, self.whole.encode_batch_fast(list(other.values()), add_special_tokens=False)))

    def _encode_pieces(self, pieces: list[str]) -> None:
        """A thousand pieces to a text; each ends with the one of its tokens that ends a word."""
        parts = [pieces[i : i + 1000] for i in range(0, len(pieces), 1000)]
        for some, x in zip(parts, self.bare.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(x.ids, np.uint32)
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) != len(some):
                raise ValueError("a piece of a word has no end among its tokens")
            raw, start = ids.tobytes(), 0
            for piece, end in zip(some, cuts):
                self.pieces[piece] = raw[start:end]
                start = end


@lru_cache(1)
def word_ids(tokenizer_path: str, remembered: int = REMEMBERED) -> WordIds:
    """One for each Python worker: its tasks load the tokenizer once, and share the words that they meet."""
    return WordIds(tokenizer_path, remembered)


def _tokenize(tokenizer_path: str, window: int, remembered: int = REMEMBERED):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        known = word_ids(tokenizer_path, remembered)
        end = array("I", [END_ID]).tobytes()
        for b in batches:
            rows = []
            texts = [t or "" for t in b.column(1).to_pylist()]
            for s, e in blocks([len(t) for t in texts], 1_000_000):
                split = [t.encode().split() for t in texts[s:e]]  # of bytes: white space of ASCII only
                known.learn(set().union(*split))
                for words in split:
                    ids = b"".join([*map(known.words.__getitem__, words), end])
                    n, step = len(ids) // 4, 4 * window
                    rows.append((n, [zlib.crc32(ids[i : i + step]) for i in range(0, len(ids), step)]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["doc_id", "doc_tokens", "crcs"])

    return run


def _place(window: int, most: int):
    """Rows sorted by group to pieces; each group is packed by itself, one beyond `most` rows (of repeated rows) in parts."""

    def pieces(sequence: int, rows: list[tuple]) -> tuple[int, pa.RecordBatch]:
        out = []
        last = []
        for doc, n, crcs in rows:
            for k in range(n // window):
                out.append((doc, k * window, window, crcs[k], n, sequence, 0))
                sequence += 1
            if n % window:
                last.append((doc, n, crcs[-1]))
        for members in pack([n % window for _, n, _ in last], window):
            offset = 0
            for i in members:
                doc, n, crc = last[i]
                out.append((doc, n - n % window, n % window, crc, n, sequence, offset))
                offset += n % window
            sequence += 1
        return sequence, pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(7)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, sequence = None, [], 0
        for b in batches:
            for group, *row in zip(*(b.column(i).to_pylist() for i in range(4))):
                if group != at or len(held) >= most:
                    if held:
                        sequence, out = pieces(sequence, held)
                        yield out
                    if group != at:
                        at, sequence = group, group << 32
                    held = []
                held.append(row)
        if held:
            yield pieces(sequence, held)[1]

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, group: int = GROUP, remembered: int = REMEMBERED) -> DataFrame:
    """A row for each piece of each document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every `window` ids of a document fill a sequence of their own. What is left of each document goes, with that of about `group` others,
    into sequences filled by minimum bin slack. Groups follow from a hash of the row and the number of rows, so a rerun gives the same
    sequences. Null texts are empty (one id); repeated rows are packed each; an empty table gives no rows. ids never leave the task that made
    them, only their lengths and checksums do. remembered: distinct words whose ids a worker remembers. tokenizer_path must be readable on every executor.
    """
    lengths = staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_tokenize(tokenizer_path, window, remembered), "doc_id long, doc_tokens long, crcs array<long>"), "lengths")
    groups = max(1, -(-lengths.count() // group))
    dealt = lengths.select(F.pmod(F.xxhash64("doc_id", "doc_tokens", "crcs"), F.lit(groups)).alias("group"), "doc_id", "doc_tokens", "crcs")
    placed = dealt.repartition("group").sortWithinPartitions("group", "doc_id", "doc_tokens", "crcs")
    return placed.mapInArrow(_place(window, 4 * group), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir: str) -> DataFrame:
    from tidemark.llm.common import table

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer())
