import hashlib
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import suffix

SCHEMA = "doc_id long, text string, spare string, anchor long"


def brute(rows):
    seen, out = {}, {}
    for doc, text in sorted((d, t or "") for d, t in rows):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - suffix.SPAN + 1):
            w = raw[i : i + suffix.SPAN]
            if w in seen:
                gone[i : i + suffix.SPAN] = True
            else:
                seen[w] = (doc, i)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc] = (len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (8, 20, 40, 120)]
    rows = []
    for d in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages) if rng.random() < 0.6 else " ".join(word() for _ in range(rng.randint(1, 40)))
            if rng.random() < 0.3 and p:
                k = rng.randrange(len(p))
                p = p[:k] + rng.choice("xyz") + p[k + 1 :]
            parts.append(p)
        rows.append((d, " ".join(parts)))
    rows += [(100, None), (101, ""), (102, "a" * 700), (103, "ab" * 300), (104, "a" * 99), (105, rows[3][1]), (106, passages[3] * 3)]
    return rows


@pytest.mark.parametrize("group_bytes", [suffix.GROUP_BYTES, 300])
def test_matches_brute_force(spark, group_bytes):
    rows = corpus(group_bytes)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix.remove_repeats(docs, group_bytes).collect()}
    assert got == brute(rows)


def test_slices_of_long_texts(spark):
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, suffix.SLICE + 60_000).astype(np.uint8).tobytes().decode()
    edge = suffix.SLICE
    rows = [(1, text), (2, "zz" + text[edge - 400 : edge + 400] + "yy" + text[edge - 130 : edge - 30]), (3, text[:edge][-99:] + text[edge + 1 :][:120])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix.remove_repeats(docs).collect()}
    assert got == brute(rows) and got[2][1] == 900


def test_texts_without_ids_stay_apart(spark):
    """Two texts without an id whose checksums agree in their low bits, one of them with a repeat of a third."""
    rng, seen = random.Random(9), {}
    made = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = made(300)
    while True:
        alone, beside = made(400), shared + made(60)
        for kind, t in (("alone", alone), ("beside", beside)):
            seen.setdefault(zlib.crc32(t.encode()) & 0xFFFFFF, {})[kind] = t
        pair = seen[zlib.crc32(alone.encode()) & 0xFFFFFF]
        if len(pair) == 2:
            break
    docs = spark.createDataFrame([(1, shared), (None, pair["alone"]), (None, pair["beside"])], "doc_id long, text string")
    got = {r.n_bytes: [(s.start, s.end) for s in r.spans] for r in suffix.remove_repeats(docs).collect()}
    assert got == {300: [], 400: [], 360: [(0, 300)]}


def test_contexts_do_not_depend_on_slices():
    raw = np.random.default_rng(5).integers(97, 101, 3000).astype(np.uint8)
    whole = suffix.contexts(raw, np.zeros(len(raw), np.int64))
    part = suffix.contexts(raw[500:], np.zeros(len(raw) - 500, np.int64))
    assert set(part[0][1:].tolist()) <= set(whole[0].tolist())
    assert set((part[1][1:]).tolist()) <= set(whole[1].tolist())


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(7, text), (7, text), (9, text), (None, text)], "doc_id long, text string")
    got = sorted((str(r.doc_id), sum(s.end - s.start for s in r.spans)) for r in suffix.remove_repeats(docs).collect())
    n = len(text)
    assert got == [("7", 0), ("7", 0), ("9", n), ("None", n)]
    assert suffix.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("group_bytes", [suffix.GROUP_BYTES, 300])
def test_repeated_rows_beside_other_contexts(spark, group_bytes):
    rows = corpus(11)
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())) for r in suffix.remove_repeats(docs, group_bytes).collect()]
    assert len(got) == 2 * len(rows)
    assert set(got) == set(brute(rows).items())


def test_a_context_under_two_keys_is_one():
    rng = random.Random(4)
    made = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    middle, left, right = made(40), made(50), made(50)
    x, y, z = left + middle + right, left + middle + made(50), made(50) + middle + right
    rows = [(1, 1, 5, 0, 140, 0, 90, x), (1, 2, 5, 0, 140, 0, 90, y), (2, 1, 5, 0, 140, 50, 90, x), (2, 3, 5, 0, 140, 50, 90, z)]
    got = list(suffix._factors(suffix.GROUP_BYTES)(iter([suffix._batch(1, rows)])))
    assert sum(b.num_rows for b in got) == 0  # no string of 100 bytes stands in two of them


def test_longest_previous_factors():
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(1, 4, 300), [0], rng.integers(1, 3, 120), np.full(130, 2)])
    got, t = suffix.longest_previous_factors(text), text.tolist()
    for i in range(len(t)):
        best = 0
        for j in range(i):
            k = 0
            while i + k < len(t) and k < 112 and t[i + k] == t[j + k]:
                k += 1
            best = max(best, k)
        assert got[i] == best


@pytest.mark.parametrize("least", [20, suffix.SPAN])
def test_factors_from_a_length_on(least):
    rng = np.random.default_rng(4)
    for _ in range(20):
        start = rng.integers(0, 257, int(rng.integers(1, 250)))
        text = np.concatenate([start, rng.integers(0, 3, 90), start, rng.integers(0, 2, 150), start[: len(start) // 2]])
        whole, some = suffix.longest_previous_factors(text), suffix.longest_previous_factors(text, least=least)
        assert (some[whole >= least] == whole[whole >= least]).all() and (some <= whole).all()
