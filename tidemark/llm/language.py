"""Language identification: a bidirectional gated recurrent network over the bytes of the text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, filtered, fold, held_out, table

#: The network is fitted on about so many labelled documents of each language, chosen by a hash of their ids, from all of the table.
SAMPLE_DOCS = 300
HIDDEN, STEPS, BATCH, LENGTH, RATE = 8, 400, 64, 96, 0.02
#: A text is read in windows of WINDOW bytes that share OVERLAP, half of it on either side, where the states of both directions settle; each byte is labelled in one window.
WINDOW, OVERLAP = 512, 64
#: Windows that go through the network at once, and characters of text that are cut into windows at once.
TOGETHER, BLOCK_CHARS = 2048, 1_000_000
UNKNOWN = "und"

#: Bytes whose labels count: letters of ASCII, and all bytes of other characters.
_COUNTS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """wx: (direction, byte, gates), u: (direction, hidden, gates), v: (2 hidden, languages), c: (languages). Gates: update, reset, new."""

    langs: list[str]
    wx: np.ndarray
    u: np.ndarray
    v: np.ndarray
    c: np.ndarray

    def states(self, x: np.ndarray, way: int, keep: list) -> np.ndarray:
        """Hidden states (length, windows, hidden) of byte rows x (windows, length), read forward (0) or backward (1); keep takes what the way back needs."""
        n, length = x.shape
        hid = self.u.shape[1]
        h, out = np.zeros((n, hid), self.u.dtype), np.empty((length, n, hid), self.u.dtype)
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            a, hu = self.wx[way][x[:, t]], h @ self.u[way]
            zr = _sigmoid(a[:, : 2 * hid] + hu[:, : 2 * hid])
            z, r = zr[:, :hid], zr[:, hid:]
            new = np.tanh(a[:, 2 * hid :] + r * hu[:, 2 * hid :])
            keep.append((t, h, z, r, new, hu[:, 2 * hid :]))
            h = new + z * (h - new)
            out[t] = h
        return out

    def _scores(self, x: np.ndarray, there: np.ndarray | None, way: int) -> Iterator[tuple[int, np.ndarray]]:
        """(position, scores (languages, windows)) of byte columns x (length, windows), one direction. there: which positions hold a byte; the state is zero on the others."""
        hid = self.u.shape[1]
        half = np.concatenate([np.full(2 * hid, 0.5), np.ones(hid)]).astype(np.float32)  # a sigmoid is a tanh of half its argument
        wx, u, v = np.ascontiguousarray((self.wx[way] * half).T), np.ascontiguousarray((self.u[way] * half).T), np.ascontiguousarray(self.v[way * hid : (way + 1) * hid].T)
        length, n = x.shape
        h = np.zeros((hid, n), np.float32)
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            a, hu = wx.take(x[t], axis=1), u @ h
            zr = a[: 2 * hid]
            zr += hu[: 2 * hid]
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            new = a[2 * hid :]
            hu[2 * hid :] *= zr[hid:]
            new += hu[2 * hid :]
            np.tanh(new, out=new)
            h -= new
            h *= zr[:hid]
            h += new
            if there is not None:
                h *= there[t]
            yield t, v @ h

    def labels(self, x: np.ndarray, there: np.ndarray | None = None) -> np.ndarray:
        """Probabilities (length, languages, windows) of the languages at every position of byte columns x (length, windows)."""
        out = np.empty((x.shape[0], len(self.langs), x.shape[1]), np.float32)
        for t, s in self._scores(x, there, 0):
            out[t] = s
        for t, s in self._scores(x, there, 1):
            p = out[t]
            p += s
            p += self.c[:, None]
            p -= p.max(0)
            np.exp(p, out=p)
            p /= p.sum(0)
        return out

    def sums(self, texts: list[bytes]) -> np.ndarray:
        """For each text the sums of its letters' probabilities: (texts, languages)."""
        out = np.zeros((len(texts), len(self.langs)))
        step, edge = WINDOW - OVERLAP, OVERLAP // 2
        # (text, where the window begins, its bytes, from which of them on and up to which its labels count)
        cuts = [(i, max(0, k - edge), min(len(t), k + step + edge), k, min(len(t), k + step)) for i, t in enumerate(texts) for k in range(0, len(t), step)]
        cuts.sort(key=lambda w: w[2] - w[1])
        for at in range(0, len(cuts), TOGETHER):
            some = cuts[at : at + TOGETHER]
            size = np.array([w[2] - w[1] for w in some])
            rows = np.frombuffer(b"".join(texts[i][a:b].ljust(size[-1], b"\0") for i, a, b, _, _ in some), np.uint8).reshape(len(some), -1)
            x = np.ascontiguousarray(rows.T)
            place = np.arange(size[-1])[:, None]
            there = None if size[0] == size[-1] else (place < size).astype(np.float32)
            count = _COUNTS[x] & (place >= [w[3] - w[1] for w in some]) & (place < [w[4] - w[1] for w in some])
            found = np.einsum("tkn,tn->nk", self.labels(x, there), count.astype(np.float32))
            np.add.at(out, [w[0] for w in some], found)
        return out


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of byte rows x (windows, length) of languages y, and its gradients by wx, u, v and c, by backpropagation through time."""
    hid = net.u.shape[1]
    kept: list[list] = [[], []]
    hs = np.concatenate([net.states(x, w, kept[w]) for w in (0, 1)], axis=2)
    logits = hs @ net.v + net.c
    p = np.exp(logits - logits.max(2, keepdims=True))
    p /= p.sum(2, keepdims=True)
    loss = float(-np.log(p[:, np.arange(len(y)), y]).mean())
    p[:, np.arange(len(y)), y] -= 1
    p /= p.shape[0] * p.shape[1]
    grads = [np.zeros_like(net.wx), np.zeros_like(net.u), np.einsum("tnh,tnk->hk", hs, p), p.sum((0, 1))]
    dhs = p @ net.v.T
    for w in (0, 1):
        back = np.zeros((len(y), hid), net.u.dtype)
        for t, h, z, r, new, hu in reversed(kept[w]):
            d = back + dhs[t][:, w * hid : (w + 1) * hid]
            dn = d * (1 - z) * (1 - new * new)
            dz, dr = d * (h - new) * z * (1 - z), dn * hu * r * (1 - r)
            np.add.at(grads[0][w], x[:, t], np.concatenate([dz, dr, dn], axis=1))
            gates = np.concatenate([dz, dr, dn * r], axis=1)
            grads[1][w] += h.T @ gates
            back = d * z + gates @ net.u[w].T
    return loss, grads


def train(langs: list[str], texts: list[list[bytes]], steps: int = STEPS, seed: int = 0) -> Network:
    """Fits the network by Adam on windows from anywhere in the texts of each language; batches hold as many of each."""
    rng, hid, k = np.random.default_rng(seed), HIDDEN, len(langs)
    net = Network(langs, *(rng.normal(0, s, d).astype(np.float32) for s, d in ((0.3, (2, 256, 3 * hid)), (0.3, (2, hid, 3 * hid)), (0.3, (2 * hid, k)))), np.zeros(k, np.float32))
    pools = [np.frombuffer(b"\n".join(some) + b"\n" * LENGTH, np.uint8) for some in texts]
    moments = [[np.zeros_like(q), np.zeros_like(q)] for q in (net.wx, net.u, net.v, net.c)]
    each = BATCH // k + 1
    for step in range(1, steps + 1):
        starts = [rng.integers(0, max(1, len(pool) - LENGTH), each) for pool in pools]
        x = np.concatenate([pool[s[:, None] + np.arange(LENGTH)] for pool, s in zip(pools, starts)])
        _, grads = gradients(net, x, np.repeat(np.arange(k), each))
        rate = RATE * (1 - 0.9 * step / steps)
        for q, g, m in zip((net.wx, net.u, net.v, net.c), grads, moments):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            q -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return net


def fit(docs: DataFrame, per_language: int = SAMPLE_DOCS, steps: int = STEPS) -> Network | None:
    """A network learned from text and non-null lang of rows outside the held-out fold, rows without an id among them; None if there are none."""
    known = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).filter((fold(F.col("doc_id")) != 1) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    spot, chosen = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")), F.lit(7)), F.lit(1 << 31)), F.lit(False)
    for a, n in counts.items():
        chosen |= (F.col("lang") == a) & (spot < min(1 << 31, int((1 << 31) * per_language / n) + 1))
    langs = sorted(counts)
    texts: list[list[tuple]] = [[] for _ in langs]
    for r in known.filter(chosen).select("doc_id", "lang", "text").toLocalIterator():
        texts[langs.index(r.lang)].append((r.doc_id, r.text.encode("utf-8", "surrogatepass")))
    if not any(t for some in texts for _, t in some):
        return None
    return train(langs, [[t for _, t in sorted(some, key=lambda r: (r[0] is None, r[0] or 0, r[1]))] for some in texts], steps)


def _identify(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            preds, scores = [UNKNOWN] * b.num_rows, [0.0] * b.num_rows
            texts = [t or "" for t in b.column(1).to_pylist()]
            for s, e in blocks([len(t) for t in texts], BLOCK_CHARS) if net else ():
                read = [i for i in range(s, e) if any(map(str.isalpha, texts[i]))]
                for i, total in zip(read, net.sums([texts[i].encode("utf-8", "surrogatepass") for i in read])):
                    best = int(total.argmax())
                    preds[i], scores[i] = net.langs[best], min(1.0, float(total[best] / total.sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row. The network labels each byte of the whole text; a document's score is the mean probability of its language over its letters.

    Null texts and those without a letter are `und` with score 0, as is everything if no language was learned. Texts of any length are read window by window.
    Repeated rows stay; an empty table gives none.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_identify(net), "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, net: Network | None, least: float = 0.4) -> DataFrame:
    """docs without the rows whose language stays unknown or whose score is below `least`; without a network nothing is known and all stay."""
    if net is None:
        return docs
    label = _identify(net)

    def keep(texts: list[str]) -> list[bool]:
        got = next(label(iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])])))
        return [p != UNKNOWN and s >= least for p, s in zip(got.column(1).to_pylist(), got.column(2).to_pylist())]

    return filtered(docs, keep)


def position_labels(net: Network, text: str) -> list[str]:
    """The language of each byte of a text, read as one window."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return [net.langs[k] for k in net.labels(raw[:, None]).argmax(1)[:, 0]] if len(raw) else []


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
