"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans they miss."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a run of digits is matched whole or not at all
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]")
#: An at sign that is spelled out; any segment with few digits and no sign needs one.
SPELLED = re.compile(r"\(at\)|\[at\]|(?<=\s)at(?=\s)", re.I)

# Words that announce each kind.
CUES = {
    "email": "mail email e-mail contact write address".split(),
    "ip": "ip host server address client from".split(),
    "card": "card visa credit debit pay account".split(),
    "phone": "phone tel telephone call mobile cell fax".split(),
}
# Words that announce a number of another sort.
OTHER = frozenset("invoice order ref reference no number nr version build release isbn iban serial sku case ticket tracking date dated since page item model part id code".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost, non-overlapping matches of each kind that pass its check, by kind and start."""
    if not ANCHOR.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


#: Entities are bounded: a segment has at most so many words and characters.
SEGMENT_WORDS, SEGMENT_CHARS = 7, 64
TOKEN = re.compile(r"[^\s]+")
TRIM = "\"'.,;:!?<>[]{}"


def _words_back(text: str, at: int, words: int) -> int:
    """Start of the word that is `words` before the one at `at`."""
    size = 128
    while True:
        part = text[max(0, at - size) : at]
        some = [m.start() for m in TOKEN.finditer(part)]
        if at <= size:
            return some[-words - 1] if len(some) > words else 0
        if len(some) > words + 1:  # the first one may be cut
            return at - size + some[-words - 1]
        size *= 4


def _words_on(text: str, at: int, words: int) -> int:
    """End of the word that is `words` after the one at `at`."""
    end = at
    for n, m in enumerate(TOKEN.finditer(text, at)):
        end = m.end()
        if n >= words:
            break
    return end


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches of whole words that hold every candidate segment of the text.

    A candidate holds a digit, an at sign or a spelled one, and at most SEGMENT_WORDS words, so words farther from all such signs are outside segments, where they score nothing:
    the best segmentation of the windows is that of the whole text. Windows with no word between them are one, as kinds of adjoining segments weigh on each other.
    """
    signs = [m.start() for m in ANCHOR.finditer(text)]
    if "at" in text or "AT" in text or "At" in text or "aT" in text:
        signs = sorted([*signs, *(m.start() for m in SPELLED.finditer(text))])
    out: list[list[int]] = []
    for at in signs:
        if out and at < out[-1][2]:  # the word was met already
            continue
        word_end = _words_on(text, at, 0)
        a, b = _words_back(text, at + 1, SEGMENT_WORDS - 1), _words_on(text, at, SEGMENT_WORDS - 1)
        if out and (a <= out[-1][1] or not text[out[-1][1] : a].strip()):
            out[-1][1:] = [max(b, out[-1][1]), word_end]
        else:
            out.append([a, b, word_end])
    return [(a, b) for a, b, _ in out]


def tokens(text: str, a: int, b: int) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text, a, b)]


def _bucket(n: int) -> int:
    return n if n < 20 else 20 + min(n // 10, 5)


def _calendar(groups: list[str]) -> bool:
    """Do three groups of digits make a date, in any usual order?"""
    n = [int(g) for g in groups]
    if len(groups[0]) == 4:
        return 1800 <= n[0] < 2200 and 1 <= n[1] <= 12 and 1 <= n[2] <= 31
    return len(groups[2]) in (2, 4) and 1 <= min(n[:2]) <= 12 and max(n[:2]) <= 31


def span_features(span: str, words: int, before: str, after: str) -> list[str]:
    """Features of the segment as a whole, and of the two words before it and the one after it; they do not hold the base patterns themselves."""
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    letters = sum(map(str.isalpha, span))
    low = span.lower()
    out = [f"d{_bucket(len(digits))}", f"w{words}", f"l{min(letters, 12) // 3}", f"at{span.count('@')}", f"dot{min(span.count('.'), 4)}", "plus" if span[0] == "+" else "noplus"]
    if len(digits) >= 12:
        out.append(f"luhn{luhn(digits)}")
    if letters == 0 and len(span) <= 24:
        out.append("shape" + re.sub("[0-9]+", lambda m: str(min(len(m[0]), 9)), span))
    if re.fullmatch(r"\+?[0-9 ().-]+", span):
        out.append("dial")
    if re.fullmatch(r"[0-9]+(?:[ -][0-9]+)*", span):
        out.append("plain")
    if re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3})+", span):
        out.append(f"quads{span.count('.')}")
    if re.fullmatch(r"[+-]?[0-9]+[.,][0-9]+", span):
        out.append("decimal")
    if len(groups) >= 3 and max(map(len, groups[:3])) <= 4 and _calendar(groups[:3]):
        out.append("date")
    if re.search(r"[\[( ]at[\]) ]", low):
        out.append("at_word")
        if m := re.fullmatch(r"([a-z0-9._%+-]{2,})([\[( ]+)at[\]) ]+([a-z0-9-]+)((?:[\[( ]*(?:dot[\]) ]+|[.])[a-z0-9-]+)+)", low):
            sign = "at_bare" if m[2] == " " else "at_bracket"
            dot = "dot_word" if "dot" in m[4] else "dot_sign"
            out += ["spelled", dot, f"{sign}_{dot}", f"end{min(len(re.split('[^a-z0-9]+', m[4])[-1]), 6)}"]
    if re.fullmatch(r"[0-9]{1,3}(?:[\[( ]*(?:dot|\.)[\]) ]*[0-9]{1,3}){3}", low) and max(map(int, groups)) <= 255:
        out.append("four_parts")
    if span[0] in "+(" or span[0].isalnum():
        out.append("opens")
    if span[-1].isalnum():
        out.append("closes")
    near = [w.strip(TRIM + "()#").lower() for w in before.split()]
    out += [f"cue_{k}" for k, some in CUES.items() if any(w in some for w in near)]
    if any(w in OTHER for w in near):
        out.append("cue_other")
    if before[-1:].isdigit() and span[0].isdigit():
        out.append("goes_on_before")
    if before and before.split()[-1].isalnum() and not before.split()[-1].isalpha() and not before.split()[-1].isdigit():
        out.append("code_before")
    if after[:1].isdigit() and span[-1].isdigit():
        out.append("goes_on_after")
    return out


class SemiMarkov:
    """Scores of whole segments by kind, and of the kinds of adjoining segments; boundaries and kinds are chosen together, by dynamic programming over segments of
    bounded length. A word outside segments is one of its own, which scores nothing."""

    def __init__(self, weights: dict[str, tuple[float, ...]] | None = None, follows: list[list[float]] | None = None) -> None:
        self.w = weights if weights is not None else {}  # feature: a weight for each kind
        self.follows = follows if follows is not None else [[0.0] * len(KINDS) for _ in KINDS]  # kind before, kind after

    def segments(self, text: str, toks: list[tuple[int, int]]) -> list[tuple[int, int, int, int, list[str]]]:
        """(first word, end word, start, end, features) of every candidate segment."""
        out = []
        for i in range(len(toks)):
            before = text[toks[max(0, i - 2)][0] : toks[i - 1][1]] if i else ""
            for j in range(i + 1, min(i + SEGMENT_WORDS, len(toks)) + 1):
                if toks[j - 1][1] - toks[i][0] > SEGMENT_CHARS:
                    break
                a, b = toks[i][0], toks[j - 1][1]
                while a < b and text[a] in TRIM:
                    a += 1
                while b > a and text[b - 1] in TRIM:
                    b -= 1
                span = text[a:b]
                if b - a < 6 or "\n" in span or not (sum(map(span.count, "0123456789")) >= 4 or "@" in span or SPELLED.search(span)):
                    continue
                after = text[toks[j][0] : toks[j][1]] if j < len(toks) and b == toks[j - 1][1] else ""
                out.append((i, j, a, b, span_features(span, j - i, before, after)))
        return out

    def scores(self, feats: list[str]) -> list[float]:
        """The segment's score as each kind."""
        found = [self.w[f] for f in ("", *feats) if f in self.w]
        return [sum(c) for c in zip(*found)] if found else [0.0] * len(KINDS)

    def best(self, text: str, toks: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """The segmentation with the highest score."""
        by_end = defaultdict(list)
        for i, j, a, b, f in self.segments(text, toks):
            by_end[j].append((i, a, b, self.scores(f)))
        if not by_end:
            return []
        low, kinds = -math.inf, range(len(KINDS))
        top, back = [0.0], {}  # the best that ends in a word outside, or at the start
        ends: list[list[float] | None] = [None]  # the best that ends in a segment of each kind
        for j in range(1, len(toks) + 1):
            last = ends[j - 1]
            k = max(kinds, key=lambda x: last[x]) if last else None
            back[j, None] = k if k is not None and last[k] > top[j - 1] else None
            top.append(top[j - 1] if back[j, None] is None else last[k])
            here = [low] * len(KINDS) if j in by_end else None
            for i, a, b, some in by_end.get(j, ()):
                for k in kinds:
                    least, came = top[i], None
                    for x in kinds if ends[i] else ():
                        if ends[i][x] + self.follows[x][k] > least:
                            least, came = ends[i][x] + self.follows[x][k], x
                    if least + some[k] > here[k]:
                        here[k] = least + some[k]
                        back[j, k] = (i, came, (KINDS[k], a, b))
            ends.append(here)
        j = len(toks)
        at = max(kinds, key=lambda x: ends[j][x]) if ends[j] else None
        at = at if at is not None and ends[j][at] > top[j] else None
        out = []
        while j:
            if at is None:
                at, j = back[j, None], j - 1
            else:
                j, at, found = back[j, at]
                out.append(found)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Lattice:
    """Candidate segments of windows of like length, as arrays: windows are the first axis of all sums."""

    def __init__(self, rows: list[tuple[int, list, list[int], np.ndarray]]) -> None:
        self.size, self.words = len(rows), max(n for n, _, _, _ in rows)
        place = [(s, j, j - i - 1) for s, (_, segs, _, _) in enumerate(rows) for i, j, _ in segs]
        self.place = tuple(np.array(c) for c in zip(*place))
        feats = [f for _, segs, _, _ in rows for _, _, f in segs]
        self.starts = np.cumsum([0, *map(len, feats)])[:-1]
        self.flat = np.concatenate(feats)
        self.of = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
        gold = np.array([k for _, _, some, _ in rows for k in some])
        self.gold = (gold[:, None] == np.arange(len(KINDS))).astype(float)
        self.pairs = sum(p for _, _, _, p in rows)

    def slope(self, w: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likelihood's slope by weight, and by kinds that adjoin: what the labels hold less what is expected, by forward and backward sums over all segmentations."""
        n, kinds, low = self.words, len(KINDS), -1e9
        score = np.full((self.size, n + 1, SEGMENT_WORDS, kinds), low)
        score[self.place] = np.add.reduceat(w[self.flat], self.starts)
        fwd = np.full((self.size, n + 1, kinds + 1), low)  # the last label: a word outside
        fwd[:, 0, kinds] = 0.0
        into, onward = np.full((2, self.size, n + 1, kinds), low)
        step = np.vstack([follows, np.zeros(kinds)])
        for j in range(n + 1):
            if j:
                fwd[:, j, kinds] = _log_sum(fwd[:, j - 1], 1)
                most = min(j, SEGMENT_WORDS)
                fwd[:, j, :kinds] = _log_sum(score[:, j, :most] + into[:, j - most : j][:, ::-1], 1)
            into[:, j] = _log_sum(fwd[:, j, :, None] + step, 1)
        bwd = np.zeros((self.size, n + 1, kinds + 1))
        for i in range(n - 1, -1, -1):
            some = [score[:, i + m + 1, m] + bwd[:, i + m + 1, :kinds] for m in range(min(SEGMENT_WORDS, n - i))]
            onward[:, i] = _log_sum(np.stack(some, 1), 1)
            bwd[:, i] = _log_sum(np.concatenate([step + onward[:, i, None], np.repeat(bwd[:, i + 1, None, kinds:], kinds + 1, 1)], 2), 2)
        total = _log_sum(fwd[:, n], 1)
        s, j, m = self.place
        left = self.gold - np.exp(np.minimum(0.0, into[s, j - m - 1] + score[self.place] + bwd[s, j, :kinds] - total[s, None]))
        by_weight = np.stack([np.bincount(self.flat, left[self.of, k], len(w)) for k in range(kinds)], 1)
        adjoin = np.exp(np.minimum(0.0, fwd[:, :n, :kinds, None] + follows + onward[:, :n, None] - total[:, None, None, None])).sum((0, 1))
        return by_weight, self.pairs - adjoin


def variants(kind: str, span: str) -> list[str]:
    """Other ways to write the same value that the exact patterns miss: labelled by construction."""
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "email":
        user, _, host = span.partition("@")
        dots = host.replace(".", " dot ")
        short = re.sub("[0-9]", "", f"{user} at {dots}")
        return [short, f"{user} at {dots}", f"{user}[at]{host.replace('.', '[dot]')}", f"{user} (at) {host}", f"{user.upper()} AT {dots.upper()}"]
    if kind == "phone" and len(digits) >= 10:
        d = digits[-10:]
        return [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"]
    if kind == "card":
        return [".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), "/".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    if kind == "ip":
        parts = span.split(".")
        return [" dot ".join(parts), " dot ".join(x[: 2 - min(n, 1)] for n, x in enumerate(parts)), " dot ".join(parts[:2]) + "." + ".".join(parts[2:]), "[.]".join(parts)]
    return []


def lookalikes(rng: np.random.Generator) -> list[str]:
    """Numbers and phrases that are no personal data: one of each shape, with the words that announce it where its digits alone leave doubt."""
    n = lambda low, high: int(rng.integers(low, high))
    run = lambda size: "".join(str(n(0, 10)) for _ in range(size))
    year, month, day, clock = n(1950, 2035), n(1, 13), n(1, 32), f"{n(0, 24):02}:{n(0, 60):02}"
    word = lambda: str(rng.choice("noon shop meet stay look sold found gate store stand here page site news home".split()))
    host = f"{word()}{word()}.{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'io'])}"
    other = str(rng.choice(sorted(OTHER)))
    dates = [f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{month:02}/{day:02}/{year}", f"{day}-{month}-{year}", f"{year}/{month:02}/{day:02}", f"{year}.{month:02}.{day:02}", f"{year}{month:02}{day:02}"]
    date = str(rng.choice(dates))
    version = f"{n(0, 30)}.{n(0, 30)}.{n(0, 400)}"
    out = [*dates, f"{date} {clock}", f"{date}T{clock}:{n(10, 60)}", f"{date} {dates[0]}", f"{year}-{year + n(1, 9)}", f"{clock}-{n(10, 24)}:30"]
    out += [f"{n(0, 10)}.{run(n(3, 12))}", f"{n(10, 180)}.{run(n(4, 8))}", f"-{n(0, 90)}.{run(6)}, {n(0, 180)}.{run(6)}", f"{n(1, 999)},{run(3)},{run(3)}.{run(2)}", f"{n(1, 999)}.{run(3)}.{run(3)},{run(2)}", f"{n(1, 99)} {run(3)} {run(3)}"]
    out += [version, f"v{version}", f"{version} build {date}", f"{version}.{n(256, 9999)}", f"{version}-{n(1, 99)}", f"version {n(1, 20)}.{n(0, 20)}.{n(0, 20)}-{run(4)}"]
    out += [f"{other} {run(3)}-{run(3)}-{run(4)}", f"{other} {run(n(6, 20))}", f"{other}: {run(4)}-{run(4)}-{run(n(2, 5))}", f"{other} #{run(3)}.{run(3)}.{run(4)}", f"{other} {run(4)} {run(4)} {run(4)} {run(4)}", f"{other} {year}-{run(6)}"]
    out += [f"978-{n(0, 9)}-{run(2)}-{run(6)}-{n(0, 9)}", f"DE{run(2)} {run(4)} {run(4)} {run(4)} {run(4)} {run(2)}", f"FR{run(2)} {run(4)} {run(4)} {run(4)} {run(4)} {run(4)} {run(3)}", f"GB{run(2)} ABCD {run(4)} {run(4)} {run(4)} {run(2)}"]
    return [*out, f"{word()} at {host}", f"{word()} at {n(1, 24)}.{n(10, 60)}", f"{word()} at {date}", f"{word()} at {word()}.{word()}", f"at {n(1, 99)}.{run(2)} {run(3)}"]


#: Longer windows, and further ones of a document, take no part in training.
TRAINED_CHARS, TRAINED_EACH = 1000, 40


def parts_of(text: str) -> list[str]:
    """The windows of a text that training may take."""
    return [text[a:b] for a, b in windows(text) if b - a <= TRAINED_CHARS][:TRAINED_EACH]


def samples_of(texts: list[str], each: int) -> list[tuple[str, set[tuple[str, int, int]]]]:
    """Windows with their gold spans: of each kind up to `each` windows that hold such a base span, with copies in which it is written another way, and four times as many windows without any; of both also copies in which a lookalike takes the value's or some word's place."""
    held: dict[str | None, list] = {k: [] for k in (*KINDS, None)}
    for part in (p for t in texts for p in parts_of(t)):
        inside = set(base_spans(part))
        for k in {k for k, _, _ in inside} or {None}:
            if len(held[k]) < each * (1 if k else 4):
                held[k].append((part, inside))
    out, rng = [], np.random.default_rng(1)
    shapes = iter(())
    for kind, some in held.items():
        for part, inside in some:
            out.append((part, inside))
            values = [(s, e) for k, s, e in sorted(inside) if k == kind]
            if kind is None:
                toks = tokens(part, 0, len(part))
                values = [toks[rng.integers(len(toks))]] if toks else []
            for s, e in values if len(inside) <= 3 else []:
                for v in variants(kind, part[s:e]) if kind else []:
                    if len(v.split()) <= SEGMENT_WORDS and len(v) <= SEGMENT_CHARS:
                        move = len(v) - (e - s)
                        rest = {(x, y + move * (y >= e), z + move * (z >= e)) for x, y, z in inside if (x, y, z) != (kind, s, e)}
                        if all(z <= s or y >= e for _, y, z in inside - {(kind, s, e)}):
                            out.append((part[:s] + v + part[e:], rest | {(kind, s, s + len(v))}))
                for _ in range(2):
                    shape = next(shapes, None)
                    if shape is None:
                        shapes = iter(lookalikes(rng))
                        shape = next(shapes)
                    made = part[:s] + shape + part[e:]
                    gold = base_spans(made)
                    if all(z <= s or y >= s + len(shape) for _, y, z in gold):
                        out.append((made, set(gold)))
    return out


def train(texts: list[str], epochs: int = 20, each: int = 150, together: int = 128) -> SemiMarkov:
    """Fitted on windows of the texts in which base spans are the labels, on copies in which values are written another way, and on lookalikes; `each` bounds the windows of a
    kind. The slope of `together` windows of like length at a time, all segmentations summed in arrays; features are made once."""
    crf, names, rows = SemiMarkov(), {"": 0}, []
    for part, gold in samples_of(texts, each):
        toks, place = tokens(part, 0, len(part)), {(s, e): KINDS.index(k) for k, s, e in gold}
        segs, labels, pairs, last, end = [], [], np.zeros((len(KINDS), len(KINDS))), None, 0
        found = sorted(crf.segments(part, toks), key=lambda x: (x[0], x[1]))
        for i, j, a, b, f in found:
            k = place.pop((a, b), -1) if i >= end else -1  # of segments with the same span the shortest is the labelled one
            if k >= 0:
                if last is not None and end == i and end:
                    pairs[last, k] += 1
                last, end = k, j
            segs.append((i, j, np.array([0, *(names.setdefault(x, len(names)) for x in f)])))
            labels.append(k)
        if segs:
            rows.append((len(toks), segs, labels, pairs))
    rows.sort(key=lambda x: x[0])
    batches = [Lattice(rows[i : i + together]) for i in range(0, len(rows), together)]
    w, follows = np.zeros((len(names), len(KINDS))), np.zeros((len(KINDS), len(KINDS)))
    seen, seen_follows = np.full(w.shape, 1.0), np.full(follows.shape, 1.0)
    for n in range(epochs):
        for i in np.random.default_rng(n).permutation(len(batches)):
            up, up_follows = batches[i].slope(w, follows)
            up, up_follows = up - 0.02 * w, up_follows - 0.02 * follows
            seen += up * up
            seen_follows += up_follows * up_follows
            w += 0.5 * up / np.sqrt(seen)
            follows += 0.5 * up_follows / np.sqrt(seen_follows)
    return SemiMarkov({f: tuple(w[i].tolist()) for f, i in names.items()} if rows else {}, follows.tolist())


def spans(text: str, crf: SemiMarkov | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: those that the field adds overlap no base span."""
    base = base_spans(text)
    if crf is None:
        return base, base
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for a, b in windows(text):
        for k, s, e in crf.best(text, tokens(text, a, b)):
            if not any(s < y and x < e for x, y in taken if y > a and x < b):
                added.append((k, s, e))
    return base, sorted([*base, *added], key=lambda x: (KINDS.index(x[0]), x[1]))


def fit(docs: DataFrame, most_docs: int = 1500) -> SemiMarkov:
    """A field trained on a bounded sample: windows of about `most_docs` documents with a digit or an at sign, chosen by a hash of the id from all of the table, and in the
    order of that hash. Tasks cut the windows; at most TRAINED_EACH of TRAINED_CHARS characters from each document reach the driver."""
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]"))
    n = some.count()
    spot = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 31))
    drawn = some.withColumn("spot", F.coalesce(spot, F.lit(0))).filter(spot < min(1 << 31, int((1 << 31) * most_docs / max(n, 1)) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(*x, n, p) for *x, t in zip(*(c.to_pylist() for c in b.columns)) for n, p in enumerate(parts_of(t))]
            cols = zip(*got) if got else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.string()))], names=["spot", "doc_id", "n", "part"])

    rows = drawn.select("spot", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text").mapInArrow(run, "spot long, doc_id long, n int, part string").toLocalIterator()
    return train([r.part for r in sorted(rows)])


def find(docs: DataFrame, crf: SemiMarkov | None) -> DataFrame:
    """(doc_id, base, spans): lists of (kind, start, end) in code points, ends exclusive, for the whole text of every row.

    base holds the exact patterns' matches by kind and start; spans adds what the field finds elsewhere. Null texts are empty, repeated rows stay,
    an empty table gives none. Without a field, spans equals base.
    """
    kind = "array<struct<kind:string,start:long,end:long>>"
    made = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = ("kind", "start", "end")
        for b in batches:
            got = [spans(t.as_py() or "", crf) for t in b.column(1)]
            cols = [pa.array([[dict(zip(name, s)) for s in g[k]] for g in got], made) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, fit(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(F.array_compact(F.transform("base", lambda s: F.when(s["kind"] == k, 1)))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
