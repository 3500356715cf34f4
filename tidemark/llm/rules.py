"""Quality rules: text statistics, and decision lists learned from labelled ones by sequential covering, as ordered Spark conditions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, held_out, table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Characters that one step of the statistics holds.
STEP = 1_000_000
#: Labelled documents of each label that training may use at most.
LABELLED = 6000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_distinct", "n_letters", "n_digits", "n_upper", "n_marks")


def _classes() -> np.ndarray:
    """A bit for each property of each code point: letter, digit, capital, punctuation mark, symbol, space."""
    marks = set(".,;:!?")
    return np.array([c.isalpha() | c.isdigit() << 1 | c.isupper() << 2 | (c in marks) << 3 | (c in SYMBOLS) << 4 | (c in SPACES) << 5 for c in map(chr, range(0x110000))], np.uint8)


def _repeated(ids: np.ndarray, doc: np.ndarray, docs: int, window: int) -> np.ndarray:
    """Words of each document that stand in a window which comes twice or more in it. Windows are told apart exactly: codes of shorter ones are paired and numbered anew."""
    n = len(ids) - window + 1
    if n < 1:
        return np.zeros(docs, np.int64)
    code = ids
    for i in range(1, window):
        code, _ = pd.factorize(code[: len(ids) - i] * (ids.max() + 1) + ids[i:])
        code = code.astype(np.int64)
    whole = doc[:n] == doc[window - 1 :]
    start = np.flatnonzero(whole)
    key, _ = pd.factorize(code[start] * docs + doc[start])
    twice = start[np.bincount(key)[key] > 1] if len(start) else start
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=docs)


def _counted(texts: list[str], classes: np.ndarray, window: int) -> np.ndarray:
    """One row of COUNTS for each text."""
    docs = len(texts)
    lengths = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(docs), lengths)
    kind = classes[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
    each = lambda bit: np.bincount(owner[(kind & bit) > 0], minlength=docs)
    split = [t.encode().split() for t in texts]  # bytes are split at the six spaces, and at no others
    n_words = np.array([len(w) for w in split])
    ids, _ = pd.factorize(np.array([w for s in split for w in s], object))
    ids, doc = ids.astype(np.int64), np.repeat(np.arange(docs), n_words)
    distinct = np.bincount(np.unique(doc * (ids.max(initial=0) + 1) + ids) // (ids.max(initial=0) + 1), minlength=docs)
    lines = [[x for x in t.split("\n") if x.strip(SPACES)] for t in texts]
    n_lines = np.array([len(x) for x in lines])
    n_dup = n_lines - np.array([len(set(x)) for x in lines])
    return np.stack([n_words, lengths - each(32), each(16), n_dup, _repeated(ids, doc, docs, window), lengths, n_lines, distinct, each(1), each(2), each(4), each(8)], 1)


def statistics(docs: DataFrame, window: int = 5) -> DataFrame:
    """(doc_id, COUNTS as longs) of each whole text; null texts are empty. Words are runs of anything but the six ASCII spaces; n_repeat_words counts those in windows of `window` words found twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes()
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for start, end in blocks([len(t) for t in texts], STEP):
                found = _counted(texts[start:end], classes, window)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, end - start), *(pa.array(c, pa.int64()) for c in found.T)], ["doc_id", *COUNTS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def measures() -> dict[str, Column]:
    """What the rules may ask about: figures that do not grow with the text, besides its length."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "marks_per_word": share("n_marks", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "letter_share": share("n_letters", "n_chars"),
        "digit_share": share("n_digits", "n_chars"),
        "capital_share": share("n_upper", "n_letters"),
        "distinct_share": share("n_distinct", "n_words"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (measure, '<=' or '>', threshold) that rejects what it covers."""

    conditions: tuple[tuple[str, str, float], ...]

    def __str__(self) -> str:
        return " AND ".join(f"{m} {o} {t:g}" for m, o, t in self.conditions)

    def covers(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        hit = np.ones(len(x), bool)
        for m, o, t in self.conditions:
            col = x[:, names.index(m)]
            hit &= col <= t if o == "<=" else col > t
        return hit

    def column(self) -> Column:
        by = measures()
        out = F.lit(True)
        for m, o, t in self.conditions:
            out &= by[m] <= t if o == "<=" else by[m] > t
        return out


def _cut(a: float, b: float) -> float:
    """The shortest decimal from a up to, but without, b."""
    middle = (a + b) / 2
    for digits in range(1, 17):
        t = float(f"{middle:.{digits}g}")
        if a <= t < b:
            return t
    return a


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], most: int) -> Rule:
    """Adds the condition with the largest information gain on the rows still covered, until no good row is, or nothing gains. Ties by measure, then direction and threshold."""
    conditions: list[tuple[str, str, float]] = []
    rows = np.arange(len(x))
    while len(conditions) < most and 0 < bad[rows].sum() < len(rows):
        y = bad[rows]
        before = np.log2(y.sum() / len(y))
        best = (1e-9, None)
        for j, name in enumerate(names):
            order = np.argsort(x[rows, j], kind="stable")
            v, hits = x[rows, j][order], np.cumsum(y[order])
            cut = np.flatnonzero(v[:-1] < v[1:])
            for sign, p, n in (("<=", hits[cut], cut + 1), (">", hits[-1] - hits[cut], len(v) - cut - 1)):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - before), 0) if len(cut) else np.zeros(0)
                if len(gain) and gain.max() > best[0]:
                    at = cut[gain.argmax()]
                    best = (gain.max(), (name, sign, _cut(v[at], v[at + 1])))
        if best[1] is None:
            break
        conditions.append(best[1])
        rows = rows[Rule((best[1],)).covers(x[rows], names)]
    return Rule(tuple(conditions))


def learn(x: np.ndarray, bad: np.ndarray, prune: np.ndarray, names: list[str], precision: float = 0.95, most_rules: int = 20, most_conditions: int = 4) -> list[Rule]:
    """Sequential covering: each rule is grown on the rows outside `prune`, cut back there to the prefix of conditions that separates best ((p - n) / (p + n)),
    and kept if at least `precision` of what it covers (counted with one good row more) is bad; its rows go before the next one is grown. The first rule that fails ends the list."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    while len(rules) < most_rules:
        grow, held = left & ~prune, left & prune
        if not bad[grow].any():
            break
        full = _grow(x[grow], bad[grow], names, most_conditions)
        worth = []
        for n in range(1, len(full.conditions) + 1):
            hit = bad[held][Rule(full.conditions[:n]).covers(x[held], names)]
            worth.append((2 * hit.sum() - len(hit)) / max(1, len(hit)))
        if not worth:
            break
        rule = Rule(full.conditions[: 1 + int(np.argmax(worth))])
        hit = left & rule.covers(x, names)
        if bad[hit].sum() < precision * (hit.sum() + 1):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELLED, **options) -> list[Rule]:
    """Rules from documents that pass the base conditions and are not held out: at most `most` of each label, those with the least hashes of doc_id and text.

    The ids are chosen from the labels alone and broadcast (at most twice `most`); numbers of as many rows reach the driver, no texts. An id with both labels is not used; no labels give no rules.
    """
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).filter("quality = _most").drop("_most")
    known = known.filter(~held_out(F.col("doc_id")))
    chosen = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for q in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))
    by = measures()
    rows = statistics(docs.select("doc_id", "text").join(chosen.select("doc_id"), "doc_id", "left_semi")).filter(~base_failed()).join(chosen, "doc_id")
    turn = F.xxhash64("doc_id", *COUNTS)
    got = np.array(rows.orderBy(turn, "doc_id").limit(2 * most).select(*by.values(), F.col("quality") == 0, F.pmod(turn, F.lit(3)) == 0).collect(), float).reshape(-1, len(by) + 2)
    return learn(got[:, : len(by)], got[:, -2] > 0, got[:, -1] > 0, list(by), **options)


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional: the number of the first rule that covers a row (from 1), else 0."""
    out = F
    for i, rule in enumerate(rules):
        out = out.when(rule.column(), F.lit(i + 1))
    return F.lit(0) if out is F else out.otherwise(F.lit(0))


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Each document with its statistics, base_failed, kept (neither failed nor covered by a rule) and rule: the text of the rule that covers it, null if none or if it failed before.

    Null texts have no words and fail; null ids stay; repeated rows stay; an empty table gives no rows; other columns of docs have no effect.
    """
    rows = statistics(docs).withColumn("base_failed", base_failed()).withColumn("_rule", F.when(F.col("base_failed"), 0).otherwise(verdict(rules)))
    said = F.element_at(F.array(*(F.lit(str(r)) for r in rules)), F.col("_rule")) if rules else F.lit(None).cast("string")
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("_rule") == 0)).withColumn("rule", F.when(F.col("_rule") > 0, said)).drop("_rule")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = judged(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", *COUNTS[:5], "base_failed", "kept", "rule", held_out(F.col("doc_id")).alias("held_out"))
