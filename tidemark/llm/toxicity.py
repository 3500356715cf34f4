"""Toxicity: a weighted grammar of finite-state transducers over the word classes of a clause."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, held_out, table

#: Fitted on at most so many labelled documents of each label, chosen by a hash of their ids, from all of the table.
SAMPLE_DOCS = 3000
THRESHOLD = 0.7

# Words of each class, in English, German, French and Spanish; insults are also learned from the labels.
INSULTS = """
idiot idiots moron morons loser losers imbecile imbeciles scumbag scumbags asshole assholes
idioten trottel dummkopf versager arschloch widerling schwachkopf vollidiot
idiote idiotes crétin crétins imbécile imbéciles abruti connard débile
idiota idiotas imbécil estúpido estúpida cretino gilipollas pendejo
""".split()
#: Insults that have an everyday sense as well; the words of a line share one.
EVERYDAY = """
stupid dumb fool fools
trash garbage filth vermin scum abschaum ordure escoria
worthless pathetic minable
disgusting
clown clowns
jerk jerks
"""
SENSES = {w: line.split()[0] for line in EVERYDAY.strip().splitlines() for w in line.split()}
THREATS = """
kill hurt destroy burn attack stab shoot murder strangle
umbringen töten verprügeln erschießen erstechen vernichten
tuer frapper détruire brûler écraser égorger
matar golpear destruir quemar aplastar apuñalar
""".split()
TARGETS = """
you yourself him them her everyone
sie
toi
ti usted ustedes vosotros ellos ellas
""".split()
#: Pronouns that are subjects only.
SUBJECTS = """
he she they
du ihr er
tu ils elles il elle
tú él ella
""".split()
#: Pronouns that stand before the verb whose object they are.
OBJECTS = "dich dir euch ihn ihnen te vous os".split()
PERSONS = """
person people man men woman women guy guys boy girl kid kids child children family
mensch menschen leute mann frau kind kinder
personne gens homme femme enfant enfants
persona gente hombre mujer niño niños
""".split()
COPULAS = """
are is am was were
ist sind
es est sont
son
""".split()
#: Copulas that tell their person.
YOU_ARE = "you're he's she's they're bist seid êtes eres sois".split()
FIRST, WILL = "i i'm we we're ich wir je nous yo".split(), "will gonna going shall".split()
#: Intention of a first person in one word.
INTENTS = "i'll we'll werde werden vais allons voy vamos".split()
NEGATIONS = """
not never no without isn't aren't wasn't don't doesn't won't nobody hardly
nicht nie niemals kein keine keinen ohne
pas jamais aucun aucune sans
nunca jamás ningún ninguna sin
""".split()
REPORTS = """
said says say quoted quotes wrote writes claimed claims reported reports called allegedly
sagte sagt schrieb behauptete zitierte angeblich
dit disait écrit prétendait selon
dijo dice escribió afirmó según
""".split()
#: Words that can follow a predicate without making it an attribute.
LINKS = """
and or but for who because so to at in of on with if when now today always anyway
und oder aber weil
et ou mais
y o pero
""".split()

#: Classes of the words of a clause: insult, insult with an everyday sense, threat, target, subject pronoun, object pronoun, person, copula, copula with its person, first
#: person, will, intention, negation, reported speech, link, other, and learned word that clean texts also hold now and then.
INSULT, COMMON, THREAT, TARGET, SUBJECT, OBJECT, PERSON, COPULA, PREDICATE, SELF, WILLING, INTENT, NEGATION, REPORT, LINK, OTHER, DOUBTFUL = "IMTYZOPBCAWGNRFoV"
CLASSES = ((LINKS, LINK), (PERSONS, PERSON), (COPULAS, COPULA), (YOU_ARE, PREDICATE), (FIRST, SELF), (WILL, WILLING), (INTENTS, INTENT), (SUBJECTS, SUBJECT), (TARGETS, TARGET), (OBJECTS, OBJECT), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT), (SENSES, COMMON), (INSULTS, INSULT))
#: Weights of what the grammar writes; the second transducer adds them up.
WORTH = {INSULT: 1.0, COMMON: 0.5, "J": 1.5, "K": 1.5, "U": 1.5, DOUBTFUL: 0.5, "D": 0.75}
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;\n]+")


@dataclass
class Transducer:
    """Letter transducer: arcs lead (state, letter) to (state, letter out, weight); a letter without an arc leads to `reset` and is copied."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    reset: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, letter: str) -> tuple[int, str, float]:
        return self.arcs.get((state, letter)) or (self.reset.get(state, 0), letter, 0.0)


@dataclass
class Composed:
    """Composition of transducers: what one writes, the next reads; weights add up. Of the states, tuples of those of the parts, only those that texts reach are made, once."""

    parts: list[Transducer]
    arcs: dict[tuple[tuple, str], tuple[tuple, str, float]] = field(default_factory=dict)

    def step(self, state: tuple, letter: str) -> tuple[tuple, str, float]:
        got = self.arcs.get((state, letter))
        if got is None:
            after, out, total = [], letter, 0.0
            for part, s in zip(self.parts, state):
                s, out, w = part.step(s, out)
                after.append(s)
                total += w
            got = self.arcs[state, letter] = (tuple(after), out, total)
        return got

    def run(self, letters: str) -> tuple[str, float]:
        state, out, total = (0,) * len(self.parts), [], 0.0
        for x in letters:
            state, y, w = self.step(state, x)
            out.append(y)
            total += w
        return "".join(out), total


def _after(triggers: str, letter: str, out: str, reach: int) -> Transducer:
    """Rewrites `letter` to `out` if one of the triggers stood at most `reach` letters before; a reach of 0 means anywhere before."""
    if reach == 0:
        return Transducer({**{(0, t): (1, t, 0.0) for t in triggers}, (1, letter): (1, out, 0.0)}, {1: 1})
    arcs = {(s, t): (1, t, 0.0) for s in range(reach + 1) for t in triggers}
    arcs |= {(s, letter): ((s + 1) % (reach + 1), out, 0.0) for s in range(1, reach + 1)}
    return Transducer(arcs, {s: (s + 1) % (reach + 1) for s in range(1, reach + 1)})


def grammar() -> tuple[Composed, Composed]:
    """Two composed transducers: the first reads a clause, the second reads what it wrote from the end.

    Negation within three words before cancels an insult or a threat; so does reported speech anywhere before or after. An insult is aimed as the predicate of a person
    (at most four words after the copula) or beside a target (two words). An insult with an everyday sense is aimed as a predicate or directly after a target, and not
    where another word follows that it describes ("a stupid bug"). A threat is aimed if a first person intends it (within four words before) and its object is a person:
    at most two words after, or an object pronoun at most four before. Letters out: i, t, v cancelled; J aimed, U aimed threat, D aimed doubtful; I, M, V plain; T and S
    threats at nobody. Weights: aimed insult or threat 1.5, plain insult 1, plain everyday insult and doubtful word 0.5, aimed doubtful word 0.75.
    """
    target = TARGET + SUBJECT + OBJECT
    cancel = [("I", "i"), ("M", "i"), ("T", "t"), ("V", "v"), ("J", "i"), ("K", "i"), ("S", "t"), ("U", "t"), ("D", "v")]
    forward = [
        *((NEGATION, x, y, 3) for x, y in cancel[:4]), *((REPORT, x, y, 0) for x, y in cancel[:4]),
        (SELF, WILLING, INTENT, 2), (INTENT, THREAT, "S", 4), (OBJECT, "S", "U", 4),
        (target + PERSON, COPULA, PREDICATE, 2), (PREDICATE, INSULT, "J", 4), (PREDICATE, COMMON, "K", 4),
        (target, INSULT, "J", 2), (TARGET + SUBJECT, COMMON, "K", 1), ("K", COMMON, "K", 1), ("K", INSULT, "J", 1), (target, DOUBTFUL, "D", 4),
    ]
    backward = [
        *((REPORT, x, y, 0) for x, y in cancel), (OTHER, "K", COMMON, 1), ("K", COMMON, "K", 1), ("J", COMMON, "K", 1),
        (TARGET + OBJECT + PERSON, "S", "U", 2), (target, INSULT, "J", 2), (target, DOUBTFUL, "D", 4),
    ]
    weigh = Transducer({(0, x): (0, "J" if x == "K" else x, w) for x, w in WORTH.items()})
    return Composed([_after(*r) for r in forward]), Composed([*(_after(*r) for r in backward), weigh])


@dataclass
class Model:
    """words and stems to their class: lower-case words, and beginnings of learned words that take many endings; weights of the features and the bias."""

    words: dict[str, str]
    stems: dict[str, str]
    weights: np.ndarray
    bias: float


#: Features of a document: logarithm of its clauses with an aimed insult; its plain insults beyond the first, each in at most two clauses, an everyday sense counting half, up to 4;
#: logarithms of its clauses with an aimed threat, and with a cancelled match only; weight per hundred words, where one of the first three is not zero; weight of its
#: doubtful clauses, up to 4, and per hundred words. So one word that is aimed at nobody never counts.
FEATURES = 7
# What the weights are taken to be where the labels say nothing, and how firmly.
PRIOR, BIAS, FIRM = np.array([6.0, 3.0, 6.0, -0.5, 0.3, 1.0, 0.5]), -3.0, 0.1
#: One aimed clause alone scores at least this, whatever the labels say: few of them may hold any.
AIMED = 0.8


class Scorer:
    def __init__(self, words: dict[str, str], stems: dict[str, str]) -> None:
        self.words, self.stems, self.rules = words, stems, grammar()
        self.find = ahocorasick.Automaton()
        for w in stems:
            self.find.add_word(w, (len(w), False))
        for w in (w for w, c in words.items() if c in (INSULT, COMMON, THREAT, DOUBTFUL)):
            self.find.add_word(w, (len(w), w not in stems))
        if len(self.find):
            self.find.make_automaton()
        self.seen: dict[str, tuple[int, float, str]] = {}

    def letter(self, word: str) -> str:
        got = self.words.get(word)
        if got is None:
            got = next((self.stems[word[:n]] for n in range(STEM[0], STEM[1] + 1) if word[:n] in self.stems), OTHER) if self.stems else OTHER
        return got

    def read(self, letters: str) -> tuple[int, float, str]:
        """Kind and weight of a clause, and what the grammar makes of each word. Kinds: 0 aimed insult, 1 aimed threat, 2 plain insult, 3 cancelled, 4 doubtful, 5 nothing."""
        if letters not in self.seen:
            if len(self.seen) > 100_000:
                self.seen.clear()
            written, w = self.rules[1].run(self.rules[0].run(letters)[0][::-1])
            self.seen[letters] = next((k for k, marks in enumerate(("J", "U", "IM", "itv", "VD")) if any(m in written for m in marks)), 5), w, written[::-1]
        return self.seen[letters]

    def clause(self, letters: str) -> tuple[int, float]:
        return self.read(letters)[:2]

    def features(self, text: str) -> np.ndarray:
        """Whole text, clause by clause; only clauses in which the automaton finds a whole word that is an insult or a threat are read word by word."""
        low, out = text.lower(), np.zeros(FEATURES)
        if not len(self.find):
            return out
        hits = sorted(e - n + 1 for e, (n, whole) in self.find.iter(low) if (not whole or e == len(low) - 1 or not low[e + 1].isalpha()) and (e < n or not low[e - n].isalpha()))
        if not hits:
            return out
        counts, total, doubtful, plain = [0.0] * 6, 0.0, 0.0, {}
        ends = [m.start() for m in CLAUSE.finditer(low)] + [len(low)]
        start = k = 0
        for end in ends:
            any_hit = False
            while k < len(hits) and hits[k] < end:
                any_hit, k = True, k + 1
            if any_hit:
                words = WORD.findall(low, start, end)
                kind, w, marks = self.read("".join(map(self.letter, words)))
                counts[kind] += 1
                unsure = WORTH[DOUBTFUL] * marks.count(DOUBTFUL) + WORTH["D"] * marks.count("D")
                doubtful += unsure
                total += w - unsure
                if kind == 2:
                    for x, m in {(SENSES.get(x, x), m) for x, m in zip(words, marks) if m in (INSULT, COMMON)}:
                        plain[x] = min(plain.get(x, 0.0) + WORTH[m], 2 * WORTH[m])
            start = end
        n = max(20, low.count(" ") + 1)
        beyond = min(max(0.0, sum(plain.values()) - 1), 4.0)
        dense = min(100 * total / n, 10.0) if counts[0] or counts[1] or beyond else 0.0
        return np.array([np.log1p(counts[0]), beyond, np.log1p(counts[1]), np.log1p(counts[3]), dense, min(doubtful, 4.0), min(100 * doubtful / n, 5.0)])


#: Shortest and longest beginning that is learned as a stem; different endings and documents that it takes; how much oftener toxic documents hold it, to be doubtful and to be an insult.
STEM, ENDINGS, STEM_DOCS, DOUBT, SURE = (3, 9), 5, 8, 4.0, 30.0


def _learned(toxic: list[str], clean: list[str], least: int = 4) -> tuple[dict[str, str], dict[str, str]]:
    """Whole words, and stems, that documents labelled toxic hold far more often than clean ones, with their class; a whole word is doubtful, as labels of documents do not
    tell what it means.

    A word must stand in at least `least` documents and after as many different words, so that copies of one text teach nothing. A stem must take several endings,
    none of them in most of its documents: "worthless" alone makes no stem of "worth".
    """
    counts, begun = [Counter(), Counter()], [Counter(), Counter()]
    around, ends = defaultdict(set), defaultdict(Counter)
    stems_of = lambda w: [w[:n] for n in range(STEM[0], min(len(w) - 1, STEM[1]) + 1)]
    for k, texts in enumerate((toxic, clean)):
        for t in texts:
            words = WORD.findall(t.lower())
            seen = set(words)
            counts[k].update(seen)
            begun[k].update({x for w in seen for x in (*stems_of(w), w)})
            if k == 0:
                for w in seen:
                    for x in stems_of(w):
                        ends[x][w] += 1
                for before, w in zip(["", *words], words):
                    if len(around[w]) < least:
                        around[w].add(before)
    odds = lambda x, c: (c[0][x] / max(1, len(toxic))) / ((c[1][x] + 0.5) / max(1, len(clean)))
    of = lambda x, c: INSULT if odds(x, c) >= SURE and c[0][x] >= 20 * c[1][x] else DOUBTFUL
    words = {x: of(x, counts) for x, n in counts[0].items() if len(x) > 2 and n >= least and len(around[x]) >= least and odds(x, counts) >= SURE}
    words = {x: DOUBTFUL for x, c in words.items() if c == INSULT}
    stems = {x: of(x, begun) for x, e in ends.items() if len(e) >= ENDINGS and begun[0][x] >= STEM_DOCS and 2 * max(e.values()) <= begun[0][x] and odds(x, begun) >= DOUBT}
    # of stems that begin alike, the one that tells most; the rest of its family are its endings
    order = sorted(stems, key=lambda x: (-begun[0][x] * np.log(odds(x, begun)), x))
    chosen: dict[str, str] = {}
    for x in order:
        if not any(x.startswith(y) or y.startswith(x) for y in chosen):
            chosen[x] = stems[x]
    return {w: c for w, c in words.items() if not any(w[:n] in chosen for n in range(STEM[0], len(w)))}, chosen


def fit_texts(toxic: list[str], clean: list[str]) -> Model:
    """Lexicon from one half of the texts, weights of the clause features from the other half (logistic regression about a prior), then the lexicon from all."""
    base = {w: c for some, c in CLASSES for w in some}
    words, stems = _learned(toxic[::2], clean[::2])
    scorer = Scorer(words | base, stems)
    x = np.array([scorer.features(t) for t in [*toxic[1::2], *clean[1::2]]]).reshape(-1, FEATURES)
    y = np.array([1.0] * len(toxic[1::2]) + [0.0] * len(clean[1::2]))
    w, bias = PRIOR.copy(), BIAS
    if y.min(initial=1) == 0 and y.max(initial=0) == 1:
        z, least, most = np.c_[x, np.ones(len(y))], np.where(np.arange(FEATURES + 1) == 3, -np.inf, 0.0), np.where(np.arange(FEATURES + 1) == 3, 0.0, np.inf)
        least[-1] = -np.inf  # evidence never lowers a score; the bias is free
        prior = np.append(PRIOR, BIAS)
        v = prior.copy()
        for _ in range(60):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
            slope = z.T @ (p - y) + FIRM * (v - prior)
            curve = (z * (p * (1 - p))[:, None]).T @ z + FIRM * np.eye(len(v))
            v = np.clip(v - 0.5 * np.linalg.solve(curve, slope), least, most)
        w, bias = v[:-1], float(v[-1])
    least = (np.log(AIMED / (1 - AIMED)) - bias) / np.log(2)
    w[0], w[2] = max(w[0], least), max(w[2], least)
    words, stems = _learned(toxic, clean)
    return Model(words | base, stems, w, bias)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_DOCS) -> Model:
    """A model learned from text and label of documents outside the held-out fold."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter((fold(F.col("doc_id")) != 1) & F.col("toxic").isin(0, 1)).dropDuplicates(["doc_id"])
    counts = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    spot, chosen = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 31)), marks.limit(0)
    for k, n in counts.items():
        near = marks.filter((F.col("toxic") == k) & (spot < min(1 << 31, int((1 << 31) * per_label / n) + 1)))
        chosen = chosen.union(near.orderBy(spot, "doc_id").limit(per_label))
    texts: list[list[str]] = [[], []]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    # at most per_label ids of each label, so the texts are not shuffled
    for r in rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text").toLocalIterator():
        texts[r.toxic].append((r.doc_id, r.text))
    return fit_texts(*([t for _, t in sorted(texts[k])] for k in (1, 0)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row, from the whole text alone; null texts count as empty, repeated rows stay, an empty table gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.words, model.stems)
        for b in batches:
            x = np.array([scorer.features(t.as_py() or "") for t in b.column(1)]).reshape(-1, FEATURES)
            s = 1 / (1 + np.exp(-(x @ model.weights + model.bias)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
