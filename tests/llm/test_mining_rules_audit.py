"""Hard negatives, quality rules and the filter audit against plain versions of them."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import audit, negatives, rules

VECTORS = "vec_id long, embedding array<float>, label int, v string, n int"


def mined(rows, every=10, positives=3, k=4, low=30, high=90):
    data = {r: None for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])}
    data = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in e], label) for i, e, label, *_ in data]
    out = []
    for a, q, label in data:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, e)), i, other) for i, e, other in data if i != a and len(e) == len(q))
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(i, -s) for s, i, other in scored if other != label and low * -p <= 100 * -s <= high * -p]
            out += [(a, pid, r, i, -p, s) for r, (i, s) in enumerate(inside[:k], 1)]
    return sorted(out)


def vectors(n, seed, dims=6, ties=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * 0.4 + 0.5
    x = np.round(x) if ties else x
    return [(i, tuple(map(float, v)), int(label), "x", 1) for i, (v, label) in enumerate(zip(x, np.where(rng.random(n) < 0.4, 0, rng.integers(0, 4, n))))]


@pytest.mark.parametrize("ties", [False, True])
def test_negatives_equal_brute_force(spark, ties):
    rows = vectors(150, 3, ties=ties)
    df = spark.createDataFrame(rows, VECTORS)
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, positives=3, k=4, piece=16, block=4)
    assert sorted(map(tuple, got.collect())) == mined(rows) != []


def test_negatives_of_odd_rows(spark):
    rows = vectors(60, 5)
    odd = [(None, rows[0][1], 1, "", 0), (70, None, 1, "", 0), (80, (1.0, float("nan")), 1, "", 0), (90, (1.0, None), 0, "", 0), (100, rows[1][1], None, "", 0), (110, (), 1, "", 0), (120, (1.0, 2.0), 1, "", 0), rows[7]]
    df = spark.createDataFrame(rows + odd, VECTORS)
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, positives=3, k=4)
    assert sorted(map(tuple, got.collect())) == mined(rows + odd[:-1])
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df, F.col("vec_id") < 0).count() == 0


def test_first_takes_ties_by_place():
    assert negatives.first(np.array([5, 9, 5, 9, 5]), 3).tolist() == [1, 3, 0]
    assert negatives.first(np.array([1]), 3).tolist() == [0]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines, n_dup = [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            n_dup += line in lines
            lines.append(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), n_dup, len(inside), failed


ODD_TEXTS = [None, "", " \n\t ", "a\x1cb c　d \x85 e", "one two\n\none two\n one two\none two", "a b c d e a b c d e", "a b c d e f a b c d", "x " * 12, "#*$%&|<> 😀 é" * 3, "Wort ß\r\nWort ß\x0b\x0c", "w" * 300_000, "r s t u v " * 40_000]


def test_statistics_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    texts = ODD_TEXTS + ["".join(rng.choice(list("ab \n\tß#"), 60)) for _ in range(200)]
    rows = [(i % 150 if i else None, t, "x", 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, rule int")
    got = rules.judged(df, [rules.Rule((("symbols_per_word", ">", 0.5),))]).collect()
    assert Counter((r.doc_id, *r[1:6], r.base_failed) for r in got) == Counter((d, *base(t)) for d, t, *_ in rows)
    assert all(not (r.base_failed and r.kept) for r in got)
    assert {bool(r.rule) for r in got if not r.base_failed and not r.kept} <= {True}
    assert rules.judged(df.limit(0), []).count() == 0


def test_rules_are_found_again():
    rng = np.random.default_rng(2)
    x = np.stack([rng.random(900), rng.random(900), rng.integers(0, 50, 900)], 1)
    bad = ((x[:, 0] > 0.7) & (x[:, 1] <= 0.4)) | (x[:, 2] >= 45)
    found = rules.learn(x, bad, rng.random(900) < 0.33, ["a", "b", "c"])
    said = np.zeros(900, bool)
    for r in found:
        said |= r.covers(x, ["a", "b", "c"])
    assert len(found) <= 4 and (said == bad).mean() > 0.98 and bad[said].mean() > 0.97


def test_noise_gives_no_rules():
    rng = np.random.default_rng(4)
    assert rules.learn(rng.random((600, 4)), rng.random(600) < 0.1, rng.random(600) < 0.33, list("abcd")) == []
    assert rules.learn(np.zeros((0, 4)), np.zeros(0, bool), np.zeros(0, bool), list("abcd")) == []
    assert rules.learn(np.zeros((9, 4)), np.ones(9, bool), np.zeros(9, bool), list("abcd")) == []


def test_spark_conditions_agree_with_the_learner(spark):
    df = spark.createDataFrame([(i, "ab " * i + "#" * (i % 7)) for i in range(60)], "doc_id int, text string")
    stats = rules.statistics(df)
    by = rules.measures()
    x = np.array(stats.select(*by.values()).collect(), float)
    list_ = [rules.Rule((("symbols_per_word", ">", 0.1), ("words", "<=", 30.0))), rules.Rule((("letter_share", "<=", 0.6),))]
    first = np.select([r.covers(x, list(by)) for r in list_], [1, 2], 0)
    assert [r[0] for r in stats.select(rules.verdict(list_)).collect()] == first.tolist()


def test_rules_hold_on_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = rules.query(spark, d).filter("not base_failed").join(labels, "doc_id").collect()
    clean, junk = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(not r.kept for r in junk if r.held_out) >= 0.8 * sum(r.held_out for r in junk)
    assert rules.fit(docs, labels.limit(0)) == []
    odd = labels.unionByName(spark.createDataFrame([(None, 0, 0), (1, None, None), (1, 0, 0), (1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert rules.fit(docs.withColumn("quality", F.lit("x")), odd, most=50) is not None


def audited(docs, labels):
    first, good, bad = {}, set(), set()
    for d, t, *_ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, q, x in labels:
        good |= {d} if d is not None and q == 1 else set()
        bad |= {d} if d is not None and x == 1 else set()
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and first[t] < d}
        rows.append((lang or "", {k for k, v in fails.items() if v}, d in good, d in bad))
    out, shapley = {}, defaultdict(int)
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                all_ = [r for r in rows if r[0] == part and f in r[1]]
                out[part, order, step] = [len(left), len(gone), len(all_) - len(gone), sum(r[1] == {f} for r in all_), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, f] += len(gone)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def texts_to_audit():
    rng = np.random.default_rng(9)
    made = [" ".join(rng.choice(["Wort", "ABC", "x", "y", "#", "é"] + [f"w{i}" for i in range(150)], int(n))) for n in rng.choice([3, 90, 100, 140], 60)]
    made += [None, "", " \n", "A", "\x1c ", "lang " * 50_000]
    return [(None if i % 37 == 5 else int(i % 90), made[int(j)], [None, "", "de", "en"][int(x)]) for i, (j, x) in enumerate(zip(rng.integers(0, len(made), 220), rng.integers(0, 4, 220)))]


LABELS = [(i, i % 2, i % 3 % 2) for i in range(0, 90, 2)] + [(4, 1, 1), (4, 0, 0), (6, None, 1), (None, 1, 1)]


@pytest.mark.parametrize("hot", [1, 1000])
def test_audit_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(audit, "HOT_PART", 1000 if hot == 1 else 1)
    monkeypatch.setattr(audit, "SHARE", 2)
    docs = texts_to_audit()
    df = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, lang string, n int, hash string")
    got = audit.audit(df, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))
    assert {tuple(r) for r in got.collect()} == audited(docs, LABELS)


def test_audit_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audit.audit(df, labels).count() == 0
    one = spark.createDataFrame([(1, "a", None)], df.schema)
    assert audit.audit(one, labels.limit(0)).count() == 600


def test_audit_of_other_filters(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "bb", "x")], "doc_id long, text string, lang string")
    got = audit.audit(df, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"), {"S": F.length("text") < 2}, "U").collect()
    assert {(r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got} == {("SU", 1, 1, 2, 0, 1, 3), ("SU", 2, 1, 0, 1, 0, 1), ("US", 1, 2, 1, 0, 0, 1), ("US", 2, 1, 1, 1, 1, 3)}


def test_fold_of_the_rules(spark):
    got = rules.query(spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_language_of_rows_without_ids(spark):
    from tidemark.llm import language

    rows = [(None if i % 2 else i, ["the cat and the dog", "der Hund und die Katze"][i % 4 // 2] * 3, ["en", "de"][i % 4 // 2]) for i in range(40)] + [(None, None, "en"), (None, "x", None), (None, "the cat", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language.fit(docs, steps=5)
    assert net.langs == ["de", "en"]
    assert language.identify(docs, net).count() == len(rows) and language.keep_known(docs, net, 0.0).count() == len(rows) - 1


def test_one_of_each_group_stays_and_no_other_text_goes(spark):
    from tidemark.llm import simhash

    long = lambda s: " ".join(f"{s}{i}" for i in range(40))
    rows = [(1, long("a"), "s"), (1, long("b"), "s"), (2, long("c"), "s"), (3, long("a"), "s"), (1, long("a"), "s"), (1, long("a"), "t"), (None, long("a"), "s"), (None, long("a"), "s"), (4, None, "s"), (5, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `source.x` string")
    got = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, long("a")), (1, long("b")), (2, long("c")), (None, long("a")), (None, long("a")), (4, None)], key=str)


def test_secret_candidates_of_a_text_full_of_them(spark):
    import time

    from tidemark.llm import secrets

    values = [f"{i:06d}abcdef0123456789" for i in range(200_000)]
    text = "é " + " ".join(values)
    begun = time.time()
    got = secrets.candidates(spark.createDataFrame([(1, text, None)], "doc_id long, text string, source string")).agg(F.count("*").alias("n"), F.max("start").alias("last"), F.sum("start").alias("sum")).first()
    assert time.time() - begun < 30
    at = [2 + 23 * i for i in range(200_000)]
    assert (got.n, got.last, got["sum"]) == (200_000, at[-1], sum(at))
