import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import _packed_well
from tidemark.llm import decontaminate, language, lines, packing, shingles, simhash
from tidemark.llm.common import table


def corpus(spark, path):
    rng = random.Random(12)
    words = {g: ["".join(rng.choice(s) for _ in range(rng.randint(3, 8))) for _ in range(200)] for g, s in (("en", "etaoinsh"), ("xx", "zqjwvkpx"))}
    passage = " ".join(rng.choice(words["en"]) for _ in range(30))
    rows = []
    for d in range(60):
        g = "en" if d % 2 else "xx"
        t = "\n".join(" ".join(rng.choice(words[g]) for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(1, 5)))
        rows.append((d, t + ("\n" + passage if d % 13 == 5 else ""), g))
    rows += [(100, rows[7][1], "en"), (101, rows[8][1].replace(" ", "  ", 3), "xx"), (102, None, None), (103, "12 34", "en"), (104, "", "xx")]
    spark.createDataFrame([(d, t, g, "web", len(t or "")) for d, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return [(1, passage), (2, None)]


def test_stages_against_brute_force(spark, tmp_path):
    items = corpus(spark, str(tmp_path))
    docs = table(spark, str(tmp_path), "documents")
    kept = {r.doc_id: r.text for r in docs.join(language.identify(docs, language.fit(docs)).filter("lang_pred <> 'und' and score >= 0.4"), "doc_id").select("doc_id", "text").collect()}
    assert {102, 103, 104}.isdisjoint(kept) and len(kept) > 50
    kept = brute.kept_lines(kept.items())
    groups = brute.components([(d, brute.fingerprint(t)) for d, t in sorted(kept.items())])
    kept = {d: t for d, t in kept.items() if groups[d] == d}
    dirty = {d for d, _ in brute.contaminated(kept.items(), items)}
    kept = {d: t for d, t in kept.items() if d not in dirty}
    assert dirty and 30 < len(kept) < 62
    _packed_well(corpus_pipeline.run(spark, str(tmp_path)).collect(), kept, 2048)


def near_copies(seed):
    """Documents and copies with some words changed, so that Jaccard indexes of shingles lie on both sides of 0.8; odd and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        words = [f"w{rng.randrange(900)}" for _ in range(rng.randint(3, 160))]
        for _ in range(6):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                copy[rng.randrange(len(copy))] = f"W{rng.randrange(900)}"
            rows.append((len(rows), " ".join(copy)))
    return rows + [(900, None), (901, ""), (902, " \n\t"), (903, rows[5][1].upper()), (5, rows[5][1]), (904, "one two"), (905, "One\ntwo")]


def by_jaccard(rows, size=5, similarity=0.8):
    sets = []
    for d, text in rows:
        words = (text or "").lower().split()
        sets.append((d, {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()))
    root = {d: d for d, _ in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x == y or len(x & y) >= similarity * len(x | y) - 1e-9:
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {d: top(d) for d in root}


@pytest.mark.parametrize("most", [shingles.GROUP_MOST, 2])
def test_shingle_groups_against_brute_force(spark, most):
    rows = near_copies(3)
    want = by_jaccard(rows)
    assert 20 < len(set(want.values())) < 60
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.component_id) for r in shingles.near_duplicates(docs, group_most=most).collect()]
    assert len(got) == len(rows) and dict(got) == want
    assert shingles.near_duplicates(docs.limit(0)).count() == 0


def test_stage_drops_near_copies_beyond_four_bits(spark):
    rows = near_copies(7)
    want = by_jaccard(rows)
    marks = {d: brute.fingerprint(t) for d, t in rows}
    assert any((marks[d] ^ marks[c]).bit_count() > 4 for d, c in want.items())
    got = corpus_pipeline.distinct_documents(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(want.values()))


def test_stages_keep_the_columns(spark, tmp_path):
    corpus(spark, str(tmp_path))
    docs = table(spark, str(tmp_path), "documents").withColumn("_lines", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pairs_by_digest_are_compared(spark, monkeypatch):
    """Without MinHash bands all pairs come from the BK-trees: copies within their radius are found, and the whole sets still decide."""
    mark = shingles._mark

    def without_bands(size):
        def run(batches):
            for b in mark(size)(batches):
                yield b.set_column(3, "bands", pa.nulls(b.num_rows, pa.list_(pa.int64())))

        return run

    monkeypatch.setattr(shingles, "_mark", without_bands)
    words = [f"w{i}" for i in range(300)]
    rows = [(3, " ".join(words)), (5, " ".join([*words, "end"])), (8, " ".join(f"v{i}" for i in range(300)))]
    assert 0 < (brute.fingerprint(rows[0][1]) ^ brute.fingerprint(rows[1][1])).bit_count() <= 4
    got = shingles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {3: 3, 5: 3, 8: 8}


def test_stages_get_texts_in_small_batches(spark, tmp_path, monkeypatch):
    """30 MB of texts in one partition, one of 6 MB among them, arrive a few MB at a time, whatever the session allows; none is cut or lost."""
    corpus(spark, str(tmp_path))
    docs = spark.range(0, 2401, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', if(id = 2400, 1200000, 2000))").alias("text"))

    def sizes(docs, *args, **how):
        def run(batches):
            for b in batches:
                n = [len(t) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (len(n), sum(n), max(n))], names=["n", "chars", "longest"])

        return docs.mapInArrow(run, "n long, chars long, longest long")

    monkeypatch.setattr(language, "fit", lambda docs: None)
    for where, name in ((language, "keep_known"), (lines, "without_repeats"), (simhash, "keep_one"), (decontaminate, "keep_clean"), (packing, "pack_documents")):
        monkeypatch.setattr(where, name, sizes)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set(key, "64m")
            got = stage(spark, docs, str(tmp_path)).collect()
            assert (sum(r.n for r in got), sum(r.chars for r in got)) == (2401, 30_000_000), name
            assert max(r.chars - r.longest for r in got) < 5_000_000, name
    finally:
        spark.conf.set(key, before)
