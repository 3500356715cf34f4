"""How filters interact: who fails which, and what each order of them removes, from the combinations of failures alone."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import HOT_PART, staged, table

#: Rows of one hot text that share a part of its join.
SHARE = 4096


def words(text: Column) -> Column:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and carriage return."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " "), "")


def conditions(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides by itself."""
    n, capitals = F.size(words(text)), F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < 100,
        "B": F.size(F.array_distinct(words(text))) * 100 < n * 80,
        "C": capitals * 100 > F.length(text) * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def later_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest) of the rows whose text a smaller doc_id has as well; repeated rows stay repeated.

    A left-semi join of docs with itself on a hash, the exact text and a smaller id. Only texts whose hash comes twice are shuffled, and of the other side only the
    first id of each text. A hash with more than one row in HOT_PART is dealt to as many parts as it has SHAREs of rows, the few texts on its other side are copied to each.
    Rows without an id are neither later nor earlier than any.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter("doc_id is not null").withColumn("hash", F.xxhash64("text"))
    seen = rows.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    total = rows.agg(F.count("*").alias("total"))
    sized = staged(seen.crossJoin(F.broadcast(total)), "copied")  # one row
    hot = F.col("n") > F.col("total") / HOT_PART
    hot_keys = F.broadcast(sized.filter(hot).select("hash", F.ceil(F.col("n") / SHARE).alias("parts")))  # fewer than HOT_PART rows
    cold_keys = sized.filter(~hot).select("hash")

    def exact(left: DataFrame, on: list[str]) -> DataFrame:
        first = rows.join(F.broadcast(hot_keys), "hash") if "part" in on else rows.join(hot_keys, "hash", "left_anti").join(cold_keys, "hash", "left_semi")
        first = first.groupBy("hash", "text").agg(F.min("doc_id").alias("first_id"), *([F.first("parts").alias("parts")] if "part" in on else []))
        if "part" in on:
            first = first.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        first = first.select(*on, F.col("text").alias("same"), "first_id")
        a, b = left.alias("a"), first.alias("b")
        met = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on] + [F.col("a.text") == F.col("b.same"), F.col("b.first_id") < F.col("a.doc_id")]
        return a.join(b, met, "left_semi").select("a.doc_id", F.xxhash64("a.text", F.lit(1)).alias("digest"))

    warm = rows.join(hot_keys, "hash").withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts"))
    cold = rows.join(hot_keys, "hash", "left_anti").join(cold_keys, "hash", "left_semi")
    return exact(cold, ["hash"]).unionByName(exact(warm, ["hash", "part"]))


def failures(docs: DataFrame, filters: dict[str, Column], copies: str | None = None) -> DataFrame:
    """(doc_id, part, bits, n): how many rows of an id and a part fail which filters; bit i stands for the i-th letter of filters, the bit after them for later copies."""
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())), F.lit(0))
    text = F.coalesce("text", F.lit(""))
    by_text = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.xxhash64(text, F.lit(1)).alias("digest"), bits.alias("bits"))
    nameless = by_text.filter("doc_id is null").groupBy("doc_id", "part", "bits").agg(F.count("*").alias("n"))
    rows = by_text.filter("doc_id is not null").select("doc_id", "digest", "part", "bits", F.lit(1).alias("n"))
    if copies is None:
        return rows.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n")).unionByName(nameless)
    later = later_copies(docs).select("doc_id", "digest", F.lit(None).cast("string").alias("part"), F.lit(1 << len(filters)).alias("bits"), F.lit(0).alias("n"))
    marked = rows.unionByName(later)
    copy = F.max(F.when(F.col("n") == 0, F.col("bits"))).over(Window.partitionBy("doc_id", "digest"))
    return marked.withColumn("copy", F.coalesce(copy, F.lit(0))).filter("n = 1").groupBy("doc_id", "part", (F.col("bits") + F.col("copy")).alias("bits")).agg(F.sum("n").alias("n")).unionByName(nameless)


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, copies: str | None = "E") -> DataFrame:
    """For each part (lang; null: empty), order of the filters and step of it: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    filters: letter to failure condition on `text`, where null is empty (A to D of `conditions` if not given); copies: the letter of the exact-copy filter, None for none.
    Every row counts, repeated ones and those without a doc_id too; an id has a label if any of its label rows says so. An empty table gives no rows; other columns have
    no effect. All orders are reckoned from the counts of failure combinations in each part: at most 2 to the number of filters.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    filters = conditions(F.col("text")) if filters is None else filters
    letters = [*filters, *([copies] if copies else [])]
    flag = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("bad"))
    each = failures(docs, filters, copies)
    labelled = each.filter("doc_id is not null").join(known, "doc_id", "left").unionByName(each.filter("doc_id is null"), allowMissingColumns=True)
    good, bad = (F.coalesce(F.sum(F.col(c) * F.col("n")), F.lit(0)).alias(c) for c in ("good", "bad"))
    met = labelled.groupBy("part", "bits").agg(F.sum("n").alias("n"), good, bad)
    parts = met.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "bad")).alias("met"))  # a few dozen for each part

    bit = {x: 1 << i for i, x in enumerate(letters)}
    steps = [("".join(p), k + 1, bit[x], sum(bit[y] for y in p[:k])) for p in permutations(letters) for k, x in enumerate(p)]
    listed = F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","k":{k},"b":{b},"m":{m}}}' for o, k, b, m in steps) + "]"), "array<struct<o string, k int, b int, m int>>")
    run = parts.withColumn("s", F.explode(listed))
    b, before = F.col("s.b"), F.col("s.m")

    def total(what: str, when) -> Column:
        return F.aggregate("met", F.lit(0).cast("long"), lambda acc, x: acc + F.when(when(x["bits"]), x[what]).otherwise(0))

    fails = lambda x: x.bitwiseAND(b) != 0
    early = lambda x: x.bitwiseAND(before) != 0
    # The filter is the first to fail in one of as many orders as the failing ones of a combination.
    share = F.aggregate("met", F.lit(0).cast("long"), lambda acc, x: acc + F.when(fails(x["bits"]), x["n"] * F.floor(F.lit(factorial(len(letters))) / F.greatest(F.bit_count(x["bits"]), F.lit(1)))).otherwise(0))
    return run.select(
        "part",
        F.col("s.o").alias("filter_order"),
        F.col("s.k").alias("step"),
        total("n", lambda x: x.bitwiseAND(b.bitwiseOR(before)) == 0).alias("kept"),
        total("n", lambda x: fails(x) & ~early(x)).alias("removed"),
        total("n", lambda x: fails(x) & early(x)).alias("redundant"),
        total("n", lambda x: x == b).alias("unique_fails"),
        total("good", lambda x: fails(x) & ~early(x)).alias("good_lost"),
        total("bad", lambda x: fails(x) & ~early(x)).alias("toxic_lost"),
        share.alias("shapley"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
    map {'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w), 'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t), 'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(first_id < d.doc_id, false)} AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), c AS (
  SELECT part, fails['A'] AS a, fails['B'] AS b, fails['C'] AS c, fails['D'] AS d, fails['E'] AS e, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM f GROUP BY ALL
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x
), g AS (
  SELECT part, filter_order, k AS step, n, good, bad, filter_order[k] AS own,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda y, i: [a, b, c, d, e][i]) AS failing, filter_order[1:k-1] AS earlier
  FROM c, o, (SELECT unnest(range(1, 6)) AS k)
), h AS (
  SELECT *, list_contains(failing, own) AS fails, len(list_filter(failing, lambda y: contains(earlier, y))) > 0 AS before FROM g
), r AS (
  SELECT part, filter_order, step, own, sum(n) FILTER (NOT fails AND NOT before) AS kept, sum(n) FILTER (fails AND NOT before) AS removed, sum(n) FILTER (fails AND before) AS redundant,
    sum(n) FILTER (fails AND len(failing) = 1) AS unique_fails, sum(good) FILTER (fails AND NOT before) AS good_lost, sum(bad) FILTER (fails AND NOT before) AS toxic_lost
  FROM h GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""
