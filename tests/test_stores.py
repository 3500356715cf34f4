"""Keyed stores: the same state for any split and replay, bytes in proportion to the batch, aggregates by deltas."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.cdc import latest_by_key_agg
from tidemark.streaming.store import GroupStore, latest_store

SCHEMA = "id long, at int, v string, _deleted boolean"


def changes(n, keys):
    return [(None if i % 97 == 5 else (i * 7) % keys, None if i % 89 == 3 else (i * 31) % 50, f"v{i % 11}", i % 13 == 0) for i in range(n)]


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


@pytest.mark.parametrize("cuts", [(400,), (30, 60, 65, 300, 400), (399, 400)])
def test_any_split_and_a_replay_give_the_same_rows(spark, tmp_path, cuts):
    rows = changes(400, 60)
    frame = lambda some: spark.createDataFrame(some, SCHEMA)
    store = latest_store(spark, f"{tmp_path}/s", frame([]).schema, ["id"], ["at", "v", "_deleted"], 4)
    assert store.latest() is None
    for n, (a, b) in enumerate(zip((0, *cuts), cuts)):
        store.apply(frame(rows[a:b]), n)
        if n % 2:
            store.apply(frame(rows[a:b]), n)  # a replay of the last batch
    want = latest_by_key_agg(frame(rows), ["id"], ["at", "v", "_deleted"], None)
    assert sorted(map(str, store.latest().collect())) == sorted(map(str, want.collect()))
    store.apply(frame([]), len(cuts))
    assert store.latest().count() == want.count() == 61
    assert len(store.versions()) <= 2


def test_bytes_written_follow_the_batch(spark, tmp_path):
    big = spark.range(40_000).select("id", F.lit(1).alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(False).alias("_deleted"))
    store = latest_store(spark, f"{tmp_path}/s", big.schema, ["id"], ["at", "v"], 8)
    store.apply(big, 0)
    whole = size(f"{tmp_path}/s")
    for n in range(1, 4):
        before = size(f"{tmp_path}/s")
        store.apply(big.limit(5).withColumn("at", F.lit(1 + n)), n)
        assert size(f"{tmp_path}/s") - before < whole / 50
        assert not os.path.exists(f"{tmp_path}/s/whole/{n}")
    assert store.latest().filter("at = 4").count() == 5 and store.latest().count() == 40_000
    few = big.filter("id = 7")
    plan = store.before(9, few)
    assert len({f.split("_bucket=")[1].split("/")[0] for f in plan.inputFiles()}) == 1  # the bucket of the one key
    for n in range(4, 14):  # parts pile up until the bucket is rewritten
        store.apply(few.withColumn("at", F.lit(n)), n)
    parts = [p for p in store.manifest(13) if p[0] == store._bucketed(few).first()["_bucket"]]
    assert len(parts) <= 9 and any(p[2] == "whole" for p in parts)
    assert store.latest().filter("id = 7").first().at == 13
    old = {int(v) for v in os.listdir(f"{tmp_path}/s/part")}
    assert old <= {p[1] for m in store.versions() for p in store.manifest(m)}  # what nothing names is gone


MEASURES = {"n": ("count", "*"), "named": ("count", "v"), "total": ("sum", "at"), "least": ("min", "at"), "most": ("max", "v"), "mean": ("avg", "at"), "values": ("count_distinct", "v"), "times": ("count_distinct", "at")}


@pytest.mark.parametrize("cuts", [(300,), (20, 21, 150, 300)])
def test_aggregates_by_deltas(spark, tmp_path, cuts):
    rows = changes(300, 9)
    frame = lambda some: spark.createDataFrame(some, SCHEMA)
    gold = GroupStore(spark, f"{tmp_path}/g", frame([]).schema, ["id"], MEASURES, 3)
    assert gold.latest() is None
    for n, (a, b) in enumerate(zip((0, *cuts), cuts)):
        gold.apply(frame(rows[a:b]), n)
        if n == 1:
            gold.apply(frame(rows[a:b]), n)
    want = frame(rows).groupBy("id").agg(F.count("*").alias("n"), F.count("v").alias("named"), F.sum("at").alias("total"), F.min("at").alias("least"), F.max("v").alias("most"), F.avg("at").alias("mean"), F.countDistinct("v").alias("values"), F.countDistinct("at").alias("times"))
    assert sorted(map(str, gold.latest().collect())) == sorted(map(str, want.collect()))
    assert gold.latest().columns == ["id", *MEASURES]
