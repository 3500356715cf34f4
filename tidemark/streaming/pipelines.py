"""Structured Streaming forms of the pipeline: change streams, bronze, current rows, refreshed aggregates, checkpoints, freshness."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.timeutil import second_diff
from tidemark.operators.cdc import latest_by_key_agg, live
from tidemark.sources.landing import pack_bronze, upsert
from tidemark.streaming.store import BUCKETS, GroupStore, KeyedStore, latest_store


def stream_changes(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000, after: object = None) -> DataFrame:
    """Files appended to a folder, as a stream. What lies there at the start is its first rows; with `after` (a time), only files written later count."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files_per_batch)).parquet(path)
    return stream if after is None else stream.filter(F.col("_metadata.file_modification_time") > F.lit(after))


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Processes what is there, batch by batch, and ends; a rerun goes on from the checkpoint."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_available(stream: DataFrame, checkpoint: str, path: str) -> None:
    """Appends a stateless stream to a folder of Parquet files, each batch once."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def stream_bronze(stream: DataFrame, source_table: str) -> DataFrame:
    """Packed payloads; stateless."""
    return pack_bronze(stream, source_table).select("payload_json", "source_table", "ingested_at")


def after_mark(df: DataFrame, ts: str, mark: Column, seen: Column) -> DataFrame:
    """Rows later than a mark, and those of the mark's own time whose hash `seen` does not hold: a row that comes late with an equal time is not lost."""
    return df.filter(mark.isNull() | (F.col(ts) > mark) | ((F.col(ts) == mark) & ~F.coalesce(F.array_contains(seen, row_hash(df)), F.lit(False))))


def row_hash(df: DataFrame) -> Column:
    """What tells rows of one time apart."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in df.columns if not c.startswith("_mark")))


def pending_rows(df: DataFrame, since: object, ts: str, seen: list[int] = ()) -> DataFrame:
    """Rows after a checkpoint (a time, and the hashes of rows of that time that are done): their number, and whether there are any."""
    return after_mark(df, ts, F.lit(since), F.array(*map(F.lit, seen)).cast("array<long>")).agg(F.count("*").alias("pending")).withColumn("has_data", F.col("pending") > 0)


def stream_latest(stream: DataFrame, keys: list[str], order: list[str], root: str, checkpoint: str, buckets: int = BUCKETS) -> KeyedStore:
    """Keeps the latest row of each key, deleted ones as tombstones: rows are ordered by change time, not by arrival. Read it with live(store.latest()).

    A batch writes its own rows, and rewrites a bucket of keys only once as many rows have come to it as it has (KeyedStore).
    """
    store = latest_store(stream.sparkSession, root, stream.schema, keys, order, buckets)
    run_available(stream, checkpoint, store.apply)
    return store


def stream_latest_stateful(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same with keyed state: a streaming aggregation that keeps one row for each key and, in update mode, emits a key's latest row when a batch touches it. A batch is reduced
    to one row for each key before it meets the state. State never expires, since a late row must still find its key; there is no watermark."""
    return latest_by_key_agg(stream, keys, order, None)


def latest_stateful(stream: DataFrame, keys: list[str], order: list[str], root: str, checkpoint: str, buckets: int = BUCKETS) -> DataFrame:
    """The latest row of each key after all that is there, with keyed state; the rows that each batch changes go to a store under root, which puts its parts together as they pile up."""
    spark = stream.sparkSession
    store = latest_store(spark, root, stream.schema, keys, order, buckets)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # state may outgrow the memory
    try:
        changed = stream_latest_stateful(stream, keys, order)
        changed.writeStream.outputMode("update").foreachBatch(store.apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return store.latest()


def stream_gold(stream: DataFrame, group: list[str], measures: dict[str, tuple[str, str]], root: str, checkpoint: str, buckets: int = BUCKETS) -> GroupStore:
    """Aggregates of an append-only stream, kept current by what each batch adds: only the states of the groups it touches are read, no earlier rows (GroupStore)."""
    gold = GroupStore(stream.sparkSession, root, stream.schema, group, measures, buckets)
    run_available(stream, checkpoint, gold.apply)
    return gold


def process_incremental(df: DataFrame, checkpoints: DataFrame, table: str, ts: str, fn: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(fn of the rows after the table's checkpoint, checkpoints advanced to the largest time seen). No new rows leave the checkpoint as it is.

    checkpoints: (table_name, last_ts, seen, rows_processed); seen holds the hashes of the rows of last_ts that are done, so that others of that time count as new.
    """
    mark = checkpoints.filter(F.col("table_name") == table).groupBy().agg(F.max_by(F.struct("last_ts", "seen"), "last_ts").alias("_mark"))
    new = after_mark(df.crossJoin(F.broadcast(mark)), ts, F.col("_mark.last_ts"), F.col("_mark.seen"))  # one row
    top = new.agg(F.max(ts).alias("last_ts"), F.count("*").alias("rows_processed")).filter("last_ts is not null")
    at_top = new.join(F.broadcast(top), F.col(ts) == F.col("last_ts")).groupBy("last_ts", "rows_processed").agg(F.collect_set(row_hash(df)).alias("_new"), F.first(F.when(F.col("_mark.last_ts") == F.col("last_ts"), F.col("_mark.seen"))).alias("_old"))
    none = F.array().cast("array<long>")
    done = at_top.select(F.lit(table).alias("table_name"), "last_ts", F.sort_array(F.array_union("_new", F.coalesce("_old", none))).alias("seen"), "rows_processed")
    return fn(new.drop("_mark")), upsert(checkpoints, done, ["table_name"], {"rows_processed": lambda o, n: o + n})


def stage_latency(stages: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest time of each stage, and seconds behind the stage before."""
    out = None
    for i, (name, (df, ts)) in enumerate(stages.items()):
        one = df.agg(F.max(ts).alias("latest")).select(F.lit(i).alias("position"), F.lit(name).alias("stage"), "latest")
        out = one if out is None else out.unionByName(one)
    before = out.select((F.col("position") + 1).alias("position"), F.col("latest").alias("_before"))
    return out.join(before, "position", "left").select("position", "stage", second_diff("latest", "_before").alias("lag_s"))


def freshness(source: DataFrame, target: DataFrame, ts: str, max_s: int = 300) -> DataFrame:
    """Seconds that the target is behind the source, and whether that is within the limit."""
    both = source.agg(F.max(ts).alias("_s")).crossJoin(target.agg(F.max(ts).alias("_t")))
    lag = second_diff("_t", "_s")
    return both.select(lag.alias("lag_s"), (lag <= max_s).alias("within_sla"))


__all__ = ["live", *(n for n in dir() if n.startswith(("stream_", "stage_")))]
