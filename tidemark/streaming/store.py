"""Keyed tables that batches change in place of being rewritten: buckets of key hashes, parts appended per batch, a manifest per version."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Buckets of key hashes; the manifest has a row for each part of a bucket.
BUCKETS = 64
#: Parts of one bucket beyond which it is rewritten as one.
PARTS = 8


class KeyedStore:
    """A table with one row for each key, under a folder.

    Version n holds what batch n made of the version before: the batch's rows, reduced to one for each key, are appended as a part of each bucket that they fall into. Reading
    reduces a bucket's parts together. A bucket is rewritten as one part when those added since hold as many rows as its first one, or are too many; so, over many
    batches, the bytes written are in proportion to the bytes that came, and what no batch touches is never read. `reduce` must give one row for each key and must not mind in
    which order, or in how many steps, rows are put together. A manifest of (bucket, version, kind, rows) is written last and makes a version valid; a replayed
    batch starts from the version before its own and gives the same one. Files that neither the last version nor the one before it names are deleted.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], reduce: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.schema, self.keys, self.reduce, self.buckets = spark, root.rstrip("/"), schema, keys, reduce, buckets

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, folder: str) -> list[str]:
        path, fs = self._path(folder), self._fs()
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        """Valid versions, oldest first."""
        return sorted(int(n) for n in self._listed("manifest") if n.isdigit() and self._fs().exists(self._path(f"manifest/{n}/_SUCCESS")))

    def manifest(self, version: int | None) -> list[tuple[int, int, str, int]]:
        """(bucket, version, kind, rows) of each part, the first of a bucket first: a bounded number."""
        if version is None:
            return []
        got = self.spark.read.schema("bucket int, version long, kind string, n long").json(f"{self.root}/manifest/{version}").collect()
        return sorted((tuple(r) for r in got), key=lambda p: (p[0], p[1], p[2]))

    def _read(self, parts: list[tuple[int, int, str, int]]) -> DataFrame:
        paths = [f"{self.root}/{kind}/{version}/_bucket={bucket}" for bucket, version, kind, _ in parts]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _write(self, df: DataFrame, kind: str, version: int) -> list[tuple[int, int, str, int]]:
        """One file for each bucket, and what the manifest says of it."""
        at = f"{self.root}/{kind}/{version}"
        self._bucketed(df).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(at)
        if not any(n.startswith("_bucket=") for n in self._listed(f"{kind}/{version}")):
            return []
        counts = self.spark.read.parquet(at).groupBy("_bucket").agg(F.count("*").alias("n")).collect()  # a row for each bucket
        return [(r["_bucket"], version, kind, r["n"]) for r in counts]

    def before(self, version: int, batch: DataFrame | None = None) -> DataFrame | None:
        """The last version before one, of all keys, or of the buckets that the batch's keys fall into; None if there is none."""
        old = [v for v in self.versions() if v < version]
        if not old:
            return None
        parts = self.manifest(old[-1])
        if batch is not None:
            touched = {r["_bucket"] for r in self._bucketed(batch.select(*self.keys)).select("_bucket").distinct().collect()}
            parts = [p for p in parts if p[0] in touched]
        return self.reduce(self._read(parts))

    def latest(self) -> DataFrame | None:
        return self.before(1 << 62)

    def apply(self, batch: DataFrame, version: int) -> None:
        """Writes the version that the batch makes of the one before it."""
        old = [v for v in self.versions() if v < version]
        parts = self.manifest(old[-1] if old else None)
        added = self._write(self.reduce(batch), "part", version)
        of: dict[int, list] = {}
        for p in parts + added:
            of.setdefault(p[0], []).append(p)
        full = [b for b in {p[0] for p in added} if len(of[b]) > 1 and (len(of[b]) > PARTS or sum(p[3] for p in of[b][1:]) >= of[b][0][3])]
        if full:
            whole = self._write(self.reduce(self._read([p for b in full for p in of[b]])), "whole", version)
            of |= {b: [p for p in whole if p[0] == b] for b in full}
        rows = [p for b in sorted(of) for p in of[b]]
        self.spark.createDataFrame(rows, "bucket int, version long, kind string, n long").coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest/{version}")
        self._sweep(version, rows, old[-1:])

    def _sweep(self, version: int, rows: list, before: list[int]) -> None:
        needed = {(kind, v, b) for b, v, kind, _ in rows} | {(kind, v, b) for o in before for b, v, kind, _ in self.manifest(o)}
        keep = {(kind, v) for kind, v, _ in needed}
        for kind in ("part", "whole"):
            for v in (int(n) for n in self._listed(kind) if n.isdigit()):
                if v < version and (kind, v) not in keep:
                    self._fs().delete(self._path(f"{kind}/{v}"), True)
                elif v < version:
                    for n in self._listed(f"{kind}/{v}"):
                        if n.startswith("_bucket=") and (kind, v, int(n[8:])) not in needed:
                            self._fs().delete(self._path(f"{kind}/{v}/{n}"), True)
        for v in self.versions():
            if v < version and v not in before:
                self._fs().delete(self._path(f"manifest/{v}"), True)


def latest_store(spark: SparkSession, root: str, schema: StructType, keys: list[str], order: list[str], buckets: int = BUCKETS) -> KeyedStore:
    """Keeps the row with the largest order columns of each key (nulls largest)."""
    from tidemark.operators.cdc import latest_by_key_agg

    return KeyedStore(spark, root, schema, keys, lambda df: latest_by_key_agg(df, keys, order, None), buckets)


#: How the partial values of a measure are put together: the state columns with their Spark aggregate of rows, and of states.
_STATES = {
    "count": lambda c: {"": (F.count(c), F.sum)},
    "sum": lambda c: {"": (F.sum(c), F.sum)},
    "min": lambda c: {"": (F.min(c), F.min)},
    "max": lambda c: {"": (F.max(c), F.max)},
    "avg": lambda c: {"__s": (F.sum(c), F.sum), "__n": (F.count(c), F.sum)},
    "count_distinct": lambda c: {},
}


class GroupStore:
    """Aggregates of appended rows, kept as mergeable states: a batch is aggregated alone and put together with the state of its own groups; earlier rows are not read again.

    measures: name to (kind, column): count, sum, min, max, avg or count_distinct; column "*" counts rows. Distinct values are kept as (group, value) pairs in stores of their own:
    the pairs of a batch that its buckets do not hold yet are added to their groups' counts, so that counts are exact. Nulls are no value, as in SQL; a null group is a group.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, group: list[str], measures: dict[str, tuple[str, str]], buckets: int = BUCKETS) -> None:
        self.group, self.measures, self.root = group, measures, root.rstrip("/")
        self.merge: dict[str, Callable] = {}
        sample = spark.createDataFrame([], schema)
        self.states = {f"{name}{end}": how for name, (kind, col) in measures.items() for end, how in _STATES[kind]("*" if col == "*" else F.col(col)).items()}
        self.distinct = {name: col for name, (kind, col) in measures.items() if kind == "count_distinct"}
        self.pairs = {
            name: KeyedStore(spark, f"{root}/pairs-{name}", sample.select(*group, F.col(col).alias("_value")).schema, [*group, "_value"], lambda df: df.distinct(), buckets)
            for name, col in self.distinct.items()
        }
        state = self._aggregate(sample)
        for name in self.distinct:
            state = state.withColumn(name, F.lit(0).cast("long"))
        names = [c for c in state.columns if c not in group]
        merged = {n: (self.states[n][1] if n in self.states else F.sum)(n).cast(state.schema[n].dataType).alias(n) for n in names}
        self.store = KeyedStore(spark, f"{root}/groups", state.schema, group, lambda df: df.groupBy(*group).agg(*merged.values()), buckets)

    def _aggregate(self, rows: DataFrame) -> DataFrame:
        aggregates = [how[0].alias(n) for n, how in self.states.items()] or [F.count("*").alias("__rows")]
        return rows.groupBy(*self.group).agg(*aggregates)

    def apply(self, batch: DataFrame, version: int) -> None:
        delta = self._aggregate(batch)
        for name, col in self.distinct.items():
            pairs = batch.filter(F.col(col).isNotNull()).select(*self.group, F.col(col).alias("_value")).distinct()
            known = self.pairs[name].before(version, pairs)
            fresh = pairs if known is None else pairs.alias("p").join(known.alias("k"), [F.col(f"p.{c}").eqNullSafe(F.col(f"k.{c}")) for c in [*self.group, "_value"]], "left_anti")
            counts = fresh.groupBy(*self.group).agg(F.count("*").alias("_n"))
            delta = delta.alias("d").join(counts.alias("c"), [F.col(f"d.{g}").eqNullSafe(F.col(f"c.{g}")) for g in self.group], "left").select("d.*", F.coalesce("c._n", F.lit(0)).cast("long").alias(name))
            self.pairs[name].apply(pairs, version)
        self.store.apply(delta.select(*self.store.schema.names), version)

    def latest(self) -> DataFrame | None:
        """One row for each group with the measures, as an aggregate of all rows would give."""
        got = self.store.latest()
        if got is None:
            return None
        value = lambda n, kind: F.try_divide(F.col(f"{n}__s").cast("double"), F.col(f"{n}__n").cast("double")) if kind == "avg" else F.col(n)
        return got.select(*self.group, *(value(n, kind).alias(n) for n, (kind, _) in self.measures.items()))


class HistoryStore:
    """History (SCD type 2) kept by batches that may come late and in any order: the same as `scd2` over all changes at once.

    All change rows are kept, those that change nothing too: a late change may give them a meaning. A batch reads the changes of its own keys only, cuts these keys' spans anew and
    appends them as their newest generation; an older generation of a key is dropped when its bucket is rewritten. Changes of one time are ordered by their other columns.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], order: str, tracked: list[str], buckets: int = BUCKETS) -> None:
        self.keys, self.order, self.tracked = keys, order, tracked
        self.rest = [c for c in schema.names if c not in (*keys, order)]
        self.changes = KeyedStore(spark, f"{root}/changes", schema, keys, lambda df: df.distinct(), buckets)
        sample = self._spans(spark.createDataFrame([], schema), 0)
        newest = Window.partitionBy(*keys).orderBy(F.desc("_generation"))
        self.spans = KeyedStore(spark, f"{root}/spans", sample.schema, keys, lambda df: df.withColumn("_r", F.rank().over(newest)).filter("_r = 1").drop("_r"), buckets)

    def _spans(self, rows: DataFrame, generation: int) -> DataFrame:
        from tidemark.operators.cdc import scd2

        return scd2(rows, self.keys, self.order, self.tracked, self.rest).withColumn("_generation", F.lit(generation).cast("long"))

    def apply(self, batch: DataFrame, version: int) -> None:
        known = self.changes.before(version, batch)
        rows = batch
        if known is not None:
            touched = batch.select(*self.keys).distinct()
            same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys]
            rows = batch.unionByName(known.alias("a").join(touched.alias("b"), same, "left_semi"))
        self.spans.apply(self._spans(rows.distinct(), version), version)
        self.changes.apply(batch, version)

    def latest(self) -> DataFrame | None:
        """All spans: the change's columns, valid_from, valid_to (null while current), is_current."""
        got = self.spans.latest()
        return None if got is None else got.drop("_generation")
