"""Helpers that every operator of this package shares."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared import shared_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus; the path may be one that only Spark can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: lineage ends here, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing lazy reads any more, and lets the driver notice which shuffles have ended, so that their files go too before the next step."""
    tables[0].sparkSession._jvm.System.gc()
    for df in tables:
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def column(name: str, inside: str | None = None) -> Column:
    """A column of any name, dots and backticks included; inside: of that struct."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{inside}.{quoted}" if inside else quoted)


def columns(df: DataFrame) -> list[Column]:
    return [column(c) for c in df.columns]


#: A key that holds more than this part of all rows is joined by broadcast: there are fewer such keys than that.
HOT_PART = 1000


def with_hot(rows: DataFrame, keyed: DataFrame, on: list[str], total: int) -> DataFrame:
    """rows joined with keyed, which has one row for each key and n, the number of rows with it. The rows of a hot key stay where they are; total: the number of all rows."""
    hot = keyed.filter(F.col("n") > total // HOT_PART)
    cold = keyed.filter(F.col("n") <= total // HOT_PART)
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null ids are in no fold and count as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 1


def blocks(lengths: list[int], most: int) -> list[tuple[int, int]]:
    """Ranges of consecutive items whose lengths add up to about `most`; a longer item stands alone."""
    out, start, total = [], 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            out.append((start, i))
            start, total = i, 0
        total += n
    if start < len(lengths):
        out.append((start, len(lengths)))
    return out


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal neighbours."""
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(keys)]))


def filtered(docs: DataFrame, keep) -> DataFrame:
    """docs, with every column, of the rows that keep(texts) marks; batch by batch, without a shuffle. Null texts reach it as empty ones."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(keep([t or "" for t in b.column(at).to_pylist()]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
