"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only where that is unset, as in tests on one machine, a temporary folder, which the session then keeps."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one."""
    return f"{shared_root(spark)}/work-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: made once, whatever reads it, and not again when an executor is lost."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
