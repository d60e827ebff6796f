"""Small intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def storage_root(spark: SparkSession) -> str:
    """A folder in spark.checkpoint.dir of the session; a local session that has none gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="gatefold-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/gatefold"


def cut(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write a per-sample table and read it back, so that plans built on it stay small and a lost executor replays nothing."""
    spark = df.sparkSession
    path = f"{storage_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_at = path
    return out


def remove(*tables: DataFrame) -> None:
    """Remove cut() tables that no later step reads."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t._cut_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
