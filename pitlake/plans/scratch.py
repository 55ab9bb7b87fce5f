"""Scratch space on storage every executor sees, and lineage cuts into it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the `spark.checkpoint.dir` of the session.

    Where that is unset, a session that runs in one process gets a folder of its own; on a cluster
    there is no folder that every executor sees, so the caller has to name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Shuffle files of a write go when it has ended: the written table stands in for them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written out and read back.

    Work done so far survives lost executors, is not repeated by later references, and its size is
    known to the planner.
    """
    spark = df.sparkSession
    path, held = scratch(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if held is None else spark.conf.set(CLEANUP, held)
    return spark.read.schema(df.schema).parquet(path)
