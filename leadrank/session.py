"""Shared-storage helpers: where lineage is cut and where scratch tables go."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session.

    `spark.checkpoint.dir` names it on a cluster. Only a local-mode session may
    fall back to a temporary folder, because there executors share that disk.
    Tables are kept as long as the session may read them: delete the folder (its
    name is a random id) when the session has ended.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        root = sc.getConf().get("spark.checkpoint.dir")
        if root is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            root = tempfile.mkdtemp(prefix="leadrank-")
        sc.setCheckpointDir(root)
    # as Spark has resolved it: with scheme, and with a folder of this session below it
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark)}/leadrank-{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back.

    For a result with several consumers: it is computed once, and its readers get
    column pruning and real size statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed_table(df: DataFrame, key: str, name: str) -> DataFrame:
    """As `stage_table`, but dealt to buckets by `key` and sorted in them: groupings by the key, alone or with more
    columns, and joins on it with another such table read it without an exchange.

    For tables whose rows of one key are bounded or end up in one row anyway: a bucket is read by one task. The table
    is known to the session's catalog under a random name, its files lie in the shared folder.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"leadrank_{re.sub('[^a-z0-9]', '_', name)}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", scratch_path(spark, name))
     .saveAsTable(table))
    return spark.table(table)
