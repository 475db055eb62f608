"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import gc
import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.session import ensure_checkpoint_dir


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name on shared storage (nothing is created yet)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back: cuts lineage, survives lost executors."""
    path = folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of phases whose result has been stored.

    The cleaner follows the driver's garbage collection and works in the background,
    so it gets a moment before the next phase writes.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def blocks_for(docs: DataFrame, text: str, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` text the table needs; at least the shuffle partitions."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / block_bytes))
