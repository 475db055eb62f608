"""Sums of numpy vectors over all rows: partial sums in tasks, one shuffle by chunk, a bounded result on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1024
PART = pa.schema([("chunk", pa.int32()), ("part", pa.list_(pa.float64()))])


def as_arrays(df: DataFrame, vector: str, *scalars: str) -> DataFrame:
    """(_x array<double>, scalars as doubles): what the tasks read."""
    return df.select(vector_to_array(vector).alias("_x"), *[F.col(c).cast("double").alias(c) for c in scalars])


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def sized(df: DataFrame, rows: int | None = None, rows_per_task: int = 20_000) -> DataFrame:
    """``df`` in tasks of at least ``rows_per_task`` rows on average, for frames that are read over and over: a small
    one is not cut into many tiny tasks, a large one stays as it is (nothing is shuffled)."""
    rows = df.count() if rows is None else rows
    parts = max(1, -(-rows // rows_per_task))
    return df.coalesce(parts) if parts < df.rdd.getNumPartitions() else df


def even(df: DataFrame, rows: int, rows_per_task: int = 20_000, most_rows: int = 500_000) -> DataFrame:
    """``df`` dealt evenly over the cores (over fewer tasks below ``rows_per_task`` rows each), for frames that are read over
    and over: a pass takes as long as its largest task, and a frame read from files, or cut by ranges, may hold a third of
    its rows in one.  A task has ``most_rows`` at most; a frame that fits one task stays as it is."""
    tasks = -(-rows // rows_per_task)
    if tasks <= 1:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks if tasks < cores else cores * -(-rows // (cores * most_rows)))


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` in even tasks, in memory (on disk beyond it) while a solver reads it once a step."""
    rows = df.count()
    held = sized(even(df, rows), rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def total(df: DataFrame, add: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over partitions of ``add(batches)``, a vector of ``size`` doubles each.

    A partition's vector leaves it in chunks, which are summed where they meet; only the
    ``size`` sums come to the driver.  Without rows the sum is 0.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.asarray(add(batches), dtype=np.float64)
        pieces = [out[at:at + CHUNK] for at in range(0, size, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pieces)), pa.int32()), pa.array(pieces, PART.field("part").type)], schema=PART)

    def meet(parts: pa.Table) -> pa.Table:
        summed = np.zeros(0)
        for column in parts.column("part").chunks:
            for piece in column:
                value = piece.values.to_numpy()
                summed = value.copy() if not len(summed) else summed + value
        return pa.table([pa.array([parts.column("chunk")[0].as_py()], pa.int32()), pa.array([summed], PART.field("part").type)], schema=PART)

    sql = "chunk int, part array<double>"
    rows = df.mapInArrow(partial, sql).groupBy("chunk").applyInArrow(meet, sql).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(r["part"])] = r["part"]
    return out


def side_by_side(jobs: Sequence[Callable[[], object]], threads: int = 4) -> list:
    """Run independent fits from a bounded pool of driver threads, each in a scheduler pool of its own;
    results in the order of ``jobs``.  The first error is raised after all have ended."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()  # a thread of the caller's may have none active

    def run(i: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{i}")
        try:
            return jobs[i]()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(jobs)))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(run), i) for i in range(len(jobs))]
    return [f.result() for f in futures]
