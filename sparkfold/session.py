"""Session helpers.

On a cluster the session comes configured; we only fill in settings that are
unset (local runs and tests).  ``spark.checkpoint.dir`` must name a folder on
shared storage; when it is unset (local tests) a scratch folder is used.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sparkfold") -> SparkSession:
    """Return the active session, or build a local one for tests/benchmarks."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("SPARKFOLD_MASTER", "local[8]"))
    builder = builder.config("spark.driver.memory", os.environ.get("SPARKFOLD_DRIVER_MEM", "16g"))
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="sparkfold-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in ``spark.checkpoint.dir`` (nothing is created yet)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame once, as Parquet in ``spark.checkpoint.dir``, and read it back.

    Later plans start from the files, survive lost executors and read only the columns they use.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "frame")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Batches of whole texts that go to Python workers hold about ``size`` bytes, not Spark's 64 MB, where nothing is set."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per context, as ``--py-files`` would."""
    bound_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_sparkfold_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sparkfold-pkg-"), "sparkfold_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._sparkfold_shipped = True
