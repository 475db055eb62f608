"""Fitted steps applied to a parquet stream give the batch result."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from sparkfold.operators import encode, impute
from sparkfold.streaming import apply_steps, score_stream


def test_stream_matches_batch(spark):
    batch = spark.read.parquet(f"{SF001}/customer.parquet").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_acctbal")).alias("bal"))
    med = impute.fit_median(batch, ["bal"])
    freq = encode.fit_freq(batch, ["c_mktsegment"])
    steps = [lambda d: d.select("c_custkey", "c_mktsegment",
                                F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_acctbal")).alias("bal")),
             lambda d: impute.apply_fill(d, med, ["bal"]),
             lambda d: encode.apply_freq(d, freq, ["c_mktsegment"])]
    expected = sorted(apply_steps(spark.read.parquet(f"{SF001}/customer.parquet"), steps).collect())
    src = spark.readStream.schema(spark.read.parquet(f"{SF001}/customer.parquet").schema) \
        .option("pathGlobFilter", "customer.parquet").parquet(SF001)
    out_dir, ck = tempfile.mkdtemp(prefix="sf-stream-"), tempfile.mkdtemp(prefix="sf-stream-ck-")
    q = score_stream(src, steps, out_dir, ck)
    q.awaitTermination(120)
    got = sorted(spark.read.parquet(out_dir).select(*[c for c in expected[0].asDict()]).collect())
    assert got == expected
