"""Flagship plan: the minimum slice through scan, impute, features, folds, encoding, metrics.

entity_base -> stratified 5-fold split (hash order) -> median fit on the
training part, applied to all rows -> ratio features -> out-of-fold target
encoding of segment / nation / region -> target rate and mean encodings per
fold, with the overall row from a rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.functions import features as FT
from sparkfold.operators import encode, impute, split
from sparkfold.plans import fixtures as fx
from sparkfold.session import cut_lineage

TE_COLS = ["segment", "nation", "region"]
RATIOS = [FT.Feature("spend_per_order", ("total_spend", "n_orders"), FT.ratio_plus_one),
          FT.Feature("balance_ratio", ("acctbal", "avg_price"), FT.ratio_plus_one)]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    eb = fx.view(spark, sf_dir, "entity_base")
    eb = split.assign_folds(eb, "status", key_col="id", k=5, seed=fx.SEED)
    # the folded frame feeds the fit, the encoders and the apply: cut the lineage once
    eb = cut_lineage(eb.withColumn("y", (F.col("status") == "Stayed").cast("int")))
    med = impute.fit_median(eb, ["acctbal"], where="fold != 0")
    eb = impute.apply_fill(eb, med, ["acctbal"])
    eb = FT.add_features(eb, RATIOS)
    fold_stats, _, glob = encode.fit_target_kfold(eb, TE_COLS, "y", "fold", 5, smoothing=10.0)
    enc = encode.apply_target(eb, fold_stats, glob, TE_COLS, fold_col="fold")
    return enc.rollup("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("y").alias("target_rate"),
        *[F.avg(f"{c}_te").alias(f"{c}_te_mean") for c in TE_COLS],
        F.avg("acctbal").alias("acctbal_mean"),
        F.avg("spend_per_order").alias("spend_per_order_mean"),
        F.avg("balance_ratio").alias("balance_ratio_mean"))
