"""Gradient boosting with early stopping, as a driver loop over Spark's regression trees (M7, M8).

Newton boosting of the logistic loss: a round's tree is fitted to ``gradient / hessian``
with the hessian as row weight, so a leaf is the Newton step of its rows.  The margin
is a column: a new tree is applied once to every row, training and validation, and one
aggregate gives both losses.  Boosting goes on from the stored margin (no tree is fitted
twice), stops ``patience`` rounds after the best validation loss, and the model is the
prefix up to the best round.

The rows live in one frame, dealt evenly over the cores, that is persisted for a round and written to
``spark.checkpoint.dir`` every ``store_every`` rounds, which bounds the lineage: a lost
executor costs that many rounds of recomputation at most.  What comes to the driver is
one tree and two losses a round.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.ml.sums import even, sized
from sparkfold.session import cut_lineage

#: Hessians below this count as this, so a row that is certain still has a weight.
LEAST_HESSIAN = 1e-6


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def log_loss(y: Column, margin: Column) -> Column:
    """-log of the probability of the label, without overflow for large margins."""
    signed = F.when(y == 1, margin).otherwise(-margin)
    return F.greatest(-signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))


@dataclass
class Boosted:
    """Trees of the best prefix, the starting margin, and the losses of every round that ran."""

    model: GBTClassificationModel | None
    base: float
    best_rounds: int
    history: list[tuple[int, float, float | None]]  # (round, training loss, validation loss); round 0: no tree

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        """Add the probability of label 1; the trees run JVM-side as one model."""
        if self.model is None:
            return df.withColumn(out, sigmoid(F.lit(self.base)))
        raw = self.model.setRawPredictionCol("_raw").setPredictionCol("_pred").setProbabilityCol("_prob").transform(df)
        # Spark's boosted model gives (-m, m); the tree weights are the steps
        return raw.withColumn(out, sigmoid(F.lit(self.base) + vector_to_array("_raw")[1])).drop("_raw", "_pred", "_prob")


def as_model(trees: list, step: float, features: str) -> GBTClassificationModel | None:
    """One Spark ML model of the given trees (it can be saved as any other)."""
    if not trees:
        return None
    sc = SparkContext._active_spark_context
    gateway = sc._gateway
    held = gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(sc._jvm.double, len(trees))
    for i, t in enumerate(trees):
        held[i], weights[i] = t._java_obj, float(step)
    java = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"boosted_{uuid.uuid4().hex[:12]}", held, weights)
    return GBTClassificationModel(java).setFeaturesCol(features)


def boost(rows: DataFrame, label: str, valid: Column | None = None, weight: str | None = None, features: str = "features",
          rounds: int = 2000, patience: int = 100, step: float = 0.05, depth: int = 6, row_share: float = 0.8,
          column_share: float = 0.8, max_bins: int = 32, seed: int = 42, store_every: int = 10) -> Boosted:
    """Boost on the rows where ``valid`` is false, watch the loss where it is true.

    Without ``valid`` all rows train and all ``rounds`` run (the refit of M8).  Each tree
    sees a share of the rows (without replacement), each node a share of the columns.  The
    smallest weighted hessian in a leaf is 1.  A NULL label or ``valid`` leaves the row
    out; no training rows are an error.  Ties of the validation loss go to the first round.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    part = F.coalesce(valid, F.lit(None)).cast("int") if valid is not None else F.lit(0)
    dense = array_to_vector(vector_to_array(features)).alias(features, metadata=rows.schema[features].metadata)  # cheaper to cut into bins
    rows = rows.select(dense, F.col(label).cast("double").alias("_y"), w.alias("_w"), part.alias("_valid")).where("_y is not null and _valid is not null")
    train = F.col("_valid") == 0
    start = rows.agg(F.count("_y").alias("rows"), F.sum(F.when(train, F.col("_w"))).alias("n"), F.sum(F.when(train, F.col("_w") * F.col("_y"))).alias("pos")).first()
    if not start["n"]:
        raise ValueError("no training rows")
    share = min(max(start["pos"] / start["n"], 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    p = sigmoid(F.col("_margin"))
    hessian = F.greatest(p * (1 - p), F.lit(LEAST_HESSIAN))
    loss = F.col("_w") * log_loss(F.col("_y"), F.col("_margin"))
    watch = [F.sum(F.when(c, loss)) / F.sum(F.when(c, F.col("_w"))) for c in (train, ~train)] + [F.sum(F.when(train, F.col("_w") * hessian))]

    targets = {"_step": (F.col("_y") - p) / hessian, "_h": F.col("_w") * hessian}  # stored with the margin: a fit reads them three times
    held = sized(cut_lineage(even(rows.withColumn("_margin", F.lit(base)), start["rows"])), start["rows"]).withColumns(targets).persist(StorageLevel.MEMORY_AND_DISK)
    trees, best_round = [], 0
    losses = held.agg(*[c.alias(f"c{i}") for i, c in enumerate(watch)]).first()
    history, best = [(0, losses[0], losses[1])], losses[1]
    while len(trees) < rounds and (valid is None or len(trees) - best_round < patience):
        fit_rows = held.where(train).select(features, "_step", "_h")
        forest = RandomForestRegressor(
            featuresCol=features, labelCol="_step", weightCol="_h", numTrees=1, maxDepth=depth, maxBins=max_bins, bootstrap=False,
            subsamplingRate=row_share, featureSubsetStrategy=str(column_share) if column_share < 1 else "all", seed=seed + len(trees),
            minWeightFractionPerNode=min(0.49, 1.0 / max(losses[2], 1e-9)))
        tree = forest.fit(fit_rows).trees[0]
        trees.append(tree)
        moved = tree.setPredictionCol("_tree").transform(held).withColumn("_margin", F.col("_margin") + F.lit(step) * F.col("_tree")).drop("_tree", *targets)
        if len(trees) % store_every == 0:
            moved = sized(cut_lineage(moved), start["rows"])
        moved = moved.withColumns(targets).persist(StorageLevel.MEMORY_AND_DISK)
        losses = moved.agg(*[c.alias(f"c{i}") for i, c in enumerate(watch)]).first()
        held.unpersist()
        held = moved
        history.append((len(trees), losses[0], losses[1]))
        if losses[1] is not None and (best is None or losses[1] < best):
            best, best_round = losses[1], len(trees)
    held.unpersist()
    kept = len(trees) if valid is None else best_round
    return Boosted(as_model(trees[:kept], step, features), base, kept, history)
