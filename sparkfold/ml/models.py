"""Model training through Spark ML.

Solvers are Spark's.  What the reference does with in-memory arrays and
fold loops becomes: a fold column carried on the rows, one distributed fit
per fold (the driver loops over k folds, never over rows), and prediction
tables ``(id, model, fold, proba)`` that the metric and search operators
consume.  Positive class probability is ``probability[1]``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.operators.metrics import add_class_weight
from sparkfold.ml import forest
from sparkfold.ml.sums import even, sized
from sparkfold.session import cut_lineage

FEATURES = "features"


# --- feature assembly (G6) -------------------------------------------------------------------------------
def feature_stages(num_cols: Sequence[str], cat_cols: Sequence[str], onehot: bool = True,
                   scale: bool = False, out: str = FEATURES) -> list:
    """Per-role stages: categoricals indexed (alphabetical, unseen kept) and one-hot
    encoded or left as indices (native tree splits, M9); numerics passed through or
    standardised on their own, so one-hot columns are not centred and the vector stays
    sparse; everything assembled into one vector."""
    stages: list = []
    idx = [f"{c}__idx" for c in cat_cols]
    if cat_cols:
        stages.append(StringIndexer(inputCols=list(cat_cols), outputCols=idx, stringOrderType="alphabetAsc",
                                    handleInvalid="keep"))
    cat_out = idx
    if cat_cols and onehot:
        cat_out = [f"{c}__ohe" for c in cat_cols]
        stages.append(OneHotEncoder(inputCols=idx, outputCols=cat_out, dropLast=True, handleInvalid="error"))
    num_out = list(num_cols)
    if scale and num_out:
        stages.append(VectorAssembler(inputCols=num_out, outputCol=f"{out}__num", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol=f"{out}__num", outputCol=f"{out}__scaled", withMean=True, withStd=True))
        num_out = [f"{out}__scaled"]
    stages.append(VectorAssembler(inputCols=num_out + cat_out, outputCol=out, handleInvalid="keep"))
    return stages


# --- estimator registry (M15) ---------------------------------------------------------------------------------
def estimator(name: str, **kw):
    """Build an estimator by name; ``weight`` names a weight column."""
    w = kw.pop("weight", None)
    if name == "logreg":
        est = LogisticRegression(maxIter=kw.pop("maxIter", 100), **kw)
    elif name == "rf":
        est = RandomForestClassifier(numTrees=kw.pop("numTrees", 200), seed=kw.pop("seed", 42), **kw)
    elif name == "gbt":
        est = GBTClassifier(maxIter=kw.pop("maxIter", 50), stepSize=kw.pop("stepSize", 0.05),
                            subsamplingRate=kw.pop("subsamplingRate", 0.8), seed=kw.pop("seed", 42), **kw)
    elif name == "svc":
        est = LinearSVC(maxIter=kw.pop("maxIter", 100), **kw)
    elif name == "tree":
        est = DecisionTreeClassifier(**kw)
    elif name == "mlp":
        est = MultilayerPerceptronClassifier(seed=kw.pop("seed", 42), **kw)
    else:
        raise ValueError(f"unknown estimator {name}")
    if w and est.hasParam("weightCol"):
        est = est.setWeightCol(w)
    return est


def max_bins(df: DataFrame, cat_cols: Sequence[str], least: int = 32) -> int:
    """Bins that hold the largest category count (M9): trees need one for each index, unseen included."""
    counts = df.agg(*[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in cat_cols]).first()
    return max([least, *(n + 2 for n in counts)])


def positive_proba(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def margin(col: str = "rawPrediction") -> Column:
    return vector_to_array(F.col(col))[1]


# --- fit / score ------------------------------------------------------------------------------------------------------
def fit_score(train: DataFrame, test: DataFrame, stages: list, est, id_col: str, score: str = "proba") -> DataFrame:
    """Fit the pipeline on ``train`` and return (id, proba) on ``test``."""
    model = Pipeline(stages=[*stages, est]).fit(train)
    pred = model.transform(test)
    col = positive_proba() if score == "proba" else margin()
    return pred.select(id_col, col.alias(score))


def oof_predictions(df: DataFrame, test: DataFrame | None, stages_fn: Callable[[], list], est_fn: Callable[[], object],
                    id_col: str, fold_col: str = "fold", k: int = 5, model_name: str = "m",
                    score: str = "proba") -> tuple[DataFrame, DataFrame | None]:
    """K-fold training: each fold's model scores its held-out rows (OOF) and the test
    rows; test scores are averaged over folds (M17, N1, N9).

    Returns (oof (id, model, fold, proba), test mean (id, model, proba) or None).
    """
    oof_parts, test_parts = [], []
    for f in range(k):
        tr = df.where(F.col(fold_col) != f)
        va = df.where(F.col(fold_col) == f)
        model = Pipeline(stages=[*stages_fn(), est_fn()]).fit(tr)
        pv = model.transform(va)
        s = positive_proba() if score == "proba" else margin()
        oof_parts.append(pv.select(id_col, F.lit(model_name).alias("model"), F.lit(f).alias("fold"), s.alias(score)))
        if test is not None:
            pt = model.transform(test)
            st = positive_proba() if score == "proba" else margin()
            test_parts.append(pt.select(id_col, F.lit(f).alias("fold"), st.alias(score)))
    oof = oof_parts[0]
    for p in oof_parts[1:]:
        oof = oof.unionByName(p)
    tmean = None
    if test_parts:
        t = test_parts[0]
        for p in test_parts[1:]:
            t = t.unionByName(p)
        tmean = t.groupBy(id_col).agg(F.avg(score).alias(score)).withColumn("model", F.lit(model_name))
    return oof, tmean


# --- forests in groups of trees (M5, M6) -------------------------------------------------------------------------------
#: Rows that the trees of one group see between them.  A deep tree has a node for every two or three of its rows, and
#: Spark holds the nodes of all trees of a fit on the driver: at 200 trees of 12,000 rows more than 750 MB.
TREE_ROWS = 250_000
#: Up to so many training rows Spark's own fits grow a forest; beyond, or the driver and the shuffles take minutes, see ``forest``.
FIT_ROWS = 4_000


def forest_groups(est: RandomForestClassifier, train: DataFrame, tree_rows: int | None = None) -> Iterator[RandomForestClassificationModel]:
    """Fit the forest ``est`` in groups of whole trees, one model at a time, so that the driver holds one group.

    A group has as many trees as see ``tree_rows`` rows (``TREE_ROWS``) between them, one tree at least.  Each
    has a seed of its own and draws columns as the whole forest would; if all trees fit into
    one group it is the model of ``est`` itself.  Drop a model before the next one is asked for.
    """
    trees, most = est.getNumTrees(), max(1, (tree_rows or TREE_ROWS) // max(1, train.count()))
    groups = math.ceil(trees / most)
    est = est.copy({est.cacheNodeIds: True})  # else every level sends all nodes so far from the driver
    if groups > 1 and est.getFeatureSubsetStrategy() == "auto":
        est = est.copy({est.featureSubsetStrategy: "sqrt"})  # what it means for more than one tree
    for g in range(groups):
        share = trees * (g + 1) // groups - trees * g // groups
        yield est.copy({est.numTrees: share, est.seed: est.getSeed() + 1_000_003 * g}).fit(train)


def grown_in_tasks(est: RandomForestClassifier, train: DataFrame, tree_rows: int | None = None) -> int:
    """The number of training rows if ``forest`` grows the trees, else 0."""
    rows = 0 if tree_rows or not forest.takes(est) else train.count()
    return rows if rows > FIT_ROWS else 0


def forest_score(est: RandomForestClassifier, train: DataFrame, test: DataFrame, id_col: str, tree_rows: int | None = None) -> DataFrame:
    """(id, proba) on ``test``: the mean vote of all trees of the forest, from groups of them.

    A group's votes are written to ``spark.checkpoint.dir`` before the next group is fitted; ids may repeat.
    More than ``FIT_ROWS`` training rows are grown by ``forest`` instead, unless ``tree_rows`` is given.
    """
    rows = cut_lineage(test.select(id_col, est.getFeaturesCol(), F.monotonically_increasing_id().alias("_row")))
    if count := grown_in_tasks(est, train, tree_rows):
        parts = forest.votes(est, train, count, rows, "_row")
    else:
        votes = vector_to_array(F.col("rawPrediction"))
        parts = []
        for model in forest_groups(est, train, tree_rows):
            parts.append(cut_lineage(model.transform(rows).select("_row", votes[1].alias("_for"), (votes[0] + votes[1]).alias("_all"))))
            del model  # the driver's copy goes before the next group comes
    summed = reduce(DataFrame.unionByName, parts).groupBy("_row").agg((F.sum("_for") / F.sum("_all")).alias("proba"))
    return rows.select(id_col, "_row").join(summed, "_row").select(id_col, "proba")


def forest_importances(est: RandomForestClassifier, train: DataFrame, tree_rows: int | None = None) -> np.ndarray:
    """Spark's importances of the whole forest, from groups of its trees: the mean over the trees that split.

    More than ``FIT_ROWS`` training rows are grown by ``forest`` instead, unless ``tree_rows`` is given."""
    if count := grown_in_tasks(est, train, tree_rows):
        return forest.importances(est, train, count)
    total, grown = 0.0, 0
    for model in forest_groups(est, train, tree_rows):
        split = sum(t.numNodes > 1 for t in model.trees)
        total, grown = total + split * model.featureImportances.toArray(), grown + split
        del model
    return total / max(1, grown)


# --- AdaBoost with weighted stumps (M10) ------------------------------------------------------------------------------
def adaboost(train: DataFrame, test: DataFrame, label: str, id_col: str, rounds: int = 50,
             features: str = FEATURES, checkpoint_every: int = 3) -> DataFrame:
    """SAMME (two classes): depth-1 trees on re-weighted rows; score = sum alpha_t * (+1/-1);
    proba is the logistic of twice the score over the sum of alphas.

    Row weights live in a column; the rows are dealt evenly over the cores and persisted for a round (it reads them
    five times).  The lineage is cut every few rounds so a lost executor recomputes at most a few rounds.
    Returns (id, score, proba) on test.
    """
    n = train.count()
    cur = sized(cut_lineage(even(train.select(label, features).withColumn("_w", F.lit(1.0 / n)), n)), n).persist(StorageLevel.MEMORY_AND_DISK)
    learners, done = [], cur
    for t in range(rounds):
        stump = DecisionTreeClassifier(maxDepth=1, labelCol=label, featuresCol=features, weightCol="_w").fit(cur)
        if done is not cur:
            done.unpersist()  # the fit has filled ``cur`` from it
        scored = stump.transform(cur).withColumn("_miss", (F.col("prediction") != F.col(label)).cast("double"))
        # the weights sum to 1 (up to rounding), so the error also gives the sum of the next ones
        wrong, total = scored.agg(F.sum(F.col("_w") * F.col("_miss")), F.sum("_w")).first()
        err = wrong / total
        if err >= 0.5 and learners:
            break  # no better than a coin: the reference's library stops here
        err = min(max(err, 1e-10), 1 - 1e-10)
        alpha = math.log((1 - err) / err)
        learners.append((stump, alpha))
        if err <= 1e-10:
            break  # a perfect stump decides alone
        next_total = total - wrong + wrong * math.exp(alpha)
        moved = scored.withColumn("_w", F.col("_w") * F.exp(F.lit(alpha) * F.col("_miss")) / F.lit(next_total)) \
            .drop("prediction", "rawPrediction", "probability", "_miss")
        if (t + 1) % checkpoint_every == 0:
            moved = sized(cut_lineage(moved), n)
        done, cur = cur, moved.persist(StorageLevel.MEMORY_AND_DISK)
    for frame in (done, cur):
        frame.unpersist()
    # all stumps score in one chain of projections, each with columns of its own
    out, score = test.select(id_col, features), F.lit(0.0)
    for i, (stump, alpha) in enumerate(learners):
        own = stump.copy().setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}")
        out = own.transform(out).drop(f"_r{i}", f"_q{i}")
        score = score + F.lit(alpha) * (F.col(f"_p{i}") * 2 - 1)
    mean = score / F.lit(sum(alpha for _, alpha in learners))
    return out.select(id_col, score.alias("score"), (1 / (1 + F.exp(-2 * mean))).alias("proba"))


# --- random configuration draws (M13, randomised search) ----------------------------------------------------------
def random_configs(space: dict[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` seeded draws from a discrete search space (a bounded list of settings)."""
    import random
    rng = random.Random(seed)
    keys = sorted(space)
    return [{k: rng.choice(list(space[k])) for k in keys} for _ in range(n)]
