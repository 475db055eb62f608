"""Support vector machines on Spark: squared hinge by Newton steps (M2), Platt calibration (M3), an RBF kernel
through Nyström landmarks (M4).

The linear solver reads the rows once a step.  Tasks sum the gradient, the curvature of
the rows inside the margin and the loss; the driver solves a system of the features'
width, so that width is bounded (``WIDEST``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.ml.sums import as_arrays, kept, matrix, total
from sparkfold.operators.split import assign_folds
from sparkfold.session import cut_lineage

WIDEST = 4096


@dataclass
class LinearMargin:
    """margin = coef . x + intercept; ``steps``: passes over the rows; ``loss``: the objective reached."""

    coef: np.ndarray
    intercept: float
    steps: int
    loss: float

    def score(self, df: DataFrame, features: str = "features", out: str = "margin") -> DataFrame:
        coef, intercept = self.coef, self.intercept

        @F.pandas_udf("double")
        def dot(x: pd.Series) -> pd.Series:
            return pd.Series(np.stack(x.to_numpy()) @ coef + intercept if len(x) else np.zeros(0))

        return df.withColumn(out, dot(vector_to_array(F.col(features))))


def squared_hinge(df: DataFrame, label: str, C: float = 1.0, weight: str | None = None, features: str = "features",
                  most_steps: int = 60, tol: float = 1e-9) -> LinearMargin:
    """Minimise ``|w|^2 / 2 + C * sum(weight * max(0, 1 - s * (w . x + b))^2)`` with s = +1 / -1.

    As in the reference's library the intercept is a weight of a constant column, so it is
    regularised too.  Newton steps, halved while the objective grows; the objective is
    strictly convex, so the result does not depend on the partitioning up to rounding.
    Rows with a NULL label are left out; without rows all weights are 0.  The rows
    are held in memory, in even tasks, and read once a step.
    """
    rows = df.where(F.col(label).isNotNull()).withColumn("_w", F.col(weight) if weight else F.lit(1.0))
    with kept(as_arrays(rows, features, label, "_w")) as rows:
        first = rows.select(F.size("_x").alias("n")).first()
        width = (first["n"] if first else 0) + 1
        if width > WIDEST:
            raise ValueError(f"{width - 1} features: the curvature is held whole, {WIDEST - 1} are the most")
        size = width * width + width + 1

        def at(w: np.ndarray) -> np.ndarray:
            def add(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
                curve, slope, loss = np.zeros((width, width)), np.zeros(width), 0.0
                for b in batches:
                    if not b.num_rows:
                        continue
                    x = np.hstack([matrix(b.column(0)), np.ones((b.num_rows, 1))])
                    s = np.where(b.column(1).to_numpy(zero_copy_only=False) > 0, 1.0, -1.0)
                    c = b.column(2).to_numpy(zero_copy_only=False)
                    short = 1 - s * (x @ w)
                    inside = short > 0
                    x, s, c, short = x[inside], s[inside], c[inside], short[inside]
                    loss += float(c @ short ** 2)
                    slope -= 2 * ((c * short * s) @ x)
                    curve += 2 * (x * c[:, None]).T @ x
                return np.concatenate([curve.ravel(), slope, [loss]])
            return total(rows, add, size)

        w, step, best, steps = np.zeros(width), np.zeros(width), np.inf, 0
        nearest = w
        while steps < most_steps:
            steps += 1
            sums = at(w)
            curve, slope = sums[:width * width].reshape(width, width), sums[-width - 1:-1]
            loss = 0.5 * float(w @ w) + C * float(sums[-1])
            if loss > best + 1e-12 * abs(best):
                step = step / 2  # too far
                w = nearest + step
                if np.abs(step).max() < 1e-14:
                    break
                continue
            nearest, gained, best = w, best - loss, loss
            gradient = w + C * slope
            if np.abs(gradient).max() < tol * max(1.0, C * abs(sums[-1])) or gained <= 1e-14 * abs(loss):
                break
            step = -np.linalg.solve(np.eye(width) + C * curve, gradient)
            w = w + step
        return LinearMargin(nearest[:-1], float(nearest[-1]), steps, best)


def calibrated(train: DataFrame, test: DataFrame, label: str, key: str, C: float = 0.5, cv: int = 3, weight: str | None = None,
               features: str = "features", seed: int = 11) -> DataFrame:
    """(key, proba) of the test rows: for each of ``cv`` stratified folds an SVM on the others and a logistic
    curve on its margins; the mean of the folds' probabilities (M3)."""
    columns = [key, label, features, *([weight] if weight else [])]
    folded = cut_lineage(assign_folds(train.select(*columns), label, key, k=cv, seed=seed, out_col="_cv"))  # read by every step
    out = test.select(key, features)
    probabilities = []
    for f in range(cv):
        svm = squared_hinge(folded.where(F.col("_cv") != f), label, C, weight, features)
        as_vector = array_to_vector(F.array("_m"))
        held = svm.score(folded.where(F.col("_cv") == f), features, "_m").select(label, as_vector.alias("m"))
        curve = LogisticRegression(featuresCol="m", labelCol=label, maxIter=100).fit(held)
        a, b = float(curve.coefficients[0]), float(curve.intercept)
        out = svm.score(out, features, f"_m{f}")
        probabilities.append(1 / (1 + F.exp(-(F.lit(a) * F.col(f"_m{f}") + F.lit(b)))))
    return out.select(key, (sum(probabilities[1:], probabilities[0]) / F.lit(float(cv))).alias("proba"))


def scale_gamma(df: DataFrame, features: str = "features") -> float:
    """The RBF width "scale": 1 / (width * variance of all entries); 1 / width where that variance is 0."""
    r = df.agg(Summarizer.mean(F.col(features)).alias("m"), Summarizer.normL2(F.col(features)).alias("q"), F.count(features).alias("n")).first()
    mean, squares = r["m"].toArray(), r["q"].toArray() ** 2 / max(r["n"], 1)
    variance = float(squares.mean() - mean.mean() ** 2)
    return 1.0 / (len(mean) * variance) if variance > 1e-12 else 1.0 / len(mean)


def nystroem(fit_on: DataFrame, df: DataFrame, key: str, features: str = "features", landmarks: int = 200,
             gamma: float | None = None, out: str = "kernel") -> DataFrame:
    """Add ``out``: features whose dot products approximate the RBF kernel (M4).

    ``landmarks`` rows of ``fit_on``, the first by a hash of their key, go to the driver -
    a bound that is a parameter, not a share of the data.  Their kernel matrix is whitened
    there (directions below 1e-10 of the largest are left out); every row's kernel with the
    landmarks is one matrix product a batch.  ``gamma`` None: :func:`scale_gamma`.
    """
    gamma = scale_gamma(fit_on, features) if gamma is None else gamma
    picked = fit_on.orderBy(F.xxhash64(key), F.col(key)).limit(landmarks).select(features).collect()
    if not picked:
        raise ValueError("no rows to take landmarks from")
    marks = np.unique(np.stack([r[features].toArray() for r in picked]), axis=0)

    def kernel(x: np.ndarray) -> np.ndarray:
        d2 = (x ** 2).sum(1)[:, None] + (marks ** 2).sum(1)[None, :] - 2 * x @ marks.T
        return np.exp(-gamma * np.maximum(d2, 0))

    values, vectors = np.linalg.eigh(kernel(marks))
    whole = values > 1e-10 * values[-1]
    whiten = vectors[:, whole] / np.sqrt(values[whole])

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        return pd.Series(list(kernel(np.stack(x.to_numpy())) @ whiten) if len(x) else [])

    return df.withColumn(out, array_to_vector(project(vector_to_array(F.col(features)))))
