"""Multi-layer perceptron with row weights in the loss and early stopping.

Every epoch is one Spark pass.  Each task goes through its rows in mini-batches with
Adam, from the common weights and moments, and the epoch's result is the mean of the
tasks' states, weighted by their rows.  A fixed share of the rows, chosen by a hash of
the key, is kept for validation; training stops ``patience`` epochs after the best
weighted validation loss and returns that epoch's weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.ml.sums import as_arrays, kept, matrix, total


def shapes(layers: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(layers[:-1], layers[1:]))


def unflatten(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for m, n in shapes(layers):
        out.append((flat[at:at + m * n].reshape(m, n), flat[at + m * n:at + m * n + n]))
        at += m * n + n
    return out


def forward(x: np.ndarray, flat: np.ndarray, layers: Sequence[int]) -> list[np.ndarray]:
    """The input and each layer's output (rectified inside, the margin at the end)."""
    values, parts = [x], unflatten(flat, layers)
    for i, (w, b) in enumerate(parts):
        z = values[-1] @ w + b
        values.append(z if i == len(parts) - 1 else np.maximum(z, 0))
    return values


def losses(y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    signed = np.where(y > 0, margin, -margin)
    return np.maximum(-signed, 0) + np.log1p(np.exp(-np.abs(signed)))


def gradient(x: np.ndarray, y: np.ndarray, weight: np.ndarray, flat: np.ndarray, layers: Sequence[int], alpha: float) -> np.ndarray:
    """Of the weighted mean log loss plus ``alpha / 2 * |weights|^2 / rows`` (intercepts are not shrunk)."""
    values, parts = forward(x, flat, layers), unflatten(flat, layers)
    margin = values[-1][:, 0]
    delta = (weight * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - (y > 0)) / weight.sum())[:, None]
    grads = []
    for i in range(len(parts) - 1, -1, -1):
        w, _ = parts[i]
        grads.append(np.concatenate([(values[i].T @ delta + alpha * w / len(x)).ravel(), delta.sum(0)]))
        if i:
            delta = (delta @ w.T) * (values[i] > 0)
    return np.concatenate(grads[::-1])


@dataclass
class Perceptron:
    layers: list[int]
    flat: np.ndarray
    best_epoch: int
    history: list[tuple[int, float]]  # (epoch, weighted validation loss of the weights after it)

    def score(self, df: DataFrame, features: str = "features", out: str = "proba") -> DataFrame:
        flat, layers = self.flat, self.layers

        @F.pandas_udf("double")
        def run(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series(np.zeros(0))
            return pd.Series(1 / (1 + np.exp(-np.clip(forward(np.stack(x.to_numpy()), flat, layers)[-1][:, 0], -500, 500))))

        return df.withColumn(out, run(vector_to_array(F.col(features))))


def start_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform in +-sqrt(6 / (inputs + outputs)) of each layer."""
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.uniform(-1, 1, m * n + n) * np.sqrt(6.0 / (m + n)) for m, n in shapes(layers)])


def fit(df: DataFrame, label: str, key: str, hidden: Sequence[int], weight: str | None = None, features: str = "features",
        epochs: int = 200, patience: int = 10, rate: float = 1e-3, alpha: float = 1e-4, batch: int = 128,
        valid_share: float = 0.1, seed: int = 42) -> Perceptron:
    """Fit on the rows of ``df`` (label 0 / 1).

    No row is replicated: a row's weight scales its loss.  The rows are held
    in memory, in even tasks, and read once an epoch.  The result depends on the partitioning, as the averaged
    states do, but not on retries: a task's shuffling is seeded by epoch and partition.
    Rows with a NULL label are left out; no training rows are an error; without validation
    rows all epochs run.
    """
    held_out = (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000)) < F.lit(round(10_000 * valid_share))).cast("double")
    rows = df.where(F.col(label).isNotNull()).withColumns({"_w": F.col(weight) if weight else F.lit(1.0), "_v": held_out})
    with kept(as_arrays(rows, features, label, "_w", "_v")) as rows:
        first = rows.select(F.size("_x").alias("n")).first()
        if first is None:
            raise ValueError("no rows to fit")
        layers = [first["n"], *hidden, 1]
        flat = start_weights(layers, seed)
        n = len(flat)
        state = np.concatenate([flat, np.zeros(2 * n)])  # weights, first and second moments
        done = 0  # Adam's step count: the rows' mean over tasks

        def epoch(state: np.ndarray, done: float, number: int) -> np.ndarray:
            def add(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
                rng = np.random.default_rng([seed, number, TaskContext.get().partitionId()])
                w, m, v = state[:n].copy(), state[n:2 * n].copy(), state[2 * n:].copy()
                t, seen, loss, weighed = done, 0, 0.0, 0.0
                for b in batches:
                    if not b.num_rows:
                        continue
                    x, y = matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
                    c, held = b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False) > 0
                    if held.any():  # the loss of the weights the epoch starts with
                        loss += float(c[held] @ losses(y[held], forward(x[held], state[:n], layers)[-1][:, 0]))
                        weighed += float(c[held].sum())
                    order = rng.permutation(np.flatnonzero(~held))
                    for at in range(0, len(order), batch):
                        part = order[at:at + batch]
                        g = gradient(x[part], y[part], c[part], w, layers, alpha)
                        t += 1
                        m = 0.9 * m + 0.1 * g
                        v = 0.999 * v + 0.001 * g * g
                        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
                    seen += len(order)
                return np.concatenate([seen * np.concatenate([w, m, v]), [seen, seen * t, loss, weighed]])
            return total(rows, add, 3 * n + 4)

        history: list[tuple[int, float]] = []
        best, best_epoch, best_flat = np.inf, 0, flat
        for number in range(epochs + 1):
            sums = epoch(state, done, number)
            seen, steps, loss, weighed = sums[-4:]
            if not seen:
                raise ValueError("no training rows")
            if weighed:  # of the weights after ``number`` epochs
                history.append((number, float(loss / weighed)))
                if loss / weighed < best:
                    best, best_epoch, best_flat = loss / weighed, number, state[:n]
                if number - best_epoch >= patience:
                    break
            if number < epochs:
                state, done = sums[:3 * n] / seen, steps / seen
        if not history:
            best_epoch, best_flat = epochs, state[:n]
        return Perceptron(layers, best_flat, best_epoch, history)
