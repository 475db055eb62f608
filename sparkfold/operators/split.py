"""Deterministic stratified splits (H1-H6).

Fold membership is defined by a hash order: within each class, rows are
ordered by ``md5(key || '|' || seed)`` (ties by key) and the i-th row goes to
fold ``i % k``.  Any engine with md5 reproduces it, and per-class fold sizes
differ by at most one.  ``mode="hash"`` gives ``pmod(xxhash64(key, seed), k)``
instead: no shuffle at all, sizes balanced only approximately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.operators.order import BEFORE_COL, TOTAL_COL, WEIGHT_COL, positions

HASH_COL = "_h"


def hash_key(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def class_positions(df: DataFrame, label_col: str | None, key_col: str, seed: int) -> DataFrame:
    """Add ``_before`` (position in the class hash order) and ``_n`` (class size)."""
    groups = [label_col] if label_col else []
    h = df.withColumn(HASH_COL, hash_key(key_col, seed))
    pos = positions(h, [HASH_COL, key_col], groups)
    return pos.drop(HASH_COL, WEIGHT_COL)


def assign_folds(df: DataFrame, label_col: str | None, key_col: str = "id", k: int = 5,
                 seed: int = 42, out_col: str = "fold", mode: str = "exact") -> DataFrame:
    """Stratified k-fold column (H2)."""
    if mode == "hash":
        return df.withColumn(out_col, F.pmod(F.xxhash64(F.col(key_col), F.lit(seed)), F.lit(k)).cast("int"))
    pos = class_positions(df, label_col, key_col, seed)
    return pos.withColumn(out_col, (F.col(BEFORE_COL) % k).cast("int")).drop(BEFORE_COL, TOTAL_COL)


def _take_first(frac: float) -> Column:
    if frac >= 1:
        return F.lit(True)
    return F.col(BEFORE_COL) < F.round(F.col(TOTAL_COL) * F.lit(float(frac)))


def split_stratified(df: DataFrame, label_col: str | None, key_col: str = "id",
                     test_frac: float = 0.2, seed: int = 42, out_col: str = "is_test") -> DataFrame:
    """Flag the first ``round(test_frac * n_class)`` rows of each class in hash order (H1)."""
    pos = class_positions(df, label_col, key_col, seed)
    return pos.withColumn(out_col, _take_first(test_frac).cast("int")).drop(BEFORE_COL, TOTAL_COL)


def sample_fraction(df: DataFrame, label_col: str | None, frac: float, key_col: str = "id",
                    seed: int = 42) -> DataFrame:
    """Exact stratified subsample: ``round(frac * n_class)`` rows per class (H4); frac >= 1 keeps all."""
    if frac >= 1:
        return df
    pos = class_positions(df, label_col, key_col, seed)
    return pos.where(_take_first(frac)).drop(BEFORE_COL, TOTAL_COL)


def split_nested(df: DataFrame, label_col: str, frac: float = 0.2, test_frac: float = 0.2,
                 key_col: str = "id", seed_sample: int = 42, seed_split: int = 7,
                 out_col: str = "is_test") -> DataFrame:
    """Subsample, then a stratified hold-out inside the subsample (H5)."""
    sub = sample_fraction(df, label_col, frac, key_col, seed_sample)
    return split_stratified(sub, label_col, key_col, test_frac, seed_split, out_col)


def main_holdout(df: DataFrame, fold_col: str = "fold", holdout_fold: int = 0):
    """HOLDOUT = one fold, MAIN = the rest."""
    return df.where(F.col(fold_col) != holdout_fold), df.where(F.col(fold_col) == holdout_fold)
