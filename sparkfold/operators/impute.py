"""Fitted imputation.

``fit_*`` returns a long statistics DataFrame ``(column, value)`` (plus a
``fold`` column for per-fold fits); ``apply_fill`` pivots it to one row per
fold (bounded: one value per imputed column) and broadcasts it.

All columns are fitted in one pass: the frame is unpivoted to
``(column, value)`` and a value histogram is built per column, so exact
medians never hold a column's rows in one buffer (see ``order``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.operators.lookup import fitted
from sparkfold.operators.order import exact_quantiles, long_values, mode_of

COL, VAL = "column", "value"


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def _hist(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), as_text: bool = False) -> DataFrame:
    if as_text:
        long = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
            list(keep), list(cols), COL, VAL)
    else:
        long = long_values(df, cols, COL, VAL, keep)
    return long.where(F.col(VAL).isNotNull()).groupBy(*keep, COL, VAL).agg(
        F.count(F.lit(1)).alias("_cnt"))


def _complement(hist: DataFrame, fold_col: str, k: int) -> DataFrame:
    """Counts over the rows *not* in each fold: total - fold, one histogram pass."""
    spark = hist.sparkSession
    total = hist.groupBy(COL, VAL).agg(F.sum("_cnt").alias("_tot"))
    folds = spark.range(k).select(F.col("id").cast("int").alias(fold_col))
    grid = total.crossJoin(F.broadcast(folds))  # k copies of the distinct values only
    comp = grid.join(hist, [COL, VAL, fold_col], "left").select(
        fold_col, COL, VAL, (F.col("_tot") - F.coalesce(F.col("_cnt"), F.lit(0))).alias("_cnt"))
    return comp.where(F.col("_cnt") > 0)


# --- medians -----------------------------------------------------------------
def fit_median(df: DataFrame, cols: Sequence[str], where: str | Column | None = None) -> DataFrame:
    """Exact median per column (C3 own frame, C4 fit on train, C7 ``where`` = HOLDOUT)."""
    cols = _present(df, cols)
    hist = _hist(_where(df, where), cols)
    q = exact_quantiles(hist, VAL, [0.5], [COL], count_col="_cnt")
    return fitted(q.select(COL, F.col("q0").alias(VAL)))


def fit_median_pooled(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Median over the union of frames."""
    pooled = frames[0].select(*cols)
    for f in frames[1:]:
        pooled = pooled.unionByName(f.select(*cols))
    return fit_median(pooled, cols)


def fit_median_per_fold(df: DataFrame, cols: Sequence[str], fold_col: str = "fold",
                        k: int = 5) -> DataFrame:
    """Median for each fold's training part (rows with fold != f), all folds in one pass."""
    cols = _present(df, cols)
    comp = _complement(_hist(df, cols, keep=[fold_col]), fold_col, k)
    q = exact_quantiles(comp, VAL, [0.5], [fold_col, COL], count_col="_cnt")
    return fitted(q.select(fold_col, COL, F.col("q0").alias(VAL)))


# --- modes -----------------------------------------------------------------------
def fit_mode(df: DataFrame, cols: Sequence[str], where: str | Column | None = None) -> DataFrame:
    """Most frequent value per column, ties to the smallest (C8, C9).  Values as text."""
    cols = _present(df, cols)
    src = _where(df, where)
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    nums = [c for c in cols if c not in text]
    parts = []
    if text:
        parts.append(mode_of(_hist(src, text, as_text=True), VAL, [COL], out_col=VAL))
    if nums:  # numeric ties break on numeric order, not text order
        m = mode_of(_hist(src, nums), VAL, [COL], out_col=VAL)
        parts.append(m.select(COL, F.col(VAL).cast("string").alias(VAL)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return fitted(out)


def fit_mode_pooled(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    pooled = frames[0].select(*cols)
    for f in frames[1:]:
        pooled = pooled.unionByName(f.select(*cols))
    return fit_mode(pooled, cols)


def fit_mode_per_fold(df: DataFrame, cols: Sequence[str], fold_col: str = "fold", k: int = 5) -> DataFrame:
    """Mode of each fold's training part, ties to the smallest: text by text, numbers by number."""
    cols = _present(df, cols)
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    parts = []
    for own, as_text in ((text, True), ([c for c in cols if c not in text], False)):
        if own:
            comp = _complement(_hist(df, own, keep=[fold_col], as_text=as_text), fold_col, k)
            mode = mode_of(comp, VAL, [fold_col, COL], out_col=VAL)
            parts.append(mode.withColumn(VAL, F.col(VAL).cast("string")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return fitted(out)


# --- apply -------------------------------------------------------------------------
def apply_fill(df: DataFrame, stats: DataFrame, cols: Sequence[str],
               fold_col: str | None = None) -> DataFrame:
    """coalesce(column, fitted value); per-fold stats are matched on ``fold_col``."""
    cols = _present(df, cols)
    keys = [fold_col] if fold_col else []
    wide = stats.groupBy(*keys).pivot(COL, list(cols)).agg(F.first(VAL))
    wide = wide.select(*keys, *[F.col(c).alias(f"__fill_{c}") for c in cols])
    # one row (or one per fold): bounded by construction
    joined = df.join(F.broadcast(wide), keys, "left") if keys else df.crossJoin(F.broadcast(wide))
    fills = {}
    for c in cols:
        dt = df.schema[c].dataType
        fv = F.col(f"__fill_{c}")
        if not isinstance(dt, T.StringType):
            fv = fv.cast(dt)
        fills[c] = F.coalesce(F.col(c), fv)
    return joined.withColumns(fills).drop(*[f"__fill_{c}" for c in cols])
