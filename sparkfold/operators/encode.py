"""Encoders (F1-F16).

Statistics are long tables keyed by ``(column, value)``; every categorical
column is fitted in the same pass by unpivoting the frame.  Codes come from
:func:`order.dense_index` (exact, no single-task window).  Apply joins the
statistics back with a size-checked broadcast, so the data side is never
shuffled while the statistics are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.operators.lookup import fitted, join_stats, materialize
from sparkfold.operators.order import dense_index, prefix_sums
from sparkfold.operators.split import hash_key

COL, VAL = "column", "value"


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def long_text(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) with values as text."""
    return df.select(*keep, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        list(keep), list(cols), COL, VAL)


def _lookup_col(df: DataFrame, stats: DataFrame, c: str, out: str, keys: Sequence[str] = (),
                nullsafe: bool = False, small: bool = True) -> DataFrame:
    """Left-join the ``stats`` rows of column ``c`` on the value of ``c`` (+ keys).

    ``stats`` comes from :func:`lookup.materialize`; ``small`` is its size check.
    """
    vcol = f"__v_{c}"
    s = stats.where(F.col(COL) == c).select(
        F.col(VAL).alias(vcol), F.col(out).alias(f"__o_{c}"), *[F.col(k).alias(f"__k_{k}") for k in keys])
    txt = F.col(c).cast("string")
    cond = txt.eqNullSafe(F.col(vcol)) if nullsafe else (txt == F.col(vcol))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__k_{k}"))
    return join_stats(df, s, cond, "left", small).drop(vcol, *[f"__k_{k}" for k in keys])


# --- label encoding ------------------------------------------------------------------
def fit_label(df: DataFrame, cols: Sequence[str], where: str | Column | None = None) -> DataFrame:
    """Sorted distinct values -> 0..n-1 per column (F1).  ``(column, value, code)``."""
    src = df if where is None else df.where(where)
    d = long_text(src, _present(src, cols)).where(F.col(VAL).isNotNull()).distinct()
    return fitted(dense_index(d, [VAL], [COL], out_col="code"))


def fit_label_combined(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Fit on the union of frames."""
    d = None
    for f in frames:
        part = long_text(f, _present(f, cols))
        d = part if d is None else d.unionByName(part)
    d = d.where(F.col(VAL).isNotNull()).distinct()
    return fitted(dense_index(d, [VAL], [COL], out_col="code"))


def class_counts(stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return stats.groupBy(*keys, COL).agg(F.count(F.lit(1)).alias("n_classes"))


def apply_label(df: DataFrame, stats: DataFrame, cols: Sequence[str], suffix: str = "",
                fitted: Sequence[str] | None = None) -> DataFrame:
    """Code per value; unseen or missing -> n (class count) (F2).

    Columns not in ``fitted`` are encoded by a fit on this frame (F3).
    """
    cols = _present(df, cols)
    fitted = list(cols) if fitted is None else list(fitted)
    local = [c for c in cols if c not in fitted]
    if local:
        stats = stats.unionByName(fit_label(df, local))
    stats, small = materialize(stats)
    n = class_counts(stats).groupBy().pivot(COL, cols).agg(F.first("n_classes"))
    n = n.select(*[F.coalesce(F.col(c), F.lit(0)).alias(f"__n_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(n))  # one row
    for c in cols:
        out = _lookup_col(out, stats, c, "code", small=small)
        out = out.withColumn(c + suffix, F.coalesce(F.col(f"__o_{c}"), F.col(f"__n_{c}")).cast("long"))
        out = out.drop(f"__o_{c}", f"__n_{c}")
    return out


def fit_label_per_fold(df: DataFrame, cols: Sequence[str], fold_col: str = "fold", k: int = 5) -> DataFrame:
    """Encoder of each fold's training part (values seen in rows with fold != f)."""
    spark = df.sparkSession
    cols = _present(df, cols)
    per = long_text(df, cols, keep=[fold_col]).where(F.col(VAL).isNotNull()) \
        .groupBy(COL, VAL, fold_col).agg(F.count(F.lit(1)).alias("_c"))
    tot = per.groupBy(COL, VAL).agg(F.sum("_c").alias("_t"))
    folds = spark.range(k).select(F.col("id").cast("int").alias(fold_col))
    comp = tot.crossJoin(F.broadcast(folds)).join(per, [COL, VAL, fold_col], "left") \
        .where(F.col("_t") - F.coalesce(F.col("_c"), F.lit(0)) > 0).select(fold_col, COL, VAL)
    return fitted(dense_index(comp, [VAL], [fold_col, COL], out_col="code"))


def apply_label_per_fold(df: DataFrame, stats: DataFrame, cols: Sequence[str],
                         fold_col: str = "fold", suffix: str = "") -> DataFrame:
    """Each row encoded by its own fold's encoder; unseen -> that fold's class count."""
    cols = _present(df, cols)
    stats, small = materialize(stats)
    n = class_counts(stats, [fold_col]).groupBy(fold_col).pivot(COL, cols).agg(F.first("n_classes"))
    n = n.select(fold_col, *[F.coalesce(F.col(c), F.lit(0)).alias(f"__n_{c}") for c in cols])
    out = df.join(F.broadcast(n), fold_col, "left")  # one row per fold
    for c in cols:
        out = _lookup_col(out, stats, c, "code", keys=[fold_col], small=small)
        out = out.withColumn(c + suffix, F.coalesce(F.col(f"__o_{c}"), F.col(f"__n_{c}")).cast("long"))
        out = out.drop(f"__o_{c}", f"__n_{c}")
    return out


def label_roundtrip(df: DataFrame, label_col: str, out_code: str = "y", where=None) -> tuple[DataFrame, DataFrame]:
    """Target to 0..n-1 and the inverse map (F6).  Returns (encoded df, classes table)."""
    classes = fit_label(df, [label_col], where).select(F.col(VAL).alias(label_col), "code")
    enc = df.join(F.broadcast(classes), label_col, "left").withColumnRenamed("code", out_code)
    return enc, classes


def decode_label(df: DataFrame, classes: DataFrame, code_col: str, out_col: str) -> DataFrame:
    """IndexToString through a join: code -> class name."""
    label = [c for c in classes.columns if c != "code"][0]
    inv = classes.select(F.col("code").alias(code_col), F.col(label).alias(out_col))
    return df.join(F.broadcast(inv), code_col, "left")


# --- factorize ---------------------------------------------------------------------------
def fit_factorize(df: DataFrame, col: str, order_col: str = "id") -> DataFrame:
    """Codes by first appearance (appearance := ``order_col`` order)."""
    first = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias(VAL)) \
        .agg(F.min(order_col).alias("_first"))
    return fitted(dense_index(first, ["_first"], out_col="code").drop("_first"))


def apply_factorize(df: DataFrame, stats: DataFrame, col: str, out_col: str) -> DataFrame:
    s, small = materialize(stats.select(F.col(VAL).alias("__fv"), F.col("code").alias("__fc")))
    j = join_stats(df, s, F.col(col).cast("string") == F.col("__fv"), "left", small)
    return j.withColumn(out_col, F.coalesce(F.col("__fc"), F.lit(-1)).cast("long")).drop("__fv", "__fc")


# --- frequency encoding ----------------------------------------------------------------
def fit_freq(df: DataFrame, cols: Sequence[str], missing: str = "exclude",
             where: str | Column | None = None) -> DataFrame:
    """Relative frequency per value.

    missing="exclude": NULLs out of the denominator and encoded 0 (F8 after a
    constant fill, F9); "category": NULL is a value, denominator = all rows (F10).
    """
    src = df if where is None else df.where(where)
    long = long_text(src, _present(src, cols))
    if missing == "exclude":
        long = long.where(F.col(VAL).isNotNull())
    cnt = long.groupBy(COL, VAL).agg(F.count(F.lit(1)).alias("_c"))
    tot = long.groupBy(COL).agg(F.count(F.lit(1)).alias("_t"))
    return fitted(cnt.join(F.broadcast(tot), COL).select(  # one row per column
        COL, VAL, (F.col("_c") / F.col("_t")).alias("freq")))


def fit_freq_pooled(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    pooled = None
    for f in frames:
        part = f.select(*_present(f, cols))
        pooled = part if pooled is None else pooled.unionByName(part)
    return fit_freq(pooled, cols, missing="category")


def apply_freq(df: DataFrame, stats: DataFrame, cols: Sequence[str], suffix: str = "_freq",
               nullsafe: bool = False, drop_original: bool = False) -> DataFrame:
    """Unseen (and missing unless ``nullsafe``) -> 0 (C11).  ``drop_original`` is F11."""
    out = df
    cols = _present(df, cols)
    stats, small = materialize(stats)
    for c in cols:
        out = _lookup_col(out, stats, c, "freq", nullsafe=nullsafe, small=small)
        out = out.withColumn(c + suffix, F.coalesce(F.col(f"__o_{c}"), F.lit(0.0))).drop(f"__o_{c}")
    return out.drop(*cols) if drop_original else out


# --- one-hot (Spark ML) -----------------------------------------------------------------
def onehot_model(train: DataFrame, cols: Sequence[str]):
    """StringIndexer(alphabetAsc, keep) + OneHotEncoder(dropLast): the dropped slot is the
    unknown one, so unseen and missing values encode as all zeros (F12)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = [f"{c}__idx" for c in cols]
    stages = [StringIndexer(inputCols=list(cols), outputCols=idx, stringOrderType="alphabetAsc",
                            handleInvalid="keep"),
              OneHotEncoder(inputCols=idx, outputCols=[f"{c}_ohe" for c in cols], dropLast=True,
                            handleInvalid="error")]
    return Pipeline(stages=stages).fit(train)


# --- target encoding -----------------------------------------------------------------------
def global_mean(df: DataFrame, y: str) -> DataFrame:
    return df.agg(F.avg(F.col(y).cast("double")).alias("_g"))


def fit_target_smooth(df: DataFrame, cols: Sequence[str], y: str, smoothing: float = 10.0,
                      where: str | Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(n*mean + s*global) / (n + s) per value (F13, J1).  Returns (stats, global)."""
    src = df if where is None else df.where(where)
    g = global_mean(src, y)
    per = long_text(src, _present(src, cols), keep=[y]).where(F.col(VAL).isNotNull()) \
        .groupBy(COL, VAL).agg(F.sum(F.col(y).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    m = F.lit(float(smoothing))
    stats = per.crossJoin(F.broadcast(g)).select(
        COL, VAL, ((F.col("_s") + m * F.col("_g")) / (F.col("_n") + m)).alias("te"))
    return fitted(stats), fitted(g)


def apply_target(df: DataFrame, stats: DataFrame, glob: DataFrame, cols: Sequence[str],
                 suffix: str = "_te", fold_col: str | None = None) -> DataFrame:
    """Lookup; unseen or missing -> global mean (C11)."""
    out = df.crossJoin(F.broadcast(glob))  # one row
    keys = [fold_col] if fold_col else []
    stats, small = materialize(stats)
    for c in _present(df, cols):
        out = _lookup_col(out, stats, c, "te", keys=keys, small=small)
        out = out.withColumn(c + suffix, F.coalesce(F.col(f"__o_{c}"), F.col("_g"))).drop(f"__o_{c}")
    return out.drop("_g")


def fit_target_kfold(df: DataFrame, cols: Sequence[str], y: str, fold_col: str = "fold", k: int = 5,
                     smoothing: float = 10.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Out-of-fold target statistics in one aggregate.

    A row in fold f is encoded from the rows of the other folds:
    complement = per-value totals - per-(value, fold) totals.  The global mean
    uses all rows.  Returns (fold stats, test stats, global):
      fold stats  (fold, column, value, te) - apply to training rows by their fold
      test stats  (column, value, te)       - mean of the k fold encodings
    """
    spark = df.sparkSession
    g = fitted(global_mean(df, y))
    per = long_text(df, _present(df, cols), keep=[fold_col, y]).where(F.col(VAL).isNotNull()) \
        .groupBy(COL, VAL, fold_col).agg(F.sum(F.col(y).cast("double")).alias("_fs"),
                                         F.count(F.lit(1)).alias("_fn"))
    tot = per.groupBy(COL, VAL).agg(F.sum("_fs").alias("_ts"), F.sum("_fn").alias("_tn"))
    folds = spark.range(k).select(F.col("id").cast("int").alias(fold_col))
    grid = tot.crossJoin(F.broadcast(folds)).join(per, [COL, VAL, fold_col], "left") \
        .crossJoin(F.broadcast(g))
    n_o = F.col("_tn") - F.coalesce(F.col("_fn"), F.lit(0))
    s_o = F.col("_ts") - F.coalesce(F.col("_fs"), F.lit(0.0))
    m = F.lit(float(smoothing))
    te = F.when(n_o > 0, (s_o + m * F.col("_g")) / (n_o + m)).otherwise(F.col("_g"))
    fold_stats = fitted(grid.select(fold_col, COL, VAL, te.alias("te")))
    test_stats = fold_stats.groupBy(COL, VAL).agg(F.avg("te").alias("te"))  # over the cached fold stats
    return fold_stats, test_stats, g


# --- ordered target statistics (M9) --------------------------------------------------------------
def fit_ordered_target(df: DataFrame, cols: Sequence[str], y: str, key: str, prior_rows: float = 1.0,
                       seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Target statistics of raw categoricals that never use a row's own label.

    Rows are ordered by a hash of their key; a row's value for a column is
    ``(s + a * g) / (n + a)`` over the *earlier* rows of its category: ``s`` labels of 1,
    ``n`` rows, ``g`` the mean label of ``df``, ``a`` = ``prior_rows``.  All columns go
    through one pass: unpivot, prefix sums over (column, value) groups - range partitioned,
    so a category that holds most rows spans many tasks -, and one aggregate back to the key.

    Returns (row values: key and one column ``<c>_ots`` for each c; totals (column, value,
    ots) for rows that were not in ``df``, see :func:`apply_ordered_target`).  ``y`` is 0
    or 1; a row with a NULL label gets a value and adds nothing.  A missing value is a
    category of its own.  Keys must be distinct and not NULL.
    """
    cols = _present(df, cols)
    g = fitted(global_mean(df, y))
    long = long_text(df.withColumn("_h", hash_key(key, seed)), cols, keep=[key, y, "_h"])
    ones = F.coalesce(F.col(y).cast("long"), F.lit(0).cast("long"))
    long = long.select(key, "_h", COL, VAL, ones.alias("_s"), F.when(F.col(y).isNull(), 0).otherwise(1).cast("long").alias("_n1"))
    sums = prefix_sums(long, ["_h", key], {"_s": ("_bs", "_ts"), "_n1": ("_bn", "_tn")}, [COL, VAL])
    a = F.lit(float(prior_rows))
    value = (F.col("_bs") + a * F.col("_g")) / (F.col("_bn") + a)
    rows = sums.crossJoin(F.broadcast(g)).withColumn("_v", value)  # one row
    rows = rows.groupBy(key).pivot(COL, cols).agg(F.first("_v")).select(key, *[F.col(c).alias(f"{c}_ots") for c in cols])
    totals = long.groupBy(COL, VAL).agg(F.sum("_s").alias("_ts"), F.sum("_n1").alias("_tn")).crossJoin(F.broadcast(g))
    totals = totals.select(COL, VAL, ((F.col("_ts") + a * F.col("_g")) / (F.col("_tn") + a)).alias("ots"), "_g")
    return rows, fitted(totals)


def apply_ordered_target(df: DataFrame, totals: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``<c>_ots`` from the totals of all fitted rows; a value that was not there gets the mean label."""
    totals, small = materialize(totals)
    mean = totals.agg(F.max("_g").alias("_g"))  # one row
    out = df.crossJoin(F.broadcast(mean))
    for c in _present(df, cols):
        out = _lookup_col(out, totals, c, "ots", nullsafe=True, small=small)
        out = out.withColumn(f"{c}_ots", F.coalesce(F.col(f"__o_{c}"), F.col("_g"))).drop(f"__o_{c}")
    return out.drop("_g")
