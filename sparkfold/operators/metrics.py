"""Classification metrics as aggregates.

Binary labels are 0/1 with 1 the positive class.  Every metric is a
conditional sum in one aggregate, grouped by whatever identifies a run
(fold, model, config, threshold).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.operators.lookup import fitted, materialize


def _sum_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def counts(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = (),
           rollup: bool = False) -> DataFrame:
    yy, pp = F.col(y), F.col(yhat)
    aggs = [_sum_if((yy == 1) & (pp == 1)).alias("tp"), _sum_if((yy == 0) & (pp == 1)).alias("fp"),
            _sum_if((yy == 1) & (pp == 0)).alias("fn"), _sum_if((yy == 0) & (pp == 0)).alias("tn"),
            F.count(F.lit(1)).alias("n")]
    g = df.rollup(*group_cols) if rollup else df.groupBy(*group_cols)
    return g.agg(*aggs)


def f1_from(tp: Column, fp: Column, fn: Column) -> Column:
    """2tp / (2tp + fp + fn); 0 when undefined (no positive predicted or true)."""
    den = F.lit(2) * tp + fp + fn
    return F.when(den == 0, F.lit(0.0)).otherwise((F.lit(2.0) * tp) / den)


def with_scores(c: DataFrame) -> DataFrame:
    return c.withColumns({
        "accuracy": (F.col("tp") + F.col("tn")) / F.col("n"),
        "f1": f1_from(F.col("tp"), F.col("fp"), F.col("fn")),
    })


def binary_metrics(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = (),
                   rollup: bool = False) -> DataFrame:
    """Accuracy and F1 (J9, J10) per group; ``rollup`` adds the overall row."""
    return with_scores(counts(df, y, yhat, group_cols, rollup))


def confusion(df: DataFrame, y: str, yhat: str, classes: DataFrame, class_col: str = "class") -> DataFrame:
    """Counts on the full (true, predicted) class grid, zeros included."""
    t = classes.select(F.col(class_col).alias("true"))
    p = classes.select(F.col(class_col).alias("pred"))
    cells = df.groupBy(F.col(y).alias("true"), F.col(yhat).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    small, few = materialize(t.crossJoin(p))  # classes x classes
    grid = F.broadcast(small) if few else small
    return grid.join(cells, ["true", "pred"], "left").select(
        "true", "pred", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def class_report(df: DataFrame, y: str, yhat: str, classes: DataFrame, class_col: str = "class") -> DataFrame:
    """Per-class precision / recall / F1 / support plus accuracy, macro and weighted rows."""
    # one pass: counts per (true, pred) cell, then per class sums over the tiny grid
    cells = confusion(df, y, yhat, classes, class_col)
    tp = cells.where(F.col("true") == F.col("pred")).select(F.col("true").alias("label"), F.col("n").alias("tp"))
    sup = cells.groupBy(F.col("true").alias("label")).agg(F.sum("n").alias("support"))
    prd = cells.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    per = tp.join(sup, "label").join(prd, "label")
    prec = F.when(F.col("predicted") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("predicted"))
    rec = F.when(F.col("support") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("support"))
    f1 = f1_from(F.col("tp"), F.col("predicted") - F.col("tp"), F.col("support") - F.col("tp"))
    per = per.select(F.col("label").cast("string").alias("label"), prec.alias("precision"),
                     rec.alias("recall"), f1.alias("f1"), F.col("support").cast("long").alias("support"),
                     F.col("tp"))
    total = per.agg(F.sum("support").alias("N"), F.sum("tp").alias("TP"))
    acc = total.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"), (F.col("TP") / F.col("N")).alias("f1"),
                       F.col("N").cast("long").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("long").alias("support"))
    w = F.col("support")
    weighted = per.agg(F.lit("weighted avg").alias("label"),
                       (F.sum(F.col("precision") * w) / F.sum(w)).alias("precision"),
                       (F.sum(F.col("recall") * w) / F.sum(w)).alias("recall"),
                       (F.sum(F.col("f1") * w) / F.sum(w)).alias("f1"),
                       F.sum(w).cast("long").alias("support"))
    return per.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Absolute and normalised counts; ``dropna=False`` keeps NULL as a value."""
    src = df if not dropna else df.where(F.col(col).isNotNull())
    c = fitted(src.groupBy(col).agg(F.count(F.lit(1)).alias("count")))
    tot = c.agg(F.sum("count").alias("_t"))  # of the counts: the rows are read once
    return c.crossJoin(F.broadcast(tot)).select(col, "count", (F.col("count") / F.col("_t")).alias("share"))


def class_weights(df: DataFrame, y: str, n_classes: int = 2) -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    c = fitted(df.groupBy(y).agg(F.count(F.lit(1)).alias("n_c")))
    tot = c.agg(F.sum("n_c").alias("_n"))
    return c.crossJoin(F.broadcast(tot)).select(
        y, "n_c", (F.col("_n") / (F.lit(float(n_classes)) * F.col("n_c"))).alias("weight"))


def add_class_weight(df: DataFrame, y: str, out_col: str = "weight", n_classes: int = 2) -> DataFrame:
    """Per-row weight column for ``weightCol`` (J8); one row per class, broadcast."""
    w = class_weights(df, y, n_classes).select(y, F.col("weight").alias(out_col))
    return df.join(F.broadcast(w), y, "left")


def scale_pos_weight(df: DataFrame, y: str) -> DataFrame:
    """neg / max(pos, 1)."""
    pos = F.sum(F.when(F.col(y) == 1, 1).otherwise(0))
    neg = F.sum(F.when(F.col(y) == 0, 1).otherwise(0))
    return df.agg(pos.cast("long").alias("pos"), neg.cast("long").alias("neg"),
                  (neg / F.greatest(pos, F.lit(1))).alias("scale_pos_weight"))


def mutual_info(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Mutual information (nats) of each discrete column with the target, from one
    contingency aggregate (missing is its own value)."""
    from sparkfold.operators.encode import long_text
    # missing is a value: a sentinel keeps it through the equi-joins below
    long = long_text(df, cols, keep=[y]).withColumn("value", F.coalesce(F.col("value"), F.lit("\u0000")))
    joint = long.groupBy("column", "value", y).agg(F.count(F.lit(1)).alias("nxy"))
    nx = joint.groupBy("column", "value").agg(F.sum("nxy").alias("nx"))
    ny = joint.groupBy("column", y).agg(F.sum("nxy").alias("ny"))
    n = joint.groupBy("column").agg(F.sum("nxy").alias("n"))
    j = joint.join(nx, ["column", "value"]).join(ny, ["column", y]).join(n, "column")
    term = (F.col("nxy") / F.col("n")) * F.log((F.col("nxy") * F.col("n")) / (F.col("nx") * F.col("ny")))
    return j.groupBy("column").agg(F.sum(term).alias("mutual_info"))


def top_mutual_info(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], y: str, k: int = 75, bins: int = 5) -> DataFrame:
    """(column, mutual_info, rank) of the k features that tell most about the target, ties by name.

    Numerics go in as exact quantile bins (:mod:`binning`; a missing value is a bin of its
    own, a column with one value is one bin), and one contingency aggregate serves all
    columns.  The frame is read twice: for the bin edges and for the counts.
    """
    from pyspark.sql import Window
    from sparkfold.operators import binning
    edges = binning.fit_quantile_bins(df, num_cols, q=bins)
    binned = binning.apply_quantile_bins(df.select(*num_cols, *cat_cols, y), edges, num_cols, q=bins, suffix="__mi").drop(*num_cols)
    binned = binned.withColumnsRenamed({f"{c}__mi": c for c in num_cols})
    found = mutual_info(binned, [*num_cols, *cat_cols], y)
    order = Window.orderBy(F.col("mutual_info").desc(), "column")  # one row a feature
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
