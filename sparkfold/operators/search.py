"""Threshold, weight and model searches.

The reference scores every threshold with a full pass over the rows (81
passes; 124 x 81 for the weight grid).  Here each row is mapped once to the
*number of thresholds at or below its score*; a histogram of that index per
class (at most ``count + 1`` cells per group) and a running sum over it give
tp / fp / fn / tn for every threshold at once.  The data is read once and the
only shuffle carries the partially aggregated histogram.

Ties: thresholds are scanned in ascending order and a later one must be
strictly better, so the *first* maximum wins - ``min(struct(-f1, i))``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.operators.lookup import fitted
from sparkfold.operators.metrics import f1_from

ThresholdFn = Callable[[Column], Column]


def fixed_grid(start: int, count: int, denom: float) -> tuple[ThresholdFn, Callable[[Column], Column], int]:
    """Thresholds (start + i) / denom for i in [0, count) - e.g. 0.10..0.90 by 0.01 = (10, 81, 100)."""
    def t(i: Column) -> Column:
        return (F.lit(start) + i).cast("double") / F.lit(float(denom))

    def guess(p: Column) -> Column:
        return F.floor(p * F.lit(float(denom))) - F.lit(start) + F.lit(1)
    return t, guess, count


def linspace_grid(lo: Column, hi: Column, num: int) -> tuple[ThresholdFn, Callable[[Column], Column], int]:
    """``num`` evenly spaced thresholds from lo to hi inclusive (numpy linspace)."""
    step = (hi - lo) / F.lit(float(num - 1))

    def t(i: Column) -> Column:
        return F.when(i == F.lit(num - 1), hi).otherwise(i.cast("double") * step + lo)

    def guess(p: Column) -> Column:
        return F.when(step > 0, F.floor((p - lo) / step) + F.lit(1)).otherwise(
            F.when(p >= lo, F.lit(num)).otherwise(F.lit(0)))
    return t, guess, num


def count_at_or_below(p: Column, grid) -> Column:
    """Exact number of grid thresholds t_i with t_i <= p (NULL p -> 0)."""
    t, guess, count = grid

    def clamp(c: Column) -> Column:
        return F.least(F.greatest(c, F.lit(0)), F.lit(count))

    c = clamp(guess(p).cast("long"))
    for _ in range(2):  # the float guess is off by at most one step
        up = F.when((c < count) & (t(c) <= p), F.lit(1)).otherwise(F.lit(0))
        down = F.when((c > 0) & (t(c - 1) > p), F.lit(1)).otherwise(F.lit(0))
        c = clamp(c + up - down)
    return F.coalesce(c, F.lit(0)).cast("int")


def threshold_curve(df: DataFrame, y: str, p: str, grid, group_cols: Sequence[str] = (),
                    grid_cols: Sequence[str] = ()) -> DataFrame:
    """tp/fp/fn/tn, F1 and accuracy at every threshold, per group.

    ``grid_cols`` are per-group columns the grid expressions use (e.g. the
    min / max of a data-driven grid); they must be constant within a group.
    """
    t, _, count = grid
    g = list(group_cols)
    keyed = df.select(*g, *grid_cols, F.col(y).cast("int").alias("_y"),
                      count_at_or_below(F.col(p), grid).alias("_j"))
    hist = keyed.groupBy(*g, *grid_cols, "_j").agg(
        F.sum(F.col("_y")).alias("_pos"), F.sum(F.lit(1) - F.col("_y")).alias("_neg"))
    # the histogram is the only pass over the rows; materialise it (<= groups x (count + 1)
    # cells) so the group list below is read from it, not re-derived from the source
    hist = fitted(hist)
    groups = hist.select(*g, *grid_cols).distinct()
    dense = groups.select(*g, *grid_cols, F.explode(F.sequence(F.lit(0), F.lit(count))).alias("_j"))
    dense = dense.join(hist, [*g, *grid_cols, "_j"], "left").fillna(0, ["_pos", "_neg"])
    w = Window.partitionBy(*g).orderBy("_j") if g else Window.orderBy("_j")
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy(*g) if g else Window.partitionBy()
    c = dense.select(*g, *grid_cols, "_j",
                     F.sum("_pos").over(cum).alias("_cp"), F.sum("_neg").over(cum).alias("_cn"),
                     F.sum("_pos").over(wall).alias("_P"), F.sum("_neg").over(wall).alias("_N"))
    c = c.where(F.col("_j") < count)  # row j describes threshold i = j
    tp, fp = F.col("_P") - F.col("_cp"), F.col("_N") - F.col("_cn")
    fn, tn = F.col("_cp"), F.col("_cn")
    return c.select(*g, F.col("_j").alias("i"), t(F.col("_j")).alias("threshold"),
                    tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
                    fn.cast("long").alias("fn"), tn.cast("long").alias("tn"),
                    f1_from(tp, fp, fn).alias("f1"),
                    ((tp + tn) / (F.col("_P") + F.col("_N"))).alias("accuracy"))


def first_best(df: DataFrame, score: str, order: str, group_cols: Sequence[str] = (),
               keep: Sequence[str] = ()) -> DataFrame:
    """Row with the highest ``score``; ties go to the smallest ``order`` (K6, K7)."""
    best = F.min(F.struct((-F.col(score)).alias("_k"), F.col(order).alias("_o"),
                          *[F.col(k).alias(k) for k in keep]))
    r = df.groupBy(*group_cols).agg(best.alias("_b"))
    return r.select(*group_cols, (-F.col("_b._k")).alias(score), F.col("_b._o").alias(order),
                    *[F.col(f"_b.{k}").alias(k) for k in keep])


def best_threshold(df: DataFrame, y: str, p: str, grid=None, group_cols: Sequence[str] = ()) -> DataFrame:
    """``best_threshold(y, p, .1, .9, .01)`` (K8): (group..., threshold, f1)."""
    grid = grid or fixed_grid(10, 81, 100)
    curve = threshold_curve(df, y, p, grid, group_cols)
    b = first_best(curve, "f1", "i", group_cols, keep=["threshold"])
    return b.select(*group_cols, "threshold", "f1")


def f1_at(df: DataFrame, y: str, p: str, thresholds: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """F1 and accuracy at a few fixed thresholds, one aggregate (K11).  A NULL score is predicted 0,
    as in :func:`threshold_curve`."""
    aggs = []
    yy, pp = F.col(y), F.col(p)
    for k, t in enumerate(thresholds):
        pred = F.coalesce(pp >= F.lit(float(t)), F.lit(False))
        aggs += [F.sum(F.when(pred & (yy == 1), 1).otherwise(0)).alias(f"tp{k}"),
                 F.sum(F.when(pred & (yy == 0), 1).otherwise(0)).alias(f"fp{k}"),
                 F.sum(F.when(~pred & (yy == 1), 1).otherwise(0)).alias(f"fn{k}"),
                 F.sum(F.when(~pred & (yy == 0), 1).otherwise(0)).alias(f"tn{k}")]
    a = df.groupBy(*group_cols).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"),
                              f1_from(F.col(f"tp{k}"), F.col(f"fp{k}"), F.col(f"fn{k}")).alias("f1"),
                              ((F.col(f"tp{k}") + F.col(f"tn{k}")) /
                               (F.col(f"tp{k}") + F.col(f"tn{k}") + F.col(f"fp{k}") + F.col(f"fn{k}")))
                              .alias("accuracy")) for k, t in enumerate(thresholds)])
    return a.select(*group_cols, F.inline(rows))


def best_threshold_incumbent(df: DataFrame, y: str, p: str, start: int = 30, count: int = 41,
                             denom: float = 100.0, incumbent: float = 0.5) -> DataFrame:
    """Grid 0.30..0.70; a threshold replaces 0.5 only if strictly better (K9)."""
    curve = threshold_curve(df, y, p, fixed_grid(start, count, denom))
    b = first_best(curve, "f1", "i", keep=["threshold"])
    base = f1_at(df, y, p, [incumbent]).select(F.col("f1").alias("_f05"))
    j = b.crossJoin(F.broadcast(base))  # one row each
    better = F.col("f1") > F.col("_f05")
    return j.select(F.when(better, F.col("threshold")).otherwise(F.lit(float(incumbent))).alias("threshold"),
                    F.when(better, F.col("f1")).otherwise(F.col("_f05")).alias("f1"),
                    F.col("_f05").alias("f1_at_default"))


def best_threshold_margin(df: DataFrame, y: str, score: str, num: int = 300) -> DataFrame:
    """Score-space search over ``num`` points from min to max of the scores."""
    rng = df.agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    j = df.crossJoin(F.broadcast(rng))  # one row
    curve = threshold_curve(j, y, score, linspace_grid(F.col("_lo"), F.col("_hi"), num),
                            grid_cols=["_lo", "_hi"])
    return first_best(curve, "f1", "i", keep=["threshold"]).select("threshold", "f1")


# --- weight grid (K13) ------------------------------------------------------------
def weight_tuples(n_models: int, levels: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)):
    """All weight tuples in product order, all-zero skipped, normalised to sum 1."""
    out = []
    seen: set[tuple[float, ...]] = set()
    for seq, ws in enumerate(product(levels, repeat=n_models)):
        s = sum(ws)
        if s == 0:
            continue
        normal = [w / s for w in ws]
        key = tuple(round(w, 12) for w in normal)
        if key not in seen:  # (1, 1, 1) and (0.5, 0.5, 0.5) are one setting: the first stands for all
            seen.add(key)
            out.append((seq, normal))
    return out


def weight_grid_search(df: DataFrame, y: str, prob_cols: Sequence[str],
                       levels: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), grid=None) -> DataFrame:
    """Best (weights, threshold, F1) over the normalised weight grid.

    Each row is expanded by the literal grid (a generator, at most 124
    entries for 3 models) and immediately reduced to the threshold histogram, so the shuffle
    carries at most 124 x 82 cells per partition.
    """
    grid = grid or fixed_grid(10, 81, 100)
    tuples = weight_tuples(len(prob_cols), levels)
    arr = F.array(*[F.struct(F.lit(seq).alias("seq"),
                             *[F.lit(float(w)).alias(f"w{k}") for k, w in enumerate(ws)])
                    for seq, ws in tuples])
    ex = df.select(y, *prob_cols, F.explode(arr).alias("_g"))
    p = None
    for k, c in enumerate(prob_cols):
        term = F.col(f"_g.w{k}") * F.col(c)
        p = term if p is None else p + term
    ex = ex.select(F.col(y), F.col("_g.seq").alias("seq"),
                   *[F.col(f"_g.w{k}").alias(f"w{k}") for k in range(len(prob_cols))], p.alias("_p"))
    wcols = [f"w{k}" for k in range(len(prob_cols))]
    curve = threshold_curve(ex, y, "_p", grid, group_cols=["seq"], grid_cols=wcols)
    per = first_best(curve, "f1", "i", ["seq"], keep=["threshold"])
    best = first_best(per, "f1", "seq", keep=["threshold"])
    wt = ex.sparkSession.createDataFrame([(s, *ws) for s, ws in tuples], ["seq", *wcols])
    return best.join(F.broadcast(wt), "seq")  # <= 124 rows


def fit_ensemble(preds: DataFrame, y: str, key: str = "id", model: str = "model", proba: str = "proba",
                 k: int = 3, grid=None) -> DataFrame:
    """Choose the k best models and search their weights (K4 -> K13): (rank, model, weight, threshold, f1).

    ``preds``: long rows (key, model, proba, y).  Models are ranked by their tuned F1, ties
    by name; which they are is known only at run time, so the rows are turned by rank, not
    by name.  Fewer than k models give as many rows.  A (key, model) that comes twice is an
    error; a missing or NULL probability counts as not predicted in a blend that uses it.
    """
    per = best_threshold(preds, y, proba, grid, group_cols=[model])
    top = [r[model] for r in per.orderBy(F.col("f1").desc(), F.col(model)).limit(k).collect()]  # k names
    cols = [f"_p{r}" for r in range(len(top))]
    seen = F.count(F.when(F.col(model) == F.lit(top[0]), 1)) if top else F.lit(0)
    for name in top[1:]:
        seen = F.greatest(seen, F.count(F.when(F.col(model) == F.lit(name), 1)))
    wide = preds.where(F.col(model).isin(top)).groupBy(key, y).agg(
        *[F.max(F.when(F.col(model) == F.lit(name), F.col(proba))).alias(c) for name, c in zip(top, cols)], seen.alias("_seen"))
    first = F.when(F.col("_seen") > 1, F.raise_error(F.lit(f"a ({key}, {model}) comes more than once")).cast("double")).otherwise(F.col(cols[0]))
    best = weight_grid_search(wide.withColumn(cols[0], first), y, cols, grid=grid)
    rows = F.array(*[F.struct(F.lit(r + 1).alias("rank"), F.lit(name).alias(model), F.col(f"w{r}").alias("weight")) for r, name in enumerate(top)])
    return best.select(F.inline(rows), "threshold", "f1")


def topk(df: DataFrame, score: str, order: str, k: int) -> DataFrame:
    """Top-k rows by score, ties in ``order`` (K4).  ``df`` is a bounded run table."""
    return df.orderBy(F.col(score).desc(), F.col(order).asc()).limit(k)


def choose_strategy(single: DataFrame, ensemble: DataFrame) -> DataFrame:
    """Ensemble only if its F1 is strictly higher than the best single model.

    ``single``: (model, seq, f1, threshold); ``ensemble``: one row (f1, threshold).
    """
    best = first_best(single, "f1", "seq", keep=["model", "threshold"])
    e = ensemble.select(F.col("f1").alias("_ef1"), F.col("threshold").alias("_et"))
    j = best.crossJoin(F.broadcast(e))  # one row each
    use = F.col("_ef1") > F.col("f1")
    return j.select(F.when(use, F.lit("ensemble")).otherwise(F.col("model")).alias("strategy"),
                    F.when(use, F.col("_ef1")).otherwise(F.col("f1")).alias("f1"),
                    F.when(use, F.col("_et")).otherwise(F.col("threshold")).alias("threshold"))
