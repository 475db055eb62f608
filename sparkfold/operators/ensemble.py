"""Blends, soup, prediction alignment and OOF assembly.

Predictions live in a long table ``(id, model, fold, proba)`` (binary) or
``(id, source, class, proba)`` (class probabilities), never in positional
arrays, so every blend is a keyed aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.operators.lookup import join_stats, materialize


def fold_mean(preds: DataFrame, keys: Sequence[str] = ("id", "model"), value: str = "proba",
              out: str = "proba") -> DataFrame:
    """Mean over folds (or seeds / variants) per key."""
    return preds.groupBy(*keys).agg(F.avg(value).alias(out))


def blend_columns(df: DataFrame, weights: Mapping[str, float], out: str = "proba",
                  normalize: bool = True) -> DataFrame:
    """sum(w * p) over columns, divided by sum(w) when ``normalize``."""
    total = sum(weights.values())
    expr = None
    for c, w in weights.items():
        term = F.lit(float(w)) * F.col(c)
        expr = term if expr is None else expr + term
    if normalize:
        expr = expr / F.lit(float(total))
    return df.withColumn(out, expr)


def check_sources(preds: DataFrame, weights: DataFrame, source_col: str) -> None:
    """Every source has exactly one weight and every weight a source; models and files are few, so both
    lists are compared on the driver (N8)."""
    have = {r[0] for r in preds.select(source_col).distinct().collect()}
    named = [r[0] for r in weights.select(source_col).collect()]
    if len(named) != len(set(named)):
        raise ValueError(f"a {source_col} has several weights")
    if have != set(named):
        raise ValueError(f"{source_col}s without a weight: {sorted(map(str, have - set(named)))}; "
                         f"weights without predictions: {sorted(map(str, set(named) - have))}")


def once(value: Column, rows: Column, what: str) -> Column:
    """``value``, but an error where ``rows`` says that a key came more than once."""
    return F.when(rows > 1, F.raise_error(F.lit(f"{what} comes more than once")).cast("double")).otherwise(value)


def blend_long(preds: DataFrame, weights: DataFrame, key: str = "id", model_col: str = "model",
               value: str = "proba", out: str = "proba") -> DataFrame:
    """sum(w * p) per key with a (model, weight) table (N4, N10).  Models are few: broadcast.

    A model without a weight, a weight without a model or a repeated (key, model) is an error.
    """
    check_sources(preds, weights, model_col)
    j = preds.join(F.broadcast(weights), model_col)
    rows = F.count(F.lit(1)) - F.size(F.collect_set(model_col)) + 1
    return j.groupBy(key).agg(once(F.sum(F.col("weight") * F.col(value)), rows, f"a ({key}, {model_col})").alias(out))


def apply_ensemble(preds: DataFrame, fitted: DataFrame, key: str = "id", model: str = "model", proba: str = "proba") -> DataFrame:
    """Blend new predictions with a searched ensemble (N10): (key, proba, threshold, is_positive).

    ``fitted``: (model, weight, threshold) rows of the chosen models, as
    ``search.fit_ensemble`` gives them; predictions of other models are not used.  An id
    that lacks a chosen model's probability, or has it twice, is an error.
    """
    few = F.broadcast(fitted.select(model, "weight", "threshold"))  # the k chosen models
    j = preds.join(few, model)
    wanted = F.broadcast(fitted.agg(F.count(F.lit(1)).alias("_k")))
    out = j.groupBy(key).agg(F.sum(F.col("weight") * F.col(proba)).alias(proba), F.first("threshold").alias("threshold"),
                             F.count(proba).alias("_rows"), F.count_distinct(model).alias("_models")).crossJoin(wanted)
    whole = (F.col("_rows") == F.col("_k")) & (F.col("_models") == F.col("_k"))
    value = F.when(whole, F.col(proba)).otherwise(F.raise_error(F.lit(f"a {key} without exactly one probability of each chosen model")).cast("double"))
    out = out.withColumn(proba, value)
    return out.select(key, proba, "threshold", (F.col(proba) >= F.col("threshold")).cast("int").alias("is_positive"))


def soup(preds: DataFrame, weights: DataFrame, classes: DataFrame, key: str = "id",
         source_col: str = "source", class_col: str = "class", value: str = "proba",
         eps: float = 1e-12) -> DataFrame:
    """Weighted class-probability soup.

    sum_s w_s * P_s per (id, class); the label is the first class (in sort
    order) with the highest sum, and its probability is that sum over the row
    sum + eps.  Every source needs exactly one weight, an id and class one row per
    source, and every row a class of the list; anything else is an error, so no id is lost.  Dividing by the row sum does not change the argmax, so one
    aggregate on id yields both: two shuffles ((id, class), then id), no join.
    """
    check_sources(preds, weights, source_col)
    # class order: a window over the class list only (k rows)
    cls = classes.select(F.col(class_col), F.dense_rank().over(Window.orderBy(class_col)).alias("_ci"))
    small, few = materialize(cls)
    j = join_stats(preds.join(F.broadcast(weights), source_col), small, class_col, "left", few)
    unlisted = F.concat(F.lit("a class that is not listed: "), F.coalesce(F.col(class_col).cast("string"), F.lit("NULL")))
    j = j.withColumn("_ci", F.when(F.col("_ci").isNull(), F.raise_error(unlisted).cast("int")).otherwise(F.col("_ci")))
    rows = F.count(F.lit(1)) - F.size(F.collect_set(source_col)) + 1
    s = j.groupBy(key, class_col, "_ci").agg(once(F.sum(F.col("weight") * F.col(value)), rows, f"a ({key}, {class_col}, {source_col})").alias("_s"))
    best = F.min(F.struct((-F.col("_s")).alias("k"), F.col("_ci").alias("ci"), F.col(class_col).alias("c"),
                          F.col("_s").alias("s")))
    r = s.groupBy(key).agg(best.alias("_b"), F.sum("_s").alias("_t"))
    return r.select(key, F.col("_b.c").alias("label"), (F.col("_b.s") / (F.col("_t") + F.lit(eps))).alias("proba"))


def argmax_class(preds: DataFrame, key: str = "id", class_col: str = "class", value: str = "proba") -> DataFrame:
    """Per-row argmax, ties to the first class in sort order."""
    best = F.min(F.struct((-F.col(value)).alias("k"), F.col(class_col).alias("c")))
    return preds.groupBy(key).agg(best.alias("_b")).select(key, F.col("_b.c").alias(class_col))


def classes_array(classes: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in classes])


def align_to_ids(ids: DataFrame, preds: DataFrame, classes: Sequence[str], key: str = "id",
                 class_col: str = "class", value: str = "proba") -> DataFrame:
    """Reindex class probabilities onto the target ids; missing rows -> 1/k (I2).  A repeated id or a
    repeated (id, class) is an error."""
    k = len(classes)
    wanted = ids.groupBy(key).agg(F.count(F.lit(1)).alias("_ids"))
    grid = wanted.select(key, "_ids", F.explode(classes_array(classes)).alias(class_col))
    single = preds.groupBy(key, class_col).agg(F.max(value).alias(value), F.count(F.lit(1)).alias("_rows"))
    j = grid.join(single, [key, class_col], "left")
    rows = F.greatest(F.coalesce("_rows", F.lit(1)), F.col("_ids"))
    return j.select(key, class_col, once(F.coalesce(F.col(value), F.lit(1.0 / k)), rows, f"a {key}").alias(value))


def label_to_onehot(labels: DataFrame, classes: Sequence[str], key: str = "id", label_col: str = "label",
                    class_col: str = "class", value: str = "proba") -> DataFrame:
    """Label file -> probability rows: 1 for the label's class, uniform 1/k for unknown labels."""
    k = len(classes)
    known = F.col(label_col).isin(*classes)
    ex = labels.select(key, label_col, F.explode(classes_array(classes)).alias(class_col))
    p = F.when(~F.coalesce(known, F.lit(False)), F.lit(1.0 / k)) \
        .when(F.col(label_col) == F.col(class_col), F.lit(1.0)).otherwise(F.lit(0.0))
    return ex.select(key, class_col, p.alias(value))


def wide_to_long(df: DataFrame, classes: Sequence[str], key: str = "id", class_col: str = "class",
                 value: str = "proba") -> DataFrame:
    """Probability columns named by class -> (id, class, proba)."""
    return df.select(key, *[F.col(c).cast("double").alias(c) for c in classes]).unpivot(
        [key], list(classes), class_col, value)


def assemble_oof(fold_preds: Sequence[DataFrame]) -> DataFrame:
    """Union of each fold model's predictions on its held-out rows."""
    out = fold_preds[0]
    for p in fold_preds[1:]:
        out = out.unionByName(p)
    return out


def oof_check(oof: DataFrame, key: str = "id", expected: DataFrame | None = None) -> DataFrame:
    """One row: rows, distinct ids, duplicated ids; each id must be predicted exactly once.

    With ``expected`` (a frame that holds the ids to predict, each once or more), also
    ``missing`` (expected, not predicted) and ``unexpected`` (predicted, not expected).
    NULL ids count as one id.
    """
    per = oof.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    aggs = [F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("rows"), F.sum((F.col("_c") > 0).cast("long")).alias("ids"),
            F.sum((F.col("_c") > 1).cast("long")).alias("duplicated")]
    if expected is not None:
        wanted = expected.select(F.col(key).alias("_want")).distinct().withColumn("_expected", F.lit(1))
        per = per.join(wanted, F.col(key).eqNullSafe(F.col("_want")), "full").fillna(0, ["_c", "_expected"])
        aggs += [F.sum((F.col("_c") == 0).cast("long")).alias("missing"), F.sum((F.col("_expected") == 0).cast("long")).alias("unexpected")]
    names = ["rows", "ids", "duplicated", *(["missing", "unexpected"] if expected is not None else [])]
    return per.agg(*aggs).fillna(0, names)
