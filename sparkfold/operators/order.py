"""Exact order statistics without a single-task window.

``Window.orderBy`` without a partition key (or partitioned by a two-valued
class label) sends all rows to one task.  Everything here that needs a global
position - exact quantiles, percentile ranks, dense codes, stratified folds -
goes through :func:`positions`, one path for every input size:

1. rows are range partitioned on (group, order keys), so many tasks hold the
   sort, whatever the key's type, and a NULL is a key like any other,
2. the partitioned rows are stored once, with the number of their partition,
3. a window over (group, partition) gives the weight before a row within its part,
4. a small (group, partition) totals table gives the weight of the parts before,
   matched with null-safe conditions.

The plan does not depend on the number of partitions, groups or rows.  Skew: value
histograms are built first (``value_counts``), so a value held by a third of all
rows is one row here, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.session import cut_lineage

PART_COL = "_part"
BEFORE_COL = "_before"
TOTAL_COL = "_n"
WEIGHT_COL = "_w"


def prefix_sums(df: DataFrame, order_cols: Sequence[str], weights: Mapping[str, tuple[str, str]],
                group_cols: Sequence[str] = (), n_parts: int | None = None) -> DataFrame:
    """For each weight column: its sum over the rows strictly earlier in the group, and over the group.

    ``weights``: weight column -> (name of the sum before, name of the group's sum); whole
    numbers, not NULL.  Rows must be distinct on ``group_cols + order_cols``; NULL groups
    and keys count as values, NULL keys first.  A group may span many partitions, so a
    group that holds most rows is split like any other.

    ``n_parts``: number of range partitions (default ``spark.sql.shuffle.partitions``).
    """
    groups, keys = list(group_cols), [*group_cols, *order_cols]
    ranged = df.repartitionByRange(n_parts, *keys) if n_parts else df.repartitionByRange(*keys)
    # stored: both uses below must see the same range bounds
    held = cut_lineage(ranged.withColumn(PART_COL, F.spark_partition_id()))

    totals = held.groupBy(*groups, PART_COL).agg(*[F.sum(w).alias(f"_b{i}") for i, w in enumerate(weights)])
    whole = Window.partitionBy(*groups)  # groups x partitions rows
    upto = whole.orderBy(PART_COL).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col(PART_COL).alias("_gp"),
        *[(F.sum(f"_b{i}").over(upto) - F.col(f"_b{i}")).alias(f"_off{i}") for i in range(len(weights))],
        *[F.sum(f"_b{i}").over(whole).alias(total) for i, (_, total) in enumerate(weights.values())])

    run = (Window.partitionBy(*groups, PART_COL).orderBy(*order_cols)
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = held.select("*", *[(F.sum(w).over(run) - F.col(w)).alias(f"_in{i}") for i, w in enumerate(weights)])
    same = F.col(PART_COL) == F.col("_gp")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = ranked.join(totals, same)
    out = out.withColumns({before: F.col(f"_off{i}") + F.col(f"_in{i}") for i, (before, _) in enumerate(weights.values())})
    return out.drop(PART_COL, "_gp", *[f"_g{i}" for i in range(len(groups))],
                    *[f"{c}{i}" for i in range(len(weights)) for c in ("_off", "_in")])


def positions(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
              weight_col: str | None = None, n_parts: int | None = None) -> DataFrame:
    """Add ``_before`` (weight of rows strictly earlier in the group) and ``_n`` (group weight), by :func:`prefix_sums`."""
    w = F.col(weight_col) if weight_col else F.lit(1).cast("long")
    return prefix_sums(df.withColumn(WEIGHT_COL, w), order_cols, {WEIGHT_COL: (BEFORE_COL, TOTAL_COL)}, group_cols, n_parts)


def value_counts(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values with their counts (map-side combined)."""
    return (df.where(F.col(value_col).isNotNull())
            .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_cnt")))


def long_values(df: DataFrame, cols: Sequence[str], name_col: str = "column",
                value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (keep..., column, value double): one scan for all columns."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(keep), list(cols), name_col, value_col)


def exact_quantiles(hist: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), count_col: str = "_cnt",
                    n_parts: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas 'linear') from a value histogram.

    ``hist`` holds distinct (group..., value, count).  Returns one row per
    group with columns ``q0, q1, ...`` (doubles) and ``_n``.
    """
    pos = positions(hist, [value_col], group_cols, weight_col=count_col, n_parts=n_parts)
    aggs = [F.first(TOTAL_COL).alias(TOTAL_COL)]
    for i, p in enumerate(probs):
        h = (F.col(TOTAL_COL) - 1) * F.lit(float(p))
        lo = F.floor(h)
        hi = F.ceil(h)
        b, c = F.col(BEFORE_COL), F.col(WEIGHT_COL)
        aggs.append(F.max(F.when((b <= lo) & (lo < b + c), F.col(value_col))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when((b <= hi) & (hi < b + c), F.col(value_col))).alias(f"_hi{i}"))
        aggs.append(F.first(h - lo).alias(f"_fr{i}"))
    agg = pos.groupBy(*group_cols).agg(*aggs)
    outs = []
    for i in range(len(probs)):
        lo, hi, fr = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
        outs.append(F.when(fr == 0, lo).otherwise(lo + fr * (hi - lo)).alias(f"q{i}"))
    return agg.select(*group_cols, *outs, TOTAL_COL)


def dense_index(distinct_df: DataFrame, order_cols: Sequence[str],
                group_cols: Sequence[str] = (), out_col: str = "index",
                n_parts: int | None = None) -> DataFrame:
    """0-based position of each distinct row in ``order_cols`` order within its group."""
    pos = positions(distinct_df, order_cols, group_cols, n_parts=n_parts)
    return pos.withColumn(out_col, F.col(BEFORE_COL).cast("long")).drop(
        BEFORE_COL, TOTAL_COL, WEIGHT_COL)


def mode_of(hist: DataFrame, value_col: str, group_cols: Sequence[str] = (),
            count_col: str = "_cnt", out_col: str = "mode") -> DataFrame:
    """Most frequent value, ties to the smallest: min over (-count, value) structs.

    A plain partial aggregate - no window, no per-group value buffer.
    """
    best = F.min(F.struct((-F.col(count_col)).alias("k"), F.col(value_col).alias("v")))
    return hist.groupBy(*group_cols).agg(best.alias("_m")).select(
        *group_cols, F.col("_m.v").alias(out_col))
