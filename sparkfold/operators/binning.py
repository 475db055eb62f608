"""Quantile bins.

Edges are exact linear-interpolated quantiles at i/q (pandas ``qcut``),
duplicates dropped; bins are right-closed with the lowest edge included.
Fit on one frame, apply anywhere (the reference refits on every frame; that
is ``apply(df, fit(df))``).  Fewer than two distinct edges -> the raw value
passes through (E4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.operators.lookup import fitted
from sparkfold.operators.order import exact_quantiles, long_values

COL, VAL = "column", "value"


def fit_quantile_bins(df: DataFrame, cols: Sequence[str], q: int = 5,
                      where: str | Column | None = None) -> DataFrame:
    """(column, edges array<double>)."""
    src = df if where is None else df.where(where)
    cols = [c for c in cols if c in src.columns]
    long = long_values(src, cols, COL, VAL).where(F.col(VAL).isNotNull())
    hist = long.groupBy(COL, VAL).agg(F.count(F.lit(1)).alias("_cnt"))
    qs = exact_quantiles(hist, VAL, [i / q for i in range(q + 1)], [COL])
    edges = F.array_distinct(F.array(*[F.col(f"q{i}") for i in range(q + 1)]))
    return fitted(qs.select(COL, edges.alias("edges")))


def classify(x: Column, edges: Column, max_edges: int) -> Column:
    """Code of x among right-closed bins over a sorted edges array; outside -> NULL."""
    e = [F.try_element_at(edges, F.lit(i + 1)) for i in range(max_edges)]
    expr = F.when(x.isNull() | (x < e[0]), F.lit(None))
    expr = expr.when(x <= e[1], F.lit(0))
    for i in range(2, max_edges):
        expr = expr.when(x <= e[i], F.lit(i - 1))
    return expr.otherwise(F.lit(None)).cast("int")


def apply_quantile_bins(df: DataFrame, stats: DataFrame, cols: Sequence[str], q: int = 5,
                        suffix: str = "_bin") -> DataFrame:
    """Bin code as double; degenerate edges (< 2 distinct) keep the raw value."""
    cols = [c for c in cols if c in df.columns]
    wide = stats.groupBy().pivot(COL, cols).agg(F.first("edges"))
    wide = wide.select(*[F.col(c).alias(f"__e_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(wide))  # one row, q+1 edges per column
    out = {}
    for c in cols:
        e = F.col(f"__e_{c}")
        x = F.col(c).cast("double")
        out[c + suffix] = F.when(F.size(e) >= 2, classify(x, e, q + 1).cast("double")).otherwise(x)
    return j.withColumns(out).drop(*[f"__e_{c}" for c in cols])
