"""Joining fitted statistics back onto the data.

Statistics tables are keyed by category or value, so their size grows with
cardinality, not with rows.  A table is broadcast only after its row count
is checked against ``sparkfold.broadcast.maxRows`` (default 2,000,000) and the
size of its cached rows against ``sparkfold.broadcast.maxBytes`` (default 256 MB);
bigger tables go through a shuffle join, where AQE's skew-join splits hot
keys.  Tables bounded by construction (one row per fold, class, column,
threshold) pass ``bounded=True`` and skip the count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 256 << 20


def max_broadcast_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("sparkfold.broadcast.maxRows", str(DEFAULT_MAX_ROWS)))


def may_broadcast(cached: DataFrame, rows: int) -> bool:
    """Rows and bytes of a cached table are within the limits; the bytes come from the cache's own statistics."""
    limit = int(cached.sparkSession.conf.get("sparkfold.broadcast.maxBytes", str(DEFAULT_MAX_BYTES)))
    size = cached.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return rows <= max_broadcast_rows(cached) and int(str(size)) <= limit


def materialize(stats: DataFrame, bounded: bool = False) -> tuple[DataFrame, bool]:
    """Cache a fitted statistics table and decide once whether it may be broadcast.

    The cache is filled by the row count, so the joins that follow read the
    cached rows instead of recomputing the fit.  Lost cache blocks are rebuilt
    from lineage; nothing is node-local.  Returns (stats, broadcastable).
    """
    if bounded:
        return stats, True
    n = getattr(stats, "_sparkfold_rows", None)  # counted already by the fit that made it
    if n is not None:
        return stats, may_broadcast(stats, n)
    cached = stats.cache()
    n = cached.count()
    try:
        cached._sparkfold_rows = n
    except AttributeError:  # pragma: no cover - DataFrame without instance attributes
        pass
    return cached, may_broadcast(cached, n)


def fitted(stats: DataFrame) -> DataFrame:
    """End of every ``fit``: statistics are computed once (eager, like Spark ML's fit)
    and later plans read them as a cached leaf instead of re-expanding the fit."""
    return materialize(stats)[0]


def join_stats(df: DataFrame, stats: DataFrame, cond, how: str, small: bool) -> DataFrame:
    return df.join(F.broadcast(stats) if small else stats, cond, how)


def lookup(df: DataFrame, stats: DataFrame, on: str | Sequence[str], how: str = "left",
           bounded: bool = False) -> DataFrame:
    """Equi-join fitted statistics onto ``df`` (broadcast only if the count allows it)."""
    s, small = materialize(stats, bounded)
    return df.join(F.broadcast(s) if small else s, on, how)


def lookup_nullsafe(df: DataFrame, stats: DataFrame, key: str, stats_key: str,
                    bounded: bool = False) -> DataFrame:
    """Left join where NULL matches NULL (missing is its own category, I5)."""
    s, small = materialize(stats, bounded)
    cond = F.col(key).eqNullSafe(F.col(stats_key))
    return join_stats(df, s, cond, "left", small).drop(stats_key)
