"""Query catalog: one Spark query and one DuckDB oracle per operator.

``REGISTRY[name] = (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
Spark queries call the library; oracles restate the semantics in plain SQL
over the same fixture views.  Output doubles are rounded to 6 places and
integers widened to bigint on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.operators import split
from sparkfold.plans import fixtures as fx
from sparkfold.session import cut_lineage

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (lambda spark, sf, _f=fn: finish(_f(spark, sf)), sql)
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Widen integers to bigint, floats to double, round doubles to 6 places."""
    out = {}
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            out[f.name] = F.col(f.name).cast("long")
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            out[f.name] = F.round(F.col(f.name).cast("double"), 6)
        elif isinstance(t, T.BooleanType):
            out[f.name] = F.col(f.name).cast("long")
    return df.withColumns(out) if out else df


# ---------------------------------------------------------------------------
# Shared frames.  TEST = fold 0, HOLDOUT = fold 1, MAIN = folds 2-4 where a
# three-way split is needed; TRAIN = fold != 0 elsewhere.
# ---------------------------------------------------------------------------
def founder_rows(spark: SparkSession, sf: str) -> DataFrame:
    """founder_base + y without folds: nothing is sorted or stored, so scans read only the used columns."""
    return fx.view(spark, sf, "founder_base").withColumn("y", (F.col("retention_status") == "Stayed").cast("int"))


def entity_rows(spark: SparkSession, sf: str) -> DataFrame:
    return fx.view(spark, sf, "entity_base").withColumn("y", (F.col("status") == "Stayed").cast("int"))


def founders(spark: SparkSession, sf: str) -> DataFrame:
    """founder_base + stratified fold + y (Stayed = 1)."""
    fb = fx.view(spark, sf, "founder_base")
    fb = split.assign_folds(fb, "retention_status", key_col="founder_id")
    # feeds many branches (fits, applies, splits): written once to the checkpoint folder
    return cut_lineage(fb.withColumn("y", (F.col("retention_status") == "Stayed").cast("int")))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    eb = fx.view(spark, sf, "entity_base")
    eb = split.assign_folds(eb, "status", key_col="id")
    return cut_lineage(eb.withColumn("y", (F.col("status") == "Stayed").cast("int")))


def preds_wide(spark: SparkSession, sf: str) -> DataFrame:
    """preds_base: id, y, fold, proba_a/b/c = 0.6 * u(id, m) + 0.4 * y."""
    eb = entities(spark, sf)
    cols = {f"proba_{m}": F.expr(fx.spark_u(f"concat(cast(id as string), '|{m}')")) * 0.6 + F.col("y") * 0.4
            for m in "abc"}
    return eb.select("id", "status", "y", "fold").withColumns(cols)


def preds_long(spark: SparkSession, sf: str) -> DataFrame:
    w = preds_wide(spark, sf)
    return w.unpivot(["id", "status", "y", "fold"], ["proba_a", "proba_b", "proba_c"], "model", "proba") \
        .withColumn("model", F.substring(F.col("model"), 7, 1))


# DuckDB counterparts ------------------------------------------------------------
FF = ("ff AS (SELECT *, " + fx.duck_fold_expr("founder_id", "retention_status") +
      " AS fold, CASE WHEN retention_status = 'Stayed' THEN 1 ELSE 0 END AS y FROM founder_base)")
EE = ("ee AS (SELECT *, " + fx.duck_fold_expr("id", "status") +
      " AS fold, CASE WHEN status = 'Stayed' THEN 1 ELSE 0 END AS y FROM entity_base)")
PW = ("pw AS (SELECT id, status, y, fold, " +
      ", ".join(f"{fx.duck_u(f'cast(id as varchar) || {chr(39)}|{m}{chr(39)}')} * 0.6 + y * 0.4 AS proba_{m}"
                for m in "abc") + " FROM ee)")
PL = ("pl AS (SELECT id, status, y, fold, 'a' AS model, proba_a AS proba FROM pw UNION ALL "
      "SELECT id, status, y, fold, 'b', proba_b FROM pw UNION ALL SELECT id, status, y, fold, 'c', proba_c FROM pw)")


def W(views: tuple[str, ...], *extra: str) -> str:
    head = fx.duck_with(*views).rstrip()
    if extra:
        head += ",\n" + ",\n".join(extra)
    return head + "\n"


WF = W(("founder_base",), FF)
WE = W(("entity_base",), EE)
WP = W(("entity_base",), EE, PW)
WPL = W(("entity_base",), EE, PW, PL)


def load_all() -> dict:
    # importing the query modules fills REGISTRY
    from sparkfold.plans import q_prep, q_encode, q_eval, q_models  # noqa: F401
    return REGISTRY
