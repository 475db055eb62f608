"""Queries: metrics, searches, set operations, blends, soup, sinks, neighbours (J, K, L, N, A, I9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfold.functions import exprs as X
from sparkfold.operators import ensemble, metrics, neighbors, search, split
from sparkfold.plans import fixtures as fx
from sparkfold.plans.catalog import WE, WF, WP, WPL, W, EE, PW, entities, founders, preds_long, preds_wide, register, entity_rows, founder_rows
from sparkfold.session import shared_folder
from sparkfold.sources import io

CLASSES = ["Left", "Stayed"]


def _f1(tp: str = "tp", fp: str = "fp", fn: str = "fn") -> str:
    return (f"CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0.0 ELSE 2.0 * cast({tp} AS double) / "
            f"cast(2 * {tp} + {fp} + {fn} AS double) END")


def _cnt(pred: str, y: str = "y") -> str:
    return (f"sum(CASE WHEN {pred} AND {y} = 1 THEN 1 ELSE 0 END) tp, sum(CASE WHEN {pred} AND {y} = 0 THEN 1 ELSE 0 END) fp, "
            f"sum(CASE WHEN NOT ({pred}) AND {y} = 1 THEN 1 ELSE 0 END) fn, "
            f"sum(CASE WHEN NOT ({pred}) AND {y} = 0 THEN 1 ELSE 0 END) tn")


# --- J aggregates / metrics ----------------------------------------------------------------------------
@register("value_counts", WF + "SELECT founder_role, count(*) count, round(count(*) * 1.0 / (SELECT count(*) FROM ff), 6) "
          "share FROM ff GROUP BY founder_role")
def value_counts(spark, sf):
    return metrics.value_counts(founder_rows(spark, sf), "founder_role", dropna=False)


@register("global_stats", WE + "SELECT round(avg(total_spend), 2) mean_spend, round(min(total_spend), 6) min_spend, "
          "round(max(total_spend), 6) max_spend, round(sum(total_spend), 2) sum_spend, round(avg(acctbal), 6) mean_acctbal, "
          "count(acctbal) n_acctbal FROM ee")
def global_stats(spark, sf):
    e = fx.view(spark, sf, "entity_base")
    # money sums are reported to the cent: summation order changes the last bits
    return e.agg(F.round(F.avg("total_spend"), 2).alias("mean_spend"), F.min("total_spend").alias("min_spend"),
                 F.max("total_spend").alias("max_spend"), F.round(F.sum("total_spend"), 2).alias("sum_spend"),
                 F.avg("acctbal").alias("mean_acctbal"), F.count("acctbal").alias("n_acctbal"))


@register("class_weights", WE + "SELECT cast(y AS bigint) y, count(*) n_c, round((SELECT count(*) FROM ee) / (2.0 * count(*)), 6) weight "
          "FROM ee GROUP BY y")
def class_weights(spark, sf):
    return metrics.class_weights(entity_rows(spark, sf), "y")


@register("scale_pos_weight", W(("quality_base",)) + "SELECT cast(sum(quality) AS bigint) pos, "
          "cast(sum(1 - quality) AS bigint) neg, round(sum(1 - quality) / greatest(sum(quality), 1), 6) "
          "scale_pos_weight FROM quality_base")
def scale_pos_weight(spark, sf):
    return metrics.scale_pos_weight(fx.view(spark, sf, "quality_base"), "quality")


@register("metric_accuracy", WP + "SELECT round(avg(CASE WHEN (proba_a >= 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) "
          "accuracy, count(*) n FROM pw")
def metric_accuracy(spark, sf):
    pw = preds_wide(spark, sf).withColumn("yhat", (F.col("proba_a") >= 0.5).cast("int"))
    return metrics.binary_metrics(pw, "y", "yhat").select("accuracy", "n")


@register("metric_f1", WP + "SELECT round(" + _f1() + ", 6) f1, cast(tp AS bigint) tp, cast(fp AS bigint) fp, "
          "cast(fn AS bigint) fn FROM (SELECT " + _cnt("proba_a >= 0.5") +
          " FROM pw)")
def metric_f1(spark, sf):
    pw = preds_wide(spark, sf).withColumn("yhat", (F.col("proba_a") >= 0.5).cast("int"))
    return metrics.binary_metrics(pw, "y", "yhat").select("f1", "tp", "fp", "fn")


@register("metric_f1_zero", W(("quality_base",)) + "SELECT round(" + _f1() + ", 6) f1 FROM (SELECT " +
          _cnt("n_chars < 0", "quality") + " FROM quality_base)")
def metric_f1_zero(spark, sf):
    """No positive prediction at all: F1 is 0, not an error."""
    q = fx.view(spark, sf, "quality_base").withColumn("yhat", (F.col("n_chars") < 0).cast("int"))
    return metrics.binary_metrics(q, "quality", "yhat").select("f1")


@register("metric_confusion", WP + """, g AS (SELECT t.c "true", p.c pred FROM (VALUES (0), (1)) t(c), (VALUES (0), (1)) p(c)),
cells AS (SELECT y "true", CASE WHEN proba_a >= 0.5 THEN 1 ELSE 0 END pred, count(*) n FROM pw GROUP BY 1, 2)
SELECT cast(g."true" AS bigint) "true", cast(g.pred AS bigint) pred, coalesce(n, 0) n FROM g LEFT JOIN cells USING ("true", pred)""")
def metric_confusion(spark, sf):
    pw = preds_wide(spark, sf).withColumn("yhat", (F.col("proba_a") >= 0.5).cast("int"))
    classes = spark.range(2).select(F.col("id").cast("int").alias("class"))
    return metrics.confusion(pw, "y", "yhat", classes)


@register("metric_class_report", WP + """, c AS (SELECT y, CASE WHEN proba_a >= 0.9 THEN 1 ELSE 0 END p FROM pw),
per AS (SELECT k label, sum(CASE WHEN y = k AND p = k THEN 1 ELSE 0 END) tp,
  sum(CASE WHEN y = k THEN 1 ELSE 0 END) support, sum(CASE WHEN p = k THEN 1 ELSE 0 END) predicted
  FROM c, (VALUES (0), (1)) t(k) GROUP BY k),
m AS (SELECT cast(label AS varchar) label,
  CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END "precision",
  CASE WHEN support = 0 THEN 0.0 ELSE tp / support END recall,
  """ + _f1("tp", "(predicted - tp)", "(support - tp)") + """ f1, support, tp FROM per)
SELECT label, round("precision", 6) "precision", round(recall, 6) recall, round(f1, 6) f1, cast(support AS bigint) support FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), cast(sum(support) AS bigint) FROM m
UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) AS bigint) FROM m
UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), cast(sum(support) AS bigint) FROM m""")
def metric_class_report(spark, sf):
    pw = preds_wide(spark, sf).withColumn("yhat", (F.col("proba_a") >= 0.9).cast("int"))
    classes = spark.range(2).select(F.col("id").cast("int").alias("class"))
    return metrics.class_report(pw, "y", "yhat", classes)


@register("metric_rollup_fold", WP + "SELECT cast(fold AS bigint) fold, round(" + _f1() + ", 6) f1, "
          "round((tp + tn) * 1.0 / n, 6) accuracy, n FROM (SELECT fold, " + _cnt("proba_a >= 0.5") +
          ", count(*) n FROM pw GROUP BY ROLLUP (fold))")
def metric_rollup_fold(spark, sf):
    pw = preds_wide(spark, sf).withColumn("yhat", (F.col("proba_a") >= 0.5).cast("int"))
    return metrics.binary_metrics(pw, "y", "yhat", ["fold"], rollup=True).select("fold", "f1", "accuracy", "n")


@register("metric_by_model", WPL + "SELECT model, round(" + _f1() + ", 4) f1, round((tp + tn) * 1.0 / n, 4) accuracy "
          "FROM (SELECT model, " + _cnt("proba >= 0.5") + ", count(*) n FROM pl GROUP BY model)")
def metric_by_model(spark, sf):
    pl = preds_long(spark, sf).withColumn("yhat", (F.col("proba") >= 0.5).cast("int"))
    m = metrics.binary_metrics(pl, "y", "yhat", ["model"])
    return X.round_cols(m.select("model", "f1", "accuracy"), 4)  # D19


@register("feature_mutual_info", WF + """, l AS (
  SELECT 'founder_role' c, founder_role v, y FROM ff UNION ALL SELECT 'startup_stage', startup_stage, y FROM ff
  UNION ALL SELECT 'team_size_category', team_size_category, y FROM ff),
j AS (SELECT c, v, y, count(*) nxy FROM l GROUP BY ALL),
x AS (SELECT c, v, sum(nxy) nx FROM j GROUP BY ALL), yy AS (SELECT c, y, sum(nxy) ny FROM j GROUP BY ALL),
n AS (SELECT c, sum(nxy) n FROM j GROUP BY c)
SELECT j.c "column", round(sum((nxy / n.n) * ln((nxy * n.n) / (nx * ny))), 6) mutual_info
FROM j JOIN x ON j.c = x.c AND j.v IS NOT DISTINCT FROM x.v JOIN yy ON j.c = yy.c AND j.y = yy.y JOIN n ON j.c = n.c
GROUP BY j.c""")
def feature_mutual_info(spark, sf):
    ff = founder_rows(spark, sf)
    return metrics.mutual_info(ff, ["founder_role", "startup_stage", "team_size_category"], "y")


MI_NUM = ["founder_age", "years_with_startup", "monthly_revenue_generated", "funding_rounds_led", "distance_from_investor_hub",
          "num_dependents", "years_since_founding"]
MI_CAT = ["work_life_balance_rating", "venture_satisfaction", "startup_performance_rating", "startup_reputation", "founder_visibility",
          "founder_role", "education_background", "personal_status", "startup_stage", "team_size_category", "founder_gender",
          "working_overtime", "remote_operations", "innovation_support"]


def _mi_all_sql() -> str:
    parts = []
    for c in MI_NUM:
        e = f"(SELECT quantile_cont({c}, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) FROM ff WHERE {c} IS NOT NULL)"
        # right-closed bins over the distinct edges: how many inner edges lie below the value
        parts.append(f"SELECT '{c}' c, cast(CASE WHEN {c} IS NULL THEN NULL ELSE greatest(len(list_filter(list_distinct({e}), lambda x: x < {c})) - 1, 0) END AS varchar) v, y FROM ff")
    parts += [f"SELECT '{c}', {c}, y FROM ff" for c in MI_CAT]
    return WF + ", l AS (" + " UNION ALL ".join(parts) + """),
j AS (SELECT c, v, y, count(*) nxy FROM l GROUP BY ALL),
x AS (SELECT c, v, sum(nxy) nx FROM j GROUP BY ALL), yy AS (SELECT c, y, sum(nxy) ny FROM j GROUP BY ALL),
n AS (SELECT c, sum(nxy) n FROM j GROUP BY c),
mi AS (SELECT j.c, sum((nxy / n.n) * ln((nxy * n.n) / (nx * ny))) m
FROM j JOIN x ON j.c = x.c AND j.v IS NOT DISTINCT FROM x.v JOIN yy ON j.c = yy.c AND j.y = yy.y JOIN n ON j.c = n.c GROUP BY j.c)
SELECT c "column", round(m, 6) mutual_info, row_number() OVER (ORDER BY m DESC, c) rank FROM mi QUALIFY rank <= 12"""


@register("feature_mutual_info_top", _mi_all_sql())
def feature_mutual_info_top(spark, sf):
    """Mutual information of all features, numerics in exact quintile bins, and the twelve highest."""
    return metrics.top_mutual_info(founder_rows(spark, sf), MI_NUM, MI_CAT, "y", k=12)


# --- K searches ----------------------------------------------------------------------------------------------
def _thr_sql(src: str, p: str, start: int, count: int, denom: int, y: str = "y") -> str:
    return (f"SELECT i, cast({start} + i AS double) / {denom}.0 t, " + _cnt(f"{p} >= cast({start} + i AS double) / {denom}.0", y) +
            f" FROM {src}, (SELECT range i FROM range({count})) r GROUP BY i")


@register("threshold_search", WP + ", c AS (" + _thr_sql("pw", "proba_a", 10, 81, 100) + ")\n"
          "SELECT round(t, 6) threshold, round(" + _f1() + ", 6) f1 FROM c ORDER BY " + _f1() + " DESC, i LIMIT 1")
def threshold_search(spark, sf):
    return search.best_threshold(preds_wide(spark, sf), "y", "proba_a")


WNS = WP.rstrip() + ",\nns AS (SELECT id, y, CASE WHEN id % 7 = 0 THEN NULL ELSE proba_a END proba_a FROM pw)\n"


@register("threshold_search_null_scores", WNS.rstrip() + ", c AS (" + _thr_sql("ns", "0 = 0 AND coalesce(proba_a, -1.0)", 30, 41, 100) + "),\n"
          "b AS (SELECT t, " + _f1() + " f1 FROM c ORDER BY " + _f1() + " DESC, i LIMIT 1),\n"
          "d AS (SELECT " + _f1() + " f05 FROM (SELECT " + _cnt("coalesce(proba_a, -1.0) >= 0.5") + " FROM ns))\n"
          "SELECT round(CASE WHEN f1 > f05 THEN t ELSE 0.5 END, 6) threshold, round(greatest(f1, f05), 6) f1, "
          "round(f05, 6) f1_at_default FROM b, d")
def threshold_search_null_scores(spark, sf):
    """A missing score is predicted 0 on the curve and at the incumbent alike."""
    p = preds_wide(spark, sf).select("id", "y", F.when(F.col("id") % 7 != 0, F.col("proba_a")).alias("proba_a"))
    return search.best_threshold_incumbent(p, "y", "proba_a")


@register("threshold_search_by_model", WPL + ", c AS (SELECT model, i, cast(10 + i AS double) / 100.0 t, " +
          _cnt("proba >= cast(10 + i AS double) / 100.0") + " FROM pl, (SELECT range i FROM range(81)) r GROUP BY model, i)\n"
          "SELECT model, round(t, 6) threshold, round(f1, 6) f1 FROM (SELECT model, t, " + _f1() +
          " f1, row_number() OVER (PARTITION BY model ORDER BY " + _f1() + " DESC, i) rn FROM c) WHERE rn = 1")
def threshold_search_by_model(spark, sf):
    return search.best_threshold(preds_long(spark, sf), "y", "proba", group_cols=["model"])


@register("threshold_search_incumbent", WP + ", c AS (" + _thr_sql("pw", "proba_c", 30, 41, 100) + "),\n"
          "b AS (SELECT t, " + _f1() + " f1 FROM c ORDER BY " + _f1() + " DESC, i LIMIT 1),\n"
          "d AS (SELECT " + _f1() + " f05 FROM (SELECT " + _cnt("proba_c >= 0.5") + " FROM pw))\n"
          "SELECT round(CASE WHEN f1 > f05 THEN t ELSE 0.5 END, 6) threshold, round(greatest(f1, f05), 6) f1, "
          "round(f05, 6) f1_at_default FROM b, d")
def threshold_search_incumbent(spark, sf):
    return search.best_threshold_incumbent(preds_wide(spark, sf), "y", "proba_c")


WM = WP.rstrip() + ",\nsc AS (SELECT id, y, fold, (proba_b - 0.5) * 4.0 s FROM pw),\n" \
    "rg AS (SELECT min(s) lo, max(s) hi FROM sc),\n" \
    "th AS (SELECT j, CASE WHEN j = 299 THEN hi ELSE cast(j AS double) * ((hi - lo) / 299.0) + lo END t FROM rg, " \
    "(SELECT range j FROM range(300)) r),\n" \
    "c AS (SELECT j, t, " + _cnt("s >= t") + " FROM sc, th GROUP BY j, t),\n" \
    "best AS (SELECT t, " + _f1() + " f1 FROM c ORDER BY " + _f1() + " DESC, j LIMIT 1)\n"


def _margins(spark, sf):
    return preds_wide(spark, sf).withColumn("s", (F.col("proba_b") - 0.5) * 4.0)


@register("threshold_search_margin", WM + "SELECT round(t, 6) threshold, round(f1, 6) f1 FROM best")
def threshold_search_margin(spark, sf):
    return search.best_threshold_margin(_margins(spark, sf), "y", "s", 300)


FIXED_T = [0.70, 0.74, 0.75, 0.76, 0.78]


@register("threshold_report", WP + ", c AS (SELECT t, " + _cnt("proba_a >= t") + " FROM pw, (VALUES " +
          ", ".join(f"({t})" for t in FIXED_T) + ") v(t) GROUP BY t)\n"
          "SELECT round(cast(t AS double), 6) threshold, round(" + _f1() + ", 6) f1, round((tp + tn) * 1.0 / (tp + tn + fp + fn), 6) "
          "accuracy FROM c")
def threshold_report(spark, sf):
    return search.f1_at(preds_wide(spark, sf), "y", "proba_a", FIXED_T)


WG = WP.rstrip() + """,
lv AS (SELECT range i FROM range(5)),
wt AS (SELECT a.i * 25 + b.i * 5 + c.i seq, cast(a.i AS double) / 4.0 wa, cast(b.i AS double) / 4.0 wb,
  cast(c.i AS double) / 4.0 wc FROM lv a, lv b, lv c WHERE a.i + b.i + c.i > 0),
wn AS (SELECT seq, wa / (wa + wb + wc) w0, wb / (wa + wb + wc) w1, wc / (wa + wb + wc) w2 FROM wt),
ens AS (SELECT seq, w0, w1, w2, y, w0 * proba_a + w1 * proba_b + w2 * proba_c p FROM wn, pw),
c AS (SELECT seq, w0, w1, w2, i, cast(10 + i AS double) / 100.0 t, """ + _cnt("p >= cast(10 + i AS double) / 100.0") + """
  FROM ens, (SELECT range i FROM range(81)) r GROUP BY seq, w0, w1, w2, i),
gbest AS (SELECT seq, w0, w1, w2, t, """ + _f1() + " f1 FROM c ORDER BY " + _f1() + """ DESC, seq, i LIMIT 1)
"""


@register("weight_grid_search", WG + "SELECT seq, round(t, 6) threshold, round(f1, 6) f1, round(w0, 6) w0, round(w1, 6) w1, "
          "round(w2, 6) w2 FROM gbest")
def weight_grid_search(spark, sf):
    return search.weight_grid_search(preds_wide(spark, sf), "y", ["proba_a", "proba_b", "proba_c"])


def _runs(spark, sf):
    """Run table: one row per (model, fold) with F1 at 0.5; seq = model order then fold."""
    pl = preds_long(spark, sf).withColumn("yhat", (F.col("proba") >= 0.5).cast("int"))
    m = metrics.binary_metrics(pl, "y", "yhat", ["model", "fold"])
    return m.select("model", "fold", (F.ascii("model") * 10 + F.col("fold")).alias("seq"), "f1")


RUNS = WPL.rstrip() + ",\nruns AS (SELECT model, fold, ascii(model) * 10 + fold seq, " + _f1() + " f1 FROM (SELECT model, fold, " + \
    _cnt("proba >= 0.5") + " FROM pl GROUP BY model, fold))\n"


@register("rank_configs", RUNS + "SELECT model, cast(fold AS bigint) fold, round(f1, 6) f1, "
          "row_number() OVER (ORDER BY f1 DESC, seq) rank FROM runs")
def rank_configs(spark, sf):
    from pyspark.sql import Window
    r = _runs(spark, sf)
    # the run table has one row per (model, fold): a bounded window
    return r.select("model", "fold", "f1", F.row_number().over(Window.orderBy(F.col("f1").desc(), "seq")).alias("rank"))


@register("topk_models", RUNS + "SELECT model, cast(fold AS bigint) fold, round(f1, 6) f1 FROM runs ORDER BY f1 DESC, seq LIMIT 3")
def topk_models(spark, sf):
    return search.topk(_runs(spark, sf), "f1", "seq", 3).select("model", "fold", "f1")


@register("best_model", RUNS + "SELECT model, cast(fold AS bigint) fold, round(f1, 6) f1 FROM runs ORDER BY f1 DESC, seq LIMIT 1")
def best_model(spark, sf):
    return search.first_best(_runs(spark, sf), "f1", "seq", keep=["model", "fold"]).select("model", "fold", "f1")


@register("choose_strategy", WG.rstrip() + ",\npl2 AS (SELECT id, y, 'a' model, proba_a proba FROM pw UNION ALL "
          "SELECT id, y, 'b', proba_b FROM pw UNION ALL SELECT id, y, 'c', proba_c FROM pw),\nsc2 AS (SELECT model, ascii(model) seq, i, cast(10 + i AS double) / 100.0 t, " +
          _cnt("proba >= cast(10 + i AS double) / 100.0") + " FROM pl2, (SELECT range i FROM range(81)) r GROUP BY model, i),\n"
          "single AS (SELECT model, t, " + _f1() + " f1 FROM sc2 ORDER BY " + _f1() + " DESC, seq, i LIMIT 1)\n"
          "SELECT CASE WHEN g.f1 > s.f1 THEN 'ensemble' ELSE s.model END strategy, round(greatest(g.f1, s.f1), 6) f1, "
          "round(CASE WHEN g.f1 > s.f1 THEN g.t ELSE s.t END, 6) threshold FROM gbest g, single s")
def choose_strategy(spark, sf):
    pw = preds_wide(spark, sf)
    single = search.best_threshold(preds_long(spark, sf), "y", "proba", group_cols=["model"]) \
        .withColumn("seq", F.ascii("model"))
    ens = search.weight_grid_search(pw, "y", ["proba_a", "proba_b", "proba_c"])
    return search.choose_strategy(single, ens)


MODELS5 = {"a": 0.6, "b": 0.6, "c": 0.6, "d": 0.7, "e": 0.5}


def _five_models(spark, sf):
    """Long predictions of five models: proba = w * u(id, model) + (1 - w) * y."""
    base = preds_wide(spark, sf).select("id", "y", "fold")
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(w).alias("w")) for m, w in MODELS5.items()])).alias("m")
    rows = base.select("id", "y", "fold", models).select("id", "y", "fold", "m.*")
    u = F.expr(fx.spark_u("concat(cast(id as string), '|', model)"))
    return rows.select("id", "y", "fold", "model", (u * F.col("w") + F.col("y") * (1.0 - F.col("w"))).alias("proba"))


CHAIN = WP.rstrip() + """,
ms AS (SELECT * FROM (VALUES """ + ", ".join(f"('{m}', cast({w} AS double))" for m, w in MODELS5.items()) + """) v(model, w)),
p5 AS (SELECT id, y, fold, model, """ + fx.duck_u("cast(id AS varchar) || '|' || model") + """ * w + y * (1.0 - w) proba FROM pw, ms),
sc AS (SELECT model, i, """ + _cnt("proba >= cast(10 + i AS double) / 100.0") + """ FROM p5, (SELECT range i FROM range(81)) r WHERE fold != 0 GROUP BY model, i),
mf AS (SELECT model, max(""" + _f1() + """) f1 FROM sc GROUP BY model),
top AS (SELECT model, row_number() OVER (ORDER BY f1 DESC, model) rank FROM mf QUALIFY rank <= 3),
pw3 AS (SELECT id, y, fold, max(CASE WHEN rank = 1 THEN proba END) proba_a, max(CASE WHEN rank = 2 THEN proba END) proba_b,
  max(CASE WHEN rank = 3 THEN proba END) proba_c FROM p5 JOIN top USING (model) GROUP BY id, y, fold),
lv AS (SELECT range i FROM range(5)),
wt AS (SELECT a.i * 25 + b.i * 5 + c.i seq, cast(a.i AS double) / 4.0 wa, cast(b.i AS double) / 4.0 wb,
  cast(c.i AS double) / 4.0 wc FROM lv a, lv b, lv c WHERE a.i + b.i + c.i > 0),
wn AS (SELECT seq, wa / (wa + wb + wc) w0, wb / (wa + wb + wc) w1, wc / (wa + wb + wc) w2 FROM wt),
ens AS (SELECT seq, w0, w1, w2, y, w0 * proba_a + w1 * proba_b + w2 * proba_c p FROM wn, pw3 WHERE fold != 0),
c AS (SELECT seq, w0, w1, w2, i, cast(10 + i AS double) / 100.0 t, """ + _cnt("p >= cast(10 + i AS double) / 100.0") + """
  FROM ens, (SELECT range i FROM range(81)) r GROUP BY seq, w0, w1, w2, i),
gbest AS (SELECT seq, w0, w1, w2, t, """ + _f1() + " f1 FROM c ORDER BY " + _f1() + """ DESC, seq, i LIMIT 1)
"""


@register("ensemble_top3_to_test", CHAIN + "SELECT id, round(w0 * proba_a + w1 * proba_b + w2 * proba_c, 6) proba, round(t, 6) threshold, "
          "CASE WHEN w0 * proba_a + w1 * proba_b + w2 * proba_c >= t THEN 'Stayed' ELSE 'Left' END label FROM pw3, gbest WHERE fold = 0")
def ensemble_top3_to_test(spark, sf):
    """The three best of five models by tuned F1, their weights and threshold searched on the training rows,
    applied to the test rows (K4, K13, N10)."""
    p5 = _five_models(spark, sf)
    found = search.fit_ensemble(p5.where("fold != 0"), "y")
    test = ensemble.apply_ensemble(p5.where("fold = 0"), found)
    return test.select("id", "proba", "threshold", F.when(F.col("is_positive") == 1, "Stayed").otherwise("Left").alias("label"))


@register("ensemble_top3_weights", CHAIN + "SELECT cast(rank AS bigint) rank, model, round(CASE rank WHEN 1 THEN w0 WHEN 2 THEN w1 ELSE w2 END, 6) weight, "
          "round(t, 6) threshold, round(f1, 6) f1 FROM top, gbest")
def ensemble_top3_weights(spark, sf):
    return search.fit_ensemble(_five_models(spark, sf).where("fold != 0"), "y")


@register("argmax_class", WP + """, l AS (SELECT id, 'Left' class, 1.0 - proba_a p FROM pw UNION ALL SELECT id, 'Stayed', proba_a FROM pw)
SELECT id, class FROM (SELECT id, class, row_number() OVER (PARTITION BY id ORDER BY p DESC, class) rn FROM l) WHERE rn = 1""")
def argmax_class(spark, sf):
    pw = preds_wide(spark, sf).select("id", (1.0 - F.col("proba_a")).alias("Left"), F.col("proba_a").alias("Stayed"))
    return ensemble.argmax_class(ensemble.wide_to_long(pw, CLASSES))


# --- L / N / A ---------------------------------------------------------------------------------------------------
TFM = WE.rstrip() + ",\ntf AS (SELECT e.id, f.k fold_model, " + fx.duck_u("cast(e.id AS varchar) || '|a' || cast(f.k AS varchar)") + \
    " * 0.6 + e.y * 0.4 proba FROM ee e, (SELECT range k FROM range(5)) f WHERE e.fold = 0)\n"


def _test_fold_preds(spark, sf):
    """Each fold model's probabilities on the test rows (fold 0), stacked long (L3)."""
    ee = entities(spark, sf).where("fold = 0")
    parts = []
    for k in range(5):
        u = F.expr(fx.spark_u(f"concat(cast(id as string), '|a{k}')"))
        parts.append(ee.select("id", F.lit(k).alias("fold_model"), (u * 0.6 + F.col("y") * 0.4).alias("proba")))
    return ensemble.assemble_oof(parts)


@register("test_fold_mean", TFM + "SELECT id, round(avg(proba), 6) proba FROM tf GROUP BY id")
def test_fold_mean(spark, sf):
    return ensemble.fold_mean(_test_fold_preds(spark, sf), keys=["id"])


@register("blend_mean", WP + "SELECT id, round(0.5 * proba_a + 0.5 * proba_b, 6) proba, CASE WHEN 0.5 * proba_a + 0.5 * proba_b "
          ">= 0.5 THEN 'Stayed' ELSE 'Left' END label FROM pw")
def blend_mean(spark, sf):
    b = ensemble.blend_columns(preds_wide(spark, sf), {"proba_a": 0.5, "proba_b": 0.5}, normalize=False)
    return b.select("id", "proba", X.threshold_label("proba", 0.5, "Stayed", "Left").alias("label"))


@register("blend_weighted", WPL + """, w AS (SELECT * FROM (VALUES ('a', 0.8), ('b', 0.1), ('c', 0.1)) w(model, weight)),
s AS (SELECT id, sum(cast(weight AS double) * proba) p FROM pl JOIN w USING (model) GROUP BY id)
SELECT id, round(p, 6) proba, CASE WHEN p >= 0.6 THEN 'Stayed' ELSE 'Left' END label FROM s""")
def blend_weighted(spark, sf):
    w = spark.createDataFrame([("a", 0.8), ("b", 0.1), ("c", 0.1)], "model string, weight double")
    b = ensemble.blend_long(preds_long(spark, sf), w)
    return b.select("id", "proba", X.threshold_label("proba", 0.6, "Stayed", "Left").alias("label"))


@register("blend_seed_mean", WPL + "SELECT id, round(avg(proba), 6) proba FROM pl GROUP BY id")
def blend_seed_mean(spark, sf):
    return ensemble.fold_mean(preds_long(spark, sf), keys=["id"])


@register("blend_soft_vote", WP + "SELECT id, round((3.0 * proba_a + 1.0 * proba_b) / 4.0, 6) proba FROM pw")
def blend_soft_vote(spark, sf):
    return ensemble.blend_columns(preds_wide(spark, sf), {"proba_a": 3.0, "proba_b": 1.0}).select("id", "proba")


def _soup_sources(spark, sf):
    pw = preds_wide(spark, sf)
    a = pw.select("id", (1.0 - F.col("proba_a")).alias("Left"), F.col("proba_a").alias("Stayed"))
    lab = F.when(F.col("id") % 13 == 0, F.lit("Maybe")).otherwise(
        X.threshold_label("proba_b", 0.5, "Stayed", "Left"))
    b = pw.select("id", lab.alias("retention_status"))
    c = pw.where("fold != 3").select("id", (1.0 - F.col("proba_c")).alias("Left"), F.col("proba_c").alias("Stayed"))
    return pw, {"a": a, "b": b, "c": c}


SOUP = WP.rstrip() + """,
ids AS (SELECT id FROM pw), cls AS (SELECT * FROM (VALUES ('Left'), ('Stayed')) c(class)),
sa AS (SELECT id, 'Left' class, 1.0 - proba_a p FROM pw UNION ALL SELECT id, 'Stayed', proba_a FROM pw),
lb AS (SELECT id, CASE WHEN id % 13 = 0 THEN 'Maybe' WHEN proba_b >= 0.5 THEN 'Stayed' ELSE 'Left' END lab FROM pw),
sb AS (SELECT id, class, cast(CASE WHEN lab NOT IN ('Left', 'Stayed') THEN 0.5 WHEN lab = class THEN 1.0 ELSE 0.0 END AS double) p
  FROM lb, cls),
sc0 AS (SELECT id, 'Left' class, 1.0 - proba_c p FROM pw WHERE fold != 3 UNION ALL SELECT id, 'Stayed', proba_c FROM pw WHERE fold != 3),
sc AS (SELECT ids.id, cls.class, coalesce(sc0.p, 0.5) p FROM ids CROSS JOIN cls LEFT JOIN sc0 ON sc0.id = ids.id AND sc0.class = cls.class),
allp AS (SELECT * FROM sa UNION ALL SELECT * FROM sb UNION ALL SELECT * FROM sc),
s AS (SELECT id, class, sum(p) s FROM allp GROUP BY id, class),
n AS (SELECT id, class, s / (sum(s) OVER (PARTITION BY id) + 1e-12) p FROM s)
"""


@register("soup", SOUP + "SELECT id, class label, round(p, 6) proba FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p DESC, class) rn "
          "FROM n) WHERE rn = 1")
def soup(spark, sf):
    pw, srcs = _soup_sources(spark, sf)
    long, _rejected = io.read_sources(srcs, CLASSES, "id", "retention_status")
    aligned = None
    for name in srcs:
        part = ensemble.align_to_ids(pw.select("id"), long.where(F.col("source") == name), CLASSES) \
            .withColumn("source", F.lit(name))
        aligned = part if aligned is None else aligned.unionByName(part)
    weights = spark.createDataFrame([(n, 1.0) for n in srcs], "source string, weight double")
    classes = spark.createDataFrame([(c,) for c in CLASSES], "class string")
    return ensemble.soup(aligned, weights, classes)


@register("align_predictions", SOUP + "SELECT id, class, round(p, 6) proba FROM sc")
def align_predictions(spark, sf):
    pw, srcs = _soup_sources(spark, sf)
    return ensemble.align_to_ids(pw.select("id"), ensemble.wide_to_long(srcs["c"], CLASSES), CLASSES)


@register("preds_wide_to_long", SOUP + "SELECT id, class, round(p, 6) proba FROM sa")
def preds_wide_to_long(spark, sf):
    _, srcs = _soup_sources(spark, sf)
    return io.read_as_proba(srcs["a"], CLASSES, "id", "retention_status")


@register("preds_label_to_onehot", SOUP + "SELECT id, class, round(p, 6) proba FROM sb")
def preds_label_to_onehot(spark, sf):
    _, srcs = _soup_sources(spark, sf)
    return io.read_as_proba(srcs["b"], CLASSES, "id", "retention_status")


@register("oof_assemble", WP + "SELECT id, cast(fold AS bigint) fold, round(proba_a, 6) proba FROM pw")
def oof_assemble(spark, sf):
    pw = preds_wide(spark, sf)
    # each fold's model scores only its held-out rows; the union covers every id once
    parts = [pw.where(F.col("fold") == k).select("id", "fold", F.col("proba_a").alias("proba")) for k in range(5)]
    return ensemble.assemble_oof(parts)


@register("oof_check", WP + "SELECT count(*) rows, count(DISTINCT id) ids, cast(0 AS bigint) duplicated, cast(0 AS bigint) missing, "
          "cast(0 AS bigint) unexpected FROM pw")
def oof_check(spark, sf):
    pw = preds_wide(spark, sf)
    parts = [pw.where(F.col("fold") == k).select("id", F.col("proba_a").alias("proba")) for k in range(5)]
    return ensemble.oof_check(ensemble.assemble_oof(parts), expected=pw)


@register("oof_check_gaps", WP + """, oof AS (SELECT id FROM pw WHERE fold <> 1 UNION ALL SELECT id FROM pw WHERE fold = 2)
SELECT (SELECT count(*) FROM oof) rows, (SELECT count(DISTINCT id) FROM oof) ids, (SELECT count(*) FROM pw WHERE fold = 2) duplicated,
(SELECT count(*) FROM pw WHERE fold = 1) missing, (SELECT count(*) FROM pw WHERE fold = 0) unexpected""")
def oof_check_gaps(spark, sf):
    """Fold 1 is never predicted, fold 2 twice, and fold 0 though it is not expected."""
    pw = preds_wide(spark, sf)
    parts = [pw.where(F.col("fold") == k).select("id", F.col("proba_a").alias("proba")) for k in (0, 2, 2, 3, 4)]
    return ensemble.oof_check(ensemble.assemble_oof(parts), expected=pw.where("fold <> 0"))


@register("template_fill", WP + "SELECT id, 'v1' version, CASE WHEN proba_a >= 0.5 THEN 'Stayed' ELSE 'Left' END retention_status "
          "FROM pw WHERE fold = 0")
def template_fill(spark, sf):
    pw = preds_wide(spark, sf)
    template = pw.where("fold = 0").select("id", F.lit("v1").alias("version"), F.lit("?").alias("retention_status"))
    preds = pw.select("id", X.threshold_label("proba_a", 0.5, "Stayed", "Left").alias("label"))
    return io.template_fill(template, preds, "id")


BAND = [0.72, 0.74, 0.75, 0.76, 0.78]


@register("multi_threshold_labels", WP + ", c AS (" + _thr_sql("pw", "proba_a", 10, 81, 100) + "),\n"
          "tuned AS (SELECT t FROM c ORDER BY " + _f1() + " DESC, i LIMIT 1),\n"
          "ths AS (SELECT 'tuned' tag, t FROM tuned UNION ALL SELECT replace(cast(t AS varchar), '.', 'p'), t FROM (VALUES " +
          ", ".join(f"({t})" for t in BAND) + ") v(t))\n"
          "SELECT tag, round(cast(t AS double), 6) threshold, id, CASE WHEN proba_a >= t THEN 'Stayed' ELSE 'Left' END label "
          "FROM ths, pw WHERE fold = 0")
def multi_threshold_labels(spark, sf):
    pw = preds_wide(spark, sf)
    tuned = search.best_threshold(pw, "y", "proba_a").select(F.lit("tuned").alias("tag"), "threshold")
    band = spark.createDataFrame([(t,) for t in BAND], "threshold double").select(
        X.threshold_tag(F.col("threshold"), 2).alias("tag"), "threshold")
    ths = tuned.unionByName(band)  # six thresholds
    path = shared_folder(spark, "by-threshold")
    io.write_by_threshold(pw.where("fold = 0"), ths, path, "proba_a", "Stayed", "Left")
    return io.read_by_threshold(spark, path).select("tag", "threshold", "id", "label")


OFFSETS = [-0.2, -0.1, 0.0, 0.1, 0.2]


@register("offset_threshold_labels", WM + ", offs AS (SELECT t + o th FROM best, (VALUES " +
          ", ".join(f"({o})" for o in OFFSETS) + ") v(o))\n"
          "SELECT replace(printf('%.4f', th), '.', 'p') tag, round(th, 6) threshold, id, "
          "CASE WHEN s >= th THEN 'Stayed' ELSE 'Left' END label FROM offs, sc WHERE fold = 0")
def offset_threshold_labels(spark, sf):
    m = _margins(spark, sf)
    best = search.best_threshold_margin(m, "y", "s", 300)
    offs = spark.createDataFrame([(o,) for o in OFFSETS], "o double")
    ths = best.crossJoin(offs).select((F.col("threshold") + F.col("o")).alias("threshold"))
    ths = ths.select(X.threshold_tag(F.col("threshold"), 4).alias("tag"), "threshold")
    path = shared_folder(spark, "by-offset")
    io.write_by_threshold(m.where("fold = 0"), ths, path, "s", "Stayed", "Left")
    return io.read_by_threshold(spark, path).select("tag", "threshold", "id", "label")


LEFT_OUT = ["lineitem", "orders"]


@register("source_discovery_filter", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{t}.parquet' file_name, count(*) n_rows FROM {t}" for t in fx.TABLES if t not in LEFT_OUT) + ")")
def source_discovery_filter(spark, sf):
    """Discovered tables, less the excluded ones, each read and counted."""
    left_out = [f"{t}.parquet" for t in LEFT_OUT]
    names = [r.file_name for r in io.discover_sources(spark, sf, "*.parquet", exclude_names=left_out).select("file_name").collect()]
    out = spark.createDataFrame([], "file_name string, n_rows long")
    for name in names:
        out = out.unionByName(spark.read.parquet(f"{sf}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("file_name", F.lit(name)))
    return out


# --- I9 nearest neighbours ---------------------------------------------------------------------------------------
KNN_ORACLE = (
    "WITH e AS (SELECT vec_id, embedding, label, row_number() OVER (PARTITION BY label ORDER BY md5(cast(vec_id AS varchar) || '|42'), vec_id) - 1 p, "
    "count(*) OVER (PARTITION BY label) n FROM embeddings),\n"
    "s AS (SELECT vec_id, embedding, label, CASE WHEN p < round(n * 0.2) THEN 1 ELSE 0 END is_test FROM e),\n"
    "d AS (SELECT q.vec_id qid, r.vec_id rid, r.label, list_sum(list_transform(list_zip(q.embedding, r.embedding), "
    "lambda x: (cast(x[1] AS double) - cast(x[2] AS double)) * (cast(x[1] AS double) - cast(x[2] AS double)))) d2 "
    "FROM s q, s r WHERE q.is_test = 1 AND r.is_test = 0),\n"
    "nn AS (SELECT qid, label FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, rid) rn FROM d) WHERE rn <= 7),\n"
    "v AS (SELECT qid, label, count(*) votes FROM nn GROUP BY ALL)\n"
    "SELECT qid vec_id, cast(label AS bigint) pred FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, label) rn "
    "FROM v) WHERE rn = 1")


def knn_sides(spark, sf):
    emb = fx.table(spark, sf, "embeddings")
    s = split.split_stratified(emb, "label", "vec_id", 0.2, 42)
    return s.where("is_test = 0"), s.where("is_test = 1")


@register("knn_vote", KNN_ORACLE)
def knn_vote(spark, sf):
    return neighbors.knn_vote(*knn_sides(spark, sf), 7, "vec_id", "embedding", "label")


@register("knn_vote_pruned", KNN_ORACLE)
def knn_vote_pruned(spark, sf):
    """Small cells, so that the second round has cells to skip at every scale."""
    return neighbors.knn_vote(*knn_sides(spark, sf), 7, "vec_id", "embedding", "label", cell_rows=64)


@register("knn_pruning_work", None)
def knn_pruning_work(spark, sf):
    """How many distances the pivots of ``knn_vote_pruned`` save against brute force."""
    return neighbors.knn_work(*knn_sides(spark, sf), 7, "vec_id", "embedding", "label", cell_rows=64)


@register("preview_head", WE + "SELECT id, status, n_orders FROM ee ORDER BY id LIMIT 5")
def preview_head(spark, sf):
    """``head()`` with an explicit order (K15): the limit is the feature."""
    return entity_rows(spark, sf).select("id", "status", "n_orders").orderBy("id").limit(5)
