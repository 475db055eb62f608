"""Queries: encoders, scalers, ranks, splits, lookups (F, G, H, I) and the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfold.operators import encode, scale, split
from sparkfold.plans import fixtures as fx
from sparkfold.plans.catalog import FF, WF, W, founders, register, founder_rows
from sparkfold.plans.flagship import TE_COLS, flagship

CATS = ["founder_role", "team_size_category", "startup_stage"]


# --- flagship --------------------------------------------------------------------------------
def _te_sql(src: str, col: str, m: float = 10.0) -> str:
    """CTEs te_<col>(v, fold, te) for out-of-fold smoothed target encoding over ``src``."""
    return f"""per_{col} AS (SELECT {col} v, fold, sum(y) s, count(*) n FROM {src} WHERE {col} IS NOT NULL GROUP BY 1, 2),
tot_{col} AS (SELECT v, sum(s) S, sum(n) N FROM per_{col} GROUP BY v),
te_{col} AS (SELECT t.v, f.fold, CASE WHEN t.N - coalesce(p.n, 0) > 0
    THEN (t.S - coalesce(p.s, 0) + {m} * g.g) / (t.N - coalesce(p.n, 0) + {m}) ELSE g.g END te
  FROM tot_{col} t CROSS JOIN (SELECT cast(range AS integer) fold FROM range(5)) f
  LEFT JOIN per_{col} p ON p.v = t.v AND p.fold = f.fold CROSS JOIN g_{src} g)"""


FLAGSHIP_SQL = W(("entity_base",), "e0 AS (SELECT *, " + fx.duck_fold_expr("id", "status") +
                 " AS fold, CASE WHEN status = 'Stayed' THEN 1 ELSE 0 END AS y FROM entity_base)",
                 "m AS (SELECT quantile_cont(acctbal, 0.5) med FROM e0 WHERE fold != 0)",
                 "ee AS (SELECT e0.* REPLACE (coalesce(acctbal, m.med) AS acctbal) FROM e0 CROSS JOIN m)",
                 "g_ee AS (SELECT avg(y) g FROM ee)",
                 *[_te_sql("ee", c) for c in TE_COLS]) + """
SELECT cast(ee.fold AS bigint) fold, count(*) n, round(avg(y), 6) target_rate,
  round(avg(coalesce(te_segment.te, g.g)), 6) segment_te_mean,
  round(avg(coalesce(te_nation.te, g.g)), 6) nation_te_mean,
  round(avg(coalesce(te_region.te, g.g)), 6) region_te_mean,
  round(avg(acctbal), 6) acctbal_mean,
  round(avg(total_spend / nullif(n_orders + 1.0, 0)), 6) spend_per_order_mean,
  round(avg(acctbal / nullif(avg_price + 1.0, 0)), 6) balance_ratio_mean
FROM ee CROSS JOIN g_ee g
LEFT JOIN te_segment ON ee.segment = te_segment.v AND ee.fold = te_segment.fold
LEFT JOIN te_nation ON ee.nation = te_nation.v AND ee.fold = te_nation.fold
LEFT JOIN te_region ON ee.region = te_region.v AND ee.fold = te_region.fold
GROUP BY ROLLUP (ee.fold)"""


@register("flagship_te_by_fold", FLAGSHIP_SQL)
def q_flagship(spark, sf):
    return flagship(spark, sf)


# --- F label encodings ------------------------------------------------------------------------
def _label_codes_sql(col: str, src: str = "ff", where: str = "WHERE fold != 0") -> str:
    w = f"{where} AND {col} IS NOT NULL" if where else f"WHERE {col} IS NOT NULL"
    return (f"lc_{col} AS (SELECT v, cast(row_number() OVER (ORDER BY v) - 1 AS bigint) code, "
            f"cast(count(*) OVER () AS bigint) n FROM (SELECT DISTINCT {col} v FROM {src} {w}))")


@register("encode_label", WF.rstrip() + ",\n" +
          ",\n".join(_label_codes_sql(c, where="") for c in CATS) + "\n" +
          "SELECT founder_id, " + ", ".join(f"coalesce(lc_{c}.code, (SELECT max(n) FROM lc_{c})) {c}" for c in CATS) +
          " FROM ff " + " ".join(f"LEFT JOIN lc_{c} ON ff.{c} = lc_{c}.v" for c in CATS))
def encode_label(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *CATS)
    return encode.apply_label(df, encode.fit_label(df, CATS), CATS)


@register("encode_label_unseen", WF.rstrip() + ",\n" + ",\n".join(_label_codes_sql(c) for c in CATS) + "\n" +
          "SELECT founder_id, " + ", ".join(f"coalesce(lc_{c}.code, (SELECT max(n) FROM lc_{c})) {c}" for c in CATS) +
          " FROM ff " + " ".join(f"LEFT JOIN lc_{c} ON ff.{c} = lc_{c}.v" for c in CATS) + " WHERE ff.fold = 0")
def encode_label_unseen(spark, sf):
    ff = founders(spark, sf)
    stats = encode.fit_label(ff, CATS, where="fold != 0")
    return encode.apply_label(ff.where("fold = 0").select("founder_id", *CATS), stats, CATS)


@register("encode_label_local", WF.rstrip() + ",\n" + _label_codes_sql("founder_role") + ",\n" +
          _label_codes_sql("education_background", where="WHERE fold = 0") + "\n" +
          "SELECT founder_id, coalesce(a.code, (SELECT max(n) FROM lc_founder_role)) founder_role, "
          "coalesce(b.code, (SELECT max(n) FROM lc_education_background)) education_background FROM ff "
          "LEFT JOIN lc_founder_role a ON ff.founder_role = a.v "
          "LEFT JOIN lc_education_background b ON ff.education_background = b.v WHERE fold = 0")
def encode_label_local(spark, sf):
    ff = founders(spark, sf)
    stats = encode.fit_label(ff, ["founder_role"], where="fold != 0")
    test = ff.where("fold = 0").select("founder_id", "founder_role", "education_background")
    # education_background has no fitted encoder: it is fitted on the test frame
    return encode.apply_label(test, stats, ["founder_role", "education_background"], fitted=["founder_role"])


@register("encode_label_combined", WF.rstrip() + ",\n" + _label_codes_sql("team_size_category", where="") + "\n" +
          "SELECT founder_id, coalesce(code, (SELECT max(n) FROM lc_team_size_category)) team_size_category "
          "FROM ff LEFT JOIN lc_team_size_category ON team_size_category = v WHERE fold = 0")
def encode_label_combined(spark, sf):
    ff = founders(spark, sf)
    train, test = ff.where("fold != 0"), ff.where("fold = 0")
    stats = encode.fit_label_combined([train, test], ["team_size_category"])
    return encode.apply_label(test.select("founder_id", "team_size_category"), stats, ["team_size_category"])


@register("encode_label_per_fold", WF + """, pres AS (
  SELECT DISTINCT f.fold, o.founder_role v FROM ff o CROSS JOIN (SELECT cast(range AS integer) fold FROM range(5)) f
  WHERE o.fold != f.fold AND o.founder_role IS NOT NULL),
codes AS (SELECT fold, v, cast(row_number() OVER (PARTITION BY fold ORDER BY v) - 1 AS bigint) code,
  cast(count(*) OVER (PARTITION BY fold) AS bigint) n FROM pres)
SELECT founder_id, cast(ff.fold AS bigint) fold,
  coalesce(c.code, (SELECT max(n) FROM codes c2 WHERE c2.fold = ff.fold)) founder_role
FROM ff LEFT JOIN codes c ON c.fold = ff.fold AND c.v = ff.founder_role""")
def encode_label_per_fold(spark, sf):
    ff = founders(spark, sf).select("founder_id", "fold", "founder_role")
    stats = encode.fit_label_per_fold(ff, ["founder_role"], "fold", 5)
    return encode.apply_label_per_fold(ff, stats, ["founder_role"], "fold")


@register("encode_target_roundtrip", WF + """, cls AS (SELECT v, cast(row_number() OVER (ORDER BY v) - 1 AS bigint) code
  FROM (SELECT DISTINCT retention_status v FROM ff))
SELECT founder_id, c.code y_code, d.v decoded FROM ff JOIN cls c ON ff.retention_status = c.v
JOIN cls d ON d.code = c.code""")
def encode_target_roundtrip(spark, sf):
    ff = founder_rows(spark, sf).select("founder_id", "retention_status")
    enc, classes = encode.label_roundtrip(ff, "retention_status", "y_code")
    dec = encode.decode_label(enc, classes, "y_code", "decoded")
    return dec.select("founder_id", "y_code", "decoded")


@register("encode_factorize", WF + """, codes AS (
  SELECT team_size_category v, cast(row_number() OVER (ORDER BY min(founder_id)) - 1 AS bigint) code
  FROM ff WHERE team_size_category IS NOT NULL GROUP BY team_size_category)
SELECT founder_id, coalesce(code, -1) team_size_code FROM ff LEFT JOIN codes ON team_size_category = v""")
def encode_factorize(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", "team_size_category")
    codes = encode.fit_factorize(df, "team_size_category", "founder_id")
    return encode.apply_factorize(df, codes, "team_size_category", "team_size_code").drop("team_size_category")


# --- F frequency encodings -------------------------------------------------------------------------
def _freq_sql(col: str, where_fit: str, nonnull: bool) -> str:
    w = f"WHERE {where_fit}" if where_fit else ""
    if nonnull:
        w = (w + " AND " if w else "WHERE ") + f"{col} IS NOT NULL"
    return (f"fq_{col} AS (SELECT {col} v, count(*) * 1.0 / sum(count(*)) OVER () f FROM ff {w} GROUP BY {col})")


@register("encode_freq", WF.rstrip() + ",\nfilled AS (SELECT founder_id, fold, coalesce(founder_role, 'Missing') "
          "founder_role, coalesce(team_size_category, 'Missing') team_size_category FROM ff),\n" +
          ",\n".join(_freq_sql(c, "fold != 0", False).replace("FROM ff", "FROM filled")
                     for c in ["founder_role", "team_size_category"]) +
          "\nSELECT founder_id, founder_role, team_size_category, " +
          ", ".join(f"round(coalesce(fq_{c}.f, 0.0), 6) {c}_freq" for c in ["founder_role", "team_size_category"]) +
          " FROM filled LEFT JOIN fq_founder_role ON filled.founder_role = fq_founder_role.v "
          "LEFT JOIN fq_team_size_category ON filled.team_size_category = fq_team_size_category.v WHERE fold = 0")
def encode_freq(spark, sf):
    from sparkfold.functions.exprs import fill_constant
    cols = ["founder_role", "team_size_category"]
    ff = fill_constant(founders(spark, sf), cols, "Missing")  # missing is a category (Q2)
    stats = encode.fit_freq(ff, cols, missing="exclude", where="fold != 0")
    return encode.apply_freq(ff.where("fold = 0").select("founder_id", *cols), stats, cols)


@register("encode_freq_nonnull", WF.rstrip() + ",\n" + ",\n".join(
    _freq_sql(c, "fold != 0", True) for c in ["founder_role", "team_size_category"]) +
    "\nSELECT founder_id, " + ", ".join(f"round(coalesce(fq_{c}.f, 0.0), 6) {c}_freq"
                                        for c in ["founder_role", "team_size_category"]) +
    " FROM ff LEFT JOIN fq_founder_role ON ff.founder_role = fq_founder_role.v "
    "LEFT JOIN fq_team_size_category ON ff.team_size_category = fq_team_size_category.v WHERE fold = 0")
def encode_freq_nonnull(spark, sf):
    cols = ["founder_role", "team_size_category"]
    ff = founders(spark, sf)
    stats = encode.fit_freq(ff, cols, missing="exclude", where="fold != 0")
    return encode.apply_freq(ff.where("fold = 0").select("founder_id", *cols), stats, cols).drop(*cols)


FREQ_POOLED = ["founder_role", "education_background", "personal_status", "startup_stage", "team_size_category",
               "founder_gender"]


@register("encode_freq_pooled", WF.rstrip() + ",\n" + ",\n".join(
    f"fq_{c} AS (SELECT {c} v, count(*) * 1.0 / (SELECT count(*) FROM ff) f FROM ff GROUP BY {c})"
    for c in FREQ_POOLED) + "\nSELECT founder_id, " + ", ".join(
    f"round(coalesce(fq_{c}.f, 0.0), 6) {c}_freq" for c in FREQ_POOLED) + " FROM ff " + " ".join(
    f"LEFT JOIN fq_{c} ON ff.{c} IS NOT DISTINCT FROM fq_{c}.v" for c in FREQ_POOLED))
def encode_freq_pooled(spark, sf):
    ff = founders(spark, sf)
    train, test = ff.where("fold != 0"), ff.where("fold = 0")
    stats = encode.fit_freq_pooled([train, test], FREQ_POOLED)
    pooled = train.unionByName(test)
    return encode.apply_freq(pooled.select("founder_id", *FREQ_POOLED), stats, FREQ_POOLED,
                             nullsafe=True).drop(*FREQ_POOLED)


@register("feat_freq_matrix", WF.rstrip() + ",\n" + ",\n".join(
    _freq_sql(c, "", True) for c in CATS) + "\nSELECT founder_id, round(founder_age, 6) founder_age, "
    "round(years_since_founding, 6) years_since_founding, " + ", ".join(
        f"round(coalesce(fq_{c}.f, 0.0), 6) {c}_freq" for c in CATS) + " FROM ff " + " ".join(
    f"LEFT JOIN fq_{c} ON ff.{c} = fq_{c}.v" for c in CATS))
def feat_freq_matrix(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", "founder_age", "years_since_founding", *CATS)
    stats = encode.fit_freq(df, CATS, missing="exclude")
    return encode.apply_freq(df, stats, CATS, drop_original=True)  # B13, F11


# --- F12 one-hot ---------------------------------------------------------------------------------------
@register("encode_onehot", WF.rstrip() + ",\n" + _label_codes_sql("founder_role") + "\n" +
          "SELECT founder_id, (SELECT max(n) FROM lc_founder_role) ohe_size, coalesce(code, -1) ohe_hot "
          "FROM ff LEFT JOIN lc_founder_role ON founder_role = v WHERE fold = 0")
def encode_onehot(spark, sf):
    from pyspark.ml.functions import vector_to_array
    ff = founders(spark, sf)
    model = encode.onehot_model(ff.where("fold != 0"), ["founder_role"])
    out = model.transform(ff.where("fold = 0").select("founder_id", "founder_role"))
    arr = vector_to_array(F.col("founder_role_ohe"))
    return out.select("founder_id", F.size(arr).alias("ohe_size"),
                      (F.array_position(arr, 1.0) - 1).alias("ohe_hot"))


# --- F13-F16 target encodings ------------------------------------------------------------------------------
TE_F = ["founder_role", "team_size_category", "education_background"]


@register("encode_target_smooth", WF + """, g_ff AS (SELECT avg(y) g FROM ff WHERE fold != 0),
st AS (SELECT founder_role v, (sum(y) + 10.0 * (SELECT g FROM g_ff)) / (count(*) + 10.0) te
  FROM ff WHERE fold != 0 AND founder_role IS NOT NULL GROUP BY founder_role)
SELECT founder_id, round(coalesce(te, (SELECT g FROM g_ff)), 6) founder_role_te
FROM ff LEFT JOIN st ON founder_role = v WHERE fold = 0""")
def encode_target_smooth(spark, sf):
    ff = founders(spark, sf)
    stats, g = encode.fit_target_smooth(ff, ["founder_role"], "y", 10.0, where="fold != 0")
    return encode.apply_target(ff.where("fold = 0").select("founder_id", "founder_role"), stats, g,
                               ["founder_role"]).drop("founder_role")


WTE = W(("founder_base",), FF, "g_ff AS (SELECT avg(y) g FROM ff)", *[_te_sql("ff", c) for c in TE_F])


@register("encode_target_kfold", WTE + "SELECT founder_id, " + ", ".join(
    f"round(coalesce(te_{c}.te, (SELECT g FROM g_ff)), 6) {c}_te" for c in TE_F) + " FROM ff " + " ".join(
    f"LEFT JOIN te_{c} ON ff.{c} = te_{c}.v AND ff.fold = te_{c}.fold" for c in TE_F))
def encode_target_kfold(spark, sf):
    ff = founders(spark, sf).select("founder_id", "fold", "y", *TE_F)
    fold_stats, _, g = encode.fit_target_kfold(ff, TE_F, "y", "fold", 5, 10.0)
    return encode.apply_target(ff, fold_stats, g, TE_F, fold_col="fold").drop(*TE_F, "fold", "y")


@register("project_suffix", WTE + "SELECT founder_id, " + ", ".join(
    f"round(coalesce(te_{c}.te, (SELECT g FROM g_ff)), 6) {c}_te" for c in TE_F) + " FROM ff " + " ".join(
    f"LEFT JOIN te_{c} ON ff.{c} = te_{c}.v AND ff.fold = te_{c}.fold" for c in TE_F))
def project_suffix(spark, sf):
    ff = founders(spark, sf)
    fold_stats, _, g = encode.fit_target_kfold(ff, TE_F, "y", "fold", 5, 10.0)
    enc = encode.apply_target(ff, fold_stats, g, TE_F, fold_col="fold")
    return enc.select("founder_id", enc.colRegex("`.*_te$`"))  # B6


@register("encode_target_test_avg", WTE + ", tavg AS (SELECT v, avg(te) te FROM te_founder_role GROUP BY v)\n"
          "SELECT e.id, round(coalesce(tavg.te, (SELECT g FROM g_ff)), 6) segment_te FROM entity_base e "
          "LEFT JOIN tavg ON e.segment = tavg.v")
def encode_target_test_avg(spark, sf):
    # encoder fitted on the founder view (founder_role = segment), applied to a second frame
    ff = founders(spark, sf)
    _, test_stats, g = encode.fit_target_kfold(ff, ["founder_role"], "y", "fold", 5, 10.0)
    test_stats = test_stats.withColumn("column", F.lit("segment"))
    eb = fx.view(spark, sf, "entity_base").select("id", "segment")
    return encode.apply_target(eb, test_stats, g, ["segment"]).drop("segment")


def _inner_fold(c: str = "founder_id") -> str:
    return (f"cast((row_number() OVER (PARTITION BY retention_status ORDER BY md5(cast({c} AS varchar) || '|7'), "
            f"{c}) - 1) % 5 AS integer)")


WMAIN = W(("founder_base",), FF, f"mm AS (SELECT * REPLACE ({_inner_fold()} AS fold) FROM ff WHERE fold >= 2)",
          "g_mm AS (SELECT avg(y) g FROM mm)", _te_sql("mm", "founder_role"),
          "full_st AS (SELECT founder_role v, (sum(y) + 10.0 * (SELECT g FROM g_mm)) / (count(*) + 10.0) te "
          "FROM mm WHERE founder_role IS NOT NULL GROUP BY founder_role)",
          "tavg AS (SELECT v, avg(te) te FROM te_founder_role GROUP BY v)")


@register("encode_target_holdout", WMAIN + """SELECT founder_id, 'MAIN' part, round(coalesce(t.te, (SELECT g FROM g_mm)), 6) te
FROM mm LEFT JOIN te_founder_role t ON mm.founder_role = t.v AND mm.fold = t.fold
UNION ALL SELECT founder_id, 'HOLDOUT', round(coalesce(s.te, (SELECT g FROM g_mm)), 6)
FROM ff LEFT JOIN full_st s ON ff.founder_role = s.v WHERE ff.fold = 1
UNION ALL SELECT founder_id, 'TEST', round(coalesce(a.te, (SELECT g FROM g_mm)), 6)
FROM ff LEFT JOIN tavg a ON ff.founder_role = a.v WHERE ff.fold = 0""")
def encode_target_holdout(spark, sf):
    """MAIN (folds 2-4): k-fold inside MAIN; HOLDOUT (fold 1): full-MAIN stats; TEST (fold 0): fold mean (F16)."""
    ff = founders(spark, sf).select("founder_id", "fold", "y", "retention_status", "founder_role")
    main = split.assign_folds(ff.where("fold >= 2").drop("fold"), "retention_status", "founder_id", 5, seed=7)
    fold_stats, test_stats, g = encode.fit_target_kfold(main, ["founder_role"], "y", "fold", 5, 10.0)
    full_stats, g_full = encode.fit_target_smooth(main, ["founder_role"], "y", 10.0)
    m = encode.apply_target(main, fold_stats, g, ["founder_role"], fold_col="fold")
    h = encode.apply_target(ff.where("fold = 1"), full_stats, g_full, ["founder_role"])
    t = encode.apply_target(ff.where("fold = 0"), test_stats, g, ["founder_role"])
    pick = [F.col("founder_id"), F.col("founder_role_te").alias("te")]
    return (m.select(pick[0], F.lit("MAIN").alias("part"), pick[1])
            .unionByName(h.select(pick[0], F.lit("HOLDOUT").alias("part"), pick[1]))
            .unionByName(t.select(pick[0], F.lit("TEST").alias("part"), pick[1])))


# --- G scalers and ranks ---------------------------------------------------------------------------------------
SC = ["founder_age", "monthly_revenue_generated", "years_with_startup"]


def _std_sql(where_fit: str, where_rows: str) -> str:
    stats = ", ".join(f"avg({c}) m_{c}, stddev_pop({c}) s_{c}" for c in SC)
    cols = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) {c}" for c in SC)
    return WF + f", st AS (SELECT {stats} FROM ff {where_fit})\nSELECT founder_id, {cols} FROM ff CROSS JOIN st {where_rows}"


@register("scale_standard", _std_sql("WHERE fold != 0", "WHERE fold = 0"))
def scale_standard(spark, sf):
    ff = founders(spark, sf)
    stats = scale.fit_standard(ff, SC, where="fold != 0")
    return scale.apply_standard(ff.where("fold = 0").select("founder_id", *SC), stats, SC)


@register("scale_standard_per_fold", WF + ", st AS (SELECT f.fold, " + ", ".join(
    f"avg(o.{c}) m_{c}, stddev_pop(o.{c}) s_{c}" for c in SC) +
    " FROM ff o JOIN (SELECT cast(range AS integer) fold FROM range(5)) f ON o.fold != f.fold GROUP BY f.fold)\n"
    "SELECT founder_id, " + ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) {c}" for c in SC) +
    " FROM ff JOIN st ON ff.fold = st.fold")
def scale_standard_per_fold(spark, sf):
    ff = founders(spark, sf).select("founder_id", "fold", *SC)
    stats = scale.fit_standard_per_fold(ff, SC, "fold", 5)
    return scale.apply_standard(ff, stats, SC, fold_col="fold").drop("fold")


@register("scale_robust", WF + ", st AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) s_{c}" for c in SC) +
    " FROM ff WHERE fold != 0)\nSELECT founder_id, " + ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) {c}" for c in SC) +
    " FROM ff CROSS JOIN st WHERE fold = 0")
def scale_robust(spark, sf):
    ff = founders(spark, sf)
    stats = scale.fit_robust(ff, SC, where="fold != 0")
    return scale.apply_robust(ff.where("fold = 0").select("founder_id", *SC), stats, SC)


RK = ["founder_age", "monthly_revenue_generated", "num_dependents"]


def _rank_sql(c: str) -> str:
    return (f"round(CASE WHEN {c} IS NULL THEN NULL ELSE (rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c}) - 1 + "
            f"(count(*) OVER (PARTITION BY {c}) + 1) / 2.0) / count({c}) OVER () END, 6) {c}_rank")


@register("rank_pct", WF + "SELECT founder_id, " + ", ".join(_rank_sql(c) for c in RK) + " FROM ff")
def rank_pct(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *RK)
    return scale.rank_pct(df, RK).drop(*RK)


@register("rank_pct_default", WF + "SELECT founder_id, " + _rank_sql("founder_age") +
          ", cast(0.5 AS double) salary_rank FROM ff WHERE fold = 0")
def rank_pct_default(spark, sf):
    test = founders(spark, sf).where("fold = 0").select("founder_id", "founder_age")
    stats = scale.fit_rank_pct(test, ["founder_age"])  # ranks are per frame
    return scale.apply_rank_pct(test, stats, ["founder_age", "salary"]).drop("founder_age")


# --- H splits -------------------------------------------------------------------------------------------------------
def _pos(seed: int, key: str = "id", label: str = "status", src: str = "entity_base") -> str:
    return (f"(row_number() OVER (PARTITION BY {label} ORDER BY md5(cast({key} AS varchar) || '|{seed}'), {key}) - 1)")


WEB = W(("entity_base",))


@register("split_kfold", WEB + "SELECT id, cast(" + _pos(42) + " % 5 AS bigint) fold FROM entity_base")
def split_kfold(spark, sf):
    return split.assign_folds(fx.view(spark, sf, "entity_base"), "status", "id", 5, 42).select("id", "fold")


WNL = WEB.rstrip() + ",\nnl AS (SELECT id, CASE WHEN id % 10 = 0 THEN NULL ELSE status END status FROM entity_base)\n"


@register("split_kfold_null_label", WNL + "SELECT id, cast(" + _pos(42) + " % 5 AS bigint) fold FROM nl")
def split_kfold_null_label(spark, sf):
    """Rows without a label are a class of their own; none is lost."""
    label = F.when(F.col("id") % 10 != 0, F.col("status")).alias("status")
    return split.assign_folds(fx.view(spark, sf, "entity_base").select("id", label), "status", "id", 5, 42).select("id", "fold")


@register("split_stratified", WEB + "SELECT id, cast(CASE WHEN " + _pos(42) +
          " < round(count(*) OVER (PARTITION BY status) * 0.2) THEN 1 ELSE 0 END AS bigint) is_test FROM entity_base")
def split_stratified(spark, sf):
    return split.split_stratified(fx.view(spark, sf, "entity_base"), "status", "id", 0.2, 42).select("id", "is_test")


@register("sample_fraction", WEB + "SELECT id, status FROM (SELECT id, status, " + _pos(42) + " p, "
          "count(*) OVER (PARTITION BY status) n FROM entity_base) WHERE p < round(n * 0.5)")
def sample_fraction(spark, sf):
    return split.sample_fraction(fx.view(spark, sf, "entity_base"), "status", 0.5, "id", 42).select("id", "status")


@register("split_nested", WEB + ", s AS (SELECT id, status FROM (SELECT id, status, " + _pos(42) + " p, "
          "count(*) OVER (PARTITION BY status) n FROM entity_base) WHERE p < round(n * 0.2))\n"
          "SELECT id, cast(CASE WHEN " + _pos(7, src="s") + " < round(count(*) OVER (PARTITION BY status) * 0.2) "
          "THEN 1 ELSE 0 END AS bigint) is_test FROM s")
def split_nested(spark, sf):
    eb = fx.view(spark, sf, "entity_base")
    return split.split_nested(eb, "status", 0.2, 0.2, "id", 42, 7).select("id", "is_test")


# --- M9 ordered target statistics -----------------------------------------------------------------------------
ORDERED = ["founder_role", "team_size_category", "education_background"]


def _ordered_sql() -> str:
    head = WF.rstrip() + ",\nmain AS (SELECT * FROM ff WHERE fold != 0), g AS (SELECT avg(y) g FROM main)"
    w = "(PARTITION BY {c} ORDER BY md5(cast(founder_id AS varchar) || '|42'), founder_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    first = ", ".join(f"round((coalesce(sum(y) OVER {w.format(c=c)}, 0) + (SELECT g FROM g)) / (count(*) OVER {w.format(c=c)} + 1.0), 6) {c}_ots" for c in ORDERED)
    then = ", ".join(f"round(coalesce((SELECT (sum(y) + (SELECT g FROM g)) / (count(*) + 1.0) FROM main m WHERE m.{c} IS NOT DISTINCT FROM t.{c} HAVING count(*) > 0), "
                     f"(SELECT g FROM g)), 6) {c}_ots" for c in ORDERED)
    return f"{head}\nSELECT founder_id, 'train' part, {first} FROM main UNION ALL SELECT founder_id, 'test', {then} FROM ff t WHERE fold = 0"


@register("encode_ordered_target", _ordered_sql())
def encode_ordered_target(spark, sf):
    """Training rows from the earlier rows of their category, TEST rows from all training rows (M9)."""
    ff = founders(spark, sf)
    values, totals = encode.fit_ordered_target(ff.where("fold != 0"), ORDERED, "y", "founder_id")
    test = encode.apply_ordered_target(ff.where("fold = 0"), totals, ORDERED).select(values.columns)
    return values.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
