"""Queries: sources, projections, cleaning, imputation, features, bins (A1, B, C, D, E)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.functions import exprs as X
from sparkfold.functions import features as FT
from sparkfold.operators import binning, encode, impute, split
from sparkfold.plans import fixtures as fx
from sparkfold.plans.catalog import WE, WF, WP, W, founders, preds_wide, register, founder_rows
from sparkfold.sources import io

NUM_F = ["founder_age", "years_with_startup", "monthly_revenue_generated", "funding_rounds_led",
         "distance_from_investor_hub", "num_dependents", "years_since_founding"]


def _med(c: str, where: str = "") -> str:
    return f"(SELECT quantile_cont({c}, 0.5) FROM ff {where})"


# --- A1 typed scan --------------------------------------------------------------------------
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


@register("scan_typed", "SELECT c_custkey, c_name, cast(c_nationkey AS bigint) c_nationkey, "
          "round(c_acctbal, 6) c_acctbal, c_mktsegment FROM customer")
def scan_typed(spark, sf):
    return io.read_typed(spark, f"{sf}/customer.parquet", CUSTOMER_SCHEMA, fmt="parquet")


# --- B projections / filters ---------------------------------------------------------------
@register("project_drop", WF + "SELECT founder_id, round(founder_age, 6) founder_age, founder_role, "
          "cast(fold AS bigint) fold FROM ff")
def project_drop(spark, sf):
    df = founders(spark, sf).select("founder_id", "founder_age", "founder_role", "fold", "retention_status", "y")
    return df.drop("retention_status", "y", "no_such_column")  # tolerant drop (B1)


@register("align_columns", WF + "SELECT founder_id, round(founder_age, 6) founder_age, founder_role FROM ff "
          "WHERE fold = 0")
def align_columns(spark, sf):
    ff = founders(spark, sf)
    train = ff.where("fold != 0").select("founder_id", "founder_age", "founder_role", "retention_status")
    test = ff.where("fold = 0").select("founder_role", "founder_id", "founder_age",
                                       F.lit(1).alias("test_only"))
    return io.align_columns(train, test, exclude=["retention_status"])[1]


@register("split_main_holdout", WF + "SELECT founder_id, CASE WHEN fold = 0 THEN 'HOLDOUT' ELSE 'MAIN' END part "
          "FROM ff")
def split_main_holdout(spark, sf):
    main, hold = split.main_holdout(founders(spark, sf))
    return main.select("founder_id", F.lit("MAIN").alias("part")).unionByName(
        hold.select("founder_id", F.lit("HOLDOUT").alias("part")))


@register("pooled_union", WF + "SELECT founder_id, retention_status, cast(1 AS bigint) AS _is_train FROM ff "
          "WHERE fold != 0 UNION ALL SELECT founder_id, NULL, cast(0 AS bigint) FROM ff WHERE fold = 0")
def pooled_union(spark, sf):
    ff = founders(spark, sf)
    train = ff.where("fold != 0").select("founder_id", "retention_status")
    test = ff.where("fold = 0").select("founder_id")
    return io.pooled_union(train, test)


@register("pooled_split_back", WF + """, pooled AS (
  SELECT founder_id, founder_role, 1 AS _is_train FROM ff WHERE fold != 0
  UNION ALL SELECT founder_id, founder_role, 0 FROM ff WHERE fold = 0),
fr AS (SELECT founder_role v, count(*) * 1.0 / (SELECT count(*) FROM pooled) f FROM pooled GROUP BY founder_role)
SELECT p.founder_id, round(coalesce(fr.f, 0.0), 6) founder_role_freq
FROM pooled p LEFT JOIN fr ON p.founder_role IS NOT DISTINCT FROM fr.v WHERE p._is_train = 0""")
def pooled_split_back(spark, sf):
    ff = founders(spark, sf)
    train = ff.where("fold != 0").select("founder_id", "founder_role", "retention_status")
    test = ff.where("fold = 0").select("founder_id", "founder_role")
    pooled = io.pooled_union(train, test)
    stats = encode.fit_freq(pooled, ["founder_role"], missing="category")
    enc = encode.apply_freq(pooled, stats, ["founder_role"], nullsafe=True)
    _, test_back = io.split_back(enc)
    return test_back.select("founder_id", "founder_role_freq")


@register("semi_join_ids", WF + "SELECT founder_id, founder_role FROM ff WHERE founder_id IN "
          "(SELECT founder_id FROM ff WHERE fold = 0)")
def semi_join_ids(spark, sf):
    ff = founders(spark, sf)
    ids = ff.where("fold = 0").select("founder_id")  # split shared by a second feature view (H6)
    view_b = fx.view(spark, sf, "founder_base").select("founder_id", "founder_role")
    return view_b.join(ids, "founder_id", "left_semi")


@register("anti_join_ids", WF + "SELECT founder_id, founder_role FROM ff WHERE founder_id NOT IN "
          "(SELECT founder_id FROM ff WHERE fold = 0)")
def anti_join_ids(spark, sf):
    ff = founders(spark, sf)
    ids = ff.where("fold = 0").select("founder_id")
    view_b = fx.view(spark, sf, "founder_base").select("founder_id", "founder_role")
    return view_b.join(ids, "founder_id", "left_anti")


@register("target_domain", WF + """SELECT retention_status class,
  cast(row_number() OVER (ORDER BY retention_status) - 1 AS bigint) code,
  cast(count(*) OVER () AS bigint) n_classes
FROM (SELECT DISTINCT retention_status FROM ff WHERE retention_status IS NOT NULL)""")
def target_domain(spark, sf):
    return io.target_domain(founder_rows(spark, sf), "retention_status")


# --- C cleaning / imputation ----------------------------------------------------------------
WD = W(("entity_base",), """dirty AS (SELECT id,
  CASE WHEN id % 97 = 0 THEN cast('NaN' AS double) WHEN id % 89 = 0 THEN cast('Infinity' AS double)
       WHEN id % 83 = 0 THEN cast('-Infinity' AS double) ELSE acctbal END x_num,
  CASE WHEN id % 5 = 0 THEN 'abc' WHEN id % 5 = 1 THEN cast(n_orders AS string) || 'e1'
       WHEN id % 5 = 2 THEN '' ELSE cast(n_orders AS string) END x_text
FROM entity_base)""")


def _dirty(spark, sf):
    eb = fx.view(spark, sf, "entity_base")
    x_num = (F.when(F.col("id") % 97 == 0, F.lit(float("nan")))
             .when(F.col("id") % 89 == 0, F.lit(float("inf")))
             .when(F.col("id") % 83 == 0, F.lit(float("-inf"))).otherwise(F.col("acctbal")))
    x_text = (F.when(F.col("id") % 5 == 0, F.lit("abc"))
              .when(F.col("id") % 5 == 1, F.concat(F.col("n_orders").cast("string"), F.lit("e1")))
              .when(F.col("id") % 5 == 2, F.lit("")).otherwise(F.col("n_orders").cast("string")))
    return eb.select("id", x_num.alias("x_num"), x_text.alias("x_text"))


@register("clean_nonfinite", WD + "SELECT id, round(CASE WHEN isnan(x_num) OR isinf(x_num) THEN NULL "
          "ELSE x_num END, 6) x_num FROM dirty")
def clean_nonfinite(spark, sf):
    d = _dirty(spark, sf)
    return d.select("id", X.nonfinite_to_null("x_num").alias("x_num"))


@register("clean_try_cast", WD + "SELECT id, round(try_cast(x_text AS double), 6) x_text FROM dirty")
def clean_try_cast(spark, sf):
    return X.clean_numeric(_dirty(spark, sf).select("id", "x_text"), ["x_text"])


def _imputed_sql(where_fit: str, where_rows: str) -> str:
    cols = ", ".join(f"round(coalesce({c}, {_med(c, where_fit)}), 6) {c}" for c in NUM_F)
    return WF + f"SELECT founder_id, {cols} FROM ff {where_rows}"


@register("impute_median", _imputed_sql("", ""))
def impute_median(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *NUM_F)
    return impute.apply_fill(df, impute.fit_median(df, NUM_F), NUM_F)


@register("impute_median_fit_apply", _imputed_sql("WHERE fold != 0", "WHERE fold = 0"))
def impute_median_fit_apply(spark, sf):
    ff = founders(spark, sf)
    stats = impute.fit_median(ff, NUM_F, where="fold != 0")
    return impute.apply_fill(ff.where("fold = 0").select("founder_id", *NUM_F), stats, NUM_F)


@register("impute_median_pooled", _imputed_sql("", "WHERE fold = 0"))
def impute_median_pooled(spark, sf):
    ff = founders(spark, sf)
    train, test = ff.where("fold != 0"), ff.where("fold = 0")
    stats = impute.fit_median_pooled([train, test], NUM_F)
    return impute.apply_fill(test.select("founder_id", *NUM_F), stats, NUM_F)


@register("impute_median_holdout", _imputed_sql("WHERE fold = 1", "WHERE fold = 0"))
def impute_median_holdout(spark, sf):
    ff = founders(spark, sf)
    stats = impute.fit_median(ff, NUM_F, where="fold = 1")  # HOLDOUT
    return impute.apply_fill(ff.where("fold = 0").select("founder_id", *NUM_F), stats, NUM_F)


def _per_fold_med(c: str) -> str:
    return f"(SELECT quantile_cont(i.{c}, 0.5) FROM ff i WHERE i.fold != o.fold)"


@register("impute_median_per_fold", WF + "SELECT founder_id, cast(fold AS bigint) fold, " + ", ".join(
    f"round(coalesce({c}, {_per_fold_med(c)}), 6) {c}" for c in NUM_F) + " FROM ff o")
def impute_median_per_fold(spark, sf):
    ff = founders(spark, sf).select("founder_id", "fold", *NUM_F)
    stats = impute.fit_median_per_fold(ff, NUM_F, "fold", 5)
    return impute.apply_fill(ff, stats, NUM_F, fold_col="fold")


MODE_COLS = ["work_life_balance_rating", "venture_satisfaction", "team_size_category"]


def _mode_sql(c: str, src: str = "ff", where: str = "") -> str:
    w = f"WHERE {c} IS NOT NULL" + (f" AND {where}" if where else "")
    return f"(SELECT {c} FROM {src} i {w} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@register("impute_mode", WF + "SELECT founder_id, " + ", ".join(
    f"coalesce({c}, {_mode_sql(c)}) {c}" for c in MODE_COLS) + " FROM ff WHERE fold = 0")
def impute_mode(spark, sf):
    ff = founders(spark, sf)
    train, test = ff.where("fold != 0"), ff.where("fold = 0")
    stats = impute.fit_mode_pooled([train, test], MODE_COLS)
    return impute.apply_fill(test.select("founder_id", *MODE_COLS), stats, MODE_COLS)


@register("impute_mode_fit_apply", WF + "SELECT founder_id, " + ", ".join(
    f"coalesce({c}, {_mode_sql(c, where='i.fold != o.fold')}) {c}" for c in ["team_size_category", "founder_role"])
    + " FROM ff o")
def impute_mode_fit_apply(spark, sf):
    cols = ["team_size_category", "founder_role"]
    ff = founders(spark, sf).select("founder_id", "fold", *cols)
    stats = impute.fit_mode_per_fold(ff, cols, "fold", 5)
    return impute.apply_fill(ff, stats, cols, fold_col="fold").drop("fold")


NUM_MODES = ["funding_rounds_led", "num_dependents"]


@register("impute_mode_numeric_per_fold", WF + "SELECT founder_id, " + ", ".join(
    f"round(coalesce({c}, {_mode_sql(c, where='i.fold != o.fold')}), 6) {c}" for c in NUM_MODES) + " FROM ff o")
def impute_mode_numeric_per_fold(spark, sf):
    ff = founders(spark, sf).select("founder_id", "fold", *[F.col(c).cast("double").alias(c) for c in NUM_MODES])
    stats = impute.fit_mode_per_fold(ff, NUM_MODES, "fold", 5)
    return impute.apply_fill(ff, stats, NUM_MODES, fold_col="fold").drop("fold")


@register("impute_constant", WF + "SELECT founder_id, coalesce(founder_role, 'Missing') founder_role, "
          "coalesce(team_size_category, 'Missing') team_size_category FROM ff")
def impute_constant(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", "founder_role", "team_size_category")
    return X.fill_constant(df, ["founder_role", "team_size_category"], "Missing")


# --- D features -------------------------------------------------------------------------------
def _r(a: str, b: str) -> str:
    return f"round({a} / nullif({b} + 1.0, 0), 6)"


@register("feat_ratios", WF + "SELECT founder_id, " + ", ".join([
    _r("years_with_startup", "founder_age") + " experience_ratio",
    _r("funding_rounds_led", "years_since_founding") + " funding_per_year",
    _r("monthly_revenue_generated", "years_since_founding") + " revenue_per_year",
    _r("num_dependents", "founder_age") + " dependents_ratio",
    _r("distance_from_investor_hub", "years_since_founding") + " distance_adjusted",
    _r("years_with_startup", "years_since_founding") + " tenure_ratio",
    _r("founder_age", "num_dependents") + " age_per_dependent"]) + " FROM ff")
def feat_ratios(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *NUM_F)
    out = FT.add_features(df, FT.RATIOS_F + FT.RATIOS_F_POOLED[2:])
    return out.drop(*NUM_F)


@register("feat_differences", WF + "SELECT founder_id, round(founder_age - years_since_founding, 6) "
          "age_at_founding FROM ff")
def feat_differences(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *NUM_F)
    return FT.add_features(df, FT.DIFFERENCES).drop(*NUM_F)  # balance_gap needs family S: skipped (B2)


@register("feat_log1p", WF + "SELECT founder_id, round(CASE WHEN monthly_revenue_generated > -1 THEN "
          "ln(1 + monthly_revenue_generated) END, 6) monthly_revenue_log, round(CASE WHEN "
          "distance_from_investor_hub > -1 THEN ln(1 + distance_from_investor_hub) END, 6) distance_log FROM ff")
def feat_log1p(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", "monthly_revenue_generated", "distance_from_investor_hub")
    df = FT.add_features(df, FT.LOGS + [FT.Feature("distance_log", ("distance_from_investor_hub",),
                                                   X.log1p_guarded)])
    return df.drop("monthly_revenue_generated", "distance_from_investor_hub")


WS = W(("founder_s",))
S_COLS = ["stress_level", "hours_worked_per_week", "revenue", "team_size", "funding_amount", "salary",
          "work_life_balance_rating"]


@register("feat_ratios_s", WS + "SELECT founder_id, " + ", ".join([
    _r("stress_level", "hours_worked_per_week") + " stress_per_hour",
    _r("revenue", "team_size") + " revenue_per_member",
    _r("funding_amount", "team_size") + " funding_per_member",
    _r("salary", "revenue") + " salary_revenue_ratio",
    _r("hours_worked_per_week", "work_life_balance_rating") + " workload_ratio",
    _r("revenue", "salary") + " revenue_div_salary",
    _r("funding_amount", "revenue") + " funding_div_revenue",
    "round(stress_level - work_life_balance_rating, 6) + 0.0 balance_gap"]) + " FROM founder_s")
def feat_ratios_s(spark, sf):
    df = fx.view(spark, sf, "founder_s")
    return FT.add_features(df, FT.RATIOS_S + FT.DIFFERENCES).drop(*S_COLS, "status")


@register("feat_products", WS + "SELECT founder_id, round(stress_level * hours_worked_per_week, 6) stress_x_hours, "
          "round(salary * stress_level, 6) salary_x_stress FROM founder_s")
def feat_products(spark, sf):
    return FT.add_features(fx.view(spark, sf, "founder_s"), FT.PRODUCTS_S).drop(*S_COLS, "status")


def _map_sql(c: str, m: dict, lower: bool = True) -> str:
    key = f"lower(trim({c}))" if lower else c
    whens = " ".join(f"WHEN '{k}' THEN cast({float(v)} AS double)" for k, v in m.items())
    return f"CASE {key} {whens} END"


SCORE_SQL = {o: _map_sql(i, m) for o, i, m in FT.SCORE_SOURCES}
SCORE_SQL_CASED = {o: f"coalesce({_map_sql(i, FT.RATING_MAP_CASED, lower=False)}, cast(1.0 AS double))"
                   for o, i, _ in FT.SCORE_SOURCES}
RATING_COLS = [i for _, i, _ in FT.SCORE_SOURCES]


@register("feat_ordinal_map", WF + "SELECT founder_id, " + ", ".join(
    f"{e} {o}" for o, e in SCORE_SQL.items()) + " FROM ff")
def feat_ordinal_map(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *RATING_COLS)
    return FT.add_features(df, FT.ORDINAL_SCORES).drop(*RATING_COLS)


@register("feat_ordinal_map_default", WF + "SELECT founder_id, " + ", ".join(
    f"{e} {o}" for o, e in SCORE_SQL_CASED.items()) + " FROM ff")
def feat_ordinal_map_default(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *RATING_COLS)
    return FT.add_features(df, FT.ORDINAL_SCORES_DEFAULT).drop(*RATING_COLS)


FLAG_SQL = {f"{c}_flag": f"CASE WHEN lower({c}) = 'yes' THEN 1 ELSE 0 END" for c in FT.FLAG_SOURCES}


@register("feat_flags", WF + "SELECT founder_id, " + ", ".join(
    f"cast({e} AS bigint) {o}" for o, e in FLAG_SQL.items()) + " FROM ff")
def feat_flags(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *FT.FLAG_SOURCES)
    return FT.add_features(df, FT.FLAGS).drop(*FT.FLAG_SOURCES)


@register("feat_interactions_pooled", WF + f""", s AS (SELECT founder_id,
  {SCORE_SQL_CASED['wlb_score']} wlb, {SCORE_SQL_CASED['satisfaction_score']} sat,
  {SCORE_SQL_CASED['performance_score']} perf, {SCORE_SQL_CASED['reputation_score']} rep,
  {SCORE_SQL_CASED['visibility_score']} vis,
  {FLAG_SQL['working_overtime_flag']} ot, {FLAG_SQL['remote_operations_flag']} rm FROM ff)
SELECT founder_id, cast(rm * ot AS double) remote_and_overtime, round(wlb * ot, 6) wlb_overtime_interaction,
  round(sat * perf, 6) satisfaction_performance_interaction, round(rep * vis, 6) reputation_visibility_interaction
FROM s""")
def feat_interactions_pooled(spark, sf):
    src = RATING_COLS + FT.FLAG_SOURCES
    df = founder_rows(spark, sf).select("founder_id", *src)
    out = FT.add_features(df, FT.ORDINAL_SCORES_DEFAULT + FT.FLAGS + FT.INTERACTIONS_POOLED)
    return out.select("founder_id", *[f.name for f in FT.INTERACTIONS_POOLED])


def _interactions_sql(visibility: str) -> str:
    return WF + f""", s AS (SELECT founder_id, {visibility} vis,
  {SCORE_SQL['wlb_score']} wlb, {SCORE_SQL['satisfaction_score']} sat,
  {SCORE_SQL['performance_score']} perf, {SCORE_SQL['reputation_score']} rep,
  distance_from_investor_hub / nullif(years_since_founding + 1.0, 0) dadj FROM ff)
SELECT founder_id, round(1.0 / nullif(wlb + 1.0, 0), 6) stress_factor,
  round(sat * vis, 6) satisfaction_x_visibility, round(perf * rep, 6) performance_x_reputation,
  round(dadj * perf, 6) investment_distance_risk FROM s"""


def _interactions(df):
    out = FT.add_features(df, FT.RATIOS_F + FT.ORDINAL_SCORES + FT.INTERACTIONS)
    return out.select("founder_id", *[f.name for f in FT.INTERACTIONS])


@register("feat_interactions", _interactions_sql(SCORE_SQL["visibility_score"]))
def feat_interactions(spark, sf):
    return _interactions(founder_rows(spark, sf).drop("y"))


@register("feat_interactions_default", _interactions_sql("0.0"))
def feat_interactions_default(spark, sf):
    # without founder_visibility, visibility_score is absent and counts as 0
    return _interactions(founder_rows(spark, sf).drop("founder_visibility", "y"))


@register("feat_factorized_ratio", WF + """, codes AS (
  SELECT team_size_category v, cast(row_number() OVER (ORDER BY min(founder_id)) - 1 AS bigint) code
  FROM ff WHERE team_size_category IS NOT NULL GROUP BY team_size_category)
SELECT founder_id, coalesce(code, -1) team_size_code,
  round((monthly_revenue_generated / nullif(years_since_founding + 1.0, 0)) / nullif(coalesce(code, -1) + 1, 0), 6)
    revenue_pressure
FROM ff LEFT JOIN codes ON team_size_category = v""")
def feat_factorized_ratio(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", "team_size_category", *NUM_F)
    codes = encode.fit_factorize(df, "team_size_category", order_col="founder_id")
    df = encode.apply_factorize(df, codes, "team_size_category", "team_size_code")
    df = FT.add_features(df, FT.RATIOS_F + [FT.Feature(
        "revenue_pressure", ("revenue_per_year", "team_size_code"),
        lambda r, c: X.safe_div(r, c + F.lit(1)))])
    return df.select("founder_id", "team_size_code", "revenue_pressure")


@register("feat_rule_flags", WF + f""", s AS (SELECT founder_id, {SCORE_SQL['wlb_score']} w,
  {SCORE_SQL['satisfaction_score']} s, {SCORE_SQL['performance_score']} p FROM ff)
SELECT founder_id, cast(coalesce(w <= 2 AND s <= 2 AND p <= 2, false) AS bigint) high_risk_flag,
  cast(coalesce(w >= 3 AND s >= 2 AND p >= 3, false) AS bigint) high_stable_flag FROM s""")
def feat_rule_flags(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *RATING_COLS)
    out = FT.add_features(df, FT.ORDINAL_SCORES + FT.RULE_FLAGS)
    return out.select("founder_id", "high_risk_flag", "high_stable_flag")


@register("threshold_label", WP + "SELECT id, CASE WHEN proba_a >= 0.5 THEN 'Stayed' ELSE 'Left' END label FROM pw")
def threshold_label(spark, sf):
    pw = preds_wide(spark, sf)
    return pw.select("id", X.threshold_label("proba_a", 0.5, "Stayed", "Left").alias("label"))


# --- E bins ---------------------------------------------------------------------------------------
def _cut_sql(c: str, edges, labels=None, outside="NULL") -> str:
    vals = labels or list(range(len(edges) - 1))
    parts = []
    for i in range(len(edges) - 1):
        lo = f"{c} >= {edges[i]}" if i == 0 else f"{c} > {edges[i]}"
        v = f"'{vals[i]}'" if isinstance(vals[i], str) else str(vals[i])
        parts.append(f"WHEN {lo} AND {c} <= {edges[i + 1]} THEN {v}")
    return f"CASE {' '.join(parts)} ELSE {outside} END"


@register("bin_fixed_labels", WF + "SELECT founder_id, " +
          _cut_sql("founder_age", FT.AGE_EDGES_LABELLED, FT.AGE_LABELS) + " founder_age_bin, " +
          _cut_sql("years_since_founding", FT.YSF_EDGES_LABELLED, FT.YSF_LABELS) + " years_since_founding_bin FROM ff")
def bin_fixed_labels(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", "founder_age", "years_since_founding")
    return FT.add_features(df, FT.BINS_LABELLED).drop("founder_age", "years_since_founding")


@register("bin_fixed_codes", WF + "SELECT founder_id, " + ", ".join([
    "cast(" + _cut_sql("founder_age", FT.AGE_EDGES_CODED, outside="-1") + " AS bigint) founder_age_bin",
    "cast(" + _cut_sql("years_with_startup", FT.YWS_EDGES_CODED, outside="-1") + " AS bigint) years_with_startup_bin",
    "cast(" + _cut_sql("years_since_founding", FT.YSF_EDGES_CODED, outside="-1") +
    " AS bigint) years_since_founding_bin"]) + " FROM ff")
def bin_fixed_codes(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", "founder_age", "years_with_startup", "years_since_founding")
    return FT.add_features(df, FT.BINS_CODED).drop("founder_age", "years_with_startup", "years_since_founding")


def _qbin_sql(c: str, fit_where: str, q: int = 5) -> tuple[str, str]:
    """(edges CTE body, classify expression) for pandas-qcut bins of column c."""
    qs = ", ".join(f"quantile_cont({c}, {i / q}) e{i}" for i in range(q + 1))
    cte = f"SELECT {qs} FROM ff {fit_where}"
    cnt = " + ".join(
        [f"(CASE WHEN {c} > e0 THEN 1 ELSE 0 END)"] +
        [f"(CASE WHEN {c} > e{i} AND e{i} > e{i - 1} THEN 1 ELSE 0 END)" for i in range(1, q + 1)])
    code = (f"CASE WHEN {c} IS NULL OR {c} < e0 OR {c} > e{q} THEN NULL WHEN {c} = e0 THEN 0 "
            f"ELSE {cnt} - 1 END")
    return cte, code


QBIN_COLS = ["monthly_revenue_generated", "distance_from_investor_hub"]


def _qbin_sql_two(fit_where: str, rows_where: str) -> str:
    ca, xa = _qbin_sql("monthly_revenue_generated", fit_where)
    cb, xb = _qbin_sql("distance_from_investor_hub", fit_where)
    for i in range(6):
        xb = xb.replace(f"e{i}", f"f{i}")
    return WF + f""", ea AS ({ca}),
eb AS (SELECT e0 f0, e1 f1, e2 f2, e3 f3, e4 f4, e5 f5 FROM ({cb}))
SELECT founder_id, round(cast(({xa}) AS double), 6) monthly_revenue_generated_bin,
  round(cast(({xb}) AS double), 6) distance_from_investor_hub_bin
FROM ff CROSS JOIN ea CROSS JOIN eb {rows_where}"""


@register("bin_quantile", _qbin_sql_two("", ""))
def bin_quantile(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", *QBIN_COLS)
    return binning.apply_quantile_bins(df, binning.fit_quantile_bins(df, QBIN_COLS), QBIN_COLS).drop(*QBIN_COLS)


@register("bin_quantile_fit_apply", _qbin_sql_two("WHERE fold != 0", "WHERE fold = 0"))
def bin_quantile_fit_apply(spark, sf):
    ff = founders(spark, sf)
    stats = binning.fit_quantile_bins(ff, QBIN_COLS, where="fold != 0")
    test = ff.where("fold = 0").select("founder_id", *QBIN_COLS)
    return binning.apply_quantile_bins(test, stats, QBIN_COLS).drop(*QBIN_COLS)


@register("bin_quantile_degenerate", WF + "SELECT founder_id, round(years_with_startup * 0.0, 6) flat_bin FROM ff")
def bin_quantile_degenerate(spark, sf):
    df = founder_rows(spark, sf).select("founder_id", (F.col("years_with_startup") * 0.0).alias("flat"))
    return binning.apply_quantile_bins(df, binning.fit_quantile_bins(df, ["flat"]), ["flat"]).drop("flat")
