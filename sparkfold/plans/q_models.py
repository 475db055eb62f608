"""Queries: model training through Spark ML (M1-M17).  Rows-only checks (no SQL oracle);
model quality is asserted against the majority-class baseline in the tests."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.functions import exprs as X
from sparkfold.functions import features as FT
from sparkfold.ml import assemble as A
from sparkfold.ml import boosting, mlp, svm
from sparkfold.ml import models as M
from sparkfold.ml.sums import side_by_side
from sparkfold.operators import encode, impute, metrics, search, split
from sparkfold.plans.catalog import WF, founders, register
from sparkfold.session import cut_lineage

NUM = ["founder_age", "years_with_startup", "monthly_revenue_generated", "funding_rounds_led",
       "distance_from_investor_hub", "num_dependents", "years_since_founding"]
CAT = ["founder_role", "education_background", "personal_status", "startup_stage", "team_size_category",
       "founder_gender"]
ENGINEERED = [f.name for f in FT.RATIOS_F] + ["wlb_score", "satisfaction_score", "performance_score",
                                              "reputation_score", "visibility_score"] + \
    [f.name for f in FT.FLAGS]


def model_frame(spark, sf) -> DataFrame:
    """Features for training: train medians (fold != 0) filled everywhere, engineered
    columns, missing categoricals as 'Missing', class weights, fold column; checkpointed."""
    ff = founders(spark, sf)
    med = impute.fit_median(ff, NUM, where="fold != 0")
    df = impute.apply_fill(ff, med, NUM)
    df = FT.add_features(df, FT.RATIOS_F + FT.ORDINAL_SCORES + FT.FLAGS)
    df = df.fillna(0.0, [c for c in ENGINEERED if c in df.columns])
    df = X.fill_constant(df, CAT, "Missing")
    df = metrics.add_class_weight(df, "y", "weight")
    return cut_lineage(df.select("founder_id", "fold", "y", "weight", *NUM, *ENGINEERED, *CAT))


NUMS = NUM + ENGINEERED
DEEPEST = 30  # the reference's forests grow without a limit; this is Spark's own


def _train_test(spark, sf):
    df = model_frame(spark, sf)
    return df, df.where("fold != 0"), df.where("fold = 0")


ASSEMBLED = ["founder_age", "monthly_revenue_generated", "distance_from_investor_hub", "years_since_founding"]


def _assemble_sql() -> str:
    parts = []
    for c in ASSEMBLED:
        m = f"(SELECT median({c}) FROM ff WHERE fold != 0)"
        parts.append(f"SELECT founder_id, '{c}' feature, (coalesce({c}, {m}) - a) / CASE WHEN s = 0 THEN 1.0 ELSE s END v FROM ff, "
                     f"(SELECT avg(coalesce({c}, {m})) a, stddev_pop(coalesce({c}, {m})) s FROM ff WHERE fold != 0) WHERE fold = 0")
    for c in CAT:
        parts.append(f"SELECT founder_id, '{c}_ohe_' || coalesce({c}, 'Missing') feature, 1.0 v FROM ff WHERE fold = 0 AND "
                     f"coalesce({c}, 'Missing') IN (SELECT coalesce({c}, 'Missing') FROM ff WHERE fold != 0)")
    return WF + "SELECT founder_id, feature, round(cast(v AS double), 6) AS value FROM (" + " UNION ALL ".join(parts) + ")"


@register("assemble_features", _assemble_sql())
def assemble_features(spark, sf):
    """TEST rows' vectors, one row for each numeric place and each one-hot place that is set."""
    from pyspark.ml.functions import vector_to_array
    df = A.assemble(founders(spark, sf), ASSEMBLED, CAT, "fold != 0")
    names = F.array(*[F.lit(n) for n in A.feature_names(df)])
    places = df.where("fold = 0").select("founder_id", F.posexplode(vector_to_array("features")).alias("place", "value"))
    rows = places.select("founder_id", F.element_at(names, F.col("place") + 1).alias("feature"), "value")
    return rows.where((F.col("value") != 0) | F.col("feature").isin(ASSEMBLED))


@register("ml_logreg")
def ml_logreg(spark, sf):
    _, train, test = _train_test(spark, sf)
    est = M.estimator("logreg", labelCol="y", weight="weight", maxIter=200)
    return M.fit_score(train, test, M.feature_stages(NUMS, CAT, scale=True), est, "founder_id")


def _scaled(spark, sf) -> DataFrame:
    """All rows with the assembled vector (numerics scaled on the training rows, one-hot sparse), stored."""
    df = A.assemble(model_frame(spark, sf), NUMS, CAT, "fold != 0")
    return cut_lineage(df.select("founder_id", "fold", "y", "weight", "features"))


@register("ml_linear_svc")
def ml_linear_svc(spark, sf):
    """Squared-hinge linear SVM, C = 1, balanced weights: margins of the test rows (M2)."""
    df = _scaled(spark, sf)
    svc = svm.squared_hinge(df.where("fold != 0"), "y", C=1.0, weight="weight")
    return svc.score(df.where("fold = 0")).select("founder_id", "margin")


@register("ml_svc_calibrated")
def ml_svc_calibrated(spark, sf):
    """Linear SVM with C = 0.5, calibrated over three folds (M3)."""
    df = _scaled(spark, sf)
    return svm.calibrated(df.where("fold != 0"), df.where("fold = 0"), "y", "founder_id", C=0.5)


@register("ml_rff_svc")
def ml_rff_svc(spark, sf):
    """RBF SVM with C = 3, gamma "scale" and probabilities, over all columns; the kernel map is Nyström's (M4)."""
    df = _scaled(spark, sf)
    mapped = svm.nystroem(df.where("fold != 0"), df, "founder_id")
    mapped = cut_lineage(mapped.select("founder_id", "fold", "y", F.col("kernel").alias("features")))
    return svm.calibrated(mapped.where("fold != 0"), mapped.where("fold = 0"), "y", "founder_id", C=3.0)


@register("ml_random_forest")
def ml_random_forest(spark, sf):
    _, train, test = _train_test(spark, sf)
    est = M.estimator("rf", labelCol="y", weight="weight", numTrees=200, maxDepth=DEEPEST, maxMemoryInMB=512, maxBins=M.max_bins(train, CAT))
    prep = M.Pipeline(stages=M.feature_stages(NUMS, CAT, onehot=False)).fit(train)
    return M.forest_score(est, prep.transform(train), prep.transform(test), "founder_id")


KEPT_FEATURES = 24


@register("select_topk_features")
def select_topk_features(spark, sf):
    """Forest importance over the named places of the assembled vector (numerics, one-hot values), the best
    ``KEPT_FEATURES`` of them sliced by name, a logistic regression refitted on the slice, TEST scored (M6, K5, B14).

    Rows of part ``feature``: rank, feature, importance; of part ``score``: founder_id, proba.
    """
    df = model_frame(spark, sf)
    df = cut_lineage(A.assemble(df, NUMS, CAT, "fold != 0").select("founder_id", "fold", "y", "weight", "features"))
    train = df.where("fold != 0")
    forest = M.estimator("rf", labelCol="y", weight="weight", numTrees=200, maxDepth=DEEPEST, maxMemoryInMB=512)
    top = A.top_names(M.forest_importances(forest, train), A.feature_names(df), KEPT_FEATURES)
    sliced = A.select_features(df, [name for _, name, _ in top])
    model = M.estimator("logreg", labelCol="y", weight="weight", featuresCol="selected", maxIter=200).fit(sliced.where("fold != 0"))
    scores = model.transform(sliced.where("fold = 0")).select("founder_id", M.positive_proba().alias("proba"))
    features = spark.createDataFrame(top, "rank int, feature string, importance double").withColumn("part", F.lit("feature"))
    return features.unionByName(scores.withColumn("part", F.lit("score")), allowMissingColumns=True)


def boosted_rows(spark, sf) -> DataFrame:
    """Training and validation rows with categoricals as ordered target statistics (M9): folds 2-4 train, each
    row from earlier rows only; fold 1 and TEST from the totals of folds 2-4."""
    df = model_frame(spark, sf)
    fit_rows, others = df.where("fold > 1"), df.where("fold <= 1")
    values, totals = encode.fit_ordered_target(fit_rows, CAT, "y", "founder_id")
    both = fit_rows.join(values, "founder_id").unionByName(encode.apply_ordered_target(others, totals, CAT))
    names = NUMS + [f"{c}_ots" for c in CAT]
    vector = M.VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(both)
    return cut_lineage(vector.select("founder_id", "fold", "y", "weight", "features"))


@register("ml_gbt")
def ml_gbt(spark, sf, rounds: int = 2000, patience: int = 100):
    """Boosted trees with early stopping (M7, M9): up to 2,000 rounds, patience 100, step 0.05, depth 6.

    Rows of part ``valid`` and ``test``: founder_id, proba; of part ``round``: the losses of every round that ran.
    """
    df = boosted_rows(spark, sf)
    fitted = boosting.boost(df.where("fold != 0"), "y", F.col("fold") == 1, rounds=rounds, patience=patience)
    scored = fitted.score(df.where("fold <= 1")).select(
        F.when(F.col("fold") == 1, "valid").otherwise("test").alias("part"), "founder_id", "proba")
    history = spark.createDataFrame(fitted.history, "round int, train_loss double, valid_loss double").withColumn("part", F.lit("round"))
    return scored.unionByName(history, allowMissingColumns=True).withColumn("best_rounds", F.lit(fitted.best_rounds))


@register("ml_gbt_refit")
def ml_gbt_refit(spark, sf, rounds: int = 800, patience: int = 50):
    """The best round by early stopping on fold 1 (up to 800 rounds, patience 50), then a fit of that many rounds
    on all training rows; TEST scored (M8).  Categoricals are raw indices: native splits (M9)."""
    df = model_frame(spark, sf)
    train = df.where("fold != 0")
    prep = M.Pipeline(stages=M.feature_stages(NUMS, CAT, onehot=False)).fit(train)
    rows = cut_lineage(prep.transform(df).select("founder_id", "fold", "y", "features"))
    bins = M.max_bins(train, CAT)
    best = boosting.boost(rows.where("fold != 0"), "y", F.col("fold") == 1, rounds=rounds, patience=patience, max_bins=bins).best_rounds
    final = boosting.boost(rows.where("fold != 0"), "y", rounds=best, max_bins=bins)
    return final.score(rows.where("fold = 0")).select("founder_id", "proba", F.lit(best).alias("best_rounds"))


@register("ml_adaboost")
def ml_adaboost(spark, sf):
    df, _, _ = _train_test(spark, sf)
    prep = M.Pipeline(stages=M.feature_stages(NUMS, CAT, onehot=False)).fit(df.where("fold != 0"))
    feats = cut_lineage(prep.transform(df).select("founder_id", "fold", "y", "features"))
    return M.adaboost(feats.where("fold != 0"), feats.where("fold = 0"), "y", "founder_id", rounds=50)


@register("ml_mlp")
def ml_mlp(spark, sf):
    """Hidden layers 128 and 64, balanced weights in the loss, up to 200 epochs with patience 10.

    Rows of part ``test``: founder_id, proba; of part ``epoch``: the validation loss of every epoch that ran.
    """
    df = _scaled(spark, sf)
    net = mlp.fit(df.where("fold != 0"), "y", "founder_id", (128, 64), weight="weight", batch=64)
    scored = net.score(df.where("fold = 0")).select(F.lit("test").alias("part"), "founder_id", "proba")
    history = spark.createDataFrame(net.history, "epoch int, valid_loss double").withColumn("part", F.lit("epoch"))
    return scored.unionByName(history, allowMissingColumns=True).withColumn("best_epoch", F.lit(net.best_epoch))


#: The reference's four networks: hidden layers, shrinkage, learning rate, batch size.
NETWORKS = [((256, 128, 64), 1e-4, 3e-4, 128), ((256, 128), 5e-4, 3e-4, 128), ((128, 64), 1e-4, 1e-3, 64), ((256, 256, 128), 5e-5, 3e-4, 128)]


def _run_table(runs: list[tuple[dict, DataFrame]], rows: DataFrame) -> DataFrame:
    """Tuned-threshold F1 of each setting on the rows it scored, the first maximum marked (K8, K6).

    ``runs``: (columns of the run table, scores (founder_id, proba)); ``rows``: (founder_id, y)."""
    parts = []
    for seq, (columns, scores) in enumerate(runs):
        best = search.best_threshold(scores.join(rows, "founder_id"), "y", "proba")
        parts.append(best.select(F.lit(seq).alias("seq"), *[F.lit(v).alias(c) for c, v in columns.items()], "threshold", "f1"))
    table = reduce(DataFrame.unionByName, parts)
    winner = search.first_best(table, "f1", "seq").select(F.col("seq").alias("_win"))
    return table.crossJoin(F.broadcast(winner)).withColumn("is_best", (F.col("seq") == F.col("_win")).cast("int")).drop("_win")


@register("ml_config_search")
def ml_config_search(spark, sf):
    """The reference's four networks, fitted side by side on folds 2-4, compared on fold 1."""
    df = _scaled(spark, sf)
    fit_rows, valid = df.where("fold > 1"), df.where("fold = 1")

    def one(hidden, alpha, rate, batch):
        net = mlp.fit(fit_rows, "y", "founder_id", hidden, weight="weight", alpha=alpha, rate=rate, batch=batch)
        columns = {"hidden": "-".join(map(str, hidden)), "alpha": alpha, "rate": rate, "batch": batch, "best_epoch": net.best_epoch}
        return columns, net.score(valid).select("founder_id", "proba")

    runs = side_by_side([partial(one, *setting) for setting in NETWORKS])
    return _run_table(runs, valid.select("founder_id", "y"))


@register("ml_fraction_study")
def ml_fraction_study(spark, sf):
    """RBF SVM on 0.2 and 0.5, network on 0.2, 0.5 and 1.0 of the training rows (stratified), compared on fold 1;
    the best fraction of each model is marked (M14, H4)."""
    df = _scaled(spark, sf)
    fit_rows, valid = df.where("fold > 1"), df.where("fold = 1")
    mapped = cut_lineage(svm.nystroem(fit_rows, df, "founder_id").select("founder_id", "fold", "y", F.col("kernel").alias("features")))

    def machine(frac):
        part = split.sample_fraction(mapped.where("fold > 1"), "y", frac, "founder_id", seed=42)
        scores = svm.calibrated(part, mapped.where("fold = 1"), "y", "founder_id", C=3.0)
        return {"model": "svm", "fraction": frac}, scores

    def network(frac):
        part = cut_lineage(split.sample_fraction(fit_rows, "y", frac, "founder_id", seed=42))
        net = mlp.fit(part, "y", "founder_id", (128, 64), batch=256, epochs=80)
        return {"model": "mlp", "fraction": frac}, net.score(valid).select("founder_id", "proba")

    runs = side_by_side([*(partial(machine, f) for f in (0.2, 0.5)), *(partial(network, f) for f in (0.2, 0.5, 1.0))])
    rows = valid.select("founder_id", "y")
    return _run_table(runs[:2], rows).unionByName(_run_table(runs[2:], rows))


@register("ml_refit_score")
def ml_refit_score(spark, sf):
    _, train, test = _train_test(spark, sf)
    est = M.estimator("logreg", labelCol="y", weight="weight", maxIter=200)
    p = M.fit_score(train, test, M.feature_stages(NUMS, CAT, scale=True), est, "founder_id")
    return p.withColumn("label", X.threshold_label("proba", 0.5, "Stayed", "Left"))


@register("ml_oof")
def ml_oof(spark, sf):
    """Five inner folds over the training part: OOF probabilities for every training row,
    test probabilities averaged over the five fold models (M17)."""
    _, train, test = _train_test(spark, sf)
    inner = cut_lineage(split.assign_folds(train.drop("fold"), "y", "founder_id", k=5, seed=7))  # read by every fit
    oof, tmean = M.oof_predictions(
        inner, test, lambda: M.feature_stages(NUMS, CAT, scale=True),
        lambda: M.estimator("logreg", labelCol="y", weight="weight", maxIter=200),
        "founder_id", "fold", 5, "logreg")
    return oof.select("founder_id", F.lit("oof").alias("part"), "fold", "proba").unionByName(
        tmean.select("founder_id", F.lit("test").alias("part"), F.lit(None).cast("int").alias("fold"), "proba"))


@register("ml_random_search")
def ml_random_search(spark, sf):
    """Randomised network search: six seeded draws of layers, learning rate, shrinkage and batch size, fitted side by
    side, tuned-threshold F1 on fold 1, first maximum wins (M13 with random draws)."""
    df = _scaled(spark, sf)
    fit_rows, valid = df.where("fold > 1"), df.where("fold = 1")
    space = {"hidden": [(64,), (128, 64), (256, 128)], "rate": [3e-4, 1e-3, 3e-3], "alpha": [1e-5, 1e-4, 1e-3], "batch": [64, 128]}

    def one(cfg):
        net = mlp.fit(fit_rows, "y", "founder_id", cfg["hidden"], weight="weight", alpha=cfg["alpha"], rate=cfg["rate"], batch=cfg["batch"])
        return {**cfg, "hidden": "-".join(map(str, cfg["hidden"]))}, net.score(valid).select("founder_id", "proba")

    runs = side_by_side([partial(one, cfg) for cfg in M.random_configs(space, 6, seed=42)])
    return _run_table(runs, valid.select("founder_id", "y"))
