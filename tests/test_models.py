"""Model operators: solvers against plain NumPy, stopping rules, selection by name, and better than chance on the fixture."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from conftest import SF001, SF01
from sparkfold.ml import assemble as A
from sparkfold.ml import boosting, forest, mlp, svm
from sparkfold.ml import models as M
from sparkfold.ml.sums import even, side_by_side, total
from sparkfold.plans import q_models


@pytest.fixture(scope="module")
def scaled(spark):
    return q_models._scaled(spark, SF01)


def points(spark, x, y, extra=""):
    rows = [(i, [float(v) for v in r], None if t is None else int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a array<double>, y int").withColumn("features", array_to_vector("a"))


def test_oof_logreg_beats_chance(spark):
    df = q_models.model_frame(spark, SF01)
    oof, _ = M.oof_predictions(df, None, lambda: M.feature_stages(q_models.NUMS, q_models.CAT, scale=True),
                               lambda: M.estimator("logreg", labelCol="y", weight="weight"), "founder_id")
    scored = oof.join(df.select("founder_id", F.col("y").cast("double").alias("y")), "founder_id")
    assert scored.count() == df.count() == scored.select("founder_id").distinct().count()
    auc = BinaryClassificationEvaluator(rawPredictionCol="proba", labelCol="y").evaluate(scored)
    assert auc > 0.55


# --- G6 / M6 ----------------------------------------------------------------------------------------------------
def test_assembled_vectors_are_sparse_and_named(spark):
    rows = [(i, float(i), f"c{i % 60}", 0) for i in range(120)] + [(500, None, "new", 1), (501, 3.0, None, 1)]
    df = spark.createDataFrame(rows, "id long, x double, c string, fold int")
    out = A.assemble(df, ["x"], ["c"], "fold = 0")
    assert out.columns == [*df.columns, "features"]
    names = A.feature_names(out)
    assert names[0] == "x" and "c_ohe_c7" in names and len(names) == 61
    got = {r.id: r.features for r in out.collect()}
    assert isinstance(got[7], SparseVector) and got[7][names.index("c_ohe_c7")] == 1.0 and got[7].numNonzeros() == 2
    assert got[500].numNonzeros() == 0  # the median is the mean here, and the value is unseen
    assert got[501].toArray()[1:].sum() == 0
    x = np.arange(120.0)
    assert abs(got[3][0] - (3 - x.mean()) / x.std()) < 1e-9
    picked = A.select_features(out, ["c_ohe_c7", "x"])
    assert {r.id: r.selected.toArray().tolist() for r in picked.where("id = 7").collect()}[7] == [1.0, got[7][0]]
    assert A.top_names([0.1, 0.5, 0.5], ["a", "b", "c"], 2) == [(1, "b", 0.5), (2, "c", 0.5)]


# --- M2 / M3 / M4 -----------------------------------------------------------------------------------------------
def plain_squared_hinge(x, s, c, C):
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        short = 1 - s * (x @ w)
        inside = short > 0
        g = w - 2 * C * (x[inside].T @ (c * short * s)[inside])
        h = np.eye(len(w)) + 2 * C * (x[inside] * c[inside, None]).T @ x[inside]
        w = w - np.linalg.solve(h, g)
    assert np.abs(g).max() < 1e-6
    return w


def test_squared_hinge_equals_numpy(spark, scaled):
    rows = scaled.where("fold != 0").select("features", "y", "weight").collect()
    x = np.stack([r.features.toArray() for r in rows])
    s, c = np.array([1.0 if r.y else -1.0 for r in rows]), np.array([r.weight for r in rows])
    got = svm.squared_hinge(scaled.where("fold != 0"), "y", 1.0, "weight")
    want = plain_squared_hinge(x, s, c, 1.0)
    assert np.abs(np.append(got.coef, got.intercept) - want).max() < 1e-6
    margins = {r.founder_id: r.margin for r in got.score(scaled).select("founder_id", "margin").collect()}
    one = scaled.first()
    assert abs(margins[one.founder_id] - (one.features.toArray() @ want[:-1] + want[-1])) < 1e-5


def test_squared_hinge_odd_rows(spark):
    df = points(spark, [[0.0], [1.0], [2.0], [3.0]], [0, 0, 1, None])
    assert svm.squared_hinge(df, "y", 10.0).coef[0] > 0
    empty = svm.squared_hinge(df.limit(0), "y")
    assert empty.intercept == 0.0 and not len(empty.coef)


def test_kernel_beats_the_line_on_a_ring(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 2))
    y = (np.hypot(*x.T) > 1.1).astype(int)
    df = points(spark, x, y)
    train, test = df.where("id % 3 != 0"), df.where("id % 3 = 0")
    linear = svm.calibrated(train, test, "y", "id", C=3.0)
    mapped = svm.nystroem(train, df, "id", landmarks=80).drop("features").withColumnRenamed("kernel", "features")
    curved = svm.calibrated(mapped.where("id % 3 != 0"), mapped.where("id % 3 = 0"), "y", "id", C=3.0)
    hits = [p.join(test, "id").agg(F.avg(((F.col("proba") >= 0.5).cast("int") == F.col("y")).cast("int"))).first()[0] for p in (linear, curved)]
    assert hits[1] > 0.9 and hits[1] > hits[0] + 0.15
    flat = x.ravel()
    assert abs(svm.scale_gamma(df) - 1 / (2 * flat.var())) < 1e-9


# --- M11 --------------------------------------------------------------------------------------------------------
def test_network_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    layers, x, y, w = [3, 4, 1], rng.normal(size=(9, 3)), rng.integers(0, 2, 9).astype(float), rng.uniform(0.5, 2, 9)
    flat = mlp.start_weights(layers, 1)

    def loss(f):
        shrunk = sum((p ** 2).sum() for p, _ in mlp.unflatten(f, layers))
        return (w @ mlp.losses(y, mlp.forward(x, f, layers)[-1][:, 0])) / w.sum() + 0.3 / 2 * shrunk / len(x)

    slope = [(loss(flat + 1e-6 * e) - loss(flat - 1e-6 * e)) / 2e-6 for e in np.eye(len(flat))]
    assert np.abs(mlp.gradient(x, y, w, flat, layers, 0.3) - slope).max() < 1e-6


def test_network_learns_stops_and_heeds_weights(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, size=(800, 2))
    df = points(spark, x, (x[:, 0] * x[:, 1] > 0).astype(int)).repartition(2).cache()
    net = mlp.fit(df, "y", "id", (16,), rate=0.02, batch=32, epochs=60, patience=10)
    hit = net.score(df).agg(F.avg(((F.col("proba") >= 0.5).cast("int") == F.col("y")).cast("int"))).first()[0]
    assert hit > 0.9 and net.history[-1][0] <= 60 and net.best_epoch == min(net.history, key=lambda h: (h[1], h[0]))[0]
    coin = points(spark, x, rng.integers(0, 2, 800)).repartition(2).cache()
    lost = mlp.fit(coin, "y", "id", (16,), rate=0.05, batch=32, epochs=100, patience=3)
    assert lost.history[-1][0] == lost.best_epoch + 3 < 100
    heavy = coin.withColumn("w", F.when(F.col("y") == 1, 9.0).otherwise(1.0))
    tilted = mlp.fit(heavy, "y", "id", (4,), weight="w", rate=0.01, batch=32, epochs=5)
    assert tilted.score(coin).agg(F.avg("proba")).first()[0] > 0.75
    with pytest.raises(ValueError):
        mlp.fit(df.limit(0), "y", "id", (4,))


def test_sums_and_side_by_side(spark):
    df = spark.range(5000, numPartitions=5)
    out = total(df, lambda batches: np.full(2500, float(sum(b.num_rows for b in batches))), 2500)
    assert out.shape == (2500,) and (out == 5000).all()
    assert side_by_side([lambda i=i: spark.range(i).count() for i in range(6)], threads=3) == list(range(6))
    with pytest.raises(ZeroDivisionError):
        side_by_side([lambda: 1, lambda: 1 // 0])


# --- M7 / M8 / M9 -----------------------------------------------------------------------------------------------
def test_boosting_stops_keeps_the_best_prefix_and_scores_it(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(int)
    df = points(spark, x, [None if i == 5 else int(t) for i, t in enumerate(y)]).repartition(2).cache()
    got = boosting.boost(df, "y", F.col("id") % 4 == 0, step=0.3, depth=3, patience=4, rounds=40, store_every=3)
    rounds = [r for r, _, _ in got.history]
    losses = [v for _, _, v in got.history]
    assert rounds == list(range(len(rounds))) and got.best_rounds == min(range(len(losses)), key=lambda i: (losses[i], i))
    assert rounds[-1] == got.best_rounds + 4 and got.history[-1][1] < got.history[0][1]
    assert len(got.model.trees) == got.best_rounds
    scored = got.score(df.where("id % 4 = 0 and y is not null")).select("y", "proba").collect()
    loss = -np.mean([np.log(r.proba if r.y else 1 - r.proba) for r in scored])
    assert abs(loss - losses[got.best_rounds]) < 1e-9  # the stored margins and the model agree
    again = boosting.boost(df, "y", rounds=2, step=0.3, depth=3)
    assert again.best_rounds == 2 and len(again.model.trees) == 2 and again.history[-1][2] is None
    with pytest.raises(ValueError):
        boosting.boost(df.where("y is null"), "y")


def test_a_useless_tree_leaves_the_prior(spark):
    df = points(spark, [[0.0]] * 40, [1] * 30 + [0] * 10)
    got = boosting.boost(df, "y", F.col("id") % 2 == 0, patience=2)
    assert got.best_rounds == 0 and got.model is None
    assert abs(got.score(df).first().proba - 0.75) < 1e-9


def test_reference_rounds_and_trees(spark, monkeypatch):
    """The registered queries ask for the reference's rounds, patience, trees and depth."""
    class Asked(Exception):
        pass

    def ask(*a, **kw):
        raise Asked(kw)

    asked_for = ((M, "adaboost", q_models.ml_adaboost, {"rounds": 50}), (M, "estimator", q_models.select_topk_features, {"numTrees": 200, "maxDepth": 30}),
                 (M, "estimator", q_models.ml_random_forest, {"numTrees": 200, "maxDepth": 30}),
                 (boosting, "boost", q_models.ml_gbt, {"rounds": 2000, "patience": 100}), (boosting, "boost", q_models.ml_gbt_refit, {"rounds": 800, "patience": 50}))
    for module, name, query, want in asked_for:
        with monkeypatch.context() as m, pytest.raises(Asked) as asked:
            m.setattr(module, name, ask)
            query(spark, SF001)
        assert want.items() <= asked.value.args[0].items()


def test_many_categories_fit_a_tree(spark):
    df = spark.createDataFrame([(i, f"c{i % 50}", float(i % 7), int(i % 50 < 20)) for i in range(600)], "id long, c string, x double, y int")
    assert M.max_bins(df, ["c"]) >= 51
    est = M.estimator("gbt", labelCol="y", maxIter=3, maxBins=M.max_bins(df, ["c"]))
    assert M.fit_score(df, df, M.feature_stages(["x"], ["c"], onehot=False), est, "id").count() == 600


# --- M5 / M6 in groups of trees -----------------------------------------------------------------------------------------
def test_a_forest_in_groups_holds_few_trees_and_scores_all(spark, monkeypatch):
    """No fit has more trees than its rows allow; all trees vote; one group is Spark's own forest; ids may repeat."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 6))
    df = points(spark, x, (x[:, 0] + x[:, 1] > 0).astype(int)).withColumn("id", F.col("id") % 250).cache()
    est = M.estimator("rf", labelCol="y", numTrees=11, maxDepth=5)
    whole = est.fit(df)
    want = sorted((r.id, r.p) for r in whole.transform(df).select("id", M.positive_proba().alias("p")).collect())
    got = sorted((r.id, r.proba) for r in M.forest_score(est, df, df, "id").collect())
    assert np.allclose(got, want, atol=1e-12, rtol=0)
    assert np.allclose(M.forest_importances(est, df), whole.featureImportances.toArray(), atol=1e-12, rtol=0)
    groups = list(M.forest_groups(est, df, tree_rows=1000))
    assert [g.getNumTrees for g in groups] == [2, 3, 3, 3] and all(g.getFeatureSubsetStrategy() == "sqrt" for g in groups)
    votes = np.mean([[r.p for r in t.transform(df).select(M.positive_proba().alias("p")).collect()] for g in groups for t in g.trees], axis=0)
    got = [r.proba for r in M.forest_score(est, df, df.withColumn("id", F.monotonically_increasing_id()), "id", tree_rows=1000).orderBy("id").collect()]
    assert np.allclose(got, votes, atol=1e-12, rtol=0)
    assert int(np.argmax(M.forest_importances(est, df, tree_rows=300))) in (0, 1)

    class Asked(Exception):
        pass

    def whole_fit(self, *a):
        raise Asked(self.getNumTrees())

    monkeypatch.setattr(M, "TREE_ROWS", 1000)
    monkeypatch.setattr(M.RandomForestClassifier, "fit", whole_fit)
    for query in (q_models.ml_random_forest, q_models.select_topk_features):
        with pytest.raises(Asked) as asked:
            query(spark, SF01)  # 1,200 training rows
        assert asked.value.args[0] < 200


def test_a_larger_forest_is_grown_in_tasks(spark, monkeypatch):
    """Beyond FIT_ROWS no forest is fitted by Spark, whose driver and shuffles a deep one outgrows; however its trees are
    cut into parts and waves, the votes are the same, and close to those of Spark's forest; ids may repeat."""
    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(size=(2000, 3)), rng.integers(0, 3, size=2000)]
    df = points(spark, x, (rng.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0] - x[:, 1] * x[:, 3]))).astype(int)).cache()
    rows = df.withColumn("id", F.col("id") % 1500)
    est = M.estimator("rf", labelCol="y", numTrees=40, maxDepth=30, featureSubsetStrategy="all")
    model = est.fit(df)
    whole = sorted((r.id, r.p) for r in model.transform(rows).select("id", M.positive_proba().alias("p")).collect())

    def stopped(*a):
        raise AssertionError("fitted whole")

    monkeypatch.setattr(M.RandomForestClassifier, "fit", stopped)
    monkeypatch.setattr(M, "FIT_ROWS", 1000)
    got = sorted((r.id, r.proba) for r in M.forest_score(est, df, rows, "id").collect())
    assert [i for i, _ in got] == [i for i, _ in whole]
    assert np.corrcoef([p for _, p in got], [p for _, p in whole])[0, 1] > 0.98
    gains = M.forest_importances(est, df)
    assert abs(gains.sum() - 1) < 1e-9 and np.abs(gains - model.featureImportances.toArray()).max() < 0.03
    monkeypatch.setattr(forest, "NODE_ROWS", 300)
    monkeypatch.setattr(forest, "WAVE_ROWS", 50_000)
    assert np.allclose(sorted((r.id, r.proba) for r in M.forest_score(est, df, rows, "id").collect()), got, atol=1e-9, rtol=0)
    assert np.allclose(M.forest_importances(est, df), gains, atol=1e-9, rtol=0)


def test_a_large_leaf_votes(spark, monkeypatch):
    """A node that is larger than a task's share and can't be split is a leaf: equal rows, and rows of one label."""
    rng = np.random.default_rng(6)
    x = np.repeat([[0.0, 0.0], [1.0, 0.0], [2.0, 1.0]], 400, axis=0)
    y = np.r_[np.zeros(400), rng.random(400) < 0.3, rng.random(400) < 0.8].astype(int)
    df = points(spark, x, y).cache()
    est = M.estimator("rf", labelCol="y", numTrees=8, maxDepth=30, featureSubsetStrategy="all")
    monkeypatch.setattr(M, "FIT_ROWS", 100)
    monkeypatch.setattr(forest, "NODE_ROWS", 100)
    got = np.array([r.proba for r in M.forest_score(est, df, df, "id").orderBy("id").collect()])
    means = y.reshape(3, 400).mean(1)
    means[:2] = means[:2].mean()  # sibling leaves that both say 0
    assert np.allclose(got, np.repeat(means, 400), atol=0.05) and len(set(np.round(got, 9))) == 2
    assert np.allclose(sorted(M.forest_importances(est, df)), [0, 1])


def test_a_grown_tree_is_the_plain_one():
    """All places drawn: a tree fits its rows as far as they differ, a category no row has goes right, like siblings are one leaf."""
    bins = forest.Bins(2, {0: np.array([0.5, 1.5])}, {1: 4})
    x = bins.of(np.array([[0, 0], [1, 1], [2, 2], [2, 0], [2, 2]], dtype=float))
    y, w = np.array([0, 1, 1, 0, 0]), np.array([1.0, 1.0, 2.0, 1.0, 1.0])
    shown = bins.of(np.array([[0, 0], [1, 1], [9, 2], [2, 0], [2, 3]], dtype=float))
    share, gains = forest.grow(x, y, w, shown, 0, 1, forest.Draw(bins, 2, 30, 42))
    # the last three places of class 1 split no further into another prediction: 3 of 4 in weight
    assert np.allclose(share, [0, 0.75, 0.75, 0, 0.75]) and gains[0] == 0 and gains[1] > 0
    share, gains = forest.grow(x, y, w, shown, 0, 1, forest.Draw(bins, 2, 0, 42))
    assert np.allclose(share, 0.5) and not gains.any()
    with pytest.raises(ValueError, match="category"):
        bins.of(np.array([[0.0, 4.0]]))


def test_side_by_side_from_a_thread_without_an_active_session(spark, monkeypatch):
    from pyspark.sql import SparkSession
    monkeypatch.setattr(SparkSession, "getActiveSession", classmethod(lambda cls: None))
    assert side_by_side([lambda i=i: spark.range(i).count() for i in range(2)]) == [0, 1]


# --- passes over even tasks ---------------------------------------------------------------------------------------------
class Passed(Exception):
    pass


@pytest.fixture(scope="module")
def lopsided(spark):
    """60,000 rows of one label each way, all in one task."""
    df = spark.range(60_000, numPartitions=1).select("id", F.array((F.col("id") % 97).cast("double"), F.lit(0.0)).alias("a"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    return df.withColumn("features", array_to_vector("a"))


def shares(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def assert_even(df, rows=60_000):
    assert len(shares(df)) == 3 and sum(shares(df)) == rows and max(shares(df)) < 1.05 * rows / 3
    assert df.storageLevel.useMemory


def test_even_leaves_a_small_frame_and_deals_a_large_one(spark, lopsided):
    assert even(lopsided, 20_000) is lopsided
    cores = spark.sparkContext.defaultParallelism
    assert even(lopsided, 60_000_000).rdd.getNumPartitions() % cores == 0
    assert even(lopsided, 60_000_000).rdd.getNumPartitions() * 500_000 >= 60_000_000


def test_boosting_reads_even_tasks(lopsided, monkeypatch):
    def fit(self, rows):
        assert max(shares(rows)) < 1.05 * 60_000 / 3 and rows.columns == ["features", "_step", "_h"]
        raise Passed

    monkeypatch.setattr(boosting.RandomForestRegressor, "fit", fit)
    with pytest.raises(Passed):
        boosting.boost(lopsided, "y", rounds=1)


def test_boosting_keeps_the_metadata_of_its_features(spark):
    """Raw categoricals stay categorical (M9): a split of one is a set of values, not a threshold."""
    df = spark.createDataFrame([(i, "abcdef"[i % 6], int(i % 6 in (1, 4))) for i in range(600)], "id long, c string, y int")
    rows = M.Pipeline(stages=M.feature_stages([], ["c"], onehot=False)).fit(df).transform(df)
    got = boosting.boost(rows, "y", rounds=1, depth=1, row_share=1.0, column_share=1.0)
    assert " in {" in got.model.trees[0].toDebugString


def test_adaboost_reads_even_tasks_from_memory(lopsided, monkeypatch):
    stump, seen = M.DecisionTreeClassifier.fit, []

    def fit(self, rows):
        assert_even(rows)
        seen.append(rows)
        return stump(self, rows)

    monkeypatch.setattr(M.DecisionTreeClassifier, "fit", fit)
    assert M.adaboost(lopsided, lopsided, "y", "id", rounds=5).count() == 60_000
    assert len(seen) == 5 and not any(rows.storageLevel.useMemory for rows in seen)


@pytest.mark.parametrize("module", [mlp, svm])
def test_solvers_read_even_tasks_from_memory(lopsided, monkeypatch, module):
    def pass_over(rows, add, size):
        assert_even(rows)
        raise Passed

    monkeypatch.setattr(module, "total", pass_over)
    with pytest.raises(Passed):
        mlp.fit(lopsided, "y", "id", (4,)) if module is mlp else svm.squared_hinge(lopsided, "y")
