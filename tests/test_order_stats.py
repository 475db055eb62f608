"""Exact order statistics: quantiles, percentile ranks, modes, dense codes (vs numpy / pandas)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfold.operators import order, scale, impute


def test_quantile_edges_with_duplicates(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 1, 2, 3, 4, 9]], "v double")
    q = order.exact_quantiles(order.value_counts(df, "v"), "v", [i / 5 for i in range(6)]).first()
    edges = sorted({round(q[f"q{i}"], 9) for i in range(6)})
    assert edges == [1.0, 2.2, 3.6, 9.0]


def test_quantiles_match_numpy_on_ties(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(0, 40, size=997).astype(float)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    q = order.exact_quantiles(order.value_counts(df, "v"), "v", probs, n_parts=7).first()
    for i, p in enumerate(probs):
        assert abs(q[f"q{i}"] - np.quantile(vals, p)) < 1e-9


def test_percentile_rank_average_ties(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 20.0), (4, None), (5, 5.0)], "id int, x double")
    out = {r["id"]: r["x_rank"] for r in scale.rank_pct(df, ["x"]).collect()}
    assert out == {1: 0.5, 2: 0.875, 3: 0.875, 4: None, 5: 0.25}


def test_percentile_rank_matches_pandas(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 50, size=500).astype(float)
    pdf = pd.DataFrame({"id": range(500), "x": x})
    out = scale.rank_pct(spark.createDataFrame(pdf), ["x"]).toPandas().sort_values("id")
    assert np.allclose(out["x_rank"].to_numpy(), pdf["x"].rank(pct=True).to_numpy())


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",)], "c string")
    assert impute.fit_mode(df, ["c"]).first()["value"] == "a"


def test_numeric_mode_tie_is_numeric(spark):
    df = spark.createDataFrame([(10.0,), (9.0,), (10.0,), (9.0,)], "c double")
    assert float(impute.fit_mode(df, ["c"]).first()["value"]) == 9.0


def test_dense_index_is_sorted_and_contiguous(spark):
    words = ["pear", "apple", "fig", "kiwi", "banana", "cherry", "date", "grape"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    out = {r["w"]: r["index"] for r in order.dense_index(df, ["w"], n_parts=3).collect()}
    assert out == {w: i for i, w in enumerate(sorted(words))}


def test_median_fit_apply_uses_train_stats(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    test = spark.createDataFrame([(None,), (5.0,)], "x double")
    stats = impute.fit_median(train, ["x"])
    assert [r["x"] for r in impute.apply_fill(test, stats, ["x"]).collect()] == [2.0, 5.0]


@pytest.mark.parametrize("parts", [8, 1024])
def test_positions_in_one_path(spark, parts):
    """NULL groups and keys, mixed URL schemes, a dominant value: exact at 8 and 1,024 partitions."""
    urls = [f"https://host{i % 97}.example.com/p/{i}" for i in range(1500)] + ["ftp://a/b", None, ""]
    rows = [(g, u, 5 if u == "ftp://a/b" else 1) for g in ("x", None) for u in urls]
    df = spark.createDataFrame(rows, "g string, u string, w long").repartition(5)
    out = order.positions(df, ["u"], ["g"], weight_col="w", n_parts=parts).collect()
    assert len(out) == len(rows)
    ordered = sorted(urls, key=lambda u: (u is not None, (u or "").encode()))
    before, run = {}, 0
    for u in ordered:
        before[u] = run
        run += 5 if u == "ftp://a/b" else 1
    assert all((r["_before"], r["_n"]) == (before[r["u"]], run) for r in out)


def test_plan_size_does_not_grow_with_partitions(spark):
    df = spark.range(300).select((F.col("id") * 7 % 300).alias("v"))
    sizes = [len(order.dense_index(df, ["v"], n_parts=n)._jdf.queryExecution().executedPlan().toString()) for n in (8, 512)]
    assert abs(sizes[0] - sizes[1]) < 100


def test_rows_with_a_null_label_stay(spark):
    from sparkfold.operators import split
    df = spark.createDataFrame([(i, None if i % 10 == 0 else "ab"[i % 2]) for i in range(1000)], "id long, y string")
    folds = split.assign_folds(df, "y").collect()
    assert len(folds) == 1000 and {r["fold"] for r in folds if r["y"] is None} == {0, 1, 2, 3, 4}
    assert split.split_stratified(df, "y").where("y is null and is_test = 1").count() == 20


def test_numeric_mode_per_fold_tie_is_numeric(spark):
    df = spark.createDataFrame([(f, v) for f in (0, 1) for v in (9.0, 10.0)], "fold int, x double")
    got = {r["fold"]: float(r["value"]) for r in impute.fit_mode_per_fold(df, ["x"], k=2).collect()}
    assert got == {0: 9.0, 1: 9.0}


def test_threshold_tag_has_no_commas(spark):
    from sparkfold.functions.exprs import threshold_tag
    assert spark.range(1).select(threshold_tag(F.lit(1234.5)).alias("t")).first()["t"] == "1234p5000"
