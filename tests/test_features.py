"""Scalar features and bins: the edge cases of FIXTURES.md section 3."""

from pyspark.sql import functions as F

from sparkfold.functions import exprs as X
from sparkfold.functions import features as FT
from sparkfold.operators import binning


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (25.0,), (26.0,), (100.0,), (101.0,), (None,), (-1.0,)], "x double")
    edges = [0, 25, 35, 45, 60, 100]
    got = [r[0] for r in df.select(FT.cut(F.col("x"), edges)).collect()]
    assert got == [0, 0, 1, 4, None, None, None]
    codes = [r[0] for r in df.select(FT.cut(F.col("x"), edges, outside=-1)).collect()]
    assert codes == [0, 0, 1, 4, -1, -1, -1]


def test_quantile_bins_degenerate_pass_through(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (3.0,)], "x double")
    out = binning.apply_quantile_bins(df, binning.fit_quantile_bins(df, ["x"]), ["x"])
    assert [r["x_bin"] for r in out.collect()] == [3.0, 3.0, 3.0]


def test_quantile_bins_fit_apply(spark):
    train = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 1, 2, 3, 4, 9]], "x double")
    test = spark.createDataFrame([(1.0,), (2.1,), (2.3,), (9.0,), (9.5,), (0.5,)], "x double")
    out = binning.apply_quantile_bins(test, binning.fit_quantile_bins(train, ["x"]), ["x"])
    assert [r["x_bin"] for r in out.collect()] == [0.0, 0.0, 1.0, 2.0, None, None]


def test_bad_number_text_and_non_finite(spark):
    df = spark.createDataFrame([("abc",), ("1e2",), ("",), ("NaN",), ("Infinity",), ("-Infinity",)], "s string")
    assert [r[0] for r in df.select(X.try_double("s")).collect()] == [None, 100.0, None, None, None, None]


def test_rating_text(spark):
    df = spark.createDataFrame([(" Good ",), ("EXCELLENT",), ("??",), (None,)], "r string")
    got = [r[0] for r in df.select(FT.ordinal(F.col("r"), FT.RATING_MAP)).collect()]
    assert got == [3.0, 4.0, None, None]
    got = [r[0] for r in df.select(FT.ordinal_default(F.col("r"), FT.RATING_MAP_CASED)).collect()]
    assert got == [1.0, 1.0, 1.0, 1.0]  # case-sensitive map: only exact spellings count


def test_guarded_features_skip_missing_inputs(spark):
    df = spark.createDataFrame([(30.0, 2.0)], "founder_age double, years_with_startup double")
    out = FT.add_features(df, FT.RATIOS_F)
    assert out.columns == ["founder_age", "years_with_startup", "experience_ratio"]
    assert abs(out.first()["experience_ratio"] - 2.0 / 31.0) < 1e-12


def test_rule_flags_missing_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0, None), (1.0, 2.0, 2.0)],
                               "wlb_score double, satisfaction_score double, performance_score double")
    out = FT.add_features(df, FT.RULE_FLAGS)
    assert [r["high_risk_flag"] for r in out.collect()] == [0, 1]


def test_log1p_guard(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (0.0,)], "x double")
    assert [r[0] for r in df.select(X.log1p_guarded("x")).collect()] == [None, None, 0.0]
