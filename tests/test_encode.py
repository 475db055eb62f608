"""Encoders: unseen / missing semantics, first-appearance codes, out-of-fold statistics."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sparkfold.operators import encode


def test_factorize_first_appearance(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, c string")
    codes = encode.fit_factorize(df, "c", "id")
    out = encode.apply_factorize(df, codes, "c", "code").orderBy("id")
    assert [r["code"] for r in out.collect()] == [0, -1, 1, 0]


def test_frequency_missing_out_of_denominator(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    out = encode.apply_freq(df, encode.fit_freq(df, ["c"], missing="exclude"), ["c"])
    assert [r["c_freq"] for r in out.collect()] == [1.0, 1.0, 0.0]
    pooled = encode.apply_freq(df, encode.fit_freq(df, ["c"], missing="category"), ["c"], nullsafe=True)
    assert sorted(r["c_freq"] for r in pooled.collect()) == [1 / 3, 2 / 3, 2 / 3]


def test_unseen_category(spark):
    train = spark.createDataFrame([("a", 1), ("b", 0), ("a", 1), ("b", 1)], "c string, y int")
    test = spark.createDataFrame([("c",)], "c string")
    assert encode.apply_label(test, encode.fit_label(train, ["c"]), ["c"]).first()["c"] == 2
    assert encode.apply_freq(test, encode.fit_freq(train, ["c"]), ["c"]).first()["c_freq"] == 0.0
    stats, g = encode.fit_target_smooth(train, ["c"], "y", 10.0)
    assert abs(encode.apply_target(test, stats, g, ["c"]).first()["c_te"] - 0.75) < 1e-12
    model = encode.onehot_model(train, ["c"])
    vec = model.transform(test).first()["c_ohe"]
    assert vec.size == 2 and vec.numNonzeros() == 0


def test_kfold_target_encoding_ignores_own_fold(spark):
    rng = np.random.default_rng(1)
    n = 400
    pdf = pd.DataFrame({"id": range(n), "c": rng.choice(list("abcde"), n), "y": rng.integers(0, 2, n),
                        "fold": rng.integers(0, 5, n)})
    pdf.loc[pdf.index % 17 == 0, "c"] = None
    df = spark.createDataFrame(pdf)
    fold_stats, test_stats, g = encode.fit_target_kfold(df, ["c"], "y", "fold", 5, 10.0)
    out = encode.apply_target(df, fold_stats, g, ["c"], fold_col="fold").toPandas().set_index("id")
    gm = pdf.y.mean()
    for i in [0, 1, 7, 34, 123, 399]:
        row = pdf.loc[i]
        if row.c is None:
            expect = gm
        else:
            other = pdf[(pdf.fold != row.fold) & (pdf.c == row.c)]
            expect = (other.y.sum() + 10 * gm) / (len(other) + 10) if len(other) else gm
        assert abs(out.loc[i, "c_te"] - expect) < 1e-9
    # test-side value = mean of the five fold encodings
    per = fold_stats.where("value = 'a'").toPandas()
    t = test_stats.where("value = 'a'").first()["te"]
    assert abs(t - per.te.mean()) < 1e-12


def test_label_per_fold_unseen_is_fold_class_count(spark):
    df = spark.createDataFrame([(0, "x"), (1, "y"), (1, "x"), (2, "z")], "fold int, c string")
    stats = encode.fit_label_per_fold(df, ["c"], "fold", 3)
    out = encode.apply_label_per_fold(df, stats, ["c"], "fold").orderBy("fold", "c").collect()
    # fold 1 trains on {x, z}: y is unseen -> 2; fold 2 trains on {x, y}: z is unseen -> 2
    assert [(r["fold"], r["c"]) for r in out] == [(0, 0), (1, 0), (1, 2), (2, 2)]


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    from sparkfold.operators import lookup
    stats = spark.range(50).selectExpr("id", "repeat('x', 1000) AS text")
    cached, small = lookup.materialize(stats)
    assert small and lookup.materialize(cached)[1]
    for key, value in (("sparkfold.broadcast.maxBytes", "200"), ("sparkfold.broadcast.maxRows", "10")):
        spark.conf.set(key, value)
        try:
            assert not lookup.materialize(cached)[1]
        finally:
            spark.conf.unset(key)
    cached.unpersist()


def test_ordered_target_uses_earlier_rows_only(spark):
    """One category holds most rows and spans many partitions; a NULL label counts for nothing; missing is a category."""
    import hashlib
    rows = [(i, "hot" if i % 3 else None, i % 2 if i != 7 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, c string, y int").repartition(4)
    values, totals = encode.fit_ordered_target(df, ["c", "absent"], "y", "id", prior_rows=2.0, seed=1)
    labels = [y for _, _, y in rows if y is not None]
    g, seen, want = sum(labels) / len(labels), {}, {}
    for i, c, y in sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}|1".encode()).hexdigest(), r[0])):
        s, n = seen.get(c, (0, 0))
        want[i] = (s + 2 * g) / (n + 2)
        if y is not None:
            seen[c] = (s + y, n + 1)
    got = {r.id: r.c_ots for r in values.collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-12
    new = spark.createDataFrame([(1, "hot"), (2, None), (3, "new")], "id long, c string")
    out = {r.id: r.c_ots for r in encode.apply_ordered_target(new, totals, ["c"]).collect()}
    assert abs(out[1] - (seen["hot"][0] + 2 * g) / (seen["hot"][1] + 2)) < 1e-12
    assert abs(out[2] - (seen[None][0] + 2 * g) / (seen[None][1] + 2)) < 1e-12 and abs(out[3] - g) < 1e-12
    assert encode.fit_ordered_target(df.limit(0), ["c"], "y", "id")[0].count() == 0
