"""Blends and soup: alignment fallbacks, normalisation, ties."""

import pytest
from pyspark.sql import functions as F

from sparkfold.operators import ensemble


def test_soup_rows_and_ties(spark):
    preds = spark.createDataFrame([
        (1, "s1", "A", 0.5), (1, "s1", "B", 0.5),
        (2, "s1", "A", 0.2), (2, "s1", "B", 0.8),
        (1, "s2", "A", 0.5), (1, "s2", "B", 0.5),
        (2, "s2", "A", 0.4), (2, "s2", "B", 0.6)], "id int, source string, class string, proba double")
    w = spark.createDataFrame([("s1", 1.0), ("s2", 1.0)], "source string, weight double")
    cls = spark.createDataFrame([("A",), ("B",)], "class string")
    out = {r["id"]: (r["label"], r["proba"]) for r in ensemble.soup(preds, w, cls).collect()}
    assert out[1][0] == "A"            # probability tie -> first class in sort order
    assert out[2][0] == "B" and abs(out[2][1] - 0.7) < 1e-9


def test_align_missing_row_uniform(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    p = spark.createDataFrame([(1, "A", 0.9), (1, "B", 0.1)], "id int, class string, proba double")
    out = {(r["id"], r["class"]): r["proba"] for r in ensemble.align_to_ids(ids, p, ["A", "B", "C"]).collect()}
    assert out[(2, "A")] == out[(2, "B")] == out[(2, "C")] == 1 / 3
    assert out[(1, "C")] == 1 / 3 and out[(1, "A")] == 0.9


def test_unknown_label_uniform(spark):
    labels = spark.createDataFrame([(1, "A"), (2, "Z")], "id int, label string")
    out = {(r["id"], r["class"]): r["proba"] for r in ensemble.label_to_onehot(labels, ["A", "B"]).collect()}
    assert out == {(1, "A"): 1.0, (1, "B"): 0.0, (2, "A"): 0.5, (2, "B"): 0.5}


def test_soup_refuses_a_class_that_is_not_listed(spark):
    rows = [(1, "s", "A", 0.2), (1, "s", "B", 0.3), (1, "s", "C", 0.5), (2, "s", "C", 1.0)]
    w = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    cls = spark.createDataFrame([("A",), ("B",)], "class string")
    for bad in (rows, [(1, "s", None, 1.0)]):
        with pytest.raises(Exception, match="not listed"):
            ensemble.soup(spark.createDataFrame(bad, "id long, source string, class string, proba double"), w, cls).collect()


def test_oof_check_sees_missing_and_unexpected_ids(spark):
    oof = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "id long")
    want = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,)], "id long")
    assert tuple(ensemble.oof_check(oof, expected=want).first()) == (5, 4, 1, 2, 2)
    assert tuple(ensemble.oof_check(oof.limit(0), expected=want.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_oof_check_counts_duplicates(spark):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "id int, proba double")
    b = spark.createDataFrame([(2, 0.3), (3, 0.4)], "id int, proba double")
    r = ensemble.oof_check(ensemble.assemble_oof([a, b])).first()
    assert (r["rows"], r["ids"], r["duplicated"]) == (4, 3, 1)


def test_blends_refuse_bad_sources(spark):
    preds = spark.createDataFrame([(1, "a", "x", 0.5), (1, "b", "x", 0.7)], "id int, source string, class string, proba double")
    cls = spark.createDataFrame([("x",)], "class string")
    weights = lambda *w: spark.createDataFrame(list(w), "source string, weight double")
    assert abs(ensemble.soup(preds, weights(("a", 0.5), ("b", 0.5)), cls).first()["proba"] - 1.0) < 1e-9
    for bad in (weights(("a", 1.0)), weights(("a", 0.5), ("b", 0.3), ("c", 0.2)), weights(("a", 0.5), ("b", 0.3), ("b", 0.2))):
        with pytest.raises(ValueError):
            ensemble.soup(preds, bad, cls)
        with pytest.raises(ValueError):
            ensemble.blend_long(preds, bad, model_col="source")
    twice = preds.unionByName(preds.limit(1))
    for out in (ensemble.soup(twice, weights(("a", 0.5), ("b", 0.5)), cls), ensemble.blend_long(twice, weights(("a", 0.5), ("b", 0.5)), model_col="source"),
                ensemble.align_to_ids(preds.select("id").distinct(), twice, ["x"])):
        with pytest.raises(Exception, match="more than once"):
            out.collect()


def test_searched_ensemble_is_applied_to_new_rows(spark):
    from sparkfold.operators import search
    rows = [(i, m, p, i % 2) for i in range(40) for m, p in (("good", 0.9 * (i % 2) + 0.05), ("bad", 0.5), ("worse", 0.9 - 0.8 * (i % 2)), ("fair", 0.3 + 0.3 * (i % 2)))]
    preds = spark.createDataFrame(rows, "id long, model string, proba double, y int")
    found = search.fit_ensemble(preds, "y", k=3)
    got = found.orderBy("rank").collect()
    assert [r.model for r in got][:2] == ["fair", "good"] and len(got) == 3 and got[0].f1 == 1.0  # equal F1: by name
    out = ensemble.apply_ensemble(preds.drop("y"), found)
    assert {r.id: r.is_positive for r in out.collect()} == {i: i % 2 for i in range(40)}
    two = search.fit_ensemble(preds.where("model in ('good', 'bad')"), "y", k=3)
    assert two.count() == 2
    for bad in (preds.where("not (id = 3 and model = 'fair')"), preds.unionByName(preds.where("id = 3"))):
        with pytest.raises(Exception, match="exactly one"):
            ensemble.apply_ensemble(bad, found).collect()
    with pytest.raises(Exception, match="more than once"):
        search.fit_ensemble(preds.unionByName(preds.where("id = 3")), "y").collect()
