"""op6, op7, op10: held-out results, odd rows, and what each method promises."""

import zlib

import numpy as np
import pytest
from conftest import OTHER, PROSE, SF01

from sparkfold.llm import langid, pu_quality, queries, toxicity


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def folds(rows, modulus, rest):
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % modulus == rest) for r in rows)


def held_out(spark, rows, column):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    return [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


# quality ---------------------------------------------------------------------
def test_quality_held_out(spark):
    rows = queries.op6_pu_quality(spark, SF01).collect()
    folds(rows, 5, 0)
    own = held_out(spark, rows, "quality")
    assert auc([(r.score, y) for r, y in own]) > 0.97
    assert np.mean([r.predicted == y for r, y in own]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_prior_and_risk():
    rng = np.random.default_rng(2)
    good = lambda n: rng.normal(1.0, 1, (n, 6))
    bad = lambda n: rng.normal(-1.0, 1, (n, 6))
    pos, unl = good(1500), np.concatenate([good(1050), bad(450)])
    rng.shuffle(unl)
    model = pu_quality.fit(pos, unl)
    assert abs(model.prior - 0.7) < 0.06
    score = lambda x: ((x - model.mean) / model.spread) @ model.weights + model.bias
    assert np.mean(score(good(500)) > 0) > 0.95 and np.mean(score(bad(500)) < 0) > 0.9


def test_junk_that_the_sample_misses_is_learned_from_the_whole():
    """A kind of junk in 2 % of the rows and in none of the sample is rejected once sums over all rows are taken."""
    rng = np.random.default_rng(4)
    good = lambda n: np.c_[rng.normal(1.0, 1, (n, 6)), np.zeros(n)]
    bad = lambda n: np.c_[rng.normal(-1.0, 1, (n, 6)), np.zeros(n)]
    odd_junk = lambda n: np.c_[rng.normal(1.0, 1, (n, 6)), np.full(n, 3.0)]
    pos, sample = good(800), np.concatenate([good(400), bad(200)])
    everything = np.concatenate([sample, good(6000), bad(3000), odd_junk(200)]).astype(np.float32)
    rng.shuffle(sample)
    whole = pu_quality.Rows(everything, np.arange(len(everything)) % 2)
    score = lambda model, x: ((x - model.mean) / model.spread) @ model.weights + model.bias
    model, short = (pu_quality.fit(pos, sample, whole, sums=n) for n in (8, 0))
    junk = odd_junk(200)
    assert np.mean(score(short, junk) > 0) > 0.9 and np.mean(score(model, junk) < 0) > 0.9
    assert np.mean(score(model, good(500)) > 0) > 0.93 and abs(model.prior - 0.67) < 0.06


def test_stored_rows_sum_like_an_array(spark):
    docs = spark.createDataFrame([(i, PROSE[:40 + i * 7] + "#" * (i % 9)) for i in range(60)] + [(None, "x"), (3, None)], "doc_id long, text string")
    table = pu_quality.unlabelled_rows(docs, 5, 0)
    x, half = pu_quality.first_rows(table, 1000)
    assert len(x) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in [*range(60), 3]) and set(half) == {0, 1}
    plain, stored = pu_quality.Rows(x, half), pu_quality.StoredRows(table)
    rng = np.random.default_rng(1)
    w = rng.normal(0, 1, pu_quality.DIMS)
    assert np.allclose(plain.moments(), stored.moments()) and np.allclose(plain.risk(w, 0.3), stored.risk(w, 0.3), rtol=1e-4)
    scorers = {0: (w, 0.1, np.array([-1.0, 0.0, 1.0])), 1: (-w, 0.0, np.array([0.5]))}
    assert all(np.array_equal(v, stored.above(scorers)[h]) for h, v in plain.above(scorers).items())


def test_quality_odd(odd, empty, odd_labels, no_labels):
    rows = pu_quality.classify(odd, odd_labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    folds(rows, 5, 0)
    assert pu_quality.classify(empty, odd_labels).count() == 0
    assert {r.score for r in pu_quality.classify(odd, no_labels).collect()} == {0.5}
    kept = pu_quality.keep_good(odd, odd_labels)
    assert kept.columns == odd.columns
    good = sorted((str(r.doc_id) for r in rows if r.predicted))
    assert sorted(str(r.doc_id) for r in kept.collect()) == good
    assert pu_quality.keep_good(odd, no_labels).count() == odd.count()


def test_long_texts_are_read_to_the_end():
    clean = (PROSE * 40).encode()
    assert not np.array_equal(pu_quality.features([clean]), pu_quality.features([clean + b"### &&& " * 50]))
    one = pu_quality.features([clean, b"", b"x"])
    assert np.allclose(one[0], pu_quality.features([clean])[0]) and np.isfinite(one).all()


# language --------------------------------------------------------------------
def test_language_held_out(spark):
    rows = queries.op7_language_by_compression(spark, SF01).collect()
    folds(rows, 5, 0)
    lang = {r.doc_id: (r.lang, len(r.text or "")) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    own = [(r.lang_pred == lang[r.doc_id][0], lang[r.doc_id][1]) for r in rows if r.held_out and lang[r.doc_id][0]]
    assert np.mean([ok for ok, _ in own]) > 0.97 and np.mean([ok for ok, n in own if n >= 200]) > 0.99
    assert np.mean([r.rejected for r in rows]) < 0.05


def test_language_odd(spark, odd, empty):
    rows = {r.doc_id: r for r in langid.classify(odd).collect()}
    learned = {r.lang for r in odd.collect()} - {None}
    assert rows[4].lang_pred == rows[5].lang_pred == rows[6].lang_pred == rows[15].lang_pred == "und" and rows[15].score == 0
    assert all(r.lang_pred in learned | {"und"} and 0 <= r.score <= 1 for r in rows.values())
    assert langid.classify(empty).count() == 0
    none = odd.withColumn("lang", odd.lang.substr(10, 5)).where("false").unionByName(odd.selectExpr(*[c if c != "lang" else "cast(null as string) as lang" for c in odd.columns]))
    assert {r.lang_pred for r in langid.classify(none).collect()} == {"und"}


def test_narrow_margins_are_rejected():
    judge = langid.Judge({"x": PROSE.encode(), "y": OTHER.encode()})
    assert judge.judge(PROSE[10:120], 0.01)[0] == "x" and judge.judge(OTHER[10:120], 0.01)[0] == "y"
    assert not judge.judge(PROSE[10:120], 0.01)[2] and judge.judge("zq", 0.01)[2]


# toxicity --------------------------------------------------------------------
def test_toxicity_held_out(spark):
    rows = queries.op10_toxicity(spark, SF01).collect()
    folds(rows, 3, 1)
    own = held_out(spark, rows, "toxic")
    assert auc([(r.score, y) for r, y in own]) > 0.85
    caught = [r.predicted for r, y in own if y]
    assert np.mean(caught) > 0.6 and np.mean([r.predicted for r, y in own if not y]) < 0.03


def test_rare_words_count_in_large_samples(spark):
    """A word of three toxic documents is learned from over 1,000 documents as it is from few."""
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = set(ids[::4])
    rare = set(ids[:12:4])
    text = lambda i: f"plain words stand here {i % 50} " + ("nasty " if i in toxic and i % 3 else "") + ("zorblax" if i in rare else "")
    docs = spark.createDataFrame([(i, text(i)) for i in ids], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int"))
    assert len(ids) > 1000 and len(rare) == 3
    assert model.weights[toxicity.word_features([b"zorblax"])[1][0]].sum() > 0


def test_toxicity_odd(odd, empty, odd_labels, no_labels):
    rows = toxicity.classify(odd, odd_labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert toxicity.classify(empty, odd_labels).count() == 0
    assert {r.predicted for r in toxicity.classify(odd, no_labels).collect()} == {0}


@pytest.mark.parametrize("even", [0.0, 30.0])
def test_identity_terms_do_not_move_the_score(even):
    """Training texts name one group mostly in toxic ones; with the penalty, swapping the group hardly moves the logit."""
    rng = np.random.default_rng(5)
    neutral = [f"word{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = list(rng.choice(neutral, 25))
        if toxic and rng.random() < 0.8:
            words.append("awfulslur")
        if rng.random() < (0.7 if toxic else 0.05):
            words.append("muslim")
        elif rng.random() < 0.2:
            words.append("christian")
        texts.append(" ".join(words).encode())
        labels.append(float(toxic))
    swap = toxicity.swaps()
    words, features, ends = toxicity.word_features(texts)
    rows, variants, start = [], [], 0
    for i, end in enumerate(ends.tolist()):
        own, first = np.unique(words[start:end], return_index=True)
        r = features[start:end][first]
        rows.append(r)
        named = [k for k, w in enumerate(own.tolist()) if w in swap]
        if named:
            other = r.copy()
            for k in named:
                other[k] = swap[int(own[k])]
            variants.append((i, other))
        start = end
    y = np.array(labels)
    model = toxicity.fit(rows, y, np.ones(len(y)), variants, even=even)
    logit = lambda p: np.log(p / (1 - p))
    plain = " ".join(neutral[:20])
    a, b, c = model.scores([f"{plain} muslim".encode(), f"{plain} jewish".encode(), f"{plain} awfulslur".encode()])
    gap = abs(logit(a) - logit(b))
    assert c > 0.5
    assert gap < 0.6 if even else gap > 1.0
