"""Threshold and weight searches against brute force."""

import itertools

import numpy as np
import pandas as pd

from sparkfold.operators import search


def _f1(y, p, t):
    pred = p >= t
    tp = int(((y == 1) & pred).sum()); fp = int(((y == 0) & pred).sum()); fn = int(((y == 1) & ~pred).sum())
    return 0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn)


def _brute(y, p, grid):
    best_t, best_f = 0.5, -1.0
    for t in grid:
        f = _f1(y, p, t)
        if f > best_f:
            best_t, best_f = t, f
    return best_t, best_f


def test_threshold_search_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 700)
    p = np.round(np.clip(0.35 * y + rng.random(700) * 0.7, 0, 1), 2)  # many values on the grid itself
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    got = search.best_threshold(df, "y", "p").first()
    t, f = _brute(y, p, [(10 + i) / 100 for i in range(81)])
    assert abs(got["threshold"] - t) < 1e-12 and abs(got["f1"] - f) < 1e-12


def test_f1_zero_when_nothing_positive(spark):
    df = spark.createDataFrame([(0, 0.05), (0, 0.01)], "y int, p double")
    assert search.best_threshold(df, "y", "p").first()["f1"] == 0.0


def test_f1_tie_takes_lowest_threshold(spark):
    # all scores identical: every threshold up to the score gives the same F1
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5)], "y int, p double")
    assert search.best_threshold(df, "y", "p").first()["threshold"] == 0.1


def test_margin_grid_matches_linspace(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    s = rng.normal(size=300) + y
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    got = search.best_threshold_margin(df, "y", "s", 300).first()
    t, f = _brute(y, s, np.linspace(s.min(), s.max(), 300))
    assert abs(got["f1"] - f) < 1e-12 and abs(got["threshold"] - t) < 1e-9


def test_weight_grid_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 200)
    P = np.clip(rng.random((200, 3)) * 0.8 + 0.2 * y[:, None], 0, 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "a": P[:, 0], "b": P[:, 1], "c": P[:, 2]}))
    got = search.weight_grid_search(df, "y", ["a", "b", "c"]).first()
    best = (-1.0, None)
    for ws in itertools.product([0.0, 0.25, 0.5, 0.75, 1.0], repeat=3):
        if sum(ws) == 0:
            continue
        wn = [w / sum(ws) for w in ws]
        pe = np.zeros(200)
        for w, col in zip(wn, P.T):
            pe += w * col
        t, f = _brute(y, pe, [(10 + i) / 100 for i in range(81)])
        if f > best[0]:
            best = (f, t, wn)
    assert abs(got["f1"] - best[0]) < 1e-12 and abs(got["threshold"] - best[1]) < 1e-12
    assert np.allclose([got["w0"], got["w1"], got["w2"]], best[2])
    assert len(search.weight_tuples(3)) == 91  # no all-zero tuple; equal shares once


def test_null_scores_are_predicted_zero_everywhere(spark):
    df = spark.createDataFrame([(1, 0.9), (1, None), (0, 0.2), (1, 0.8)], "y int, p double")
    grid = search.fixed_grid(50, 1, 100)
    curve = search.threshold_curve(df, "y", "p", grid).first()["f1"]
    assert curve == search.f1_at(df, "y", "p", [0.5]).first()["f1"] and abs(curve - 0.8) < 1e-9


def test_knn_memory_and_ties(spark):
    """Tiles bound a task's memory whatever the block sizes; ties go to the smaller id across tiles."""
    import tracemalloc

    import numpy as np
    import pandas as pd

    from sparkfold.operators import neighbors as N
    assert 8 * N.QUERY_TILE * N.REF_TILE * 64 < 50e6
    rng = np.random.default_rng(3)
    R = rng.integers(0, 3, (5000, 16)).astype(float)
    Q = rng.integers(0, 3, (70, 16)).astype(float)
    pdf = pd.DataFrame({"id": [*range(5000), *range(70)], "vec": [*R, *Q], "label": [0] * 5070, "_side": [1] * 5000 + [0] * 70})
    tracemalloc.start()
    out = N._block_topk(7)((0, 0), pdf)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()
    for q, cands in zip(out["qid"], out["cands"]):
        d2 = ((R - Q[q]) ** 2).sum(axis=1)
        assert [c["rid"] for c in cands] == sorted(range(5000), key=lambda i: (d2[i], i))[:7]


def test_knn_with_null_labels_and_vectors(spark):
    from sparkfold.operators import neighbors
    rows = [(1, [0.0, 0.0], 5), (2, [0.1, 0.0], None), (3, None, 6), (4, [9.0, 9.0], 7)]
    train = spark.createDataFrame(rows, "id long, vec array<double>, label long")
    test = spark.createDataFrame([(10, [0.1, 0.0]), (11, None), (12, [8.0, 8.0])], "id long, vec array<double>")
    assert {r.id: r.pred for r in neighbors.knn_vote(train, test, k=1).collect()} == {10: 5, 11: None, 12: 7}
    none = train.where("id = 3")
    assert {r.id: r.pred for r in neighbors.knn_vote(none, test, k=1).collect()} == {10: None, 11: None, 12: None}


def plain_votes(R, labels, Q, k):
    out = {}
    for q, v in Q.items():
        near = sorted(R, key=lambda i: (((R[i] - v) ** 2).sum(), i))[:k]
        votes = {}
        for i in near:
            votes[labels[i]] = votes.get(labels[i], 0) + 1
        out[q] = min(votes, key=lambda c: (-votes[c], c)) if votes else None
    return out


def test_knn_with_pivots_equals_brute_force(spark):
    """Clusters, a hot cell of equal vectors, whole-number ties, small blocks: the same votes, fewer distances."""
    import numpy as np

    from sparkfold.operators import neighbors
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 20, (12, 8))
    clustered = centres[rng.integers(0, 12, 900)] + rng.normal(0, 1, (900, 8))
    hot = np.repeat(centres[:1], 450, axis=0)
    whole = rng.integers(0, 3, (300, 8)).astype(float)
    vecs = np.concatenate([clustered, hot, whole])
    R = dict(enumerate(vecs))
    labels = {i: int(rng.integers(0, 5)) for i in R}
    Q = {10_000 + i: v for i, v in enumerate(np.concatenate([vecs[rng.integers(0, len(vecs), 60)] + rng.normal(0, 0.5, (60, 8)),
                                                             vecs[::97], rng.integers(0, 3, (30, 8)).astype(float)]))}
    train = spark.createDataFrame([(i, v.tolist(), labels[i]) for i, v in R.items()], "id long, vec array<double>, label long")
    test = spark.createDataFrame([(q, v.tolist()) for q, v in Q.items()], "id long, vec array<double>")
    for k, cell_rows, block_rows in ((7, 40, 50), (5, 3000, 200)):
        got = {r.id: r.pred for r in neighbors.knn_vote(train, test, k=k, cell_rows=cell_rows, block_rows=block_rows).collect()}
        assert got == plain_votes(R, labels, Q, k)
    work = neighbors.knn_work(train, test, k=7, cell_rows=40, block_rows=50).first()
    to_pivots = 42 * (len(R) + 2 * len(Q))  # every row once, every query in both rounds: much for so few queries
    assert work.n_brute == len(Q) * len(R) and work.n_pivots == 42
    assert to_pivots < work.n_computed < to_pivots + 0.4 * work.n_brute and work.saved > 0


def test_knn_with_fewer_rows_than_k_and_none(spark):
    from sparkfold.operators import neighbors
    train = spark.createDataFrame([(1, [0.0], 4), (2, [5.0], 3), (3, [5.0], 3)], "id long, vec array<double>, label long")
    test = spark.createDataFrame([(10, [0.1]), (11, None), (None, [1.0])], "id long, vec array<double>")
    got = {r.id: r.pred for r in neighbors.knn_vote(train, test, k=7, cell_rows=1).collect()}
    assert got == {10: 3, 11: None, None: None}
    assert neighbors.knn_vote(train, test.limit(0), k=2, cell_rows=1).count() == 0
    none = neighbors.knn_work(train.limit(0), test, k=2).first()
    assert (none.n_rows, none.n_computed, none.saved) == (0, 0, 0.0)


def test_cells_of_queries_are_arrow_arrays_of_bounded_memory():
    """10,000 queries that must meet all 256 cells: 2.56 million (cell, gap) pairs, never Python objects."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from sparkfold.operators import neighbors as N
    rng = np.random.default_rng(2)
    pivots, vecs = rng.normal(size=(256, 4)), rng.normal(size=(10_000, 4))
    counts, low, high = np.ones(256, dtype=np.int64), np.zeros(256), np.full(256, 99.0)
    counts[7] = 0
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), pa.array(list(vecs)), pa.array(np.full(10_000, 99.0)), pa.array(np.arange(10_000))],
                                       ["id", "vec", "_bound", "_salt"])
    fn = N._cells_of_queries(pivots, N._gaps(pivots, pivots), counts, low, high, 1, True)
    tracemalloc.start()
    met, rows = 0, 0
    for out in fn(iter([batch])):
        cells = out.column("_cells")
        met, rows = met + len(cells.flatten()), rows + out.num_rows
        first = cells[0].as_py()
    assert tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()
    assert rows == 10_000 and met > 10_000 * 250 and 7 not in [c["cell"] for c in first]
    v = vecs[out.column("id")[0].as_py()]
    assert all(abs(c["gap"] - np.linalg.norm(v - pivots[c["cell"]])) < 1e-12 for c in first)


def test_block_keeps_what_the_bound_allows_and_computes_few_differences(monkeypatch):
    """Rows beyond a query's bound are left to other blocks; ties at the bound stay; distances come from one product."""
    import numpy as np
    import pandas as pd

    from sparkfold.operators import neighbors as N
    rng = np.random.default_rng(4)
    for offset in (0.0, 1e6):
        R, Q = rng.integers(0, 4, (3000, 6)) + offset, rng.integers(0, 4, (40, 6)) + offset
        d2 = ((Q[:, None] - R[None]) ** 2).sum(axis=2)
        bound = np.sqrt(np.sort(d2, axis=1)[:, 2])
        gaps = np.linalg.norm(np.concatenate([R, Q]) - R[0], axis=1)
        pdf = pd.DataFrame({"id": [*range(3000), *range(40)], "vec": [*R.astype(float), *Q.astype(float)], "label": [0] * 3040,
                            "_side": [1] * 3000 + [0] * 40, "_gap": gaps, "_bound": [*[None] * 3000, *bound]})
        out = N._block_topk(7, 256)((0, 0, 0), pdf)
        for q, cands in zip(out["qid"], out["cands"]):
            near = sorted((d, i) for i, d in enumerate(d2[q].tolist()) if d <= bound[q] ** 2 * (1 + 1e-9))[:7]
            assert [(c["d2"], c["rid"]) for c in cands] == near
