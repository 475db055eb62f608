"""op9: links, components and sketches against plain set arithmetic."""

import random
import re

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from sparkfold.llm import queries
from sparkfold.llm import hyperminhash as H
from sparkfold.llm.shingles import shingle_sets, word_hashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain_set(text, width):
    words = WORDS.findall((text or "").translate(FOLD))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) or frozenset([tuple(words)])


def plain(rows, width, percent):
    """doc_id -> (set size, component) over all pairs."""
    sets = {d: plain_set(t, width) for d, t in rows if d is not None}
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in ids}


def same(df, rows, width=2, percent=80):
    want = plain(rows, width, percent)
    got = H.near_duplicates(df, width, percent).collect()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert len(got) == df.count()


def test_word_hashes_follow_the_words():
    texts = ["A b  a\tB", "", " \n", "\x0bx\x1cy z\x85", "é É e\u0301"]
    hashes, ends = word_hashes([t.encode() for t in texts])
    words = [w for t in texts for w in WORDS.findall(t.translate(FOLD))]
    assert ends.tolist() == np.cumsum([len(WORDS.findall(t)) for t in texts]).tolist()
    assert [[a == b for b in words] for a in words] == (hashes[:, None] == hashes[None]).tolist()
    assert [len(s) for s in shingle_sets([t.encode() for t in texts], 2)] == [len(plain_set(t, 2)) for t in texts]


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.95):
        for n in (300, 3000):
            base = rng.integers(0, 2**64, n, dtype=np.uint64)
            k = int(n * share)
            a = np.unique(base)
            b = np.unique(np.concatenate([base[:k], rng.integers(0, 2**64, n - k, dtype=np.uint64)]))
            x, y = H.registers([a, b])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(abs(H.estimate(int((x == y).sum()), len(a), len(b)) - true))
    assert max(errors) < 0.16 and np.mean(errors) < 0.06
    assert 0 < H.expected_collisions(12, 12) < 1


def test_odd_documents(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for width in (2, 5):
        same(odd, rows, width)
    assert H.near_duplicates(empty).count() == 0 and H.keep_one(empty).count() == 0
    left = H.keep_one(odd, 5)
    assert left.columns == odd.columns
    ids = sorted((r.doc_id for r in left.collect() if r.doc_id is not None))
    assert ids == sorted(d for d, (_, c) in plain(rows, 5, 80).items() if c == d)
    assert left.filter("doc_id is null").count() == 2


@pytest.mark.parametrize("few", [256, 0])
def test_chains_copies_and_short_texts(spark, few, monkeypatch):
    """Groups that only a chain connects, many near copies, sets of a few shingles; pairs and blocks agree."""
    monkeypatch.setattr(H, "FEW_PAIRS", few)
    monkeypatch.setattr(H, "CHUNK", 40)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, n = [], 0
    for _ in range(3):  # chains: each text is the last one with some words changed
        words = [word() for _ in range(80)]
        for _ in range(15):
            rows.append((n, " ".join(words)))
            n += 1
            for _ in range(rng.randint(2, 5)):
                words[rng.randrange(80)] = word()
    base = [word() for _ in range(120)]
    for _ in range(130):  # a large group around one text, some far out
        words = base[:]
        for _ in range(rng.choice([0, 1, 3, 8, 12, 16, 20])):
            words[rng.randrange(120)] = word()
        rows.append((n, " ".join(words)))
        n += 1
    for k in range(60):  # short sets, at the limit of 4 of 5
        rows.append((n, " ".join("pqrstuvw"[(k + i) % 8] for i in range(rng.randint(0, 8)))))
        n += 1
    rng.shuffle(rows)
    same(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 40)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r.node: r.label for r in H.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[node] == min(seen)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = plain(rows, 2, 80)
    got = queries.op9_near_duplicates(spark, SF001).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and any(not r.kept for r in got)


def test_one_query_does_not_multiply_a_large_group(spark):
    n = 20_000
    texts = spark.range(n).select(F.col("id").alias("rep"), F.concat(F.lit("text "), "id").alias("text"))
    groups = texts.select(F.lit(1).cast("long").alias("lead"), "rep", F.col("rep").alias("label"), (F.col("rep") == 7).alias("is_query"),
                          F.lit(n).cast("long").alias("n"), F.lit(1).cast("long").alias("queries"))
    members, queries_ = H.dealt_blocks(groups, texts)
    chunks = n // H.CHUNK
    assert members.count() == n and members.filter("q != 0").count() == 0
    assert queries_.count() == chunks and queries_.select("m").distinct().count() == chunks
    # every query meets every member once
    assert members.select("lead", "m", "q").join(queries_.select("lead", "m", "q"), ["lead", "m", "q"]).count() == n
    # a group without a query is not dealt at all
    none = groups.withColumns({"is_query": F.lit(False), "queries": F.lit(0).cast("long")})
    assert H.dealt_blocks(none, texts)[0].count() == 0


def test_a_doc_id_of_several_sets_has_no_estimate(spark):
    rng = np.random.default_rng(5)
    far, near = (np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64)) for _ in range(2))
    rows = [(1, far), (1, near), (2, near), (3, far), (4, np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64)))]
    nodes = spark.createDataFrame([(i, len(s), bytearray(H.registers([s])[0].tobytes())) for i, s in rows], "rep long, n_shingles long, registers binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (2, 4)], "a long, b long")
    assert {(r.a, r.b) for r in H.likely(pairs, nodes, 80).collect()} == {(1, 2), (1, 3)}
