"""op13: runs equal a plain search over all periods; the planted rewriting and digests equal plain Python."""

import hashlib
import random
import zlib

import numpy as np
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkfold.llm import queries
from sparkfold.llm.word_runs import common_words, find_runs, periodic_runs, suffix_ranks


def plain_runs(words, least=6, times=4):
    """Longest stretches of each period, smallest period first for one stretch."""
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def found(docs, least=6, times=4):
    codes = np.array([x for d in docs for x in d], dtype=np.int64)
    which, *columns = find_runs(codes, np.cumsum([len(d) for d in docs], dtype=np.int64), least, times)
    out = [[] for _ in docs]
    for k, *run in zip(which.tolist(), *(c.tolist() for c in columns)):
        out[k].append(tuple(run))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=6))
def test_small_alphabets(docs):
    assert found(docs) == [plain_runs(d) for d in docs]
    assert found(docs, least=3, times=3) == [plain_runs(d, 3, 3) for d in docs]


def test_planted_periods():
    rng = random.Random(9)
    docs = []
    for _ in range(200):
        doc = [rng.randrange(30) for _ in range(rng.randint(0, 50))]
        for _ in range(rng.randint(1, 3)):
            unit = [rng.randrange(30) for _ in range(rng.randint(1, 12))]
            at = rng.randint(0, len(doc))
            doc[at:at] = (unit * 9)[:rng.randint(0, 90)]
        docs.append(doc)
    docs += [[1] * 500, [1, 2] * 300, [], [7], [1, 1, 2] * 100 + [1, 1, 2, 2] * 80]
    assert found(docs) == [plain_runs(d) for d in docs]


def test_shared_symbols_of_two_suffixes():
    rng = random.Random(1)
    symbols = [rng.randrange(2) for _ in range(300)]
    keys = np.array([*(s + 1 for s in symbols), 0])
    suffixes, levels = suffix_ranks(keys)
    assert suffixes.tolist() == sorted(range(301), key=lambda i: keys[i:].tolist())
    a, b = np.arange(0, 299), np.arange(1, 300)
    want = [next(k for k in range(301) if keys[x + k] != keys[y + k]) for x, y in zip(a, b)]
    assert common_words(levels, a, b).tolist() == want


def collapsed(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def test_odd_documents(spark, odd, empty):
    extra = spark.createDataFrame([(60, "a b " * 50), (61, "x\x1cy z\x0b" * 8 + "x\x1cy"), (62, "A a A a A a A a")], "doc_id long, text string")
    docs = odd.unionByName(extra, allowMissingColumns=True)
    got = sorted((repr(r.doc_id), r.n_words, repr([tuple(x) for x in r.runs]), r.collapsed.decode()) for r in periodic_runs(docs).collect())
    want = []
    for r in docs.select("doc_id", "text").collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        runs = plain_runs(words) if len(words) < 5000 else []  # the long one repeats its units after 400 words each: none below
        if len(words) >= 5000:
            runs = [(0, len(words), 400)]
        want.append((repr(r.doc_id), len(words), repr(runs), collapsed(words, runs)))
    assert got == sorted(want)
    assert periodic_runs(empty).count() == 0


def test_query_against_plain_runs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, SF001).collect()}
    assert len(got) == len(docs)
    n_runs = 0
    for doc_id, text in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        n_runs += len(runs)
        best = (None, None, None, None)
        for s, length, q in runs:
            if best[0] is None or length * best[2] > best[1] * q:
                best = (s, length, q, 1000 * length // q)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want = (doc_id, len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))))
        assert got[doc_id] == want
    assert n_runs > 20
