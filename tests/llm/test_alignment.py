"""op12: groups, links and corpus counts equal a plain comparison of token byte ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SF001

from sparkfold.llm import queries
from sparkfold.llm.alignment import TwoTokenizers, align, align_documents, links, pack, unpack

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return TwoTokenizers(A, B)


def plain_groups(a, b):
    common = sorted(set(a) & set(b))
    return [([i for i, x in enumerate(a) if p < x <= c], [j for j, y in enumerate(b) if p < y <= c]) for p, c in zip([0, *common], common)]


def plain_links(a, b):
    return [(i, j) for i, (s, e) in enumerate(zip([0, *a], a)) for j, (t, f) in enumerate(zip([0, *b], b)) if max(s, t) < min(e, f)]


def test_random_end_arrays():
    rng = random.Random(2)
    for _ in range(400):
        lanes_a, lanes_b, a, b = [0], [0], [], []
        for _ in range(rng.randint(0, 5)):  # lanes meet at common ends
            base, size = (a[-1] if a else 0), rng.randint(1, 60)
            density = rng.choice([0.2, 0.6, 0.95])
            cuts = [{base + x for x in range(1, size) if rng.random() < density} | {base + size} for _ in "ab"]
            if rng.random() < 0.5:  # long one-to-one stretches with a few differences
                cuts[1] = set(cuts[0]) ^ ({rng.randrange(base + 1, base + size)} if size > 1 else set())
            a += sorted(cuts[0])
            b += sorted(cuts[1])
            lanes_a.append(len(a))
            lanes_b.append(len(b))
        ends_a, ends_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        last_a, last_b = align(ends_a, ends_b, np.array(lanes_a), np.array(lanes_b))
        groups = plain_groups(a, b)
        assert np.flatnonzero(last_a).tolist() == [g[0][-1] for g in groups]
        assert np.flatnonzero(last_b).tolist() == [g[1][-1] for g in groups]
        left, right = links(ends_a, ends_b, last_a, last_b)
        assert list(zip(left.tolist(), right.tolist())) == plain_links(a, b)


def test_packed_numbers_come_back():
    for n in ([], [0], [1, 2**32 - 1, 7], list(range(1000))):
        assert unpack(pack(np.array(n, dtype=np.int64))).tolist() == n


def walked_groups(a, b):
    out, i, j = [], 0, 0
    for c in sorted(set(a) & set(b)):
        p, q = a.index(c, i) + 1, b.index(c, j) + 1
        out.append((list(range(i, p)), list(range(j, q))))
        i, j = p, q
    return out


def walked_links(a, b):
    out, i, j = [], 0, 0
    while i < len(a):
        out.append((i, j))
        i, j = i + (a[i] <= b[j]), j + (b[j] <= a[i])
    return out


def plain(both, rows, group=plain_groups, link=plain_links):
    """Expected rows of (doc_id, text): every pair of tokens whose byte ranges overlap, counted over all rows."""
    found, total = [], Counter()
    for doc_id, text in rows:
        ids = (both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)) if text else ([], [])
        parts = [[table.blob[table.starts[i]:table.starts[i] + table.sizes[i]].tobytes() for i in side] for side, table in zip(ids, (both.bytes_a, both.bytes_b))]
        if any(b"".join(p) != (" " + (text or "")).encode() for p in parts):
            ids, parts = ([], []), ([], [])
        ends = [np.cumsum([len(x) for x in p]).astype(int).tolist() for p in parts]
        groups = group(*ends)
        pairs = [(ids[0][i], ids[1][j]) for i, j in link(*ends)]
        total.update(pairs)
        spelled = ";".join(",".join(str(ids[0][i]) for i in g) + "|" + ",".join(str(ids[1][j]) for j in h) for g, h in groups)
        found.append((doc_id, len(ids[0]), len(ids[1]), len(groups), pairs, spelled))
    best = Counter()
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    return sorted(((d, a, b, g, len(p), sum(total[x] == best[x[1]] for x in p), sum(total[x] for x in p), s) for d, a, b, g, p, s in found), key=repr)


def test_odd_documents(spark, both, odd, empty):
    extra = spark.createDataFrame([(50, "a ▁ b"), (51, "<s> x</s><unk><|endoftext|> <0x41>"), (52, "  two  spaces \n x"), (53, " a" * 30)], "doc_id long, text string")
    rows = odd.select("doc_id", "text").filter("text is null or length(text) < 3000").unionByName(extra)
    docs = odd.filter("text is null or length(text) < 3000").unionByName(extra, allowMissingColumns=True)
    got = sorted(((*tuple(r)[:-1], r.groups.decode()) for r in align_documents(docs, A, B).collect()), key=repr)
    assert got == plain(both, [tuple(r) for r in rows.collect()])
    assert align_documents(odd, A, B).count() == odd.count()
    assert align_documents(empty, A, B).count() == 0


def test_query_against_plain_links(spark, both):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {w[0]: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in plain(both, docs, walked_groups, walked_links)}
    got = {r.doc_id: tuple(r) for r in queries.op12_tokenizer_alignment(spark, SF001).collect()}
    assert got == want
