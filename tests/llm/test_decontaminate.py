"""op3: the bit-parallel distance and the whole search against plain dynamic programming."""

import math
import random

import numpy as np
import pytest
from conftest import OTHER, PROSE, SF001

from sparkfold.llm import decontaminate as decontaminate_module
from sparkfold.llm import queries
from sparkfold.llm.decontaminate import Matcher, best_match, cuts_by_rarity, decontaminate, find_passages, fold, fold_places


def slow(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, x in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != x)))
        before = row
    return min(before), before.index(min(before))


def test_best_match():
    rng = random.Random(2)
    for _ in range(1500):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        assert best_match(p, t) == slow(p, t)


def test_every_passage_within_the_budget_is_found():
    rng = random.Random(3)
    found = 0
    for _ in range(300):
        item = "".join(rng.choice("abcde ") for _ in range(rng.randint(20, 60))).strip() or "abc"
        rate = rng.choice([0.05, 0.1, 0.2])
        edited = list(fold(item).strip())
        for _ in range(rng.randint(0, 8)):
            k = rng.randrange(len(edited) + 1)
            edited[k:k + rng.randint(0, 1)] = rng.choice(["", "q", "zz"])
        text = "".join(rng.choice("abcde ") for _ in range(rng.randint(0, 50))) + "".join(edited) + "".join(rng.choice("abcde ") for _ in range(rng.randint(0, 50)))
        folded = fold(text)
        pattern = fold(item).strip()
        distance, _ = slow(pattern, folded)
        got = Matcher([(1, item)], rate).find(folded)
        assert bool(got) == (distance <= math.floor(rate * len(pattern)))
        found += bool(got)
        if got:
            assert got[0][0] >= distance
    assert found > 50


def test_fold_places():
    text = "A--B Éİ c!"
    places = fold_places(text)
    assert len(places) == len(fold(text)) and [text[p] for p, c in zip(places, fold(text)) if c == "b"] == ["B"]


def test_odd_documents(spark, odd, empty):
    items = spark.createDataFrame([(1, PROSE[:150]), (2, None), (3, ""), (4, "?!"), (None, OTHER), (5, OTHER[30:130].upper()), (6, OTHER[30:130].replace("winter", "wintre")), (7, PROSE[:150])],
                                  "item_id long, text string")
    rows = find_passages(odd, items).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert {(d, i) for d in (1, 2, 3, 13, None) for i in (1, 7)} <= got and {(12, 5), (13, 5), (16, 5), (16, 6)} <= got
    assert {i for _, i in got} == {1, 5, 6, 7} and {r.distance for r in rows if r.item_id == 5} == {0}
    left = decontaminate(odd, items)
    assert left.columns == odd.columns
    assert {r.doc_id for r in left.collect()}.isdisjoint({1, 2, 3, 12, 13, 16}) and {4, 5, 6, 7, 9, 10, 11} <= {r.doc_id for r in left.collect()}
    assert find_passages(empty, items).count() == 0 and decontaminate(empty, items).count() == 0
    none = items.limit(0)
    assert find_passages(odd, none).count() == 0 and decontaminate(odd, none).count() == odd.count()
    assert {(r.doc_id, r.item_id) for r in find_passages(odd, items, block_bytes=200).collect()} == got  # several blocks


def test_query_against_whole_items(spark):
    items = [(r.item_id, fold(r.text).strip()) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    docs = [(r.doc_id, fold(r.text or "")) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {(d, i) for d, t in docs for i, x in items if x in t}
    rows = queries.op3_benchmark_passages(spark, SF001).collect()
    assert want and {(r.doc_id, r.item_id) for r in rows if r.distance == 0} == want


def test_short_items_are_whole_words():
    items = [(1, "art"), (2, "a"), (3, "the art"), (4, "Art!")]
    def found(text):
        m = Matcher(items, 0.05, whole_words=True)
        return sorted((i, d, s, e) for item, (d, s, e) in m.find(fold(text)).items() for i in m.item_ids(item))
    assert found("the cartwright and a partner") == [(2, 0, 19, 20)]
    assert found("cart art") == [(1, 0, 5, 8), (4, 0, 5, 8)]  # the first hit stands within a word
    assert found("art") == [(1, 0, 0, 3), (4, 0, 0, 3)] and found("the-ART, now") == [(1, 0, 4, 7), (3, 0, 0, 7), (4, 0, 4, 7)]
    assert found("bathe art") == [(1, 0, 6, 9), (4, 0, 6, 9)] and found("") == [] and found("the arts") == []


def test_cuts_by_rarity():
    rng = random.Random(8)
    for _ in range(400):
        n = rng.randint(1, 120)
        pieces = rng.randint(1, n)
        held = np.array([rng.choice([1, 1, 3, 50, 4000]) for _ in range(max(0, n - 5))], dtype=np.int64)
        cuts = cuts_by_rarity(held, n, pieces)
        assert cuts[0] == 0 and cuts[-1] == n and len(cuts) == pieces + 1
        assert min(b - a for a, b in zip(cuts, cuts[1:])) >= min(6, n // pieces)
    stem = np.array([1000] * 100 + [1] * 95)
    cuts = cuts_by_rarity(stem, 200, 11)
    assert all((stem[a:b - 5] == 1).any() for a, b in zip(cuts, cuts[1:]))  # each piece holds a whole gram of its own


def templated(n, own, seed=9):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    stem = "Read the following passage with care and then choose the one answer that is the most correct of all: "
    return [(i, stem + say(own)) for i in range(n)], stem, say


@pytest.mark.parametrize("own", [3, 6, 14])
def test_items_that_share_a_stem(own):
    """Shared pieces: the same items as by plain distance, and only a few of them are searched for."""
    rng = random.Random(10)
    items, stem, say = templated(300, own)
    matcher = Matcher(items, 0.05)
    for _ in range(12):
        passage = list(fold(items[rng.randrange(300)][1]).strip())
        for _ in range(rng.randint(0, 9)):
            k = rng.randrange(len(passage) + 1)
            passage[k:k + rng.randint(0, 1)] = rng.choice(["", "q", "zz"])
        text = fold(say(10) + " " + "".join(passage) + " " + say(5))
        got = matcher.find(text)
        want = set()
        for i, (pattern, _, k) in enumerate(matcher.items):
            if best_match(pattern, text)[0] <= k:
                want.add(i)
        assert set(got) == want


def test_a_shared_stem_is_not_searched_for_each_item(monkeypatch):
    searched = []
    monkeypatch.setattr(decontaminate_module, "best_match", lambda p, t: searched.append(p) or best_match(p, t))
    counts = []
    for n in (100, 4000):
        items, stem, say = templated(n, 20)
        matcher = Matcher(items, 0.05)
        searched.clear()
        found = matcher.find(fold(" ".join([say(60), stem, say(60), items[5][1], stem, say(60)])))
        assert set(found) == {5}
        counts.append(len(searched))
    assert counts[1] <= 400 < 4000 * 2, counts  # two stems without an item: 8,000 searches if each were tried
