"""op5: every token in one piece, sequences full or at a block's end, groups even."""

import numpy as np
import public_tokenizers
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkfold.llm import queries
from sparkfold.llm.packing import TIERS, pack, plan, step_groups

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 5000), st.sampled_from([1, 256, 257, 2048, 4096])), max_size=60))
def test_plan(lengths):
    sequences = plan(lengths)
    seen = [np.zeros(n, int) for n in lengths]
    for s in sequences:
        for doc, at, n in s:
            assert n > 0
            seen[doc][at:at + n] += 1
    assert all((x == 1).all() for x in seen)
    totals = [sum(p[2] for p in s) for s in sequences]
    assert all(0 < t <= TIERS[-1] for t in totals)
    assert sum(t not in TIERS for t in totals) <= 1  # the last one of the block


def test_step_groups_are_even():
    rng = np.random.default_rng(1)
    sequences = plan(rng.integers(1, 3000, 3000).tolist())
    groups = step_groups(sequences, 32_768)
    cost = np.bincount(groups, [sum(p[2] ** 2 for p in s) for s in sequences])
    assert cost.max() < 1.1 * cost.mean()


def check(rows, texts):
    tokenizer = Tokenizer.from_file(BYTE)
    assert sum(r.length for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len({(r.sequence_tokens, r.tier, r.step_group) for r in own}) == 1


def test_odd_documents(odd, empty):
    rows = pack(odd, BYTE, 1).collect()
    check(rows, odd.select("doc_id", "text").collect())
    tokenizer = Tokenizer.from_file(BYTE)
    ids = {}
    for r in sorted(rows, key=lambda r: r.start):
        if r.doc_id not in (None, 12):
            ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    for r in odd.select("doc_id", "text").collect():
        if r.doc_id not in (None, 12):
            assert ids[r.doc_id] == [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
    assert pack(empty, BYTE, 1).count() == 0


def test_small_blocks_stay_bounded(odd):
    check(pack(odd, BYTE, 1, block_tokens=500).collect(), odd.select("doc_id", "text").collect())


def test_query(spark):
    rows = queries.op5_pack_tiers(spark, SF001).collect()
    check(rows, spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    sizes = {r.sequence_id: r.sequence_tokens for r in rows}
    padding = sum(2048 - n for n in sizes.values() if n & (n - 1))
    assert padding <= 2048
