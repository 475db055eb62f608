"""op11: ids, decoded texts and digests equal the library's, for whole texts, odd code points and odd rows."""

import hashlib
import random

import public_tokenizers
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkfold.llm import queries
from sparkfold.llm.bpe import BpeCodec, MergeRounds, byte_letters, encode_documents

WORD = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, CODEC = Tokenizer.from_file(WORD), BpeCodec(WORD)


def whole(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def ours(codec, texts):
    ids, ends = codec.encode(texts)
    stops = [0, *ends.tolist()]
    numbers, decoded = codec.decimal(ids, ends), codec.decode(ids, ends)
    split = [ids[a:b].tolist() for a, b in zip(stops, stops[1:])]
    assert numbers == [" ".join(map(str, s)).encode() for s in split]
    return list(zip(split, (d.decode() for d in decoded)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="abAB .,'sTt\n\té \x01\x1c<|>ΣςİßÅ1２中\U0001F600", max_size=60)), max_size=6))
def test_ids_and_texts_of_the_library(texts):
    assert ours(CODEC, texts) == [whole(t) for t in texts]


def test_every_code_point():
    texts = [f"aA{chr(c)}1b {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = texts[:0x3100] + texts[0x3100:0x20000:7] + texts[0x2FA00:0x33000:5] + texts[-300:]
    codec = BpeCodec(WORD)
    assert ours(codec, texts) == [whole(t) for t in texts]


@pytest.mark.parametrize("text", ["", " ", "a<|endoftext|>B <|startoftext|> x<|", "<|endoftext|>" * 3, "x" * 5000, "ab" * 3000 + " " + "é" * 999,
                                  "ΟΔΟΣ Σ", "don't I'LL we 've", "\n\n a\x85b　c"])
def test_single_texts(text):
    assert ours(CODEC, [text]) == [whole(text)]


def test_full_memory_is_emptied_and_results_stay():
    small = BpeCodec(WORD, most=5)
    texts = ["a b c d e f g", "h i j k l", "word " * 40 + "y" * 300]
    for _ in range(3):
        assert ours(small, texts) == [whole(t) for t in texts]


def test_rounds_equal_single_merges():
    rng = random.Random(4)
    letters = byte_letters()
    vocabulary = {c: i for i, c in enumerate(letters)} | {c + "$": 256 + i for i, c in enumerate(letters)}
    merges, known = [], list("abc") + ["a$", "b$", "c$"]
    while len(merges) < 60:
        a, b = rng.choice([k for k in known if not k.endswith("$")]), rng.choice(known)
        if a + b not in vocabulary and len(a + b) < 9:
            vocabulary[a + b] = len(vocabulary)
            known.append(a + b)
            merges.append((a, b))
    rank = {m: i for i, m in enumerate(merges)}

    def plain(word):
        parts = [*word[:-1], word[-1] + "$"]
        while True:
            found = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
            if found is None:
                return [vocabulary[p] for p in parts]
            i = found[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    rounds = MergeRounds(vocabulary, merges, "$")
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(500)] + ["a" * 99, "ab" * 50]
    ids, ends = rounds.merge([w.encode() for w in words])
    stops = [0, *ends.tolist()]
    assert [ids[a:b].tolist() for a, b in zip(stops, stops[1:])] == [plain(w) for w in words]
    with pytest.raises(ValueError):
        MergeRounds(vocabulary, merges[::-1], "$")


def test_odd_documents(spark, odd, empty):
    got = encode_documents(odd, WORD).collect()
    want = sorted((repr(r.doc_id), *map(repr, whole(r.text or ""))) for r in odd.select("doc_id", "text").collect())
    import numpy as np
    assert sorted((repr(r.doc_id), repr(np.frombuffer(r.ids, "<u4").tolist()), repr(r.decoded.decode())) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert encode_documents(empty, WORD).count() == 0


def test_query_against_whole_texts(spark):
    got = {r.doc_id: tuple(r) for r in queries.op11_bpe_round_trip(spark, SF001).collect()}
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        ids, text = whole(r.text or "")
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))
        assert got.pop(r.doc_id) == (r.doc_id, len(ids), *digests)
    assert not got
