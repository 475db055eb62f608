"""op1 and the encoder: ids equal those of whole texts; files read back; single documents; damage is seen."""

import numpy as np
import public_tokenizers
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkfold.llm import queries, scratch
from sparkfold.llm.chunk_encode import ChunkEncoder
from sparkfold.llm.tokens import ShardReader, ShardWriter, read_shards, token_files, write_shards

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {path: (ChunkEncoder(path, path == BYTE), Tokenizer.from_file(path)) for path in (WORD, BYTE)}


def whole(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="ab .,'st\n\té \x01<|>", max_size=60)), max_size=6))
def test_pieces_give_the_ids_of_the_whole_text(path, texts):
    encode, tokenizer = ENCODERS[path]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode.encode(texts)] == [whole(tokenizer, t) for t in texts]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_white_space_beside_spaces(path):
    texts = ["a foo\n", "b foo\n", "\nfoo bar", "x \nfoo foo\n  bar", "foo\n foo\n", " foo", "foo ", "  ", "\n", "a  b\t c \u00a0d"]
    fresh = ChunkEncoder(path, path == BYTE)
    for batch in (texts, texts[::-1], texts[:2], [t + t for t in texts]):
        assert [np.frombuffer(b, "<u4").tolist() for b in fresh.encode(batch)] == [whole(fresh.tokenizer, t) for t in batch]


def test_full_memory_is_emptied_and_results_stay():
    small = ChunkEncoder(BYTE, True, most=5)
    texts = ["a b c d e f g", "h i j k l", "a b c", "word " * 40 + "y" * 300]
    for _ in range(3):
        assert [np.frombuffer(b, "<u4").tolist() for b in small.encode(texts)] == [whole(small.tokenizer, t) for t in texts]


def test_odd_documents(spark, odd, empty):
    got = token_files(spark, odd, WORD, 2).collect()
    assert [r.start for r in got] is not None and len(got) == odd.count()
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in ordered), key=lambda d: (d is not None, d or 0))
    assert sum(r.n_tokens for r in got) == ordered[-1].start + ordered[-1].n_tokens
    tokenizer = Tokenizer.from_file(WORD)
    want = sorted([*whole(tokenizer, r.text or ""), 2] for r in odd.select("text").collect())
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in got) == want
    assert token_files(spark, empty, WORD, 2).count() == 0


def test_only_asked_documents_are_read(spark, odd):
    manifest = write_shards(odd, scratch.folder(spark, "t"), WORD, 2)
    got = read_shards(manifest, [7, 12, 12345]).collect()
    assert sorted(r.doc_id for r in got) == [7, 12, 12] and all(r.start is None for r in got)


def test_damage_fails_the_checksum(tmp_path):
    path = str(tmp_path / "x.zst")
    w = ShardWriter("file:" + path)
    for i in range(5):
        w.add(i, np.arange(i * 100, dtype="<u4").tobytes())
    w.close()
    import zstandard
    raw = open(path, "rb").read()
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(plain) == 4 * sum(i * 100 for i in range(5))
    assert dict(ShardReader("file://" + path).read([3]))[3] == np.arange(300, dtype="<u4").tobytes()
    open(path, "wb").write(raw[:40] + bytes([raw[40] ^ 255]) + raw[41:])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(ShardReader("file://" + path).scan())


def test_query_against_whole_texts(spark):
    import zlib
    tokenizer = Tokenizer.from_file(WORD)
    got = {r.doc_id: r for r in queries.op1_token_files(spark, SF001).collect()}
    start = 0
    for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*whole(tokenizer, r.text or ""), 2], dtype="<u4")
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
