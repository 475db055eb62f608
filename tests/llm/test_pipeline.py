"""The pipeline's stages one by one against their operators, on fixtures and odd rows; and the entry without it."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from conftest import SF001
from tokenizers import Tokenizer

import corpus_pipeline as P
from test_hyperminhash import plain as plain_links
from test_suffix_dedup import plain as plain_cut

ROOT = Path(P.__file__).parent


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "near_duplicates", "suffix_array_dedup", "benchmark_decontamination", "packing"] and P.ORACLE_SQL is None
    before = docs
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, before, SF001).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        old, new = before.collect(), after.collect()
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
            left = {r.doc_id for r in new}
            assert all(r.doc_id in left for r in old if labels.get(r.doc_id) == 1) and len(new) < len(old)
        elif name == "near_duplicates":
            want = plain_links([(r.doc_id, r.text) for r in old], 5, 80)
            assert sorted(r.doc_id for r in new) == sorted(d for d, (_, c) in want.items() if c == d)
        elif name == "suffix_array_dedup":
            rows = [(r.doc_id, r.text) for r in old]
            want = {d: kept.decode(errors="ignore") for d, kept, _ in plain_cut(rows, 50)}
            assert {r.doc_id: r.text for r in new} == want and all(r.n_chars == len(r.text) for r in new)
        elif name == "benchmark_decontamination":
            from sparkfold.llm.decontaminate import find_passages
            hit = {r.doc_id for r in find_passages(before, spark.read.parquet(f"{SF001}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in new} == {r.doc_id for r in old} - hit
        else:
            tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            ids = {}
            for r in sorted(new, key=lambda r: r.start):
                ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
            assert ids == {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in old}
        before = after
    packed = P.run(spark, SF001)
    assert sorted((r.doc_id, r.start, r.length) for r in packed.collect())[0][0] == min(r.doc_id for r in new)
    assert packed.agg({"length": "sum"}).first()[0] == sum(r.length for r in new)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_odd_documents(spark, odd, empty, name, tmp_path):
    stage = dict(P.STAGES)[name]
    for n, frame in enumerate((odd, empty)):
        stage(spark, frame, SF001).write.parquet(f"{tmp_path}/{n}")
        out = spark.read.parquet(f"{tmp_path}/{n}")
        if name != "packing":
            assert out.columns == odd.columns
        assert out.count() <= 4 * frame.count() + 400 * n * 0 + (400 if frame is odd else 0)


def test_entry_stands_without_the_subpackage(tmp_path):
    code = ("import sys\nsys.modules['corpus_pipeline'] = None\nsys.modules['sparkfold.llm'] = None\n"
            "import __spark_entry__ as e\nassert 'pipeline' not in e.queries() and len(e.queries()) > 100")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
