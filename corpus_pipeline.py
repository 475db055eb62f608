"""From raw documents to packed training sequences, as five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which ``run`` writes as Parquet and reads back as the next one's
``docs``.  All but the last return the columns of ``documents``:

1. quality classifier: documents that the positive-unlabelled scorer rejects go;
2. near-duplicates: of each group (five-word shingles, similarity 0.8) one stays;
3. suffix-array dedup: passages that an earlier document holds are cut out;
4. decontamination: documents that hold a benchmark passage go;
5. packing: pieces of the token sequences, with their ids.

Null texts, ids and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkfold.llm import scratch
from sparkfold.llm.decontaminate import decontaminate
from sparkfold.llm.hyperminhash import keep_one
from sparkfold.llm.packing import pack
from sparkfold.llm.pu_quality import keep_good
from sparkfold.llm.suffix_dedup import cut_repeats
from sparkfold.session import ship_package

#: The last three stages can't be written in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_one(docs, width=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return cut_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ship_package(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored on shared storage before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.stored(stage(spark, docs, sf_dir), name)
        scratch.release(spark)
    return docs
