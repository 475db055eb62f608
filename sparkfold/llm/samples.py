"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(modulus: int) -> Column:
    """crc32 of the doc_id written as text, modulo ``modulus`` (null ids: of the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_ids(labels: DataFrame, label: str, train: Column) -> DataFrame:
    """(doc_id, label) of training rows; ids without a label or with two different ones are left out."""
    return (labels.select(F.col("doc_id").cast("long"), F.col(label).alias("label")).filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
            .filter(train).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
            .filter("label = other").drop("other"))


def first_by_hash(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, the first in the order of a hash of doc_id: the same rows in every run."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, label, text) of the sampled ids; ``ids`` is a bounded sample, so it is broadcast."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id")
