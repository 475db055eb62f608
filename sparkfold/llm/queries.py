"""The registered queries of this subpackage: thin calls of the operators, and digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.llm import rules
from sparkfold.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sparkfold.llm.tokens import token_files
    out = token_files(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op5_pack_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sparkfold.llm.packing import pack
    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset", "sequence_tokens", "tier", "step_group")


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.hyperminhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query
def op3_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.decontaminate import find_passages
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.toxicity import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.pu_quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_language_by_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.langid import classify
    return classify(table(spark, sf_dir, "documents"))


@query
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.suffix_dedup import repeated_passages
    out = repeated_passages(table(spark, sf_dir, "documents"))
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long")
    return out.select("row.doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.rules import judge
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op2_weak_supervision"] = rules.oracle_sql()

@query
def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sparkfold.llm.bpe import encode_documents
    out = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sparkfold.llm.alignment import align_documents
    out = align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("piece_bpe_32k.model"), as_text=False)
    return out.withColumn("groups_sha256", F.col("groups").cast("string")).drop("groups")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the contract's rewriting: where h = crc32 of the decimal doc_id is divisible by 10, the
    words from number a on repeat their first p."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (h % 10).alias("_tenth"), F.floor(h / 10).alias("_g"),
                       F.when(h % 10 == 0, words).alias("_words")).withColumn("_n", F.size("_words"))
    a = F.col("_g") % F.col("_n")
    p = 1 + F.floor((F.col("_n") - a) / (3 + F.col("_g") % 8))
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, a).cast("int")).withColumn("_p", F.when(F.col("_n") > 0, p).cast("int"))
    again = F.transform("_words", lambda w, i: F.when(i < F.col("_a"), w).otherwise(
        F.element_at("_words", F.col("_a") + (i - F.col("_a")) % F.col("_p") + 1)))
    text = F.when((F.col("_tenth") == 0) & (F.col("_n") > 0), F.array_join(again, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.word_runs import periodic_runs
    out = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")), least=6, times=4)
    # runs are in the order of start, then period: only a strictly greater exponent takes the place
    none = F.get("runs", F.lit(0))
    best = F.aggregate("runs", none, lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    return out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.urls import judge
    return judge(table(spark, sf_dir, "pages"), URL_RULES)
