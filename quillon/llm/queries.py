"""The contract queries over the driver's tables: each applies an operator of this package and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import bpe, cascade, codes, common, language, lines, minhash, mixing, oracles, packing, quality, substring, suffix, toxicity, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks() -> tuple[str, str]:
    """The file of ranks of op12, and the pattern that cuts texts before it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(documents(spark, sf_dir))


@query("op2_minhash_dedup", oracles.NEAR)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), words=2, percent=80)


def _removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])


@query("op3_substring_dedup", oracles.SUBSTRINGS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.dedup_substrings(documents(spark, sf_dir), length=20)
    return cut.select("doc_id", F.col("n_units").alias("n_words"), _removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_quality_rules", oracles.QUALITY)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), host="source").drop("text")


@query("op5_suffix_array_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.dedup_bytes(documents(spark, sf_dir), length=400)
    return cut.select("doc_id", F.col("n_units").alias("n_bytes"), _removed().alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_source_mixing", oracles.MIXING)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), weights=(1, 2, 3), cap=3.0).drop("source")


@query("op7_line_dedup", oracles.LINES)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(documents(spark, sf_dir), run=3, long_words=50)
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(documents(spark, sf_dir), tokenizer_path(), capacity=2048, end_id=0)


@query("op9_embedding_dedup", oracles.VECTORS)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.9)


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op11_vector_codes", oracles.CODES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), parts=8, entries=16, rounds=6, scale=4096)


@query("op12_byte_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), *ranks()), *ranks())
    n_tokens = F.expr("octet_length(ids) div 4")
    return coded.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_cascading_release", oracles.CASCADE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return cascade.replay(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
