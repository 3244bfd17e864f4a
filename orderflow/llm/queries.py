"""The registered queries of this subpackage and their SQL. Each applies one operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import language_id, oracles, toxicity
from orderflow.llm.byte_bpe import bpe_digests
from orderflow.llm.conversation_repair import damaged, repairs
from orderflow.llm.fingerprints import compare_with_next
from orderflow.llm.jaccard_join import near_duplicates
from orderflow.llm.licenses import license_scan
from orderflow.llm.packing import pack_documents
from orderflow.llm.repeats import remove_repeats
from orderflow.llm.sharding import shard_documents
from orderflow.llm.token_counts import token_counts
from orderflow.llm.topk import top_k_products
from orderflow.llm.whitening import whiten


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("digest")


def _remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), _remainder(4) == 2
    return language_id.language_id(docs, language_id.fit(docs, held_out=held_out), held_out=held_out)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), _remainder(5) == 0
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out=held_out)
    return toxicity.toxicity(docs, model, held_out=held_out)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repairs(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_fingerprints": op3_fingerprints,
    "op4_packing": op4_packing,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_language_id": op6_language_id,
    "op7_license_scan": op7_license_scan,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_topk": op10_topk,
    "op11_repeats": op11_repeats,
    "op12_whitening": op12_whitening,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": pipeline,
}

LLM_ORACLES: dict[str, str] = {
    "op5_jaccard_join": oracles.JACCARD,
    "op7_license_scan": oracles.LICENSES,
    "op10_topk": oracles.TOPK,
}
