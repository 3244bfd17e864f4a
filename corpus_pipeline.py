"""From documents to packed training sequences: toxicity, language, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result to the shared
folder and reads it again as the next stage's documents, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import language_id, toxicity
from orderflow.llm.jaccard_join import without_duplicates
from orderflow.llm.packing import pack_documents
from orderflow.operators.barrier import sealed
from orderflow.session import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field finds toxic (score of a half or more) go; all others stay as they are."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = toxicity.scores(spark, model)(F.col("text").cast("string"))
    return docs.where(score["score"] < 0.5)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letter in it) go; ``lang`` becomes the predicted one.

    If no row has a language to learn from, the same documents go, and the others keep their ``lang``.
    """
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(language_id.has_letter()(F.col("text").cast("string")))
    predicted = language_id.predictions(spark, model)(F.col("text").cast("string"))
    # Sealed, as the filter would otherwise be pushed down with a second prediction of every text.
    known = sealed(docs, [c for c in docs.columns if c != "lang"], predicted["lang_pred"].alias("lang"))
    return known.where(F.col("lang") != language_id.UNKNOWN).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the least id."""
    return without_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: A field, language trees and a tokenizer are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
