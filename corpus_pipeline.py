"""From raw documents to training sequences, stage by stage.

Each stage reads what the one before it has kept; every stage is written as Parquet in
between, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from portpulse.functions.scale import shared_folder
from portpulse.llm.exact_dedup import drop_copies
from portpulse.llm.ngram_join import keep_one
from portpulse.llm.packing import pack
from portpulse.llm.substring_dedup import strip_repeats
from portpulse.llm.toxicity import learned, scored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not call toxic; it learns from the labelled ones."""
    grammar = learned(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = scored(docs, grammar, "text", *docs.columns, into="_toxicity")
    return found.where("_toxicity < 0.5").drop("_toxicity")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return drop_copies(docs)


def ngram_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the smallest id."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur again elsewhere. A document that
    consists of such passages stays with an empty text."""
    return strip_repeats(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_dedup", ngram_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]
#: Learned weights, hashing and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
