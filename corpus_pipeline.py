"""The corpus pipeline: quality rules, toxicity, near-duplicates, mixing, encoding and decoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its
result is written as Parquet and read back as the next stage's ``docs``.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import bpe, mixing, quality, simhash, toxicity
from basketflow.llm.common import stage, table
from basketflow.llm.queries import RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a model learned from the labelled ones among ``docs``."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and offsets of every mixed document, and the digest of the bytes decoded from its ids."""
    e = bpe.encode(docs.select("doc_id", "lang", "source", "text"), RANKS,
                   outputs=("n_tokens", "ids", "offsets", "decoded"), keep_text=False)
    return e.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode_bpe", encode_bpe),
]

#: Learned scores and seeded choices have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
