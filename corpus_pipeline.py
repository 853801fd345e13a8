"""From raw documents to token shards in training order: five stages, each over all that the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioscan.llm import decontaminate, jaccard, mixing, quality, shards
from folioscan.sources.workspace import new_folder, written

TOKENIZER = "byte_bpe_50k.tiktoken"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(quality.labelled(quality.document_statistics(docs, ["doc_id"]), labels))
    return quality.keep_good(docs, model)


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return jaccard.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated rows are repeats."""
    return mixing.mixed_documents(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids in training order, written as shards; one row per sequence."""
    path = public_tokenizers.path(TOKENIZER)
    stored = shards.write_shards(docs, new_folder(spark, "shards"), path, public_tokenizers.PATTERN)
    return shards.shard_digest(stored)


STAGES = [
    ("quality", good_documents),
    ("near duplicates", first_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("tokens", token_shards),
]

# A fitted classifier and MinHash are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
