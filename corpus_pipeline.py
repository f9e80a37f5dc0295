"""From raw documents to token files: rules, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir); its result is written to the shared folder as Parquet and read again as the
next one's documents, so a lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from penprint.llm import quality_rules, source_mixing, token_files, weighted_minhash, winnowing
from penprint.session import stored


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return weighted_minhash.keep_one(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return winnowing.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources come near their target shares of words."""
    return source_mixing.mix_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; per document, what they hold."""
    return token_files.read_documents(token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("source_mixing", mix_sources),
    ("token_files", write_tokens),
]

#: SQL can express neither the sampling of near-duplicates nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
