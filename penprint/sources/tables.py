"""Corpora made from the analytics tables (``documents``, ``labels``, ``conversations``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.session import spread

# One conversation has fewer turns than this.
_TURNS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, text`` of the unlabelled documents."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


def doc_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents; the quality grade stands in for the class."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    rated = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return spread(rated, "doc_id").join(labels, "doc_id")


def chat_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of conversations: the user's are human, the assistant's AI."""
    turns = table(spark, folder, "conversations").where(F.col("role").isin("user", "assistant"))
    keyed = turns.select(
        (F.col("conv_id") * _TURNS + F.col("turn")).alias("doc_id"),
        "text",
        F.when(F.col("role") == "user", 0).otherwise(1).alias("label"),
    )
    return spread(keyed, "doc_id")


def paragraph_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with each line set off as a paragraph of its own."""
    spaced = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return documents(spark, folder).withColumn("text", spaced)
