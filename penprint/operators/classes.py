"""Counts and shares per class. One partial aggregation; only the per-class rows are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators.prepare import CLASSES


def class_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def class_ratios(df: DataFrame) -> DataFrame:
    """Share of every label: all counts in one row first, so no window over an open number of rows."""
    counts = class_counts(df)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("ratio", F.col("n") / total)


def class_sufficiency(df: DataFrame, min_samples: int) -> DataFrame:
    """One row per class 0 and 1, also for a class without rows, telling whether it is too small."""
    counts = df.agg(*[
        F.count_if(F.col("label") == k).alias(f"n{k}") for k in CLASSES
    ])
    rows = F.array(*[
        F.struct(F.lit(k).alias("label"), F.col(f"n{k}").alias("n")) for k in CLASSES
    ])
    return counts.select(F.inline(rows)).withColumn("too_few", F.col("n") < min_samples)


def stray_labels(df: DataFrame) -> DataFrame:
    """How many rows carry a label that is neither 0 nor 1, or none: class operators leave them out."""
    outside = F.col("label").isNull() | ~F.col("label").isin(*CLASSES)
    return df.agg(F.count_if(outside).alias("stray"), F.count(F.lit(1)).alias("total"))
