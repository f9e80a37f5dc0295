"""Corpus preparation jobs: one lazy plan each, from raw layouts to a balanced, merged corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.functions import tokens as tk
from penprint.functions.keys import order_key
from penprint.operators import merge, prepare, sampling


def prepare_real(df: DataFrame, layout: str, max_samples: int | None = None, seed: int = 42) -> DataFrame:
    """Unify layout 'a' or 'b' and subsample by class before anything costly runs."""
    unify = {"a": prepare.unify_layout_a, "b": prepare.unify_layout_b}[layout]
    corpus = unify(df, keep=[c for c in ("doc_id",) if c in df.columns])
    if max_samples is None:
        return corpus
    return sampling.balanced_subsample(corpus, max_samples, seed)


def merge_large_into_real(
    real: DataFrame | None, large: DataFrame, drop_duplicates: bool = True, shuffle: bool = True,
    seed: int = 42,
) -> DataFrame:
    """Merge a generated corpus into a real one; the real row of a repeated text stays."""
    merged = merge.merge_corpora(real, large)
    if drop_duplicates:
        merged = merge.dedupe_text_label(merged)
    if shuffle:
        merged = merged.withColumn("shuffle_key", order_key(seed, "source_rank", "doc_id"))
    return merged


def load_large(df: DataFrame, seed: int = 42) -> DataFrame:
    """Null and short texts dropped, then both classes cut to the smaller one."""
    return sampling.balance_to_minority(prepare.min_chars(prepare.drop_null(df, "text")), seed)


def load_standard(df: DataFrame) -> DataFrame:
    """Columns checked, null rows dropped, text stripped, labels 0 and 1 only."""
    prepare.require_columns(df, "text", "label")
    return prepare.by_class(prepare.cast_trim(prepare.drop_null(df, "text", "label")))


def load_collected(df: DataFrame) -> DataFrame:
    return prepare.clean_texts(df)


def preview_per_class(df: DataFrame, length: int = 200) -> DataFrame:
    """The head of one text of each class."""
    first = sampling.sample_row_per_class(df)
    head = F.substring(tk.collapse(F.col("text")), 1, length)
    return first.select("label", "doc_id", head.alias("preview"))
