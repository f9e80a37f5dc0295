"""Row-wise preparation of labelled corpora. Every function is narrow: nothing is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import tokens as tk

# Fixed values that must equal the reference's.
MIN_CHARS = 30
TARGET_WORDS = 200
CLASSES = (0, 1)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail before any job runs when a column is missing, naming those that were found."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def drop_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns or ("text",)))


def cast_trim(df: DataFrame) -> DataFrame:
    """Text stripped of outer white space, label as an integer."""
    return df.withColumns({
        "text": tk.strip(F.col("text").cast("string")),
        "label": F.col("label").cast("int"),
    })


def min_chars(df: DataFrame, more_than: int = MIN_CHARS) -> DataFrame:
    """Keep texts of more than so many characters, outer white space not counted."""
    return df.where(F.length(tk.strip(F.col("text"))) > more_than)


def clean_texts(df: DataFrame, more_than: int = MIN_CHARS) -> DataFrame:
    """One blank for every run of white space; short and missing texts dropped."""
    collapsed = df.withColumn("text", tk.collapse(F.col("text")))
    return collapsed.where(F.length("text") > more_than)


def by_class(df: DataFrame, *labels: int) -> DataFrame:
    return df.where(F.col("label").isin(*(labels or CLASSES)))


def unify_layout(
    df: DataFrame, text: str, label: str, keep: Sequence[str] = (), more_than: int = MIN_CHARS
) -> DataFrame:
    """Bring a raw layout into ``text, label``: null rows and short texts dropped, text stripped."""
    require_columns(df, text, label)
    renamed = df.select(*keep, F.col(text).alias("text"), F.col(label).alias("label"))
    return min_chars(cast_trim(drop_null(renamed, "text", "label")), more_than)


def unify_layout_a(df: DataFrame, keep: Sequence[str] = (), more_than: int = MIN_CHARS) -> DataFrame:
    """Raw layout ``text, generated`` with 0/1 or 0.0/1.0."""
    return unify_layout(df, "text", "generated", keep, more_than)


def unify_layout_b(df: DataFrame, keep: Sequence[str] = (), more_than: int = MIN_CHARS) -> DataFrame:
    """Raw layout ``Data, Label``."""
    return unify_layout(df, "Data", "Label", keep, more_than)


def _or_default(df: DataFrame, name: str, default: str) -> Column:
    value = F.col(name) if name in df.columns else F.lit(None).cast("string")
    return F.coalesce(value, F.lit(default))


def tag_provenance(df: DataFrame, label: int) -> DataFrame:
    """Add the label, and source, category and topic where they are missing."""
    human = label == 0
    return df.withColumns({
        "label": F.lit(label),
        "source": _or_default(df, "source", "synthetic_human" if human else "synthetic_ai"),
        "category": _or_default(df, "category", "unknown" if human else "formal_explanation"),
        "topic": _or_default(df, "topic", "unknown"),
    })


def normalize_length(df: DataFrame, target: int = TARGET_WORDS) -> DataFrame:
    """Cut texts longer than ``target`` words, drop those under half of it, leave the rest."""
    listed = df.withColumn("_words", tk.whitespace_words(F.col("text")))
    kept = listed.where(F.size("_words") >= target // 2)
    cut = F.array_join(F.slice(F.col("_words"), 1, target), " ")
    return kept.withColumn(
        "text", F.when(F.size("_words") > target, cut).otherwise(F.col("text"))
    ).drop("_words")


def scorable(df: DataFrame, at_least: int = 10) -> DataFrame:
    """Texts long enough to be scored, outer white space not counted."""
    return df.where(F.length(tk.strip(F.col("text"))) >= at_least)
