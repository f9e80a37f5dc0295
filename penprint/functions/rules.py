"""Rules over feature and probability columns: profile, heuristic score, confidence, wording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import tokens as tk
from penprint.functions.features import add_features

# Limits and factors that must equal the reference's.
AI_WORD_LIMIT = 0.01
VARIATION_LIMIT = 0.3
UNIQUE_LIMIT = 0.5
PUNCTUATION_LIMIT = 0.01
NARROW_MARGIN, NARROW_FACTOR = 0.2, 0.8
MIDDLE_MARGIN, MIDDLE_FACTOR = 0.4, 0.9
LONG_LABELS = ("Human-Written", "AI-Generated")
SHORT_LABELS = ("Human", "AI")

PROFILE_RATIOS = (
    "unique_word_ratio",
    "ai_word_ratio",
    "sentence_variation",
    "avg_word_length",
    "punctuation_density",
    "conjunction_ratio",
)
PROFILE = ("text_length", "word_count", *PROFILE_RATIOS, "heuristic_score")


def heuristic_score() -> Column:
    """Share of four warning signs that are on; every limit is strict."""
    flags = (
        F.col("ai_word_ratio") > AI_WORD_LIMIT,
        F.col("sentence_variation") < VARIATION_LIMIT,
        F.col("unique_word_ratio") < UNIQUE_LIMIT,
        F.col("punctuation_density") < PUNCTUATION_LIMIT,
    )
    total = sum((f.cast("int") for f in flags[1:]), flags[0].cast("int"))
    return total / F.lit(4.0)


def add_heuristic_class(df: DataFrame) -> DataFrame:
    """Prediction columns from the heuristic score: AI when more than half of the signs are on."""
    score = F.col("heuristic_score")
    return df.withColumn("heuristic_score", heuristic_score()).withColumns({
        "is_ai": score > 0.5,
        "human_probability": 1.0 - score,
        "ai_probability": score,
        "ai_score": score,
    })


def add_profile(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """Add features, then ``text_length``, ``word_count`` and ``heuristic_score``.

    Words are counted in the text as written, the features in its lower-cased form.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    sized = df.withColumns({
        "text_length": F.length(body),
        "word_count": tk.token_count(tk.spaced_words(body)),
    })
    return add_features(sized, text, **options).withColumn("heuristic_score", heuristic_score())


def profile_struct() -> Column:
    return F.struct(*PROFILE)


def interpretation() -> Column:
    """The explanations that apply, as an array of messages."""
    return F.array_compact(F.array(
        F.when(F.col("ai_word_ratio") > AI_WORD_LIMIT, F.lit("High AI word usage detected")),
        F.when(
            F.col("sentence_variation") < VARIATION_LIMIT,
            F.lit("Low sentence length variation (common in AI text)"),
        ),
        F.when(F.col("unique_word_ratio") < UNIQUE_LIMIT, F.lit("High word repetition detected")),
    ))


def add_calibrated_confidence(df: DataFrame) -> DataFrame:
    """Confidence lowered near the decision boundary, with the margin and an uncertainty grade."""
    top = F.greatest("human_probability", "ai_probability")
    margin = F.col("decision_margin")
    return df.withColumn(
        "decision_margin", F.abs(F.col("ai_probability") - F.col("human_probability"))
    ).withColumns({
        "calibrated_confidence": F.when(margin < NARROW_MARGIN, top * NARROW_FACTOR)
        .when(margin < MIDDLE_MARGIN, top * MIDDLE_FACTOR)
        .otherwise(top),
        "uncertainty": F.when(margin < NARROW_MARGIN, "HIGH")
        .when(margin < MIDDLE_MARGIN, "MEDIUM")
        .otherwise("LOW"),
    })


def confidence() -> Column:
    return F.greatest("human_probability", "ai_probability")


def decode_label(is_ai: Column, names: tuple[str, str] = SHORT_LABELS) -> Column:
    return F.when(is_ai, names[1]).otherwise(names[0])


def preview(text: Column, length: int = 50) -> Column:
    """The head of a text, with dots when something was left out."""
    head = F.concat(F.substring(text, 1, length), F.lit("..."))
    return F.when(F.length(text) > length, head).otherwise(text)
