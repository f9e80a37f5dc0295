"""Scoring jobs: single analysis rows, batches and their summary."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.functions import rules
from penprint.functions.features import add_features
from penprint.operators.evaluate import prediction_summary
from penprint.operators.models import Ensemble, predict_or_heuristic
from penprint.operators.prepare import scorable

PREDICTION = ("is_ai", "human_probability", "ai_probability", "ai_score")


def score_texts(df: DataFrame, ensemble: Ensemble | None = None, at_least: int = 10) -> DataFrame:
    """Prediction columns for every text long enough. Narrow, so the same on a stream."""
    features = add_features(scorable(df, at_least))
    return predict_or_heuristic(features, ensemble).select(*df.columns, *PREDICTION)


def batch_predict(df: DataFrame, ensemble: Ensemble | None = None) -> DataFrame:
    """Head of the text, short label and AI probability of every non-blank text."""
    scored = score_texts(df, ensemble, at_least=1)
    others = [c for c in df.columns if c != "text"]
    return scored.select(
        *others,
        rules.preview(F.col("text")).alias("text"),
        rules.decode_label(F.col("is_ai")).alias("prediction"),
        "ai_probability",
    )


def batch_summary(df: DataFrame, ensemble: Ensemble | None = None) -> DataFrame:
    return prediction_summary(score_texts(df, ensemble, at_least=1))


def combined_analysis(df: DataFrame, ensemble: Ensemble | None = None) -> DataFrame:
    """Prediction, confidence and the nested profile of every text."""
    profiled = predict_or_heuristic(rules.add_profile(df), ensemble)
    others = [c for c in df.columns if c != "text"]
    return profiled.select(
        *others,
        rules.decode_label(F.col("is_ai"), rules.LONG_LABELS).alias("prediction"),
        rules.confidence().alias("confidence"),
        "ai_probability", "human_probability",
        rules.profile_struct().alias("detailed_analysis"),
    )


def scoring_rate(df: DataFrame, ensemble: Ensemble | None = None) -> DataFrame:
    """Rows scored, seconds and milliseconds per text of one full scoring run.

    A digest over all predictions goes with the count, so that no part of the work is pruned away.
    """
    scored = score_texts(df, ensemble)
    start = time.monotonic()
    rows = scored.agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*PREDICTION)).alias("digest")
    ).first()["rows"]
    seconds = time.monotonic() - start
    return df.sparkSession.createDataFrame(
        [(rows, seconds, 1000.0 * seconds / max(rows, 1))],
        "rows long, seconds double, ms_per_text double",
    )
