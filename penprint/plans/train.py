"""Training: split, features once, fit, evaluate, analyse."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.functions.features import FEATURES, add_features
from penprint.operators import evaluate, models, sampling
from penprint.operators.prepare import by_class, require_columns
from penprint.session import cut_lineage
from penprint.sources.writers import append_run_log, run_metadata, save_model, write_metrics


@dataclass(frozen=True)
class Evaluation:
    """Tables over one scored test set."""

    scored: DataFrame
    metrics: DataFrame
    report: DataFrame
    confidence: DataFrame
    roc_points: DataFrame
    pr_points: DataFrame
    roc_auc: DataFrame
    pr_auc: DataFrame
    seconds: float
    rows: int

    @property
    def ms_per_text(self) -> float:
        return 1000.0 * self.seconds / max(self.rows, 1)


@dataclass(frozen=True)
class Training:
    ensemble: models.Ensemble
    evaluation: Evaluation
    inner: Evaluation | None
    contrast: DataFrame
    importance: DataFrame
    metadata: DataFrame


def evaluate_on(ensemble: models.Ensemble, features: DataFrame) -> Evaluation:
    """Score a feature table once, write the scores, and derive every table from them."""
    start = time.monotonic()
    scored = cut_lineage(
        models.predict(ensemble, features).withColumn("score", F.col("ai_probability"))
    )
    seconds = time.monotonic() - start
    return Evaluation(
        scored,
        evaluate.nested_metrics(scored),
        evaluate.classification_report(scored),
        evaluate.confidence_stats(scored),
        evaluate.roc_points(scored),
        evaluate.pr_points(scored),
        evaluate.roc_auc(scored),
        evaluate.pr_auc(scored),
        seconds,
        scored.count(),
    )


def train_and_evaluate(
    corpus: DataFrame,
    test_size: float = 0.2,
    inner_holdout: bool = False,
    contrast_rows: int | None = None,
    seed: int = 42,
    path: str | None = None,
    **settings,
) -> Training:
    """Train on a corpus ``doc_id, text, label`` and evaluate on a held-out share.

    Texts are tokenised once: their features are written to the shared folder before the fits.
    ``inner_holdout`` fits on four fifths of the training rows and also evaluates on the rest.
    ``contrast_rows`` limits the feature contrast to so many rows per class. With ``path``, models,
    metadata, metrics and the run log are written below it.
    """
    require_columns(corpus, "doc_id", "text", "label")
    split = sampling.stratified_split(by_class(corpus), test_size, seed)
    features = cut_lineage(add_features(split).select("doc_id", "label", "is_test", *FEATURES))
    train, test = features.where(~F.col("is_test")), features.where("is_test")

    fitted_on, held_out = train, None
    if inner_holdout:
        # Another seed: by the same key the test rows were the lowest ones, so none would be left.
        parts = sampling.random_split(train, 0.2, seed + 1)
        fitted_on, held_out = parts.where(~F.col("is_holdout")), parts.where("is_holdout")

    start = time.monotonic()
    ensemble = models.fit_ensemble(fitted_on, seed=seed, **settings)
    training_seconds = time.monotonic() - start

    evaluation = evaluate_on(ensemble, test)
    inner = evaluate_on(ensemble, held_out) if held_out is not None else None
    shown = train if contrast_rows is None else sampling.head_per_class(train, contrast_rows, seed)

    sizes = features.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("test"),
        F.count_if(F.col("label") == 0).alias("human"), F.count_if(F.col("label") == 1).alias("ai"),
    ).first()
    facts = {
        "dataset_size": sizes["n"], "train_samples": sizes["n"] - sizes["test"],
        "test_samples": sizes["test"], "human_samples": sizes["human"], "ai_samples": sizes["ai"],
        "seed": seed,
    }
    metadata = run_metadata(
        corpus.sparkSession, **facts, model_type=ensemble.name, features_used=len(FEATURES),
        training_time_seconds=training_seconds, inference_time_seconds=evaluation.seconds,
        avg_inference_time_ms=evaluation.ms_per_text,
    )
    training = Training(
        ensemble, evaluation, inner, evaluate.feature_contrast(shown),
        models.feature_importance(ensemble, corpus.sparkSession), metadata,
    )
    if path is not None:
        save_training(training, path, facts)
    return training


def save_training(training: Training, path: str, facts: dict) -> None:
    save_model(training.ensemble, f"{path}/model", training.metadata)
    results = training.evaluation
    write_metrics(results.metrics, f"{path}/test_results")
    write_metrics(results.report, f"{path}/classification_report")
    write_metrics(results.confidence, f"{path}/confidence_analysis")
    write_metrics(results.roc_points, f"{path}/roc_curve")
    write_metrics(results.pr_points, f"{path}/pr_curve")
    write_metrics(training.contrast, f"{path}/feature_statistics")
    write_metrics(training.importance, f"{path}/feature_importance")
    areas = results.roc_auc.crossJoin(F.broadcast(results.pr_auc))  # one row each
    write_metrics(areas, f"{path}/areas")
    append_run_log(areas, f"{path}/run_log", run_id=str(time.time_ns()), **facts)
