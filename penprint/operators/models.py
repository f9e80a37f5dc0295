"""The soft-voting ensemble: a forest, boosted trees and a logistic regression, and its use on feature tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from penprint.functions.features import FEATURES
from penprint.functions.rules import add_heuristic_class
from penprint.operators.boosting import BoostedTrees, fit_boosted
from penprint.operators.evaluate import importance_rank
from penprint.operators.forest import Forest, fit_forest
from penprint.operators.logistic import Logistic, fit_logistic
from penprint.operators.passes import training_rows
from penprint.operators.sampling import kfold, row_ranks
from penprint.session import run_together, stored

# Settings that must equal the reference's.
TREES, DEPTH = 100, 15
ROUNDS, RATE, BOOST_DEPTH = 100, 0.1, 3
MAX_ITER = 1000
SEED = 42


@dataclass(frozen=True)
class Ensemble:
    """Three fitted models that vote with equal weight."""

    forest: Forest
    boosted: BoostedTrees
    logistic: Logistic

    @property
    def name(self) -> str:
        return "soft vote of forest, boosted trees and logistic regression"


def fit_ensemble(
    train: DataFrame,
    trees: int = TREES,
    depth: int = DEPTH,
    rounds: int = ROUNDS,
    max_iter: int = MAX_ITER,
    seed: int = SEED,
    id_col: str = "doc_id",
) -> Ensemble:
    """Fit the three models on a feature table with ``label``, at the same time.

    The fits read the table hundreds of times: pass one whose lineage is cut. What they read is cached; a lost block is
    rebuilt from the written table, not from the texts. All of them run at once, each in a scheduler pool of its own.
    """
    rows = training_rows(train, FEATURES, id_col=id_col).persist()
    try:
        done = run_together(train.sparkSession, {
            "forest": lambda: fit_forest(rows, FEATURES, trees, depth, seed),
            "boosted": lambda: fit_boosted(rows, FEATURES, rounds, RATE, BOOST_DEPTH),
            "logistic": lambda: fit_logistic(rows, FEATURES, max_iter=max_iter),
        })
    finally:
        rows.unpersist()
    return Ensemble(done["forest"], done["boosted"][0], done["logistic"][0])


def probabilities(ensemble: Ensemble, df: DataFrame) -> DataFrame:
    """Add each model's probability of class 1 to a feature table: ``_forest``, ``_boosted``, ``_logistic``. Narrow."""
    return df.select(
        *df.columns, ensemble.forest.probability().alias("_forest"),
        ensemble.boosted.probability().alias("_boosted"), ensemble.logistic.probability().alias("_logistic"),
    )


def predict(ensemble: Ensemble, df: DataFrame) -> DataFrame:
    """Add ``is_ai``, both probabilities and ``ai_score`` to a feature table. Narrow.

    The vote is the mean of the three probabilities; a tie is human.
    """
    voted = probabilities(ensemble, df).withColumn("ai_probability", (F.col("_forest") + F.col("_boosted") + F.col("_logistic")) / 3)
    p = F.col("ai_probability")
    return voted.select(
        *df.columns, (p > 1.0 - p).alias("is_ai"), (1.0 - p).alias("human_probability"), p,
        p.alias("ai_score"),
    )


def predict_or_heuristic(df: DataFrame, ensemble: Ensemble | None = None) -> DataFrame:
    """The vote where there is a model, else the heuristic; the same columns either way."""
    if ensemble is not None:
        return predict(ensemble, df)
    scored = add_heuristic_class(df)
    return scored if "heuristic_score" in df.columns else scored.drop("heuristic_score")


def feature_importance(ensemble: Ensemble, spark: SparkSession) -> DataFrame:
    """The forest's importances, ranked with running share."""
    table = spark.createDataFrame(list(zip(FEATURES, ensemble.forest.importances)), "feature string, importance double")
    return importance_rank(table)


def permutation_importance(ensemble: Ensemble, features: DataFrame, seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """``feature, importance`` of the vote: by how much its accuracy on ``features`` falls when one column is re-dealt.

    The rows are put in two orders by hash keys; each row gets the column's value from the row that has its place in
    the other order. One pass scores every row as it is and with each column re-dealt. Only ids and feature columns
    move. ``id_col`` must be unique.
    """
    rows = stored(features.select(id_col, "label", *FEATURES), "importance")
    place = {k: row_ranks(rows, seed + k, id_col) for k in (1, 2)}
    given = rows.join(place[2], id_col).select("rank", *[F.col(f).alias(f"_{f}") for f in FEATURES])
    paired = rows.join(place[1], id_col).join(given, "rank")
    dealt = paired.withColumn("_changed", F.explode(F.sequence(F.lit(0), F.lit(len(FEATURES)))))
    changed = dealt.select("label", "_changed", *[
        F.when(F.col("_changed") == i, F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for i, f in enumerate(FEATURES, 1)
    ])
    hit = F.avg((F.col("is_ai").cast("int") == F.col("label")).cast("double"))
    accuracies = {r["_changed"]: r["accuracy"] for r in predict(ensemble, changed).groupBy("_changed").agg(hit.alias("accuracy")).collect()}
    falls = [(f, accuracies[0] - accuracies[i]) for i, f in enumerate(FEATURES, 1)] if accuracies else []
    return features.sparkSession.createDataFrame(falls, "feature string, importance double")


def save_ensemble(ensemble: Ensemble, path: str) -> None:
    spark = SparkSession.active()
    ensemble.forest.save(spark, f"{path}/forest")
    ensemble.boosted.save(spark, f"{path}/boosted")
    ensemble.logistic.save(spark, f"{path}/logistic")


def load_ensemble(path: str) -> Ensemble:
    spark = SparkSession.active()
    return Ensemble(
        Forest.load(spark, f"{path}/forest"),
        BoostedTrees.load(spark, f"{path}/boosted"),
        Logistic.load(spark, f"{path}/logistic"),
    )


def cross_validate(
    features: DataFrame, k: int = 5, seed: int = SEED, id_col: str = "doc_id", trees: int = TREES, depth: int = DEPTH,
    rounds: int = ROUNDS, max_iter: int = MAX_ITER,
) -> DataFrame:
    """Accuracy per fold with the mean and twice the deviation over folds.

    The rows are read from one table with a fold column. Boosted trees and regressions of all folds are fitted in the
    same passes; the forests follow one by one, each scored and let go before the next, since they are the large part
    of a model.
    """
    folded = stored(kfold(features, k, seed, id_col).select(id_col, "label", "fold", *FEATURES), "folds")
    rows = training_rows(folded, FEATURES, "fold", id_col).persist()
    scored = None
    try:
        done = run_together(features.sparkSession, {
            "boosted": lambda: fit_boosted(rows, FEATURES, rounds, RATE, BOOST_DEPTH, k),
            "logistic": lambda: fit_logistic(rows, FEATURES, max_iter=max_iter, folds=k),
        })
        for fold, others in enumerate(zip(done["boosted"], done["logistic"], strict=True)):
            ensemble = Ensemble(fit_forest(rows, FEATURES, trees, depth, seed, fold), *others)
            part = predict(ensemble, folded.where(F.col("fold") == fold))
            part = part.select(F.col("fold").cast("int").alias("fold"), (F.col("is_ai").cast("int") == F.col("label")).cast("double").alias("hit"))
            part = stored(part, "fold-scores")
            scored = part if scored is None else scored.unionByName(part)
    finally:
        rows.unpersist()
    table = scored.groupBy("fold").agg(F.avg("hit").alias("accuracy"))
    folds = Window.partitionBy(F.lit(0))  # k rows
    return table.withColumns({
        "mean_accuracy": F.avg("accuracy").over(folds),
        "two_deviations": 2 * F.stddev_pop("accuracy").over(folds),
    })
