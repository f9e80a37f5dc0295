"""Evaluation tables over scored texts.

Input columns: ``label`` (0 human, 1 AI), ``is_ai`` (the prediction), ``human_probability`` and
``ai_probability``; the curves take any ``score`` in [0, 1]. Every metric is one partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.functions.features import FEATURES
from penprint.functions.rules import SHORT_LABELS, confidence
from penprint.session import stored

# Width bins of a curve. Their running totals are one window over at most this many rows, and as
# many rows are broadcast.


def _ratio(top: Column, bottom: Column) -> Column:
    """Zero on an empty denominator."""
    return F.when(bottom > 0, top / F.when(bottom > 0, bottom)).otherwise(0.0)


def confusion(df: DataFrame) -> DataFrame:
    """One row ``tn, fp, fn, tp``."""
    ai, predicted = F.col("label") == 1, F.col("is_ai")
    human = F.col("label") == 0
    return df.agg(
        F.count_if(human & ~predicted).alias("tn"),
        F.count_if(human & predicted).alias("fp"),
        F.count_if(ai & ~predicted).alias("fn"),
        F.count_if(ai & predicted).alias("tp"),
    )


def binary_metrics(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, specificity and false positive rate, with the counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion(df).withColumns({
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
        "specificity": _ratio(tn, tn + fp),
        "false_positive_rate": _ratio(fp, fp + tn),
        "test_size": tn + fp + fn + tp,
    })


def nested_metrics(df: DataFrame) -> DataFrame:
    """The metrics with the confusion counts as a struct, the layout of the results file."""
    return binary_metrics(df).select(
        "accuracy", "precision", "recall", "f1_score", "specificity", "false_positive_rate",
        F.struct(
            F.col("tn").alias("true_negatives"), F.col("fp").alias("false_positives"),
            F.col("fn").alias("false_negatives"), F.col("tp").alias("true_positives"),
        ).alias("confusion_matrix"),
        "test_size",
    )


def classification_report(df: DataFrame, names: tuple[str, str] = SHORT_LABELS) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    per_class = {
        0: (_ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fp + fn), tn + fp),
        1: (_ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn), tp + fn),
    }
    measures = ("p", "r", "f", "s")
    wide = confusion(df).withColumns({
        f"{m}{k}": value for k, values in per_class.items() for m, value in zip(measures, values)
    }).withColumn("n", F.col("s0") + F.col("s1"))

    def row(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"), p.cast("double").alias("precision"),
            r.cast("double").alias("recall"), f.cast("double").alias("f1_score"), s.alias("support"),
        )

    def mean(m: str, weighted: bool) -> Column:
        if weighted:
            total = F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1")
            return _ratio(total, F.col("n"))
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    nothing = F.lit(None)
    rows = [row(names[k], *[F.col(f"{m}{k}") for m in measures]) for k in (0, 1)]
    rows.append(row("accuracy", nothing, nothing, _ratio(tp + tn, F.col("n")), F.col("n")))
    for name, weighted in (("macro avg", False), ("weighted avg", True)):
        rows.append(row(name, *[mean(m, weighted) for m in "prf"], F.col("n")))
    return wide.select(F.inline(F.array(*rows)))


def confidence_stats(df: DataFrame) -> DataFrame:
    """Confidence overall and by predicted class; zero for a class that was never predicted."""
    value = confidence()

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    return df.agg(
        or_zero(F.avg(value)).alias("avg_confidence"),
        or_zero(F.avg(F.when(~F.col("is_ai"), value))).alias("avg_human_confidence"),
        or_zero(F.avg(F.when(F.col("is_ai"), value))).alias("avg_ai_confidence"),
        or_zero(F.min(value)).alias("min_confidence"),
        or_zero(F.max(value)).alias("max_confidence"),
    )


def feature_contrast(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Mean of every feature per class, their difference, and that in percent of the human mean.

    One aggregation to one row, turned into a row per feature afterwards: rows are not multiplied.
    """
    means = df.agg(*[
        F.avg(F.when(F.col("label") == k, F.col(f))).alias(f"{f}_{k}") for f in features for k in (0, 1)
    ])
    rows = F.array(*[
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"{f}_0").alias("human_mean"),
            F.col(f"{f}_1").alias("ai_mean"),
        )
        for f in features
    ])
    difference = F.col("ai_mean") - F.col("human_mean")
    return means.select(F.inline(rows)).withColumns({
        "difference": difference,
        "pct_difference": F.when(
            F.col("human_mean") != 0,
            difference / F.when(F.col("human_mean") != 0, F.col("human_mean")) * 100,
        ).otherwise(0.0),
    })


def prediction_summary(df: DataFrame) -> DataFrame:
    """Totals and shares of predicted classes; no rows give zeros, not an error."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_ai").alias("predicted_ai"),
        F.count_if(~F.col("is_ai")).alias("predicted_human"),
    )
    return totals.withColumns({
        "ai_share": _ratio(F.col("predicted_ai"), F.col("total")),
        "human_share": _ratio(F.col("predicted_human"), F.col("total")),
    })


def labelled_check(df: DataFrame) -> DataFrame:
    """Correct and total against ``expected`` ('AI' or 'Human')."""
    hit = F.when(F.col("is_ai"), SHORT_LABELS[1]).otherwise(SHORT_LABELS[0]) == F.col("expected")
    return df.agg(
        F.count_if(hit).alias("correct"), F.count(F.lit(1)).alias("total")
    ).withColumn("accuracy", _ratio(F.col("correct"), F.col("total")))


def attach_truth(predictions: DataFrame, truth: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Pair predictions with true labels kept in another table; the optimizer picks the join."""
    return predictions.join(truth.select(id_col, "label"), id_col)


def importance_rank(importances: DataFrame) -> DataFrame:
    """Rank from 1 and running share by falling ``importance``. One row per feature, so one window."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return importances.select(
        "feature", "importance",
        F.row_number().over(order).alias("rank"),
        F.sum("importance").over(so_far).alias("cumulative"),
    )


def sort_by_importance(importances: DataFrame) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature")


def _running(df: DataFrame) -> DataFrame:
    """One row per distinct score with the AI and human rows at and above it.

    Rows are reduced to distinct scores, then to width bins. Running totals over the bins are a
    window over at most 65,537 rows; each bin's own scores are summed up in their own window.
    """
    by_score = df.where(F.col("label").isin(0, 1)).groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    # Ranges of equal depth, whatever the scores' spread; written, so that a range keeps its rows. Missing scores
    # rank last.
    in_ranges = by_score.repartitionByRange(F.desc_nulls_last("score"))
    binned = stored(in_ranges.withColumn("_bin", F.spark_partition_id()), "curve")
    above = Window.partitionBy(F.lit(0)).orderBy("_bin").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(F.lit(0))
    bins = binned.groupBy("_bin").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    offsets = bins.select(
        "_bin",
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_pos_above"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_neg_above"),
        F.sum("_p").over(whole).alias("all_pos"),
        F.sum("_n").over(whole).alias("all_neg"),
    )
    inside = Window.partitionBy("_bin").orderBy(F.desc_nulls_last("score")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        binned.withColumns({"_tp": F.sum("pos").over(inside), "_fp": F.sum("neg").over(inside)})
        .join(F.broadcast(offsets), "_bin")
        .select(
            "score", "pos", "neg", "all_pos", "all_neg",
            (F.col("_pos_above") + F.col("_tp")).alias("tps"),
            (F.col("_neg_above") + F.col("_fp")).alias("fps"),
        )
    )


def roc_points(df: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct score, after the start at (0, 0)."""
    points = _running(df).select(
        "score",
        _ratio(F.col("fps"), F.col("all_neg")).alias("fpr"),
        _ratio(F.col("tps"), F.col("all_pos")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def roc_auc(df: DataFrame) -> DataFrame:
    """Area under the curve by trapezoids.

    A step's height is known from its own running totals, so no step looks at its neighbour. The
    products are summed as decimals: exact for any number of rows.
    """
    neg, steps = F.col("neg").cast("decimal(19,0)"), (2 * F.col("tps") - F.col("pos")).cast("decimal(19,0)")
    twice = (neg * steps).cast("decimal(38,0)")
    sums = _running(df).agg(
        F.coalesce(F.sum(twice).cast("double"), F.lit(0.0)).alias("_twice"),
        F.coalesce(F.max("all_pos"), F.lit(0)).cast("double").alias("_p"),
        F.coalesce(F.max("all_neg"), F.lit(0)).cast("double").alias("_n"),
    )
    return sums.select(_ratio(F.col("_twice"), 2 * F.col("_p") * F.col("_n")).alias("roc_auc"))


def pr_points(df: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score, ending at recall 0 with precision 1."""
    points = _running(df).select(
        "score",
        _ratio(F.col("tps"), F.col("tps") + F.col("fps")).alias("precision"),
        _ratio(F.col("tps"), F.col("all_pos")).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("score"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def pr_auc(df: DataFrame) -> DataFrame:
    """Area under precision over recall by trapezoids, from the point (recall 0, precision 1)."""
    tps, fps, pos = F.col("tps"), F.col("fps"), F.col("pos")
    before_all = tps + fps - pos - F.col("neg")
    before = F.when(before_all > 0, (tps - pos) / F.when(before_all > 0, before_all)).otherwise(1.0)
    area = _ratio(pos, F.col("all_pos")) * (before + tps / (tps + fps)) / 2
    return _running(df).agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("pr_auc"))
