import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from penprint.operators import evaluate


def scored(spark, rows):
    """Rows of (label, AI probability)."""
    df = spark.createDataFrame([(k, float(s)) for k, s in rows], "label int, score double")
    p = F.col("score")
    return df.select(
        "label", "score", (p > 0.5).alias("is_ai"), (1 - p).alias("human_probability"), p.alias("ai_probability")
    )


def points(rows):
    """(positives, negatives) at and above each distinct score, falling."""
    out = []
    for s in sorted({s for _, s in rows}, reverse=True):
        out.append((s, sum(k == 1 and x >= s for k, x in rows), sum(k == 0 and x >= s for k, x in rows)))
    return out


GOLDEN = [(0, 0.1)] * 3 + [(0, 0.9)] + [(1, 0.1)] * 2 + [(1, 0.9)] * 4


def test_metrics_golden(spark):
    row = evaluate.binary_metrics(scored(spark, GOLDEN)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (3, 1, 2, 4)
    got = [row[c] for c in ("accuracy", "precision", "recall", "f1_score", "specificity", "false_positive_rate")]
    assert got == pytest.approx([0.7, 0.8, 0.666667, 0.727273, 0.75, 0.25], abs=1e-6)
    nested = evaluate.nested_metrics(scored(spark, GOLDEN)).first()
    assert nested["confusion_matrix"]["true_positives"] == 4 and nested["test_size"] == 10


def test_metrics_of_nothing(spark):
    row = evaluate.binary_metrics(scored(spark, GOLDEN).where("false")).first()
    assert row["accuracy"] == row["precision"] == row["specificity"] == 0.0
    assert tuple(evaluate.confidence_stats(scored(spark, GOLDEN).where("false")).first()) == (0.0,) * 5
    assert evaluate.roc_auc(scored(spark, GOLDEN).where("false")).first()[0] == 0.0


def test_report(spark):
    rows = {r["row"]: r for r in evaluate.classification_report(scored(spark, GOLDEN)).collect()}
    assert rows["Human"]["precision"] == pytest.approx(0.6)
    assert rows["AI"]["recall"] == pytest.approx(4 / 6)
    assert rows["accuracy"]["f1_score"] == pytest.approx(0.7) and rows["accuracy"]["support"] == 10
    assert rows["macro avg"]["precision"] == pytest.approx(0.7)
    assert rows["weighted avg"]["precision"] == pytest.approx((0.6 * 4 + 0.8 * 6) / 10)


def test_confidence(spark):
    row = evaluate.confidence_stats(scored(spark, [(0, 0.2), (1, 0.6), (1, 0.9)])).first()
    assert tuple(row) == pytest.approx(((0.8 + 0.6 + 0.9) / 3, 0.8, 0.75, 0.6, 0.9))


def draws(seed, n, digits):
    r = random.Random(seed)
    return [(k := int(r.random() < 0.3), round(min(max(r.gauss(0.4 + 0.2 * k, 0.2), 0), 1), digits)) for _ in range(n)]


# A third of the rows share one score; the last set starts with negatives at the top score.
SETS = [
    draws(1, 400, 2), draws(2, 400, 6), draws(3, 300, 3) + [(1, 0.5)] * 100 + [(0, 0.5)] * 100,
    [(0, 1.0), (0, 1.0), (1, 0.8), (0, 0.3), (1, 0.3), (1, 0.0)], [(1, 0.5 + i * 1e-9) for i in range(50)] + [(0, 0.5)],
]


@pytest.mark.parametrize("rows", SETS)
def test_curves_against_brute_force(spark, rows):
    df = scored(spark, rows)
    pos, neg = sum(k for k, _ in rows), sum(1 - k for k, _ in rows)
    want = points(rows)
    roc = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_points(df).collect())
    curve = [(0.0, 0.0)] + [(f / neg, t / pos) for _, t, f in want]
    assert len(roc) == len(curve)
    assert all(a == pytest.approx(b) for a, b in zip(roc, sorted(curve)))
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(area)

    pr = [(0.0, 1.0)] + [(t / pos, t / (t + f)) for _, t, f in want]
    got = sorted((r["recall"], r["precision"]) for r in evaluate.pr_points(df).collect())
    assert len(got) == len(pr)
    assert all(a == pytest.approx(b) for a, b in zip(got, sorted(pr)))
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pr, pr[1:]))
    assert evaluate.pr_auc(df).first()[0] == pytest.approx(area)


def test_roc_area_equals_the_library_evaluator(spark):
    df = scored(spark, SETS[2]).withColumn("label", F.col("label").cast("double"))
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(want, abs=1e-12)


def test_scores_are_reduced_before_the_window(spark):
    rows = scored(spark, SETS[0])
    assert evaluate._running(rows).count() == rows.select("score").distinct().count()


def test_scores_close_together(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(2), 1 - rng.randrange(400) * 1e-11) for _ in range(3000)]
    df = spark.createDataFrame([(k, s) for k, s in rows], "label int, score double")
    pos, neg = [s for k, s in rows if k], [s for k, s in rows if not k]
    area = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(area, abs=1e-12)


def test_contrast(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0), (0, 3.0, 0.0), (1, 5.0, 2.0)], "label int, a double, b double")
    rows = {r["feature"]: tuple(r)[1:] for r in evaluate.feature_contrast(df, ["a", "b"]).collect()}
    assert rows == {"a": (2.0, 5.0, 3.0, 150.0), "b": (0.0, 2.0, 2.0, 0.0)}


def test_importance(spark):
    df = spark.createDataFrame([("x", 0.2), ("y", 0.5), ("z", 0.3)], "feature string, importance double")
    rows = [tuple(r) for r in evaluate.importance_rank(df).orderBy("rank").collect()]
    assert [r[0] for r in rows] == ["y", "z", "x"] and [r[2] for r in rows] == [1, 2, 3]
    assert [r[3] for r in rows] == pytest.approx([0.5, 0.8, 1.0])
    assert [r[0] for r in evaluate.sort_by_importance(df).collect()] == ["y", "z", "x"]


def test_labelled_check(spark):
    df = spark.createDataFrame([(True, "AI"), (False, "AI"), (False, "Human")], "is_ai boolean, expected string")
    assert tuple(evaluate.labelled_check(df).first()) == pytest.approx((2, 3, 2 / 3))


def test_attach_truth(spark):
    predictions = spark.createDataFrame([(1, True), (2, False), (3, True)], "doc_id long, is_ai boolean")
    truth = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, label int, other int")
    assert {tuple(r) for r in evaluate.attach_truth(predictions, truth).collect()} == {(1, True, 1), (2, False, 1)}
