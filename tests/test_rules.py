import pytest
from pyspark.sql import functions as F

from penprint.functions import rules
from penprint.functions.features import FEATURES
from penprint.plans import score


@pytest.mark.parametrize("ai, variation, unique, punctuation, expected, is_ai", [
    (0.02, 0.1, 0.4, 0.005, 1.0, True),
    (0.02, 0.1, 0.6, 0.02, 0.5, False),
    (0.01, 0.3, 0.5, 0.01, 0.0, False),
    (0.02, 0.1, 0.4, 0.5, 0.75, True),
])
def test_heuristic(spark, ai, variation, unique, punctuation, expected, is_ai):
    df = spark.createDataFrame(
        [(ai, variation, unique, punctuation)],
        "ai_word_ratio double, sentence_variation double, unique_word_ratio double, punctuation_density double",
    )
    row = rules.add_heuristic_class(df).first()
    assert (row["heuristic_score"], row["is_ai"]) == (expected, is_ai)
    assert row["human_probability"] == pytest.approx(1 - expected)
    assert row["ai_score"] == row["ai_probability"] == expected


@pytest.mark.parametrize("human, ai, margin, confidence, grade", [
    (0.45, 0.55, 0.10, 0.44, "HIGH"),
    (0.35, 0.65, 0.30, 0.585, "MEDIUM"),
    (0.125, 0.875, 0.75, 0.875, "LOW"),
    (0.5, 0.5, 0.0, 0.4, "HIGH"),
])
def test_calibrated_confidence(spark, human, ai, margin, confidence, grade):
    df = spark.createDataFrame([(human, ai)], "human_probability double, ai_probability double")
    row = rules.add_calibrated_confidence(df).first()
    assert row["decision_margin"] == pytest.approx(margin)
    assert row["calibrated_confidence"] == pytest.approx(confidence)
    assert row["uncertainty"] == grade


def test_interpretation(spark):
    df = spark.createDataFrame(
        [(0.02, 0.1, 0.6), (0.0, 0.9, 0.9)],
        "ai_word_ratio double, sentence_variation double, unique_word_ratio double",
    )
    got = [r[0] for r in df.select(rules.interpretation()).collect()]
    assert [len(m) for m in got] == [2, 0]
    assert got[0][0] == "High AI word usage detected"


def test_preview_and_labels(spark):
    df = spark.createDataFrame([("x" * 50, True), ("x" * 51, False)], "text string, is_ai boolean")
    rows = df.select(
        rules.preview(F.col("text")), rules.decode_label(F.col("is_ai")),
        rules.decode_label(F.col("is_ai"), rules.LONG_LABELS),
    ).collect()
    assert tuple(rows[0]) == ("x" * 50, "AI", "AI-Generated")
    assert tuple(rows[1]) == ("x" * 50 + "...", "Human", "Human-Written")


def test_profile_counts_words_as_written(spark):
    df = spark.createDataFrame([(1, "IT'S late. It'S Late")], "doc_id long, text string")
    row = rules.add_profile(df).first()
    assert row["text_length"] == 20 and row["word_count"] == 7
    assert set(rules.PROFILE_RATIOS) <= set(FEATURES)


def test_combined_analysis_is_nested(spark):
    df = spark.createDataFrame([(1, "However, it is a robust realm. Moreover, it is.")], "doc_id long, text string")
    row = score.combined_analysis(df).first()
    assert row["prediction"] in rules.LONG_LABELS
    assert row["confidence"] == max(row["ai_probability"], row["human_probability"])
    assert set(row["detailed_analysis"].asDict()) == set(rules.PROFILE)


def test_batch(spark):
    df = spark.createDataFrame([(1, "short"), (2, "   "), (3, "However robust realm of a myriad thus.")], "doc_id long, text string")
    assert score.batch_predict(df).count() == 2
    summary = score.batch_summary(df).first()
    assert summary["total"] == 2 and summary["predicted_ai"] + summary["predicted_human"] == 2
    empty = score.batch_summary(df.where("doc_id > 9")).first()
    assert tuple(empty) == (0, 0, 0, 0.0, 0.0)
    assert score.score_texts(df, at_least=10).count() == 1


def test_scoring_rate(spark):
    df = spark.createDataFrame([(i, f"a text of some length {i}") for i in range(20)], "doc_id long, text string")
    row = score.scoring_rate(df).first()
    assert row["rows"] == 20 and row["seconds"] > 0
    assert row["ms_per_text"] == pytest.approx(1000 * row["seconds"] / 20)
