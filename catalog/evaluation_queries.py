"""Metrics and curves on a score both engines can compute: the share of distinct words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import text_sql as ts
from catalog.entry import Entry
from penprint.functions.features import FEATURES, add_features
from penprint.operators import evaluate, lexicon, sampling
from penprint.sources import tables


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with the score as AI probability."""
    p = F.col("ratio")
    return lexicon.distinct_ratio(tables.doc_corpus(spark, folder), "doc_id", "label").select(
        "doc_id", "label", p.alias("score"), p.alias("ai_probability"),
        (1 - p).alias("human_probability"), (p > 1 - p).alias("is_ai"),
    )


_SCORED = f"""scored AS (SELECT doc_id, label, p AS score, p AS ai_probability, 1 - p AS human_probability,
  p > 1 - p AS is_ai FROM (
    SELECT doc_id, label, len(list_distinct(w)) / greatest(len(w), 1)::DOUBLE AS p FROM (
      SELECT doc_id, label, {ts.words('lt')} AS w FROM (
        SELECT doc_id, label, lower(text) AS lt FROM ({ts.DOC}))))),
conf AS (SELECT count(*) FILTER (label = 0 AND NOT is_ai) AS tn, count(*) FILTER (label = 0 AND is_ai) AS fp,
  count(*) FILTER (label = 1 AND NOT is_ai) AS fn, count(*) FILTER (label = 1 AND is_ai) AS tp FROM scored)"""

_RUNNING = f"""{_SCORED},
tot AS (SELECT count(*) FILTER (label = 1)::DOUBLE AS ap, count(*) FILTER (label = 0)::DOUBLE AS an FROM scored),
g AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM scored GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC)::DOUBLE AS tps,
  sum(neg) OVER (ORDER BY score DESC)::DOUBLE AS fps FROM g)"""


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


def _over_scored(operator):
    return lambda spark, folder: _round_doubles(operator(_scored(spark, folder)))


def _contrast(spark: SparkSession, folder: str) -> DataFrame:
    features = add_features(tables.chat_corpus(spark, folder))
    return evaluate.feature_contrast(features).select(
        "feature", *[F.round(c, 4).alias(c) for c in ("human_mean", "ai_mean", "difference")],
        F.round("pct_difference", 2).alias("pct_difference"),
    )


def _contrast_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The contrast over the first 200 texts of each class; only those are tokenised."""
    sample = sampling.head_per_class(tables.chat_corpus(spark, folder), 200)
    return evaluate.feature_contrast(add_features(sample)).select(
        "feature", F.round("human_mean", 4).alias("human_mean"), F.round("ai_mean", 4).alias("ai_mean"),
    )


def _contrast_sql(source: str) -> str:
    return "WITH " + ts.features_cte(source, carry="doc_id, label") + ", m AS (" + " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, avg({f}) FILTER (label = 0) AS h, avg({f}) FILTER (label = 1) AS a
        FROM feats""" for f in FEATURES
    ) + ")"


def _label_check(spark: SparkSession, folder: str) -> DataFrame:
    expected = F.when(F.col("label") == 1, "AI").otherwise("Human")
    return _round_doubles(evaluate.labelled_check(_scored(spark, folder).withColumn("expected", expected)))


def _truth(spark: SparkSession, folder: str) -> DataFrame:
    predictions = lexicon.distinct_ratio(tables.documents(spark, folder)).select(
        "doc_id", (F.col("ratio") > 0.5).alias("is_ai")
    )
    truth = tables.table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return evaluate.attach_truth(predictions, truth).select("doc_id", "is_ai", "label")


def _variances(spark: SparkSession, folder: str) -> DataFrame:
    """A stand-in importance per feature: the absolute difference of its class means."""
    return evaluate.feature_contrast(add_features(tables.chat_corpus(spark, folder))).select(
        "feature", F.round(F.abs("difference"), 4).alias("importance")
    )


_VARIANCES = "SELECT feature, round(abs(a - h), 4) AS importance FROM m"


ENTRIES = [
    Entry("agg4_confusion", _over_scored(evaluate.confusion), f"WITH {_SCORED} SELECT * FROM conf"),
    Entry(
        "agg5_binary_metrics", _over_scored(evaluate.binary_metrics),
        f"""WITH {_SCORED} SELECT *, tn + fp + fn + tp AS test_size,
        round((tp + tn) / (tn + fp + fn + tp)::DOUBLE, 6) AS accuracy,
        round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
        round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
        round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1_score,
        round(coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0), 6) AS specificity,
        round(coalesce(fp / nullif(tn + fp, 0)::DOUBLE, 0), 6) AS false_positive_rate FROM conf""",
    ),
    Entry(
        "agg6_classification_report", _over_scored(evaluate.classification_report),
        f"""WITH {_SCORED}, p AS (SELECT *,
          tn / nullif(tn + fn, 0)::DOUBLE AS p0, tn / nullif(tn + fp, 0)::DOUBLE AS r0,
          2 * tn / nullif(2 * tn + fp + fn, 0)::DOUBLE AS f0, tn + fp AS s0,
          tp / nullif(tp + fp, 0)::DOUBLE AS p1, tp / nullif(tp + fn, 0)::DOUBLE AS r1,
          2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE AS f1, tp + fn AS s1 FROM conf),
        z AS (SELECT coalesce(p0, 0) AS p0, coalesce(r0, 0) AS r0, coalesce(f0, 0) AS f0, s0,
          coalesce(p1, 0) AS p1, coalesce(r1, 0) AS r1, coalesce(f1, 0) AS f1, s1, tp + tn AS hit FROM p),
        r AS (SELECT 'Human' AS row, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM z
          UNION ALL SELECT 'AI', p1, r1, f1, s1 FROM z
          UNION ALL SELECT 'accuracy', NULL, NULL, hit / (s0 + s1)::DOUBLE, s0 + s1 FROM z
          UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM z
          UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
            (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM z)
        SELECT row, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round(f1_score, 6) AS f1_score, support FROM r""",
    ),
    Entry(
        "agg7_confidence_stats", _over_scored(evaluate.confidence_stats),
        f"""WITH {_SCORED}, k AS (SELECT is_ai, greatest(ai_probability, human_probability) AS c FROM scored)
        SELECT round(avg(c), 6) AS avg_confidence,
        round(coalesce(avg(c) FILTER (NOT is_ai), 0), 6) AS avg_human_confidence,
        round(coalesce(avg(c) FILTER (is_ai), 0), 6) AS avg_ai_confidence,
        round(min(c), 6) AS min_confidence, round(max(c), 6) AS max_confidence FROM k""",
    ),
    Entry(
        "agg8_feature_contrast", _contrast,
        f"""{_contrast_sql(ts.CHAT)} SELECT feature, round(h, 4) AS human_mean, round(a, 4) AS ai_mean,
        round(a - h, 4) AS difference,
        round(CASE WHEN h <> 0 THEN (a - h) / h * 100 ELSE 0 END, 2) AS pct_difference FROM m""",
    ),
    Entry(
        "agg8_feature_contrast_200", _contrast_sample,
        _contrast_sql(f"""SELECT doc_id, text, label FROM (SELECT *,
          row_number() OVER (PARTITION BY label ORDER BY {ts.key(42, 'doc_id')}) AS rn FROM ({ts.CHAT}))
          WHERE rn <= (SELECT least(200, min(n)) FROM (SELECT count(*) AS n FROM ({ts.CHAT}) GROUP BY label))""")
        + " SELECT feature, round(h, 4) AS human_mean, round(a, 4) AS ai_mean FROM m",
    ),
    Entry(
        "agg10_labelled_check", _label_check,
        f"""WITH {_SCORED} SELECT tn + tp AS correct, tn + fp + fn + tp AS total,
        round((tp + tn) / (tn + fp + fn + tp)::DOUBLE, 6) AS accuracy FROM conf""",
    ),
    Entry(
        "jn2_attach_truth", _truth,
        f"""SELECT doc_id, p > 0.5 AS is_ai, quality AS label FROM (
          SELECT doc_id, len(list_distinct(w)) / greatest(len(w), 1)::DOUBLE AS p FROM (
            SELECT doc_id, {ts.words('lt')} AS w FROM (SELECT doc_id, lower(text) AS lt FROM documents)))
        JOIN labels USING (doc_id)""",
    ),
    Entry(
        "win1_importance_rank",
        lambda spark, d: _round_doubles(evaluate.importance_rank(_variances(spark, d))),
        f"""{_contrast_sql(ts.CHAT)}, v AS ({_VARIANCES}) SELECT feature, importance,
        row_number() OVER (ORDER BY importance DESC, feature)::INT AS rank,
        round(sum(importance) OVER (ORDER BY importance DESC, feature), 6) AS cumulative FROM v""",
    ),
    Entry(
        "ord7_sort_by_importance", lambda spark, d: evaluate.sort_by_importance(_variances(spark, d)),
        f"{_contrast_sql(ts.CHAT)} {_VARIANCES} ORDER BY importance DESC, feature",
    ),
    Entry(
        "win4_roc_points", _over_scored(evaluate.roc_points),
        f"""WITH {_RUNNING} SELECT round(score, 6) AS score, round(coalesce(fps / nullif(an, 0), 0), 6) AS fpr,
        round(coalesce(tps / nullif(ap, 0), 0), 6) AS tpr FROM c, tot
        UNION ALL SELECT NULL, 0::DOUBLE, 0::DOUBLE""",
    ),
    Entry(
        "win5_roc_auc", _over_scored(evaluate.roc_auc),
        f"""WITH {_SCORED}, r AS (SELECT label, rank() OVER (ORDER BY score) AS lo,
          count(*) OVER (PARTITION BY score) AS same FROM scored)
        SELECT round((sum(lo + (same - 1) / 2.0::DOUBLE) FILTER (label = 1)
          - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0::DOUBLE)
          / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) AS roc_auc FROM r""",
    ),
    Entry(
        "win6_pr_points", _over_scored(evaluate.pr_points),
        f"""WITH {_RUNNING} SELECT round(score, 6) AS score, round(tps / (tps + fps), 6) AS precision,
        round(coalesce(tps / nullif(ap, 0), 0), 6) AS recall FROM c, tot
        UNION ALL SELECT NULL, 1::DOUBLE, 0::DOUBLE""",
    ),
    Entry(
        "win6_pr_auc", _over_scored(evaluate.pr_auc),
        f"""WITH {_RUNNING}, pts AS (SELECT tps / ap AS r, tps / (tps + fps) AS p, score FROM c, tot
          UNION ALL SELECT 0, 1, 2),
        l AS (SELECT r, p, lag(r) OVER (ORDER BY score DESC) AS r0, lag(p) OVER (ORDER BY score DESC) AS p0 FROM pts)
        SELECT round(sum((r - r0) * (p + p0) / 2), 6) AS pr_auc FROM l""",
    ),
]
