import pytest
from pyspark.sql import functions as F

from penprint.functions.features import FEATURES, add_features
from penprint.functions.rules import add_heuristic_class
from penprint.operators import models
from penprint.plans import score, train
from penprint.session import cut_lineage
from penprint.sources import writers

SMALL = {"trees": 5, "depth": 4, "rounds": 3, "max_iter": 200}


@pytest.fixture(scope="module")
def texts(spark):
    human = "I don't know, it's fine! We went home. You were late, and my dog was tired number {0}."
    machine = (
        "However, the comprehensive framework number {0} facilitates a robust paradigm. "
        "Moreover, the realm is considered essential; it was designed to optimize synergy."
    )
    rows = [(i, (machine if i % 3 == 0 else human).format(i), int(i % 3 == 0)) for i in range(240)]
    # Some of either class look like the other.
    rows = [(i, t, 1 - k if i % 17 == 0 else k) for i, t, k in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(4, "doc_id")


@pytest.fixture(scope="module")
def features(texts):
    return cut_lineage(add_features(texts).select("doc_id", "label", *FEATURES))


@pytest.fixture(scope="module")
def ensemble(features):
    return models.fit_ensemble(features, **SMALL)


def probabilities(df):
    return {r["doc_id"]: r["ai_probability"] for r in df.select("doc_id", "ai_probability").collect()}


def test_vote_is_the_mean(features, ensemble):
    got = probabilities(models.predict(ensemble, features))
    parts = []
    scored = models.probabilities(ensemble, features)
    for name in ("_forest", "_boosted", "_logistic"):
        p = F.col(name)
        parts.append(probabilities(scored.select("doc_id", p.alias("ai_probability"))))
    for i in got:
        assert got[i] == pytest.approx(sum(p[i] for p in parts) / 3)
    rows = models.predict(ensemble, features)
    assert rows.where("is_ai != (ai_probability > human_probability)").count() == 0
    assert rows.where("abs(ai_probability + human_probability - 1) > 1e-9").count() == 0
    accuracy = rows.agg(F.avg((F.col("is_ai").cast("int") == F.col("label")).cast("double"))).first()[0]
    assert accuracy > 0.9


def test_fits_repeat(features, ensemble):
    again = models.fit_ensemble(features, **SMALL)
    a, b = probabilities(models.predict(ensemble, features)), probabilities(models.predict(again, features))
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9


def test_save_and_load(spark, tmp_path, features, ensemble):
    writers.save_model(ensemble, f"{tmp_path}/m", writers.run_metadata(spark, dataset_size=240))
    loaded, metadata = writers.load_model(spark, f"{tmp_path}/m")
    assert metadata.first()["dataset_size"] == 240
    assert probabilities(models.predict(loaded, features)) == pytest.approx(
        probabilities(models.predict(ensemble, features))
    )


def test_without_a_model_the_heuristic_decides(features, ensemble):
    plain = models.predict_or_heuristic(features)
    assert plain.columns == models.predict_or_heuristic(features, ensemble).columns
    want = probabilities(add_heuristic_class(features))
    assert probabilities(plain) == want


def test_importance(spark, ensemble):
    rows = models.feature_importance(ensemble, spark).orderBy("rank").collect()
    assert {r["feature"] for r in rows} == set(FEATURES)
    assert rows[-1]["cumulative"] == pytest.approx(1.0)
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True)


def test_cross_validation(features):
    rows = models.cross_validate(features, k=3, **SMALL).collect()
    assert [r["fold"] for r in sorted(rows)] == [0, 1, 2]
    mean = sum(r["accuracy"] for r in rows) / 3
    assert all(r["mean_accuracy"] == pytest.approx(mean) for r in rows)
    spread = (sum((r["accuracy"] - mean) ** 2 for r in rows) / 3) ** 0.5
    assert all(r["two_deviations"] == pytest.approx(2 * spread) for r in rows)


def test_train_and_evaluate(spark, tmp_path, texts):
    run = train.train_and_evaluate(texts, inner_holdout=True, contrast_rows=20, path=f"{tmp_path}/run", **SMALL)
    facts = run.metadata.first()
    assert (facts["dataset_size"], facts["test_samples"], facts["train_samples"]) == (240, 48, 192)
    assert facts["features_used"] == 15 and facts["human_samples"] + facts["ai_samples"] == 240
    assert facts["avg_inference_time_ms"] > 0
    assert run.evaluation.metrics.first()["test_size"] == 48
    assert run.inner is not None and 20 < run.inner.rows < 60
    assert 0 <= run.evaluation.roc_auc.first()[0] <= 1 and 0 <= run.evaluation.pr_auc.first()[0] <= 1
    assert run.contrast.count() == 15 and run.importance.count() == 15
    for name in ("test_results", "classification_report", "confidence_analysis", "roc_curve", "pr_curve", "areas", "feature_statistics",
                 "feature_importance", "run_log"):
        assert spark.read.json(f"{tmp_path}/run/{name}").count() > 0
    loaded, _ = writers.load_model(spark, f"{tmp_path}/run/model")
    assert score.score_texts(texts, loaded).count() == 240


def test_models_do_not_depend_on_partitions(features):
    few = models.fit_ensemble(features.repartition(3), **SMALL)
    many = models.fit_ensemble(features.repartition(11, "label"), **SMALL)
    a, b = (probabilities(models.predict(m, features)) for m in (few, many))
    assert a == pytest.approx(b, abs=1e-9)


def test_permutation_importance(spark, ensemble, features):
    flat = features.withColumn("readability", F.lit(0.5))
    got = {r["feature"]: r["importance"] for r in models.permutation_importance(ensemble, flat, seed=3).collect()}
    assert set(got) == set(FEATURES) and got["readability"] == 0.0

    # The same by hand: rows in two orders, one column at a time.
    rows = {r["doc_id"]: r.asDict() for r in flat.collect()}
    order = [{r["doc_id"]: r["rank"] for r in models.row_ranks(flat, 3 + k).collect()} for k in (1, 2)]
    giver = {rank: i for i, rank in order[1].items()}
    changed = []
    for f in FEATURES:
        changed += [(*[rows[giver[order[0][i]]][g] if g == f else r[g] for g in FEATURES], r["label"], f) for i, r in rows.items()]
    names = ", ".join(f"{f} double" for f in FEATURES)
    hit = F.avg((F.col("is_ai").cast("int") == F.col("label")).cast("double")).alias("a")
    by_hand = models.predict(ensemble, spark.createDataFrame(changed, f"{names}, label int, changed string")).groupBy("changed").agg(hit)
    whole = models.predict(ensemble, flat).agg(hit).first()["a"]
    assert got == pytest.approx({r["changed"]: whole - r["a"] for r in by_hand.collect()})
    assert max(got.values()) > 0
