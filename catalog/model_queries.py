"""Model fits, which SQL cannot express, and the stream, which it can.

The fits run on all rows of the chat corpus with the default settings. One fitted ensemble is saved for a session and
folder and serves all queries over it. Their SQL names the rows of the held-out set; flags say what must hold of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import text_sql as ts
from catalog.corpus_queries import ENTRIES as CORPUS
from catalog.entry import Entry
from catalog.evaluation_queries import ENTRIES as EVALUATION
from catalog.evaluation_queries import _round_doubles, _scored
from catalog.text_queries import _scored_sql
from penprint.functions.features import FEATURES, add_features
from penprint.functions.rules import add_calibrated_confidence
from penprint.operators import evaluate, models, sampling
from penprint.operators.forest import read_nodes
from penprint.operators.models import predict_or_heuristic
from penprint.operators.prepare import scorable
from penprint.plans import train
from penprint.session import cut_lineage, scratch_path, stored
from penprint.sources import tables, writers
from penprint.streaming import score as stream
from penprint.streaming import summary

_SAVED: dict[tuple[str, str], str] = {}


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    split = sampling.stratified_split(tables.chat_corpus(spark, folder))
    features = cut_lineage(add_features(split).select("doc_id", "label", "is_test", *FEATURES))
    return features.where(~F.col("is_test")), features.where("is_test")


def _ensemble(spark: SparkSession, folder: str) -> tuple[models.Ensemble, DataFrame]:
    """The ensemble of the chat corpus, fitted once, and the features of its test rows."""
    ensemble, _, test = _fitted(spark, folder)
    return ensemble, test


def _fitted(spark: SparkSession, folder: str) -> tuple[models.Ensemble, DataFrame, DataFrame]:
    """The ensemble, and the features of the rows that it learned from and of the test rows."""
    fitted, test = _split(spark, folder)
    key = spark.sparkContext.applicationId, folder
    if key not in _SAVED:
        path = scratch_path(spark, "ensemble")
        models.save_ensemble(models.fit_ensemble(fitted), path)
        _SAVED[key] = path
    return models.load_ensemble(_SAVED[key]), fitted, test


def _near(a, b, most: float = 1e-9):
    return F.abs(a - b) <= most


def _soft_vote(spark: SparkSession, folder: str) -> DataFrame:
    ensemble, test = _ensemble(spark, folder)
    single = models.probabilities(ensemble, test)
    mean = single.select("doc_id", (F.col("_forest") / 3 + F.col("_boosted") / 3 + F.col("_logistic") / 3).alias("_mean"))
    p = F.col("ai_probability")
    return models.predict(ensemble, test).join(mean, "doc_id").select(
        "doc_id", "label", _near(p, F.col("_mean")).alias("is_mean"), (F.col("is_ai") == (p > 0.5)).alias("is_class"),
        _near(p + F.col("human_probability"), F.lit(1.0)).alias("sums_to_one"), (p == F.col("ai_score")).alias("is_score"),
    )


def _calibrated(spark: SparkSession, folder: str) -> DataFrame:
    ensemble, test = _ensemble(spark, folder)
    scored = add_calibrated_confidence(models.predict(ensemble, test))
    most, margin = F.greatest("human_probability", "ai_probability"), F.col("decision_margin")
    factor = F.col("calibrated_confidence") / most
    return scored.select(
        "doc_id", "label", _near(margin, 2 * most - 1).alias("is_margin"),
        F.expr("uncertainty in ('HIGH', 'MEDIUM', 'LOW')").alias("is_graded"),
        F.when(F.col("uncertainty") == "HIGH", _near(factor, F.lit(0.8)))
        .when(F.col("uncertainty") == "MEDIUM", _near(factor, F.lit(0.9))).otherwise(_near(factor, F.lit(1.0))).alias("is_scaled"),
    )


def _evaluate(spark: SparkSession, folder: str) -> DataFrame:
    ensemble, test = _ensemble(spark, folder)
    run = train.evaluate_on(ensemble, test)
    cells = F.expr("confusion_matrix.true_negatives + confusion_matrix.false_positives + confusion_matrix.false_negatives + confusion_matrix.true_positives")
    right = F.expr("confusion_matrix.true_negatives + confusion_matrix.true_positives")
    return run.metrics.select(
        cells.cast("long").alias("test_size"), _near(F.col("accuracy"), right / cells).alias("is_accuracy"),
        (F.lit(run.seconds) > 0).alias("is_timed"),
    )


#: Rows that walk a tree together, and tasks that walk, by parts of rows and of trees.
_WALKED = 500
_WALKING = 32, 4


def _walked(test: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """``doc_id`` and the mean leaf value of every tree, by following nodes (tree, node, feature, threshold, left, right,
    value) from node 0 on as folds in SQL: a second way to a forest's or a booster's scores. Blocks of rows meet the
    trees, a row each, so only blocks and leaf values move."""
    place = F.create_map(*[F.lit(x) for i, f in enumerate(FEATURES) for x in (f, i)])
    packed = F.struct("node", place[F.col("feature")].alias("feature"), "threshold", "left", "right", "value")
    trees = stored(nodes.groupBy("tree").agg(F.array_sort(F.collect_list(packed)).alias("nodes")).select("nodes"), "trees")
    blocks = max(1, -(-test.count() // _WALKED))
    row = F.struct("doc_id", F.array(*FEATURES).alias("x"))
    keyed = test.select(row.alias("row"), F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"))
    rows = stored(keyed.groupBy("block").agg(F.collect_list("row").alias("rows")).select("rows"), "walked-rows")
    leaf = f"""aggregate(sequence(1, {depth}), 0, (at, i) -> if(nodes[at].feature is null, at,
        if(r.x[nodes[at].feature] <= nodes[at].threshold, nodes[at].left, nodes[at].right)))"""
    # Neither side is broadcast: unpacked trees are large for a driver.
    both = rows.repartition(_WALKING[0]).crossJoin(trees.repartition(_WALKING[1]).hint("shuffle_replicate_nl"))
    found = both.select(F.explode(F.expr(f"transform(rows, r -> named_struct('doc_id', r.doc_id, 'value', nodes[{leaf}].value))")).alias("f"))
    return found.groupBy("f.doc_id").agg(F.avg("f.value").alias("mean"))


def _boosted_nodes(spark: SparkSession, model) -> DataFrame:
    """The booster's nodes, numbered from 0; a node without a split leads left."""
    n = model.table(spark)
    return n.select(
        "tree", (F.col("node") - 1).alias("node"), "feature", "threshold",
        (2 * F.col("node") - 1).alias("left"), (2 * F.col("node")).alias("right"), "value",
    )


def _area(scored: DataFrame, score: str) -> float:
    return evaluate.roc_auc(scored.select("label", F.col(score).alias("score"))).first()[0]


def _forest(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of the forest on the test rows, its saved trees walked again, and what it has learned."""
    ensemble, fitted, test = _fitted(spark, folder)
    model = ensemble.forest
    path = scratch_path(spark, "forest")
    model.save(spark, path)
    again = _walked(test, read_nodes(spark, path), models.DEPTH)
    scored = models.probabilities(ensemble, test).join(again, "doc_id")
    settings = model.trees == models.TREES and model.depth == models.DEPTH
    return _learned(ensemble, fitted, "_forest", scored, F.lit(settings) & _near(F.col("_forest"), F.col("mean")))


def _boosted(spark: SparkSession, folder: str) -> DataFrame:
    ensemble, fitted, test = _fitted(spark, folder)
    model = ensemble.boosted
    again = _walked(test, _boosted_nodes(spark, model), models.BOOST_DEPTH)
    margin = model.start + models.RATE * models.ROUNDS * F.col("mean")
    scored = models.probabilities(ensemble, test).join(again, "doc_id")
    settings = len(model.trees) == models.ROUNDS and model.depth == models.BOOST_DEPTH and model.rate == models.RATE
    return _learned(ensemble, fitted, "_boosted", scored, F.lit(settings) & _near(F.col("_boosted"), 1 / (1 + F.exp(-margin))))


def _logistic(spark: SparkSession, folder: str) -> DataFrame:
    """The gradient of the penalised loss on the training rows, summed by Spark, vanishes at the weights."""
    ensemble, fitted, test = _fitted(spark, folder)
    model = ensemble.logistic
    residual = F.col("_logistic") - F.col("label")
    sums = models.probabilities(ensemble, fitted).agg(
        F.count("*").alias("n"), F.sum(residual).alias("_intercept"), *[F.sum(residual * F.col(f)).alias(f) for f in FEATURES]
    ).first()
    gradient = [sums["_intercept"], *(sums[f] + w for f, w in zip(FEATURES, model.weights, strict=True))]
    optimal = max(map(abs, gradient)) / sums["n"] < 1e-6
    return _learned(ensemble, fitted, "_logistic", models.probabilities(ensemble, test), F.lit(optimal))


def _learned(ensemble: models.Ensemble, fitted: DataFrame, name: str, scored: DataFrame, as_fitted) -> DataFrame:
    """Flags that a model of noise, or another model than the one fitted, fails: the area under the curve over the rows
    that it learned from is far above a half, and each probability is what the model's parts say."""
    area = _area(models.probabilities(ensemble, fitted), name)
    p = F.col(name)
    return scored.select(
        "doc_id", "label", p.between(0, 1).alias("is_probability"), as_fitted.alias("is_as_fitted"), F.lit(area > 0.6).alias("has_learned"),
    )


def _importance(spark: SparkSession, folder: str) -> DataFrame:
    ensemble, _ = _ensemble(spark, folder)
    everything = Window.partitionBy(F.lit(0))  # fifteen rows
    ranked = models.feature_importance(ensemble, spark)
    return ranked.select(
        "feature", _near(F.sum("importance").over(everything), F.lit(1.0)).alias("sums_to_one"),
        (F.col("rank") == 1 + F.coalesce(F.count("*").over(everything.orderBy(F.desc("importance"), "feature").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).alias("is_ranked"),
    )


def _reloaded(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of an ensemble that was saved and loaded, beside those of the one it was saved from."""
    ensemble, test = _ensemble(spark, folder)
    path = scratch_path(spark, "ensemble")
    models.save_ensemble(ensemble, path)
    again = models.predict(models.load_ensemble(path), test).select("doc_id", F.col("ai_probability").alias("_again"))
    scored = models.predict(ensemble, test).join(again, "doc_id")
    return scored.select("doc_id", "label", (F.col("ai_probability") == F.col("_again")).alias("is_equal"))


def _cross_validated(spark: SparkSession, folder: str) -> DataFrame:
    features = add_features(tables.chat_corpus(spark, folder)).select("doc_id", "label", *FEATURES)
    folds = models.cross_validate(features, k=5)
    everything = Window.partitionBy(F.lit(0))  # five rows
    return folds.select(
        F.col("fold").cast("long").alias("fold"), F.col("accuracy").between(0, 1).alias("is_share"),
        _near(F.col("mean_accuracy"), F.avg("accuracy").over(everything)).alias("is_mean"),
    )


def _permuted(spark: SparkSession, folder: str) -> DataFrame:
    """The fall of the vote's accuracy by feature, on the test rows with one more feature held constant."""
    ensemble, test = _ensemble(spark, folder)
    falls = models.permutation_importance(ensemble, test.withColumn("passive_ratio", F.lit(0.0)))
    p = F.col("importance")
    return falls.select(
        "feature", p.between(-1, 1).alias("is_share"), ((F.col("feature") != "passive_ratio") | (p == 0)).alias("constant_is_zero")
    )


def _trained(spark: SparkSession, folder: str) -> DataFrame:
    """The whole training job with its files read back: rows of each, and whether they agree with the scores."""
    path = scratch_path(spark, "run")
    run = train.train_and_evaluate(tables.chat_corpus(spark, folder), path=path)
    loaded, metadata = writers.load_model(spark, f"{path}/model")
    facts, scored = metadata.first(), run.evaluation.scored
    right = scored.agg(F.avg((F.col("is_ai").cast("int") == F.col("label")).cast("double"))).first()[0]
    again = models.predict(loaded, scored.select("doc_id", "label", *FEATURES)).select("doc_id", F.col("ai_probability").alias("_again"))
    checks = {
        "test_results": _near(F.col("accuracy"), F.lit(right)),
        "classification_report": F.col("support") > 0,
        "confidence_analysis": F.col("min_confidence") <= F.col("max_confidence"),
        "feature_statistics": F.col("feature").isin(*FEATURES),
        "feature_importance": F.col("rank").between(1, len(FEATURES)),
        "areas": F.col("roc_auc").between(0, 1) & F.col("pr_auc").between(0, 1),
    }
    sizes = F.lit(facts["dataset_size"]).cast("long").alias("dataset_size"), F.lit(facts["test_samples"]).cast("long").alias("test_samples")
    out = scored.join(again, "doc_id").agg(
        F.lit("model").alias("file"), F.count(F.lit(1)).alias("n"), F.every(F.col("ai_probability") == F.col("_again")).alias("agrees")
    )
    for name, holds in checks.items():
        part = spark.read.json(f"{path}/{name}").agg(F.lit(name).alias("file"), F.count(F.lit(1)).alias("n"), F.every(holds).alias("agrees"))
        out = out.unionByName(part)
    log = writers.read_run_log(spark, f"{path}/run_log")
    out = out.unionByName(log.agg(F.lit("run_log").alias("file"), F.count(F.lit(1)).alias("n"), F.every(F.col("dataset_size") == facts["dataset_size"]).alias("agrees")))
    for name, cells in (("roc_curve", ("fpr", "tpr")), ("pr_curve", ("precision", "recall"))):
        points = spark.read.json(f"{path}/{name}")
        distinct = scored.select("score").distinct().count() + 1
        inside = F.every(F.col(cells[0]).between(0, 1) & F.col(cells[1]).between(0, 1)) & (F.count(F.lit(1)) == distinct)
        out = out.unionByName(points.agg(F.lit(name).alias("file"), F.lit(1).cast("long").alias("n"), inside.alias("agrees")))
    return out.select("file", "n", "agrees", *sizes)


def _stamps(spark: SparkSession, folder: str) -> DataFrame:
    """The dates that a run's files are stamped with: their form, and that they are today's or yesterday's."""
    rows = tables.chat_corpus(spark, folder).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    path = scratch_path(spark, "stamps")
    writers.write_metrics(writers.run_metadata(spark, dataset_size=rows), f"{path}/metadata")
    writers.append_run_log(spark.range(1).select(F.lit(rows).alias("dataset_size")), f"{path}/log", "one")
    first = spark.read.json(f"{path}/metadata").select("dataset_size", F.col("training_date").alias("stamp"))
    second = writers.read_run_log(spark, f"{path}/log").select("dataset_size", F.col("logged_at").alias("stamp"))
    recent = F.timestamp_diff("DAY", F.to_timestamp("stamp"), F.current_timestamp()) <= 1
    form = F.col("stamp").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")
    return first.unionByName(second).select(F.col("dataset_size").cast("long").alias("dataset_size"), form.alias("has_form"), recent.alias("is_recent"))


def _document_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a stream. The braces make the path a pattern, which matches a file as well as a folder of files."""
    return stream.read_text_stream(spark, f"{folder}/{{documents.parquet}}")


def _stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct documents through the stream, scored, as totals by window; the windows are summed up."""
    out = scratch_path(spark, "totals")
    source = _document_stream(spark, folder)
    timed = source.withColumn("at", F.timestamp_seconds((F.col("doc_id") + 1) * 60))  # the epoch itself would be late
    first = summary.distinct_texts(timed, "at", "100000 days")
    scored = predict_or_heuristic(add_features(scorable(first, 10)))
    summary.start_totals(scored, "at", "1 day", out, f"{out}-checkpoint", once=True).awaitTermination()
    totals = summary.read_totals(spark, out)
    return totals.agg(
        F.sum("n").alias("n"), F.sum("n_ai").alias("n_ai"), F.round(F.sum(F.col("mean_ai") * F.col("n")) / F.sum("n"), 6).alias("mean_ai")
    )


def _flags(*names: str) -> str:
    """The held-out rows, all flags true."""
    return f"SELECT doc_id, label, {', '.join(f'true AS {n}' for n in names)} FROM ({_ORD4}) WHERE is_test"


_ORD4 = next(e.sql for e in CORPUS if e.name == "ord4_stratified_split")


def _metrics_file(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics written as JSON and read back."""
    path = scratch_path(spark, "metrics")
    writers.write_metrics(evaluate.binary_metrics(_scored(spark, folder)), path)
    return _round_doubles(spark.read.json(path))


def _run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs in one log, one of them logged twice."""
    path = scratch_path(spark, "run-log")
    area = evaluate.roc_auc(_scored(spark, folder))
    for run, seed in (("first", 42), ("second", 41), ("second", 43)):
        writers.append_run_log(area, path, run, seed=seed)
    return _round_doubles(writers.read_run_log(spark, path).drop("logged_at"))


def _run_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The metadata row of a split, written and read back without its date."""
    counts = sampling.stratified_split(tables.chat_corpus(spark, folder)).agg(
        F.count(F.lit(1)).alias("dataset_size"), F.count_if("is_test").alias("test_samples")
    ).first()
    path = scratch_path(spark, "metadata")
    writers.write_metrics(writers.run_metadata(spark, **counts.asDict(), features_used=len(FEATURES)), path)
    return spark.read.json(path).drop("training_date")


def _streamed(spark: SparkSession, folder: str) -> DataFrame:
    """All documents through the stream, read back from its sink."""
    out = scratch_path(spark, "scores")
    source = _document_stream(spark, folder)
    scored = stream.score_stream(source, partitions=2 * spark.sparkContext.defaultParallelism)
    query = stream.start_scoring(scored, out, f"{out}-checkpoint", once=True)
    query.awaitTermination()
    return spark.read.parquet(out)


ENTRIES = [
    Entry(
        "str1_score_stream", _streamed,
        f"""WITH {_scored_sql(ts.DOCS)} SELECT doc_id, is_ai, human_probability, ai_probability, ai_score
        FROM scored WHERE length({ts.strip('text')}) >= 10""",
    ),
    Entry(
        "snk2_write_metrics", _metrics_file,
        next(e.sql for e in EVALUATION if e.name == "agg5_binary_metrics"),
    ),
    Entry(
        "snk3_append_run_log", _run_log,
        f"""SELECT a.roc_auc, run_id, seed FROM ({next(e.sql for e in EVALUATION if e.name == "win5_roc_auc")}) a,
        (VALUES ('first', 42::BIGINT), ('second', 43::BIGINT)) r(run_id, seed)""",
    ),
    Entry(
        "snk4_write_run_metadata", _run_facts,
        f"""SELECT count(*) AS dataset_size, ceil(count(*) * 0.2::DOUBLE)::BIGINT AS test_samples,
        15::BIGINT AS features_used FROM ({ts.CHAT})""",
    ),
    Entry("mod1_fit_forest", _forest, _flags("is_probability", "is_as_fitted", "has_learned")),
    Entry("mod2_fit_boosted", _boosted, _flags("is_probability", "is_as_fitted", "has_learned")),
    Entry("mod3_fit_logistic", _logistic, _flags("is_probability", "is_as_fitted", "has_learned")),
    Entry("mod4_soft_vote", _soft_vote, _flags("is_mean", "is_class", "sums_to_one", "is_score")),
    Entry("mod5_predict_calibrated", _calibrated, _flags("is_margin", "is_graded", "is_scaled")),
    Entry(
        "mod7_evaluate", _evaluate,
        f"SELECT count(*)::BIGINT AS test_size, true AS is_accuracy, true AS is_timed FROM ({_ORD4}) WHERE is_test",
    ),
    Entry(
        "mod8_feature_importance", _importance,
        f"SELECT unnest({list(FEATURES)!r}) AS feature, true AS sums_to_one, true AS is_ranked",
    ),
    Entry(
        "mod9_cross_validate", _cross_validated,
        "SELECT range::BIGINT AS fold, true AS is_share, true AS is_mean FROM range(5)",
    ),
    Entry(
        "mod8_permutation_importance", _permuted,
        f"SELECT unnest({list(FEATURES)!r}) AS feature, true AS is_share, true AS constant_is_zero",
    ),
    Entry(
        "mod9_train_pipeline", _trained,
        f"""WITH s AS (SELECT count(*)::BIGINT AS dataset_size, count(*) FILTER (is_test)::BIGINT AS test_samples FROM ({_ORD4}))
        SELECT file, CASE WHEN file = 'model' THEN test_samples ELSE n END::BIGINT AS n, true AS agrees, dataset_size, test_samples
        FROM s, (VALUES ('model', 0), ('test_results', 1), ('classification_report', 5), ('confidence_analysis', 1),
          ('feature_statistics', 15), ('feature_importance', 15), ('areas', 1), ('run_log', 1), ('roc_curve', 1), ('pr_curve', 1)) f(file, n)""",
    ),
    Entry(
        "dat_run_stamps", _stamps,
        f"SELECT count(*)::BIGINT AS dataset_size, true AS has_form, true AS is_recent FROM ({ts.CHAT}), range(2) GROUP BY range",
    ),
    Entry(
        "str1_stream_totals", _stream_totals,
        f"""WITH {_scored_sql(ts.DOCS)}, u AS (SELECT text, any_value(is_ai) AS is_ai, any_value(ai_probability) AS p FROM scored
          WHERE length({ts.strip('text')}) >= 10 GROUP BY text)
        SELECT count(*)::BIGINT AS n, count(*) FILTER (is_ai)::BIGINT AS n_ai, round(avg(p), 6) AS mean_ai FROM u""",
    ),
    Entry("snk5_save_load_model", _reloaded, _flags("is_equal")),
]
