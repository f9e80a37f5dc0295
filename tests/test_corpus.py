import hashlib
import io
import math
import re
from collections import Counter
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from penprint.operators import classes, merge, prepare, sampling
from penprint.plans import prepare as jobs
from penprint.session import stored


def ordered(corpus, label, seed=42):
    ids = [r["doc_id"] for r in corpus.where(F.col("label") == label).select("doc_id").collect()]
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


def kept(df):
    out = {0: set(), 1: set()}
    for r in df.select("doc_id", "label").collect():
        out[r["label"]].add(r["doc_id"])
    return out


def test_balanced_subsample(corpus):
    got = kept(sampling.balanced_subsample(corpus, 500))
    assert got == {0: set(ordered(corpus, 0)[:250]), 1: set(ordered(corpus, 1))}
    assert sampling.balanced_subsample(corpus, 1000).count() == 1000


def test_balance_and_head(corpus):
    assert kept(sampling.balance_to_minority(corpus)) == {
        0: set(ordered(corpus, 0)[:200]), 1: set(ordered(corpus, 1)),
    }
    assert kept(sampling.head_per_class(corpus, 7)) == {k: set(ordered(corpus, k)[:7]) for k in (0, 1)}
    assert sampling.balance_to_minority(corpus.where("label = 0")).count() == 0


def test_threshold_bucket_with_company(spark, monkeypatch):
    """Few buckets, so that the threshold falls inside a bucket of many rows."""
    monkeypatch.setattr(sampling, "_DIGITS", 1)
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    got = kept(sampling.head_per_class(df, 333))
    assert got == {k: set(ordered(df, k)[:333]) for k in (0, 1)}
    ranks = {r["doc_id"]: r["rank"] for r in sampling.rank_in_class(df).collect()}
    for k in (0, 1):
        assert [ranks[i] for i in ordered(df, k)] == list(range(1, len(ordered(df, k)) + 1))


@pytest.mark.parametrize("n0, n1", [(800, 200), (7, 3), (11, 6), (1, 1), (9, 0), (501, 333)])
def test_stratified_split(spark, n0, n1):
    df = spark.range(n0 + n1).select(F.col("id").alias("doc_id"), (F.col("id") >= n0).cast("int").alias("label"))
    split = sampling.stratified_split(df).collect()
    assert len(split) == n0 + n1
    test = Counter(r["label"] for r in split if r["is_test"])
    total = math.ceil((n0 + n1) * 0.2)
    assert sum(test.values()) == total
    for k, n in ((0, n0), (1, n1)):
        assert abs(test[k] - total * n / (n0 + n1)) < 1
        got = {r["doc_id"] for r in split if r["label"] == k and r["is_test"]}
        assert got == set(ordered(df, k)[:test[k]])


def test_order_keys_do_not_depend_on_partitions(corpus):
    a = {tuple(r) for r in sampling.stratified_split(corpus.coalesce(1)).select("doc_id", "is_test").collect()}
    b = {tuple(r) for r in sampling.stratified_split(corpus.repartition(13)).select("doc_id", "is_test").collect()}
    assert a == b
    shuffled = [r["doc_id"] for r in sampling.seeded_shuffle(corpus, sort=True).collect()]
    assert shuffled == sorted(shuffled, key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())


def test_random_split_and_folds(corpus):
    share = sampling.random_split(corpus).where("is_holdout").count() / 1000
    assert 0.15 < share < 0.25
    folds = sampling.kfold(corpus, 5).groupBy("label", "fold").count().collect()
    for k in (0, 1):
        sizes = [r["count"] for r in folds if r["label"] == k]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_sample_row_per_class(corpus):
    assert kept(sampling.sample_row_per_class(corpus)) == {0: {1}, 1: {0}}


def test_texts_are_not_shuffled_by_sampling(corpus):
    plan = sampling.head_per_class(corpus, 5)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text" in line for line in exchanges)
    assert "CartesianProduct" not in plan


def test_dedupe_golden(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "a", 1), (4, "b", 1)], "doc_id long, text string, label int")
    assert {tuple(r) for r in merge.dedupe_text_label(df).select("doc_id", "text", "label").collect()} == {
        (1, "a", 0), (3, "a", 1), (4, "b", 1),
    }
    assert tuple(merge.dedupe_report(df).first()) == (4, 3, 1)


def test_dedupe_skewed_and_idempotent(corpus):
    once = merge.dedupe_text_label(corpus)
    want = {}
    for r in sorted(corpus.collect(), key=lambda r: r["doc_id"]):
        want.setdefault((r["text"], r["label"]), r["doc_id"])
    assert {r["doc_id"] for r in once.collect()} == set(want.values())
    assert merge.dedupe_text_label(once).count() == once.count()


def test_merge_prefers_the_real_row(spark):
    real = spark.createDataFrame([(5, " x ", 0), (6, None, 0)], "doc_id long, text string, label int")
    made = spark.createDataFrame([(5, "x", 0, "s"), (7, "y", 1, "s")], "doc_id long, text string, label int, source string")
    merged = jobs.merge_large_into_real(real, made)
    rows = {(r["source_rank"], r["doc_id"]): r["source"] for r in merged.collect()}
    assert rows == {(0, 5): None, (1, 7): "s"}
    assert "shuffle_key" in merged.columns
    assert jobs.merge_large_into_real(None, made).count() == 2
    assert jobs.merge_large_into_real(real, made, drop_duplicates=False, shuffle=False).count() == 3


def test_dedupe_loses_no_source_and_needs_no_ids(spark):
    rows = [(r, i, t, 0) for r, i, t in [
        (0, 1, "a"), (1, 1, "a"), (2, 5, "a"), (2, 6, "only third"), (2, 7, "only third"), (1, 3, "same id"), (1, 3, "same id"),
        (3, 3, None), (3, None, None), (0, None, "no id"), (0, None, "no id"),
    ]]
    df = spark.createDataFrame(rows, "source_rank int, doc_id long, text string, label int")
    left = merge.dedupe_text_label(df)
    assert left.columns == df.columns
    texts = [(r.source_rank, r.text) for r in left.collect() if r.text]
    assert sorted(texts) == [(0, "a"), (0, "no id"), (1, "same id"), (2, "only third")]
    report = merge.dedupe_report(df.where("text is not null")).first()
    assert report["dropped"] == df.where("text is not null").count() - len(texts)


def test_holdout_limits(corpus):
    assert sampling.random_split(corpus, 1.0).where("is_holdout").count() == corpus.count()
    assert sampling.random_split(corpus, 0.0).where("is_holdout").isEmpty()
    with pytest.raises(ValueError):
        sampling.random_split(corpus, 1.1)


def test_layouts(spark):
    long = "  " + "words " * 10
    a = spark.createDataFrame([(long, 1.0), ("short", 0.0), (None, 1.0)], "text string, generated double")
    assert [tuple(r) for r in prepare.unify_layout_a(a).collect()] == [(long.strip(), 1)]
    b = spark.createDataFrame([(long, 0), (long, None)], "Data string, Label int")
    assert [tuple(r) for r in prepare.unify_layout_b(b).collect()] == [(long.strip(), 0)]
    with pytest.raises(ValueError, match="generated"):
        prepare.unify_layout_a(b)
    assert jobs.prepare_real(a.withColumn("doc_id", F.lit(1)), "a", 10).count() == 1


def test_lengths(spark):
    rows = [(1, "w " * 99), (2, "w " * 100), (3, " ".join(["w"] * 200)), (4, "w\n" * 201)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in prepare.normalize_length(df).collect()}
    assert got == {2: "w " * 100, 3: rows[2][1], 4: " ".join(["w"] * 200)}
    limits = spark.createDataFrame([("x" * 30,), ("x" * 31,), (" " * 40,), (" x\t\ny" * 10,)], "text string")
    assert prepare.min_chars(limits).count() == 2
    assert [r[0] for r in prepare.clean_texts(limits).collect()] == ["x" * 31, "x y" + " x y" * 9]


def test_provenance(spark):
    df = spark.createDataFrame([("a", "web"), ("b", None)], "text string, source string")
    rows = [tuple(r) for r in prepare.tag_provenance(df, 0).select("label", "source", "category", "topic").collect()]
    assert rows == [(0, "web", "unknown", "unknown"), (0, "synthetic_human", "unknown", "unknown")]


def test_classes(spark, corpus):
    ratios = {r["label"]: (r["n"], r["ratio"]) for r in classes.class_ratios(corpus).collect()}
    assert ratios == {0: (800, 0.8), 1: (200, 0.2)}
    few = {r["label"]: (r["n"], r["too_few"]) for r in classes.class_sufficiency(corpus.where("label = 0"), 100).collect()}
    assert few == {0: (800, False), 1: (0, True)}
    odd = spark.createDataFrame([(0,), (2,), (None,)], "label int")
    assert tuple(classes.stray_labels(odd).first()) == (2, 3)
    assert prepare.by_class(odd).count() == 1


def test_standard_loading(spark):
    df = spark.createDataFrame([(1, " a ", 1.0), (2, None, 0.0), (3, "b", 5.0)], "doc_id long, text string, label double")
    assert [tuple(r) for r in jobs.load_standard(df).collect()] == [(1, "a", 1)]
    with pytest.raises(ValueError):
        jobs.load_standard(df.drop("label"))


def test_load_large_balances(corpus):
    long = corpus.withColumn("text", F.concat("text", F.lit(" with some more words in it")))
    assert Counter(r["label"] for r in jobs.load_large(long).collect()) == {0: 200, 1: 200}


def test_ranks_move_no_text(corpus):
    corpus = stored(corpus)
    shown = io.StringIO()
    with redirect_stdout(shown):
        sampling.kfold(corpus).explain("formatted")
    moved = [part for part in shown.getvalue().split("\n\n") if re.match(r"\(\d+\) (Exchange|Sort|Window)", part.strip())]
    assert not any("text#" in part for part in moved)
    ranks = {r["doc_id"]: r["rank"] for r in sampling.class_ranks(corpus).collect()}
    assert ranks == {r["doc_id"]: r["rank"] for r in sampling.rank_in_class(corpus).collect()}
    for k in (0, 1):
        own = sorted(ranks[r["doc_id"]] for r in corpus.where(f"label = {k}").collect())
        assert own == list(range(1, len(own) + 1))


def test_csv_job_reads_labelled_documents_and_kept_rows_from_files(spark, tmp_path):
    """Neither the join with the labels nor the deduplication is planned again by what follows them."""
    from catalog import corpus_queries

    docs = [(i, f" text number {i % 30} ", "en", "s") for i in range(60)] + [(60, None, "en", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(61)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    turns = [(i, t, "user" if t else "assistant", f"turn {i % 5} {t}") for i in range(20) for t in (0, 1)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = corpus_queries._csv_merged(spark, str(tmp_path))
    assert not any(f"/{name}.parquet" in f for f in got.inputFiles() for name in ("documents", "labels", "conversations"))
    assert any("/kept-" in f for f in got.inputFiles())
    rows = got.collect()
    labelled = {(f"text number {i % 30}", i % 2) for i in range(60)}
    want = labelled | {(f"turn {i % 5} {t}", t) for i in range(20) for t in (0, 1)} | {(f"text number {i}", 1) for i in range(30)}
    assert len(rows) == len(want)
    assert {r["dropped"] for r in rows} == {60 * 2 + 40 + 60 + 60 - len(want)}
