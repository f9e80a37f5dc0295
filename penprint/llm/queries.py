"""One registered query for each operator of this subpackage, with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.entry import Entry
from penprint.llm import (
    exact_dedup,
    histogram_sort,
    quality_rules,
    ranked_search,
    source_mixing,
    suffix_levels,
    token_files,
    toxicity,
    warc,
    weak_labels,
    weighted_minhash,
    whitening,
    winnowing,
)
from penprint.llm.sql import OP4_SQL, OP6_SQL, OP7_SQL, OP8_SQL, OP9_SQL, OP12_SQL, OP13_SQL


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op5_weighted_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    classes = weighted_minhash.near_classes(_table(spark, folder, "documents"))
    return classes.select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules.judge(_table(spark, folder, "documents"))
    base_failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"),
    )


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learned from the labels outside the held-out fold."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op2_suffix_levels(spark: SparkSession, folder: str) -> DataFrame:
    """What of every document does not repeat an earlier one."""
    left = suffix_levels.remove_repeats(_table(spark, folder, "documents"), texts=False)
    return left.select(
        "doc_id", "n_bytes",
        F.expr("aggregate(removed, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), "kept_sha256",
    )


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Place, length and checksum of every document's ids, from the files."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.read_documents(token_files.write_token_files(_table(spark, folder, "documents"), path))


def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The words that the mix takes of every document."""
    plan, _, _ = source_mixing.plan_mix(_table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op7_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = winnowing.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """What the archives say of every page."""
    manifest = warc.write_archives(_table(spark, folder, "pages"))
    return warc.read_archives(manifest, payloads=False).drop("payload")


def op9_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard and place, under the law of near equal bytes."""
    placed = histogram_sort.shard_documents(_table(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        histogram_sort.text_bytes("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document by weak labels."""
    return weak_labels.score_quality(_table(spark, folder, "documents"))


def op11_lanczos_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector in the directions of greatest variance, scaled to a variance of one."""
    vectors = _table(spark, folder, "embeddings")
    model = whitening.fit_whitening(vectors)
    explained = F.array(*[F.lit(float(v)) for v in model.variances / (model.total or 1.0)], F.lit(0.0))
    return whitening.whiten(vectors, model).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("component")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 highest-scoring documents of every benchmark item."""
    return ranked_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's group of copies, and the one that stays."""
    found = exact_dedup.find_copies(_table(spark, folder, "documents"), digests=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ENTRIES = [
    Entry("op1_toxicity", op1_toxicity),
    Entry("op2_suffix_levels", op2_suffix_levels),
    Entry("op3_token_files", op3_token_files),
    Entry("op4_source_mixing", op4_source_mixing, OP4_SQL),
    Entry("op5_weighted_minhash", op5_weighted_minhash),
    Entry("op6_quality_rules", op6_quality_rules, OP6_SQL),
    Entry("op7_winnowing", op7_winnowing, OP7_SQL),
    Entry("op8_warc", op8_warc, OP8_SQL),
    Entry("op9_histogram_sort", op9_histogram_sort, OP9_SQL),
    Entry("op10_weak_labels", op10_weak_labels),
    Entry("op11_lanczos_whitening", op11_lanczos_whitening),
    Entry("op12_ranked_search", op12_ranked_search, OP12_SQL),
    Entry("op13_exact_dedup", op13_exact_dedup, OP13_SQL),
]
