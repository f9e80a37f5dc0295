"""Combining corpora: union, deduplication, stacking of classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators.prepare import cast_trim, drop_null, require_columns


def merge_corpora(real: DataFrame | None, generated: DataFrame, *more: DataFrame) -> DataFrame:
    """Clean and concatenate labelled corpora; ``real`` may be absent.

    ``source_rank`` tells them apart (0 real, 1 generated, then the others), so that
    ``(source_rank, doc_id)`` is a key even if all number their rows from the same start.
    """
    parts = []
    for rank, part in enumerate((real, generated, *more)):
        if part is not None:
            require_columns(part, "text", "label")
            cleaned = cast_trim(drop_null(part, "text", "label"))
            parts.append(cleaned.withColumn("source_rank", F.lit(rank)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _groups(df: DataFrame, id_col: str) -> DataFrame:
    """One row per distinct (text, label): its copies and the row that stays, ``_head``, the least (source_rank, id).

    Grouped by two digests of the text, so texts are not shuffled; counts and minima combine on the map side,
    so a text with any number of copies costs each task one row.
    """
    return df.groupBy(
        F.md5("text").alias("_digest"), F.xxhash64("text").alias("_hash"), F.col("label").alias("_label")
    ).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.min(F.struct(F.col("source_rank").alias("_rank"), F.col(id_col).alias("_id"))).alias("_head"),
    )


def _ranked(df: DataFrame) -> DataFrame:
    return df if "source_rank" in df.columns else df.withColumn("source_rank", F.lit(0))


def dedupe_text_label(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Drop repeats of (text, label): the row of the earliest source, then of the lowest id, stays.

    Only texts with repeats are looked up, by digest; they are few, so that adaptive execution may broadcast
    them. Of rows with one source, id, text and label one stays.
    """
    ranked = _ranked(df)
    repeated = _groups(ranked, id_col).where(F.col("_copies") > 1)
    same = (
        (F.md5("text") == F.col("_digest")) & (F.xxhash64("text") == F.col("_hash"))
        & F.col("label").eqNullSafe(F.col("_label"))
    )
    marked = ranked.join(repeated, same, "left")
    head = F.col("_head")
    stays = F.col("source_rank").eqNullSafe(head["_rank"]) & F.col(id_col).eqNullSafe(head["_id"])
    once = marked.where(F.col("_digest").isNull()).select(*df.columns)
    # Ids need not be distinct: of the few heads of repeated texts, one each stays.
    heads = marked.where(stays).dropDuplicates(["_digest", "_hash", "_label"]).select(*df.columns)
    return once.unionByName(heads)


def dedupe_report(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows before, after and dropped, from the groups alone."""
    groups = _groups(_ranked(df), id_col)
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("dropped", F.col("rows_before") - F.col("rows_after"))


def stack_classes(human: DataFrame, ai: DataFrame) -> DataFrame:
    """One corpus from the texts of either class."""
    return human.withColumn("label", F.lit(0)).unionByName(
        ai.withColumn("label", F.lit(1)), allowMissingColumns=True
    )
