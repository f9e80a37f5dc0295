"""Score a stream of texts with the same plan as a batch. Stateless: no watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from penprint.operators.models import Ensemble
from penprint.plans.score import PREDICTION, score_texts


def score_stream(
    stream: DataFrame,
    ensemble: Ensemble | None = None,
    at_least: int = 10,
    partitions: int | None = None,
) -> DataFrame:
    """Predictions for a stream with ``doc_id, text``.

    ``partitions`` spreads every micro-batch over so many tasks, for streams of few small files that
    would not keep the cores busy. Leave it out where batches bring files enough.
    """
    texts = stream.select("doc_id", "text")
    if partitions is not None:
        texts = texts.repartition(partitions, "doc_id")
    return score_texts(texts, ensemble, at_least).select("doc_id", *PREDICTION)


def read_text_stream(
    spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files of ``doc_id, text`` as they arrive in a folder, or in the folders and files that a path pattern matches."""
    return (
        spark.readStream.schema("doc_id bigint, text string")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def start_scoring(scored: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append predictions to Parquet files, exactly once by the checkpoint.

    ``once`` works off what is there, in batches, and stops.
    """
    writer = scored.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer).start(out)
