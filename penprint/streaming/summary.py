"""Distinct texts and running totals of a scored stream.

Copies of a text that arrive within the watermark's delay are dropped by state that holds a digest for each text, until
the watermark has passed it. Totals by window are partial sums of a micro-batch: each batch writes its own under its
number, and a batch that is run again after a failure overwrites what it wrote, so that nothing counts twice. The sums
of all batches are the totals of the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def distinct_texts(stream: DataFrame, event_time: str, delay: str, text: str = "text") -> DataFrame:
    """The first of equal texts that arrive within ``delay`` of each other, by event time."""
    marked = stream.withColumn("_digest", F.md5(F.col(text))).withWatermark(event_time, delay)
    return marked.dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def window_totals(scored: DataFrame, event_time: str, width: str) -> DataFrame:
    """Per window: texts, texts called AI, and the sum of the AI probability as an exact decimal."""
    return scored.groupBy(F.window(event_time, width).alias("window")).agg(
        F.count("*").alias("n"), F.count_if("is_ai").alias("n_ai"),
        F.sum(F.col("ai_probability").cast("decimal(20,12)")).alias("ai_sum"),
    )


def start_totals(scored: DataFrame, event_time: str, width: str, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write the window totals of every micro-batch below ``out``; ``once`` works off what is there and stops."""

    def write(batch: DataFrame, number: int) -> None:
        partial = window_totals(batch, event_time, width).withColumn("batch", F.lit(f"b{number}"))
        partial.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    writer = scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_totals(spark: SparkSession, out: str) -> DataFrame:
    """``start, n, n_ai, mean_ai`` of every window so far."""
    sums = spark.read.parquet(out).groupBy("window.start").agg(
        F.sum("n").alias("n"), F.sum("n_ai").alias("n_ai"), F.sum("ai_sum").alias("_sum")
    )
    return sums.select("start", "n", "n_ai", (F.col("_sum").cast("double") / F.col("n")).alias("mean_ai"))
