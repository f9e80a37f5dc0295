"""Writers. A corpus goes to a new path: a job cannot overwrite what it still reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.operators.models import Ensemble, load_ensemble, save_ensemble


def write_corpus(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet, in zstandard, or CSV with a header and doubled quotes."""
    writer = df.write.mode(mode)
    if format == "csv":
        writer.options(header=True, escape='"', quoteAll=True).csv(path)
    else:
        writer.options(**({"compression": "zstd"} if format == "parquet" else {})).format(format).save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """JSON, one object per row."""
    df.write.mode("overwrite").json(path)


def append_run_log(df: DataFrame, path: str, run_id: str, **facts) -> None:
    """Log a run's metrics with its id, the time and the given facts (sizes, seed).

    Each run has a partition of its own, which a repeated run overwrites: the log has one entry for each id.
    """
    tagged = df.withColumns({
        "run_id": F.lit(run_id),
        "logged_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"),
        **{name: F.lit(value) for name, value in facts.items()},
        "run_key": F.concat(F.lit("run-"), F.md5(F.lit(run_id))),
    })
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_key").json(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """One row for each logged run and row of its metrics."""
    return spark.read.json(path).drop("run_key")


def run_metadata(spark: SparkSession, **facts) -> DataFrame:
    """One row of facts about a run, stamped with the date."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("training_date")
    return spark.range(1).select(stamp, *[F.lit(v).alias(k) for k, v in facts.items()])


def save_model(ensemble: Ensemble, path: str, metadata: DataFrame) -> None:
    """The three models and, beside them, the metadata row."""
    save_ensemble(ensemble, path)
    write_metrics(metadata, f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[Ensemble, DataFrame]:
    return load_ensemble(path), spark.read.json(f"{path}/metadata")
