"""Session helpers: the shared folder, lineage cuts, and spreading small inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` where the cluster names one.

    A session on one machine (a ``local`` master, as in tests) may leave it unset and gets a temporary
    folder; a cluster without the setting raises, since a local path is a different disk on each machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(_SETTING, None)
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="penprint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one; ``clear_scratch`` removes it."""
    return f"{shared_folder(spark)}/penprint-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in this application's folder that nothing else uses."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application wrote, through the file system that Spark uses for it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application wrote to its folder; tables read from there end with it."""
    remove_path(spark, run_folder(spark))


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lost executors never recompute it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder, so that lost executors never cause it to be recomputed."""
    return stored(df, "cut")


def spread(df: DataFrame, key: str, at_least: int = 32) -> DataFrame:
    """Repartition by ``key`` an input that is read in fewer than ``at_least`` tasks.

    A small file is read as one task, which would leave all token work to one core. The number does not
    follow the cluster, and an input with enough partitions is left alone: no shuffle is added at scale.
    """
    return df.repartition(at_least, key) if df.rdd.getNumPartitions() < at_least else df


def run_together(spark: SparkSession, jobs: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run driver functions in threads, so that their Spark jobs share the cluster; the first error is raised.

    Each function's jobs go to a scheduler pool of its name: with ``spark.scheduler.mode=FAIR`` they get even shares,
    with the default they fill what the others leave.
    """

    def in_pool(name: str, job: Callable[[], Any]) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return job()

    with ThreadPoolExecutor(max(len(jobs), 1)) as threads:
        futures = {name: threads.submit(inheritable_thread_target(spark)(in_pool), name, job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}
