"""Sums over all rows of a training table, as fits need them by the hundred.

A training table holds ``label`` (0 or 1), ``fold`` and ``x``, an array of doubles. It is packed once into blocks of
numpy arrays, written to the shared folder and kept by the executors; a lost block is read again from there. A pass
turns each block into an array of sums, adds those of a task and then those of tasks as a tree, so what reaches the
driver follows the number of sums and not that of rows or tasks. A pass is one short job on the blocks: as a query of
its own, planning it would take longer than running it.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from penprint.session import stored

#: Rows of a block: sums of 30-bit integers stay exact in doubles.
BLOCK = 1 << 16
#: Blocks of few rows are gathered in a quarter of the tasks that read them, but no fewer than this.
LEAST_TASKS = 2
#: From so many rows on, a task more.
ROWS_A_TASK = 20_000

Block = dict[str, np.ndarray]


def training_rows(df: DataFrame, columns: Sequence[str], fold: str | None = None, id_col: str | None = None) -> DataFrame:
    """``label``, ``fold`` and ``x`` of a feature table; with ``id_col`` also ``key``, a hash of the whole row."""
    number = F.lit(-1) if fold is None else F.col(fold)
    values = F.array(*[F.col(c).cast("double") for c in columns])
    key = [] if id_col is None else [F.xxhash64(id_col, "label", *columns).alias("key")]
    return df.select(F.col("label").cast("int").alias("label"), number.cast("int").alias("fold"), values.alias("x"), *key)


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column whose arrays all have ``width`` values."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


class Blocks:
    """The packed rows of a table: ``pack`` makes a block's arrays from a batch of rows."""

    def __init__(self, rows: DataFrame, pack: Callable[[pa.RecordBatch], Block]):
        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    yield pa.record_batch({"block": pa.array([pickle.dumps(pack(part))], pa.binary()), "n": pa.array([part.num_rows])})

        self._nothing = pack(pa.RecordBatch.from_pylist([], to_arrow_schema(rows.schema)))
        self._keep(rows.mapInArrow(packed, "block binary, n long"))

    def _keep(self, table: DataFrame) -> None:
        blocks = stored(table, "blocks")
        n = blocks.agg(F.sum("n")).first()[0] or 0
        rdd = blocks.select("block").rdd.map(lambda r: pickle.loads(r[0]))
        tasks = max(LEAST_TASKS, rdd.getNumPartitions() // 4, n // ROWS_A_TASK)
        self.rdd: RDD[Block] = rdd.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)

    def sum(self, work: Callable[[Block], np.ndarray]) -> np.ndarray:
        """The sum of ``work`` over all blocks."""

        def of_task(found: Iterator[Block]) -> Iterator[np.ndarray]:
            total = None
            for block in found:
                own = work(block)
                total = own if total is None else total + own
            if total is not None:
                yield total

        zero = work(self._nothing)
        return self.rdd.mapPartitions(of_task).treeAggregate(zero, np.add, np.add)

    def changed(self, spark: SparkSession, change: Callable[[Block], Block]) -> Blocks:
        """The blocks with other arrays, written anew; these ones are let go."""
        new = object.__new__(Blocks)
        new._nothing = change(self._nothing)
        new._keep(spark.createDataFrame(self.rdd.map(lambda b: (pickle.dumps(change(b)), len(b["label"]))), "block binary, n long"))
        self.close()
        return new

    def close(self) -> None:
        self.rdd.unpersist()
