"""A persisted index of what a corpus holds, so that a batch is added without reading the corpus again.

The index is a table of one digest for each distinct (text, label), bucketed and sorted by it. To add a batch, only the
batch's digests move: they are dealt to the index's buckets, and the index is read where it lies. The rows that are new
come back; their digests are appended to the index, one file for each bucket, after the rows were written.

The table belongs to the session's catalog and its files to ``path``; ``DigestIndex.open`` declares the table again in a
later session. The digest is MD5 and a 64-bit hash of label and text together. A missing label is a value; rows without
a text are never known, as they are never repeats. An interrupted ``add`` either has its digests in the index or not; adding the same batch once more is then without effect,
or whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.operators.merge import dedupe_text_label
from penprint.session import stored

BUCKETS = 64
#: Digests of known rows that may be broadcast (48 bytes each).
BROADCAST_KNOWN = 500_000


def text_digest() -> Column:
    """One key for (label, text); null for a missing text, which is like no other."""
    whole = F.concat(F.coalesce(F.col("label").cast("string"), F.lit("none")), F.lit(":"), F.col("text"))
    return F.concat(F.md5(whole), F.lower(F.hex(F.xxhash64(whole))))


@dataclass(frozen=True)
class DigestIndex:
    spark: SparkSession
    name: str
    path: str
    buckets: int

    @staticmethod
    def create(corpus: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> DigestIndex:
        """An index of a corpus ``text, label``, which may hold repeats."""
        index = DigestIndex(corpus.sparkSession, name, path, buckets)
        index._append(corpus.select(text_digest().alias("digest")).distinct())
        return index

    @staticmethod
    def open(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> DigestIndex:
        """The index that another session left at ``path``."""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{name}` (digest STRING) USING parquet OPTIONS (path '{path}') "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
        )
        return DigestIndex(spark, name, path, buckets)

    def _append(self, digests: DataFrame) -> None:
        placed = digests.where("digest is not null").repartition(self.buckets, "digest")
        writer = placed.write.mode("append").format("parquet").option("path", self.path)
        writer.bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def known(self, digests: DataFrame) -> DataFrame:
        """Those of some distinct digests that the index holds. The index is not shuffled."""
        return digests.join(self.table().hint("merge"), "digest", "left_semi")

    def new_rows(self, batch: DataFrame, id_col: str = "doc_id") -> DataFrame:
        """The batch's rows whose text and label the index doesn't hold, one of each; texts stay where they are but
        for those that the batch itself repeats."""
        digests = batch.select(text_digest().alias("digest")).distinct()
        known = stored(self.known(digests), "known")
        side = F.broadcast(known) if known.count() <= BROADCAST_KNOWN else known.hint("merge")
        fresh = batch.withColumn("_digest", text_digest()).join(side.withColumnRenamed("digest", "_digest"), "_digest", "left_anti")
        return dedupe_text_label(fresh.drop("_digest"), id_col)

    def add(self, batch: DataFrame, id_col: str = "doc_id") -> DataFrame:
        """``new_rows``, written to the shared folder; then their digests join the index."""
        fresh = stored(self.new_rows(batch, id_col), "fresh")
        self._append(fresh.select(text_digest().alias("digest")))
        return fresh
