"""Exact sampling and splitting per class, without sorting a class in one task.

Rows are ordered by a hash key. The k rows of a class with the lowest keys are found by their
threshold: a histogram over the key's leading digits names the bucket that holds the k-th row, and
only that bucket (1 in 65,536 rows) is ranked. The corpus is then filtered by the threshold, so texts
are never shuffled; only keys and labels are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.functions.keys import order_key
from penprint.operators.prepare import CLASSES
from penprint.session import stored

#: Rows whose ids and ranks may be broadcast (about 40 bytes each).
BROADCAST_RANKS = 1_000_000

_DIGITS = 4
_BUCKETS = 16**_DIGITS

# From the columns ``size`` (of the class), ``total`` and ``smallest`` to the number of rows to take.
Quota = Callable[[], Column]


def seeded_shuffle(
    df: DataFrame, seed: int = 42, id_col: str = "doc_id", sort: bool = False
) -> DataFrame:
    """Add the order key ``shuffle_key``; sort by it only when a physical order is wanted."""
    keyed = df.withColumn("shuffle_key", order_key(seed, id_col))
    return keyed.orderBy("shuffle_key") if sort else keyed


def _histogram(keyed: DataFrame) -> DataFrame:
    bucket = F.substring("_key", 1, _DIGITS).alias("_bucket")
    return keyed.groupBy("label", bucket).agg(F.count(F.lit(1)).alias("_n"))


def _sizes(histogram: DataFrame) -> DataFrame:
    """Class sizes with the total and the smallest class, for the two classes."""
    sizes = histogram.groupBy("label").agg(F.sum("_n").alias("size"))
    everything = Window.partitionBy(F.lit(0))
    return sizes.withColumns({
        "total": F.sum("size").over(everything),
        # A class without rows has size 0 and no row here.
        "smallest": F.when(
            F.count(F.lit(1)).over(everything) == len(CLASSES), F.min("size").over(everything)
        ).otherwise(0),
    })


def _thresholds(df: DataFrame, key: Column, quotas: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``label, _cut``: the key of the last row to take per class. At most one row per class."""
    keyed = df.where(F.col("label").isin(*CLASSES)).select("label", key.alias("_key"))
    histogram = _histogram(keyed)
    wanted = quotas(_sizes(histogram)).select("label", F.least("take", "size").alias("_take"))
    by_bucket = Window.partitionBy("label").orderBy("_bucket")  # at most 65,536 rows a class
    running = histogram.withColumn("_upto", F.sum("_n").over(by_bucket))
    cut_bucket = (
        running.join(F.broadcast(wanted), "label")
        .where((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_n") < F.col("_take")))
        .select("label", "_bucket", (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    ranked = (
        keyed.withColumn("_bucket", F.substring("_key", 1, _DIGITS))
        .join(F.broadcast(cut_bucket), ["label", "_bucket"])
        .withColumn("_rank", F.row_number().over(Window.partitionBy("label").orderBy("_key")))
    )
    return ranked.where(F.col("_rank") == F.col("_need")).select("label", F.col("_key").alias("_cut"))


def _take(df: DataFrame, quotas: Callable[[DataFrame], DataFrame], seed: int, id_col: str) -> DataFrame:
    key = order_key(seed, id_col)
    cuts = F.broadcast(_thresholds(df, key, quotas))  # one row per class
    return df.join(cuts, "label").where(key <= F.col("_cut")).select(*df.columns)


def take_per_class(df: DataFrame, quota: Quota, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Keep the ``quota`` rows of each class with the lowest keys. ``id_col`` must be unique."""
    return _take(df, lambda sizes: sizes.withColumn("take", quota()), seed, id_col)


def balanced_subsample(
    df: DataFrame, max_samples: int, seed: int = 42, id_col: str = "doc_id"
) -> DataFrame:
    """When there are more than ``max_samples`` rows, at most half of that from either class."""
    def quota() -> Column:
        return F.when(F.col("total") > max_samples, F.lit(max_samples // 2)).otherwise(F.col("size"))

    return take_per_class(df, quota, seed, id_col)


def balance_to_minority(df: DataFrame, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Cut each class to the size of the smaller one."""
    return take_per_class(df, lambda: F.col("smallest"), seed, id_col)


def head_per_class(
    df: DataFrame, k: int, seed: int = 42, id_col: str = "doc_id"
) -> DataFrame:
    """The first ``k`` rows of each class, or as many as the smaller class has."""
    return take_per_class(df, lambda: F.least(F.lit(k), F.col("smallest")), seed, id_col)


def _test_quotas(sizes: DataFrame, test_size: float) -> DataFrame:
    """Test rows per class: class shares kept, the total exact.

    The training rows are shared out by largest remainder and the test set is what is left, so both
    totals are those of an unstratified split.
    """
    everything = Window.partitionBy(F.lit(0))
    n_train = F.col("total") - F.ceil(F.col("total") * F.lit(test_size))
    shared = sizes.withColumn("_train_total", n_train).withColumns({
        "_floor": F.floor(F.col("size") * F.col("_train_total") / F.col("total")),
        "_rest": (F.col("size") * F.col("_train_total")) % F.col("total"),
    })
    placed = shared.withColumns({
        "_open": F.col("_train_total") - F.sum("_floor").over(everything),
        "_turn": F.row_number().over(everything.orderBy(F.desc("_rest"), "label")),
    })
    train = F.col("_floor") + (F.col("_turn") <= F.col("_open")).cast("long")
    return placed.withColumn("take", F.col("size") - train)


def stratified_split(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, id_col: str = "doc_id"
) -> DataFrame:
    """Add ``is_test``, with the share of each class kept in both parts."""
    labelled = df.where(F.col("label").isin(*CLASSES))
    key = order_key(seed, id_col)
    cuts = F.broadcast(_thresholds(labelled, key, lambda s: _test_quotas(s, test_size)))
    return labelled.join(cuts, "label", "left").select(
        *df.columns, F.coalesce(key <= F.col("_cut"), F.lit(False)).alias("is_test")
    )


def random_split(
    df: DataFrame, holdout: float = 0.2, seed: int = 42, id_col: str = "doc_id"
) -> DataFrame:
    """Add ``is_holdout`` by hash bucket, whatever the class. Narrow."""
    if not 0 <= holdout <= 1:
        raise ValueError(f"holdout {holdout} is not a share")
    bucket = F.conv(F.substring(order_key(seed, id_col), 1, _DIGITS), 16, 10).cast("int")
    return df.withColumn("is_holdout", bucket < F.lit(int(holdout * _BUCKETS)))


def _ranks(keyed: DataFrame, id_col: str) -> DataFrame:
    """``label, id, rank`` of a table of labels, ids and keys: the position of each row in its class by key.

    Rows are ranked inside key buckets; the rows in lower buckets are added as an offset. The offsets
    are at most 65,536 rows a class, hence safe to broadcast.
    """
    before = Window.partitionBy("label").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = _histogram(keyed).select(
        "label", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("label", "_bucket").orderBy("_key")
    return (
        keyed.withColumn("_bucket", F.substring("_key", 1, _DIGITS))
        .withColumn("_inside", F.row_number().over(inside))
        .join(F.broadcast(offsets), ["label", "_bucket"])
        .select("label", id_col, (F.col("_offset") + F.col("_inside")).alias("rank"))
    )


def class_ranks(df: DataFrame, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """``label, id_col, rank``: the position of each row in its class by order key. Only ids and labels move."""
    labelled = df.where(F.col("label").isin(*CLASSES))
    return _ranks(labelled.select("label", id_col, order_key(seed, id_col).alias("_key")), id_col)


def row_ranks(df: DataFrame, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """``id_col, rank``: the position of each row among all by order key."""
    return _ranks(df.select(F.lit(0).alias("label"), id_col, order_key(seed, id_col).alias("_key")), id_col).drop("label")


def rank_in_class(df: DataFrame, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Add ``rank``, the position of each row in its class by order key. ``id_col`` must be unique.

    Ranks are found from ids alone. They are looked up by a join that broadcasts them while they are few, so that texts
    stay where they are; beyond that rows and ranks meet by id. ``class_ranks`` gives the ranks without the rows.
    """
    ranks = class_ranks(df, seed, id_col).drop("label")
    n = df.where(F.col("label").isin(*CLASSES)).count()
    side = F.broadcast(stored(ranks, "ranks")) if n <= BROADCAST_RANKS else ranks
    return df.where(F.col("label").isin(*CLASSES)).join(side, id_col).select(*df.columns, "rank")


def kfold(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Add ``fold`` from 0 to k-1, each with the same share of either class."""
    ranked = rank_in_class(df, seed, id_col)
    return ranked.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank")


def sample_row_per_class(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The row of each class with the lowest id: ids are reduced first, then the rows looked up."""
    first = df.where(F.col("label").isin(*CLASSES)).groupBy("label").agg(F.min(id_col).alias(id_col))
    return df.join(F.broadcast(first), ["label", id_col], "left_semi")
