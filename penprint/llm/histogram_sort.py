"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined until they meet, one exchange.

Documents are ordered by a seeded 60-bit key of their id. A round counts the exact bytes under every value of the
next key digit, for the key ranges that still hold a splitter, on a narrow table of keys and sizes. When each
splitter stands between two keys (or its range holds at most ``tolerance`` bytes), every document's shard follows
from its key by comparisons, and the rows move once, to their place in the sorted shard.

What reaches the driver is one row for each of 256 digit values and unresolved splitter. Sorting is by ranges of
about ``task_bytes``, never by whole shards, so a shard of any size is ordered by many tasks.

Defined results: a null id or text is a value as any other (a null text has no bytes); documents with one id have
one key and stay together; equal texts are spread by their ids, so a group of copies of any size is split over
shards; an empty table gives an empty result. Columns called ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.llm.exprs import quoted
from penprint.session import stored

#: Bytes that a document adds to its text's.
OVERHEAD = 8
KEY_BITS = 60
_DIGIT = 6


def sort_key(id_col: str, seed: int) -> Column:
    """The first 60 bits of an MD5 digest of seed and id."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(quoted(id_col)).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def text_bytes(text: str) -> Column:
    return F.octet_length(F.coalesce(F.col(quoted(text)), F.lit(""))).cast("bigint") + OVERHEAD


def find_splitters(sizes: DataFrame, n_shards: int, tolerance: int = 0) -> tuple[list[int], int]:
    """The least keys at which shards 1, 2, ... begin, and the bytes of all rows, of a table (key, size).

    Splitter j is the first place in key order with at least j/n of all bytes before it.
    """
    digit, shift = 2 * _DIGIT, KEY_BITS - 2 * _DIGIT
    rows = sizes.groupBy(F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    found = {r["bin"]: (r["bytes"], r["n"]) for r in rows.collect()}
    total = sum(b for b, _ in found.values())
    splitters: dict[int, int] = {}
    #: Per unresolved range (a key prefix): the bytes before it and the splitters that it holds.
    open_ranges: dict[int | None, tuple[int, list[int]]] = {None: (0, list(range(1, n_shards)))}
    while True:
        following: dict[int | None, tuple[int, list[int]]] = {}
        for parent, (before, targets) in open_ranges.items():
            low = 0 if parent is None else parent << digit
            for value in sorted(b for b in found if low <= b < low + (1 << digit)):
                size, n = found[value]
                here = [j for j in targets if before * n_shards < j * total <= (before + size) * n_shards]
                if here and (n == 1 or shift == 0 or size <= tolerance):
                    splitters |= dict.fromkeys(here, (value + 1) << shift)
                elif here:
                    following[value] = (before, here)
                before += size
        open_ranges = following
        if not open_ranges:
            return [splitters[j] for j in sorted(splitters)], total
        digit = min(_DIGIT + 2, shift)
        inside = F.shiftright("key", shift).isin(list(open_ranges))
        shift -= digit
        rows = (
            sizes.filter(inside).groupBy(F.shiftright("key", shift).alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        )
        found = {r["bin"]: (r["bytes"], r["n"]) for r in rows.collect()}


def shard_of(key: Column, splitters: list[int], first: int = 0) -> Column:
    """The number of splitters that are not above the key, by halving."""
    if not splitters:
        return F.lit(first)
    mid = len(splitters) // 2
    return F.when(key < splitters[mid], shard_of(key, splitters[:mid], first)).otherwise(
        shard_of(key, splitters[mid + 1 :], first + mid + 1)
    )


def shard_documents(
    docs: DataFrame, n_shards: int = 24, seed: int = 0, tolerance: int = 0, task_bytes: int = 32 << 20,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The documents with ``shard`` (0 to n - 1, near equal bytes) and ``slot`` (place in the shard, from 0)."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    keyed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in kept]).alias("row"),
        sort_key(id_col, seed).alias("key"),
        text_bytes(text).alias("size"),
    )
    sizes = stored(keyed.select("key", "size"), "shard-sizes")
    splitters, total = find_splitters(sizes, n_shards, tolerance)
    bits = max(0, math.ceil(math.log2(max(total, 1) / task_bytes)))
    place = [
        shard_of(F.col("key"), splitters).cast("int").alias("shard"),
        F.shiftright("key", KEY_BITS - bits).alias("part"),
    ]
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.select(*place).groupBy("shard", "part").agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("shard", "part").orderBy("key", F.crc32(F.col(f"row.{quoted(text)}")))
    ranked = keyed.select("row", "key", *place).withColumn("rank", F.row_number().over(inside) - 1)
    slotted = ranked.join(starts, ["shard", "part"])
    return slotted.select("row.*", "shard", (F.col("first") + F.col("rank")).cast("bigint").alias("slot"))
