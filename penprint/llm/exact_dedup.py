"""Exact duplicates by progressive refinement: by length, then by a hash of the beginning, then by a hash of the whole.

Two texts are copies when they are identical after all ASCII white space is deleted. A first, narrow scan takes each
text's length and the hash of its first ``PREFIX`` characters; lengths that occur once are done, and so are pairs of
length and prefix hash that occur once. A second scan computes the digest (SHA-256) of the whole text for what is
left, or, if ``digests`` asks for it, of every text. Copies share length and digest. Of a group, the row with the
most characters as written stays, then the one with the least id.

Texts are read, never shuffled: what moves are lengths and hashes with map-side counts, so a group of copies of any
size costs a row for each task and level. Tables of repeated keys are broadcast after their rows were counted and up
to ``BROADCAST_KEYS`` of them; beyond that rows and keys are joined by key and salt, each key once for every salt, so
that no task gets more than a share of a hot key.

Defined results: a null text counts as an empty one, and all texts without a character other than white space are
copies of each other; a null id is a value, and the last of all; of rows that agree in id and number of characters,
exactly one stays; an empty table gives an empty result. Only the id and the text are read, so other columns may
have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.llm.exprs import SPACE, literal, quoted
from penprint.session import stored

#: Characters of the normalised text that the prefix hash covers.
PREFIX = 64
#: Keys of at most about 80 bytes that may be broadcast.
BROADCAST_KEYS = 500_000
SALTS = 32


def normalised(text: str) -> Column:
    """The text without its ASCII white space; null gives an empty text."""
    plain = f"coalesce({quoted(text)}, '')"
    return F.expr(reduce(lambda inner, c: f"replace({inner}, {literal(c)}, '')", SPACE, plain))


def _repeated(keys: DataFrame, on: list[str]) -> DataFrame:
    """The keys that occur twice or more, as a stored table."""
    counted = keys.groupBy(*on).agg(F.count("*").alias("n")).filter("n > 1")
    return stored(counted.drop("n").withColumn("again", F.lit(True)), "repeated")


def _looked_up(rows: DataFrame, keys: DataFrame, on: list[str], salt: Column, most: int) -> DataFrame:
    """``rows`` left joined with a stored table of distinct keys; null keys meet nothing."""
    if keys.count() <= most:
        return rows.join(F.broadcast(keys), on, "left")
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)))
    every = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("_salt", F.col("_salt").cast("long"))
    return salted.join(every.hint("merge"), [*on, "_salt"], "left").drop("_salt")


def find_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digests: bool = False, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """One row per document: doc_id, n_chars (as written), keep_id (of the row that stays), group_size, kept, and
    digest, which is null for texts that no other shares a length and prefix with, unless ``digests`` is true."""
    texts = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.length(F.coalesce(F.col(quoted(text)), F.lit(""))).alias("n_chars"), normalised(text).alias("t"))
    sketched = texts.select(
        "doc_id", "n_chars", "t", F.octet_length("t").alias("length"), F.xxhash64(F.substring("t", 1, PREFIX)).alias("prefix")
    )
    keys = stored(sketched.select("doc_id", "length", "prefix"), "copy-keys")
    salt = F.xxhash64("doc_id")

    lengths = _repeated(keys, ["length"])
    alike = _looked_up(keys, lengths, ["length"], salt, broadcast_keys).filter("again").select("length", "prefix")
    prefixes = _repeated(alike, ["length", "prefix"])
    marked = _looked_up(sketched, prefixes, ["length", "prefix"], salt, broadcast_keys)
    digest = F.sha2("t", 256)
    hashed = stored(
        marked.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", "length",
            F.coalesce("again", F.lit(False)).alias("alike"),
            (digest if digests else F.when(F.col("again"), digest)).alias("digest"),
        ),
        "copy-digests",
    )

    first = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    groups = hashed.filter("alike").groupBy("length", "digest").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1")
    groups = stored(groups.select("length", "digest", "n", F.struct("first.doc_id", "first.row").alias("first")), "copy-groups")
    found = _looked_up(hashed, groups, ["length", "digest"], F.xxhash64("doc_id"), broadcast_keys)
    return found.select(
        "doc_id", "n_chars",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
        "digest",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The documents without their copies, with the columns they came with."""
    found = find_copies(docs, id_col, text, broadcast_keys=broadcast_keys).filter("group_size > 1")
    #: Rows that agree in all that tells rows of a group apart: none, one or one of several stays.
    same = ["id", "n_chars", "digest"]
    verdicts = found.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("doc_id").isNull().alias("unnamed"), "n_chars", "digest")
    verdicts = stored(verdicts.agg(F.max("kept").alias("kept"), F.count("*").alias("n")).filter("not kept or n > 1"), "copy-verdicts")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).alias("id"),
        F.col(quoted(id_col)).isNull().alias("unnamed"),
        F.length(F.coalesce(F.col(quoted(text)), F.lit(""))).alias("n_chars"),
        F.sha2(normalised(text), 256).alias("digest"),
    )
    judged = _looked_up(rows, verdicts, [*same, "unnamed"], F.xxhash64("id"), broadcast_keys)
    alone = judged.filter("n is null").select("row.*")
    tied = judged.filter("kept and n > 1").dropDuplicates([*same, "unnamed"]).select("row.*")
    return alone.unionByName(tied)
