"""Ranked lexical search: documents of a block are grouped by the mask of an item's terms that they hold.

Documents are cut into terms once; what is stored of each is its number of terms and the counts of those that some
item asks for. Numbers of documents, terms and documents for each term are counted from that table. A worker then
takes blocks of documents, with one bitmap over the block for each term. For each item, the bitmaps of its terms are
turned into one mask per document, and documents of one mask form a group. A mask's score can't exceed the sum over
its terms of what the most frequent occurrence in the block gives in the group's shortest document; masks are
evaluated by falling maximum until none is left that reaches the item's 50th score so far.

That bound starts from the 50th score among the documents whose hashed id falls in one of ``PROBE`` classes. Any
document below it is beaten by 50 others, so the result is exact, and about ``PROBE`` times 50 rows an item leave the
workers, however many documents there are. They are ranked in two steps, by parts of an item's rows and then by item.

Items are taken in slices whose terms have a bounded total, by a hash of the item; a slice's terms are what is sent to
the tasks, and the documents are gone through once for each slice.

Defined results: null and empty texts have no terms and are never found; they don't count as documents. An item without
terms has no rows. Each row of the items is an item, also where ids repeat; a null item id is a value. Ids of documents
are integers, a null id is the last of all; rows of one id are documents of their own. Equal scores are ranked by
ascending id. Empty tables give an empty result. Only ids and texts are read, so other columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from penprint.llm.exprs import quoted
from penprint.llm.shingles import chunks
from penprint.session import stored

TOP = 50
#: Terms, over all items of a slice, that are sent to every task (an item with more is a slice of its own).
SLICE_TERMS = 20_000
PROBE = 64
_PARTS = 32
#: Documents of a block, and bits of all its bitmaps.
_BLOCK, _BITS = 4096, 1 << 25
_NONE = np.iinfo(np.int64).max

#: What each byte counts as in a term: itself in lower case, or 0 where it ends a term.
_LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 0 for b in range(256)], np.uint8)


def term_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(terms of all texts in a row, as bytes; the text that each is of). Null has none."""
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    letters = _LETTERS[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = letters != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[bounds] = inside[bounds]
    starts = np.flatnonzero(begins)
    # A term ends before the next start, less the bytes between that are in no term.
    before = np.concatenate(([0], np.cumsum(np.add.reduceat(inside[:-1], starts, dtype=np.int64)))) if len(starts) else np.zeros(1, np.int64)
    kept = letters[inside[:-1]]
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(before), pa.py_buffer(kept)])
    return terms, np.searchsorted(bounds, starts, "right") - 1


def item_terms(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """item_id and its distinct terms, as sorted bytes, of every item that has some."""
    rows = items.select(F.col(quoted(id_col)).alias("item_id"), F.col(quoted(text)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                terms, owner = term_runs(part.column(1))
                flat, lists = terms.to_pylist(), [set() for _ in range(part.num_rows)]
                for i, t in zip(owner.tolist(), flat, strict=True):
                    lists[i].add(t)
                yield pa.record_batch([part.column(0), pa.array([sorted(s) for s in lists], pa.list_(pa.binary()))], names=["item_id", "terms"])

    schema = StructType([*rows.schema.fields[:1]]).add("terms", ArrayType(BinaryType()))
    return rows.mapInArrow(run, schema).filter(F.size("terms") > 0)


def postings(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (terms, with repeats), terms (places in the vocabulary) and counts of every document with a term."""
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    known = pa.array(vocabulary, pa.large_binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                terms, owner = term_runs(part.column(1))
                places = pc.index_in(terms, value_set=known)
                met = pc.is_valid(places).to_numpy(zero_copy_only=False)
                keys = owner[met] * max(len(known), 1) + pc.drop_null(places).to_numpy()
                keys, counts = np.unique(keys, return_counts=True)
                ends = np.searchsorted(keys, np.arange(part.num_rows + 1) * max(len(known), 1)).astype(np.int32)
                found = (keys % max(len(known), 1)).astype(np.int32)
                n = np.bincount(owner, minlength=part.num_rows)
                columns = [
                    part.column(0), pa.array(n), pa.ListArray.from_arrays(pa.array(ends), pa.array(found)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(counts)),
                ]
                yield pa.record_batch(columns, names=["doc_id", "n", "terms", "counts"]).filter(pa.array(n > 0))

    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


@dataclass(frozen=True)
class Scoring:
    """What scores depend on besides a document: documents and terms of the corpus, a weight for each term."""

    documents: int
    terms: int
    weights: np.ndarray

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """20 m of documents with n terms."""
        if 50 * int(n.max(initial=0)) * self.documents < _NONE:
            return 20 * (50 + 50 * n * self.documents // self.terms)
        return np.array([20 * (50 + 50 * int(x) * self.documents // self.terms) for x in n], np.int64)


def count_scoring(table: DataFrame, n_terms: int) -> Scoring:
    """N, L and weights from a table of postings."""
    total = table.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(n_terms, np.int64)
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weights = [math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * int(f) + 1))) for f in df]
    return Scoring(total["documents"], max(total["terms"], 1), np.array(weights, np.int64))


@dataclass
class _Best:
    """The highest rows of an item so far: score, whether the id is null, id; and the row that a new one must beat."""

    score: np.ndarray
    unnamed: np.ndarray
    doc: np.ndarray
    floor: int

    def add(self, score: np.ndarray, unnamed: np.ndarray, doc: np.ndarray, top: int) -> None:
        good = score >= max(self.floor, 1)
        if not good.any():
            return
        score, unnamed, doc = (np.concatenate(p) for p in ((self.score, score[good]), (self.unnamed, unnamed[good]), (self.doc, doc[good])))
        order = np.lexsort((doc, unnamed, -score))[:top]
        self.score, self.unnamed, self.doc = score[order], unnamed[order], doc[order]
        if len(order) == top:
            self.floor = max(self.floor, int(self.score[-1]))


class _Block:
    """Some documents' postings, by term, with a bitmap over the documents for each term."""

    def __init__(self, table: pa.Table, n_terms: int, scoring: Scoring):
        self.size = table.num_rows
        ids = table.column("doc_id").combine_chunks()
        self.unnamed = pc.is_null(ids).to_numpy(zero_copy_only=False)
        self.doc = pc.fill_null(ids, _NONE).to_numpy()
        self.length = scoring.lengths(table.column("n").to_numpy())
        terms, counts = (table.column(c).combine_chunks() for c in ("terms", "counts"))
        owner = np.repeat(np.arange(self.size), pc.list_value_length(terms).to_numpy())
        place = terms.flatten().to_numpy().astype(np.int64)
        keys = place * self.size + owner
        order = np.argsort(keys, kind="stable")
        self.keys, self.counts = keys[order], counts.flatten().to_numpy()[order]
        held = np.zeros((n_terms, self.size), bool)
        held[place, owner] = True
        self.bitmaps = np.packbits(held, axis=1)
        self.most = np.zeros(n_terms, np.int64)
        np.maximum.at(self.most, place, counts.flatten().to_numpy())

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents that hold a term, the group of each, a row of bits for each group): documents by matched terms."""
        rows = self.bitmaps[terms]
        some = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(rows, axis=0), count=self.size))
        bits = np.unpackbits(rows, axis=1, count=self.size)[:, some]
        packed = np.ascontiguousarray(np.packbits(bits, axis=0).T)
        masks = packed.view(np.dtype((np.void, packed.shape[1]))).reshape(-1)
        _, first, group = np.unique(masks, return_index=True, return_inverse=True)
        return some, group, bits[:, first].T.astype(bool)

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        wanted = terms[:, None] * self.size + docs
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        tf = np.where(self.keys[at] == wanted, self.counts[at], 0)
        return (weights[:, None] * (1_000_000_000 * tf // (1000 * tf + self.length[docs]))).sum(0)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: _Best, top: int) -> None:
        """Masks by falling maximum, until none that is left can reach the row to beat."""
        some, group, bits = self.masks(terms)
        if not len(some):
            return
        shortest = np.full(len(bits), _NONE)
        np.minimum.at(shortest, group, self.length[some])
        tf = self.most[terms].astype(np.float64)
        reach = weights * (1e9 * tf / (1000 * tf + shortest[:, None].astype(np.float64)))
        maxima = (reach * bits).sum(1) * (1 + 1e-9)
        by_maximum = np.argsort(-maxima[group], kind="stable")
        falling = maxima[group][by_maximum]
        at, step = 0, 2 * top
        while at < len(some) and falling[at] >= max(best.floor, 1):
            # Whole masks: the last one taken is taken to its end.
            upto = min(int(np.searchsorted(-falling, -falling[min(at + step, len(some)) - 1], "right")), len(some))
            docs = some[by_maximum[at:upto]]
            best.add(self.scores(docs, terms, weights), self.unnamed[docs], self.doc[docs], top)
            at, step = upto, 2 * step


def _candidates(table: DataFrame, wanted: list[np.ndarray], floors: list[int], scoring: Scoring, top: int, block: int) -> DataFrame:
    """item (its number), doc_id, score: each task's rows that may be among an item's highest."""
    n_terms = len(scoring.weights)
    size = max(64, min(block, _BITS // max(n_terms, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), f) for f in floors]

        def search(rows: list[pa.RecordBatch]) -> None:
            part = _Block(pa.Table.from_batches(rows), n_terms, scoring)
            if len(part.keys):
                for terms, found in zip(wanted, best, strict=True):
                    part.search(terms, scoring.weights[terms], found, top)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = size - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == size:
                    search(held)
                    held = []
        if held:
            search(held)
        for i, found in enumerate(best):
            if len(found.score):
                ids = pa.array(found.doc, mask=found.unnamed)
                yield pa.record_batch([pa.array(np.full(len(ids), i, np.int32)), ids, pa.array(found.score)], names=["item", "doc_id", "score"])

    return table.mapInArrow(run, "item int, doc_id long, score long")


def _highest(rows: DataFrame, top: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The highest rows of each item: of parts of its rows first."""
    parts = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)))
    return _highest(_highest(parts, top, "item", "part").drop("rank", "part"), top, "item")


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", slice_terms: int = SLICE_TERMS, probe: int = PROBE, block: int = _BLOCK,
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``top`` highest documents with a score above 0."""
    spark = docs.sparkSession
    listed = stored(item_terms(items, item_id, item_text), "search-items")
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_slices = -(-total // slice_terms)
    slices = F.pmod(F.xxhash64(F.col("item_id").cast("string"), "terms"), F.lit(max(n_slices, 1)))
    out = spark.createDataFrame([], StructType([listed.schema["item_id"]]).add("rank", IntegerType()).add("doc_id", LongType()).add("score", LongType()))
    for k in range(n_slices):
        own = sorted(listed.filter(slices == k).collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["terms"]))
        vocabulary = sorted({bytes(t) for r in own for t in r["terms"]})
        place = {t: i for i, t in enumerate(vocabulary)}
        wanted = [np.array([place[bytes(t)] for t in r["terms"]], np.int64) for r in own]
        table = stored(postings(docs, vocabulary, id_col, text), "search-postings")
        scoring = count_scoring(table, len(vocabulary))

        probed = table.filter(F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(probe)) == 0)
        first = _ranked(_candidates(probed, wanted, [0] * len(own), scoring, top, block), top)
        floors = [0] * len(own)
        for r in first.filter(F.col("rank") == top).collect():
            floors[r["item"]] = r["score"]
        rows = stored(_ranked(_candidates(table, wanted, floors, scoring, top, block), top), "search-found")
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], StructType().add("item", IntegerType()).add(listed.schema["item_id"]))
        out = out.unionByName(rows.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
