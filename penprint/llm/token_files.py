"""Token ids in Arrow IPC files: batches of fixed-size lists, so that any sequence is a view into the mapped file.

Documents are range-partitioned and sorted by id; each task encodes its texts, ends every document with an end id
and cuts the stream into sequences of equal length. A file holds ``input_ids`` (fixed-size lists of unsigned 16 or
32-bit ids) and ``mask`` (fixed-size lists of booleans, false for the padding after a file's last document). Beside
it lies an index with each document's place. Files get names of their own, and the manifest, a table that Spark
commits, lists those of finished tasks: a task that is run again leaves nothing behind that is read.

Defined results: a null text counts as empty, an empty text is its end id alone; a null doc_id sorts first;
rows with one id are ordered by their text; an empty table gives no files and an empty result. Other columns are
not read.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from penprint.llm import files
from penprint.llm.exprs import quoted
from penprint.session import scratch_path, spread, stored

END_ID = 1
SEQUENCE = 2048
#: Sequences in a record batch.
BATCH = 64
#: Pieces of text whose ids a Python worker remembers.
CACHE = 500_000
#: Bytes of text that a worker encodes at a time.
CHARS = 4 << 20
#: Texts that the tokenizer encodes at a time: what it returns takes some hundred bytes a token.
TEXTS = 256
#: Codes whose ids are looked up at a time.
CODES = 1 << 16

_MANIFEST = "shard int, tokens_path string, index_path string, n_docs long, n_tokens long"
_LETTERS_THEN_SIGNS = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")
_SIGNS = frozenset(string.punctuation)


class PieceEncoder:
    """Encodes texts by the pieces between spaces and line ends, each distinct piece once.

    The tokenizer's pattern never crosses white space and its model never crosses a match, so a text's ids are
    those of its pieces one after the other. A run of letters and a following run of signs are two matches; new
    runs of letters are encoded many at a time and told apart by the tokens that end a word.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = bool(self.suffix) and token.endswith(self.suffix)
        self.lowers = self.tokenizer.encode("A", add_special_tokens=False).ids == self.tokenizer.encode("a", add_special_tokens=False).ids
        self.dtype = np.uint16 if len(self.ends) <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        """Codes of pieces and of their parts; a code's ids are ``flat[starts[code]:][:lengths[code]]``."""
        self.codes: dict[str, int] = {}
        self.parts: dict[str, int] = {}
        self.flat = np.zeros(1 << 20, self.dtype)
        self.starts = np.zeros(1 << 18, np.int64)
        self.lengths = np.zeros(1 << 18, np.int64)
        self.used = self.n = 0

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> range:
        """Codes for new entries, whose ids come one after the other."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while self.n + len(lengths) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.lengths = np.concatenate((self.lengths, np.zeros_like(self.lengths)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[self.n : self.n + len(lengths)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n : self.n + len(lengths)] = lengths
        self.used, self.n = self.used + len(ids), self.n + len(lengths)
        return range(self.n - len(lengths), self.n)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [np.zeros(0, self.dtype)], []
        for i in range(0, len(texts), TEXTS):
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + TEXTS], add_special_tokens=False)]
            parts.append(np.fromiter(chain.from_iterable(lists), self.dtype))
            sizes.extend(map(len, lists))
        return np.concatenate(parts), np.array(sizes, np.int64)

    def _add_texts(self, texts: list[str]) -> range:
        return self._add(*self._encoded(texts))

    def _add_letter_runs(self, runs: list[str]) -> range:
        """As ``_add_texts``, for runs of letters: 200 in a text, cut where tokens end a word."""
        groups = [runs[i : i + 200] for i in range(0, len(runs), 200)]
        ids, sizes = self._encoded([" ".join(g) for g in groups])
        ends = np.flatnonzero(self.ends[ids]) + 1
        in_group = np.diff(np.searchsorted(ends, np.cumsum(sizes), "right"), prepend=0)
        if in_group.tolist() != list(map(len, groups)):  # a letter that the tokenizer changes to something else
            return self._add_texts(runs)
        return self._add(ids, np.diff(ends, prepend=0))

    def _learn(self, pieces: list[str]) -> None:
        letters, letter_runs, hard = [], [], []
        mixed, mixed_runs, mixed_signs = [], [], []
        for p in pieces:
            if not self.suffix:
                hard.append(p)
                continue
            if p.isalpha():
                letters.append(p)
                letter_runs.append(p.lower() if self.lowers and p.isascii() else p)
                continue
            if (run := p[:-1]).isalpha() and p[-1] in _SIGNS:
                sign = p[-1]
            elif (m := _LETTERS_THEN_SIGNS.fullmatch(p)) and m[1].isalpha():
                run, sign = m[1], m[2]
            else:
                hard.append(p)
                continue
            mixed.append(p)
            mixed_runs.append(run.lower() if self.lowers and run.isascii() else run)
            mixed_signs.append(sign)
        parts = self.parts
        new = [r for r in dict.fromkeys(chain(letter_runs, mixed_runs)) if r not in parts]
        parts.update(zip(new, self._add_letter_runs(new), strict=True))
        new = [s for s in dict.fromkeys(mixed_signs) if s not in parts]
        parts.update(zip(new, self._add_texts(new), strict=True))
        self.codes.update(zip(hard, self._add_texts(hard), strict=True))
        self.codes.update(zip(letters, map(parts.__getitem__, letter_runs), strict=True))
        both = np.empty((len(mixed), 2), np.int64)
        for k, of in enumerate((mixed_runs, mixed_signs)):
            both[:, k] = np.fromiter(map(parts.__getitem__, of), np.int64, len(of))
        self.codes.update(zip(mixed, self._add(self._ids(both.reshape(-1)), self.lengths[both].sum(1)), strict=True))

    def _ids(self, codes: np.ndarray) -> np.ndarray:
        """The ids of codes, one after the other."""
        parts = [np.zeros(0, self.dtype)]
        for i in range(0, len(codes), CODES):
            some = codes[i : i + CODES]
            lengths = self.lengths[some]
            shift = self.starts[some] - np.cumsum(lengths) + lengths
            parts.append(self.flat[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))])
        return np.concatenate(parts)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each followed by the end id, and the number of ids of each text."""
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        counts = pc.list_value_length(pieces).to_numpy()
        listed = pieces.flatten().dictionary_encode()
        distinct = listed.dictionary.to_pylist()
        if len(self.codes) > CACHE:
            self.forget()
        found = list(map(self.codes.get, distinct))
        missing = [i for i, code in enumerate(found) if code is None]
        self._learn([distinct[i] for i in missing])
        for i in missing:
            found[i] = self.codes[distinct[i]]
        known = np.fromiter(found, np.int64, len(found))
        closing = self._add(np.array([end_id], self.dtype), np.ones(1, np.int64))[0]
        codes = np.insert(known[listed.indices.to_numpy()], np.cumsum(counts), closing)
        sizes = np.cumsum(self.lengths[codes])[np.cumsum(counts + 1) - 1]
        return self._ids(codes), np.diff(sizes, prepend=0)


@lru_cache(maxsize=1)
def _encoder(path: str) -> PieceEncoder:
    """A worker's encoder. A task has one core: the tokenizer's own threads would each keep memory in the worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return PieceEncoder(path)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``CHARS`` bytes of text; a longer text is a piece of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy()) // CHARS
    starts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield batch.slice(a, b - a)


class _Writer:
    """One file of sequences and its index."""

    def __init__(self, folder: str, partition: int, dtype: np.dtype, sequence: int) -> None:
        self.paths = [f"{folder}/{files.unique_name(s, partition, '.arrow')}" for s in ("tokens", "index")]
        self.sequence = sequence
        ids = pa.list_(pa.from_numpy_dtype(dtype), sequence)
        self.schema = pa.schema([("input_ids", ids), ("mask", pa.list_(pa.bool_(), sequence))])
        self.places = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])
        self.outs = [files.create(p) for p in self.paths]
        self.tokens = pa.ipc.new_file(self.outs[0], self.schema)
        self.index = pa.ipc.new_file(self.outs[1], self.places)
        self.rest = np.zeros(0, dtype)
        self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        offsets = self.n_tokens + np.cumsum(lengths) - lengths
        self.index.write_batch(pa.record_batch([doc_ids.cast(pa.int64()), pa.array(offsets), pa.array(lengths)], schema=self.places))
        self.n_tokens += len(ids)
        self.n_docs += len(doc_ids)
        self.rest = np.concatenate((self.rest, ids))
        whole = self.sequence * BATCH
        while len(self.rest) >= whole:
            self._flush(self.rest[:whole], whole)
            self.rest = self.rest[whole:]

    def _flush(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(a), self.sequence) for a in (ids, mask)]
        self.tokens.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if len(self.rest):
            padded = np.zeros(-(-len(self.rest) // self.sequence) * self.sequence, self.rest.dtype)
            padded[: len(self.rest)] = self.rest
            self._flush(padded, len(self.rest))
        for w in (self.tokens, self.index, *self.outs):
            w.close()


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID, sequence: int = SEQUENCE,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Encode and write all documents in ascending id order; the manifest of the files, in shard order."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, shard = _encoder(tokenizer_path), None, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or _Writer(folder, shard, encoder.dtype, sequence)
            for part in _slices(batch):
                out.add(part.column(0), *encoder.encode(part.column(1), end_id))
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "tokens_path": out.paths[0], "index_path": out.paths[1], "n_docs": out.n_docs, "n_tokens": out.n_tokens}],
                schema=pa.schema([("shard", pa.int32()), ("tokens_path", pa.string()), ("index_path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    rows = docs.select(
        F.col(quoted(id_col)).cast("long").alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text")
    )
    in_order = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    manifest = stored(in_order.mapInArrow(write, _MANIFEST), "token-manifest")
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)))


class TokenFile:
    """Random access to the sequences of one file."""

    def __init__(self, path: str) -> None:
        self.file = pa.ipc.open_file(files.open_random(path))
        self.sequence = self.file.schema.field("input_ids").type.list_size
        self.at, self.batch = -1, None

    def _values(self, batch: int, column: str) -> pa.Array:
        if batch != self.at:
            self.at, self.batch = batch, self.file.get_batch(batch)
        return self.batch.column(self.batch.schema.get_field_index(column)).values

    def sequence_ids(self, i: int) -> np.ndarray:
        """Sequence i, a view into the file."""
        row = (i % BATCH) * self.sequence
        return self._values(i // BATCH, "input_ids").to_numpy(zero_copy_only=True)[row : row + self.sequence]

    def sequence_mask(self, i: int) -> pa.Array:
        """The mask of sequence i, a view into the file."""
        return self._values(i // BATCH, "mask").slice((i % BATCH) * self.sequence, self.sequence)

    def tokens(self, offset: int, n: int) -> np.ndarray:
        """n ids from a place in the stream of all sequences; a view where one batch holds them."""
        whole, parts = self.sequence * BATCH, []
        while n:
            values = self._values(offset // whole, "input_ids").to_numpy(zero_copy_only=True)
            part = values[offset % whole :][:n]
            parts.append(part)
            offset, n = offset + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = TokenFile(row["tokens_path"])
                index = pa.ipc.open_file(files.open_random(row["index_path"]))
                for i in range(index.num_record_batches):
                    places = index.get_batch(i)
                    offsets, lengths = (places.column(c).to_numpy() for c in (1, 2))
                    sums = [
                        zlib.crc32(tokens.tokens(o, n).astype("<u4").tobytes())
                        for o, n in zip(offsets.tolist(), lengths.tolist(), strict=True)
                    ]
                    columns = [places.column(0), pa.array(row["start"] + offsets), places.column(2), pa.array(sums, pa.int64())]
                    yield pa.record_batch(columns, schema=schema)

    few_each = spread(manifest.select("tokens_path", "index_path", "start"), "tokens_path")
    return few_each.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


