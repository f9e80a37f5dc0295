"""Word shingles of batches of texts as 64-bit hashes, in Arrow and numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that a worker takes at a time; a longer text is taken whole.
CHUNK = 4 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def chunks(batch: pa.RecordBatch, text: int, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``size`` bytes of the text in column ``text``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()) // size
    starts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def mixed(values: np.ndarray) -> np.ndarray:
    """Hashes with their bits spread."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts in a row, and the number of words of each; null has none.

    Words are the runs between the six ASCII white-space characters. Each distinct word is hashed once.
    """
    flat = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[\x09-\x0D]", " ")
    parts = pc.split_pattern(flat, " ")
    listed = parts.flatten().dictionary_encode()
    words = listed.dictionary
    # Arrow makes the objects of a numpy array at once, those of to_pylist one by one.
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.uint64, len(words))
    codes = listed.indices.to_numpy()
    real = (pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)[codes]
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    return hashes[codes][real], np.bincount(owner[real], minlength=len(texts))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words within each text, and the text each is of.

    A text of fewer words, but not none, has one shingle, of all its words.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    n = max(len(words) - size + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled = rolled * _MULTIPLIER + words[i : i + n]
    inside = owner[:n] == owner[size - 1 :] if n else np.zeros(0, bool)
    values, of = rolled[inside], owner[:n][inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        starts = np.cumsum(counts) - counts
        whole = np.zeros(len(short), np.uint64)
        for i in range(size):
            has = counts[short] > i
            whole[has] = whole[has] * _MULTIPLIER + words[starts[short[has]] + i] + np.uint64(1)
        values, of = np.concatenate((values, whole)), np.concatenate((of, short))
    return mixed(values), of


def distinct_shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, count) of the distinct shingles of each text, ordered by text and hash."""
    values, of = shingle_hashes(*word_hashes(texts), size)
    # One key sorts faster than two: the text, then the hash as far as it fits.
    bits = np.uint64(max(len(texts).bit_length(), 1))
    order = np.argsort((of.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits))
    values, of = values[order], of[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    return values[first], of[first], np.diff(first, append=len(values))
