"""Exact repeats between documents by a family of suffix arrays that grows in levels.

Documents come in batches of ascending ids. A batch gets its suffix array, which is scanned in order against the
arrays of the levels that exist, and then becomes a level of size one; levels of equal size are merged, so that n
batches are held in about log n levels and a suffix is written again about log n times.

The arrays are sparse and truncated, which loses no match of ``LENGTH`` bytes: of the grams of 20 bytes in a window of
50, the one with the least hash is its anchor, so equal windows have anchors at equal places, and consecutive windows
with one anchor form a run. An array holds one entry for each distinct run, in the order of the bytes at its anchor,
with digests of all bytes of the run's windows and the least document that has them. About one position in 16 is an
anchor. Equal runs meet in the merge scan and all their windows repeat. Where runs share an anchor's bytes but differ
around it (a match that begins or ends inside them) their windows are listed one by one, of the first document of
each run only, and meet by digest; one more pass per text settles them.

Arrays are cut into buckets by the anchor's first bytes and hashed bits; a bucket's slices of a batch and of all levels
are scanned in one task, in numpy. A part (about ``PART_BYTES`` of text) sends each distinct run once with its least
document, so equal runs of a passage that a third of all documents share cost a bucket one entry for each part.
Runs that differ around one such anchor are all entries of one bucket, one or two for each document that has
it. Windows, about 15 for each of these, go to buckets by all their bits, so they are spread.
Texts are kept as parts in the shared folder, and answers go to parts; no text is shuffled.

What only one part has needs no entry, as a part settles itself what its own documents share. So where all batches are
known (``add_all``), parts first send ``SHORT`` bits of each distinct anchor, sorted and stored as differences, about
three bytes each, and learn by one bit each which of them some other part has too; only runs at those anchors become entries. Windows
are dealt with in the same way. Anchors that share these bits by chance cost an entry and change no result.

Beyond the first 8 bytes of the anchor, entries are ordered and matched by hashes, not by bytes: 16 bits of the anchor
and 104 bits of all bytes of the run, or of the window and its distance from the anchor, from two polynomials of
different bases. Inside a part, and in answers to it, runs and windows are looked up by 64 bits made of all of these.

Defined results: a null text is empty; a document with a null id loses nothing and takes nothing from others; equal ids
are not smaller than each other; texts under 50 bytes lose nothing; an empty table gives an empty result. Only id and
text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from penprint.llm import files
from penprint.llm.exprs import quoted
from penprint.llm.shingles import mixed
from penprint.session import remove_path, scratch_path, stored

LENGTH = 50
GRAM = 20
BATCHES = 4
PART_BYTES = 16 << 20
CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
SHORT = 40
_BASE = 0x9E3779B97F4A7C15
_BASE_2 = 0xD1342543DE82EF95
_NO_DOC = np.int64(2**63 - 1)

_ROWS = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("part", pa.int64()), ("path", pa.string()), ("blob", pa.binary())])
_DDL = "kind int, bucket long, part long, path string, blob binary"
#: Kinds of rows: a part's own place; its entries; answers to it; a level's entries; short keys, which are shared, and the
#: runs that differ around an anchor of one part alone.
PART, ENTRIES, ANSWER, LEVEL, REQUEST, WINDOWS, WINDOW_ANSWER, KEYS, SHARED, LOCAL = range(10)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 8-byte numbers, byte plane by byte plane, compressed; the first is stored as differences."""
    first = np.diff(arrays[0].view(np.uint64), prepend=np.uint64(0))
    columns = [first, *arrays[1:]]
    planes = np.stack([c.view(np.uint8).reshape(len(c), 8).T for c in columns])
    return len(first).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:]), np.uint8)
    arrays = [np.ascontiguousarray(p.T).view(np.uint64).reshape(-1) for p in raw.reshape(-1, 8, n)]
    return [np.cumsum(arrays[0], dtype=np.uint64), *arrays[1:]]


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    factors = np.full(n, base & (2**64 - 1), np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _power_tables(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, from tables that chunks of usual size share."""
    size = max(n, 2 * CHUNK_BYTES)
    return _powers(size, base)[:n], _powers(size, pow(base, -1, 2**64))[:n]


@dataclass
class Runs:
    """Runs of windows of a chunk of texts: first and last window, the document's row, anchor bytes and digests."""

    first: np.ndarray
    last: np.ndarray
    row: np.ndarray
    anchor: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    more: np.ndarray
    sums: np.ndarray
    inverse: np.ndarray
    sums_2: np.ndarray
    inverse_2: np.ndarray

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, run, head, tail, more) of all windows of some runs; tail and more tell a window from others at its anchor."""
        n = self.last[which] - self.first[which] + 1
        starts = np.repeat(self.first[which], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        run = np.repeat(which, n)
        digests = mixed((self.sums[starts + LENGTH] - self.sums[starts]) * self.inverse[starts])
        place = (self.anchor[run] - starts).astype(np.uint64) << np.uint64(40)
        more = mixed((self.sums_2[starts + LENGTH] - self.sums_2[starts]) * self.inverse_2[starts])
        return starts, run, self.head[run], (self.tail[run] >> np.uint64(40) << np.uint64(48)) | place | (digests >> np.uint64(24)), more


def find_runs(data: np.ndarray, lengths: np.ndarray) -> Runs:
    """The runs of texts that lie one after the other in ``data``."""
    n = len(data)
    power, inverse = _power_tables(n + 1)
    power_2, inverse_2 = _power_tables(n + 1, _BASE_2)
    values = data.astype(np.uint64) + np.uint64(1)
    sums, sums_2 = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
    np.cumsum(values * power[:n], dtype=np.uint64, out=sums[1:])
    np.cumsum(values * power_2[:n], dtype=np.uint64, out=sums_2[1:])
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, *[none.astype(np.uint64)] * 3, sums, inverse, sums_2, inverse_2)
    grams = (sums[GRAM:] - sums[:-GRAM]) * inverse[: n + 1 - GRAM]
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(_BASE)
    # The least hash and then the leftmost place, over all grams of a window, by doubling.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    reach, wanted = 1, LENGTH - GRAM + 1
    while reach < wanted:
        step = min(reach, wanted - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    # A run begins where the anchor changes or a text begins; windows that leave their text are none.
    ends = np.cumsum(lengths)
    begins = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=begins[1:])
    starts = ends - lengths
    begins[starts[starts < len(least)]] = True
    outside = (ends[:, None] - np.arange(1, LENGTH)).reshape(-1)
    begins[outside[(outside >= 0) & (outside < len(least))]] = False
    first = np.flatnonzero(begins)
    row = np.searchsorted(ends, first, "right")
    last = np.minimum(np.append(first[1:], len(least)) - 1, ends[row] - LENGTH)
    anchor = (least[first] & np.uint64(2**32 - 1)).astype(np.int64)
    head = np.zeros(len(first), np.uint64)
    for i in range(8):
        head = (head << np.uint64(8)) | data[anchor + i]
    context = mixed((sums[last + LENGTH] - sums[first]) * inverse[first] + (anchor - first).astype(np.uint64) * np.uint64(_BASE))
    tail = (mixed(grams[anchor]) & np.uint64(0xFFFF)) << np.uint64(40) | (context >> np.uint64(24))
    more = mixed((sums_2[last + LENGTH] - sums_2[first]) * inverse_2[first] + (anchor - first).astype(np.uint64) * np.uint64(_BASE_2))
    return Runs(first, last, row, anchor, head, tail, more, sums, inverse, sums_2, inverse_2)


def _grouped(head: np.ndarray, tail: np.ndarray, more: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): the order by head, tail, more and then doc, and where each distinct (head, tail, more) begins in it."""
    order = np.lexsort((doc, more, tail, head))
    h, t, m = head[order], tail[order], more[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1]) | (m[1:] != m[:-1])
    return order, np.flatnonzero(new)


def _ordered(head: np.ndarray, tail: np.ndarray, more: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct (head, tail, more) in order, and the least document of each."""
    order, first = _grouped(head, tail, more, doc)
    at = order[first]
    return head[at], tail[at], more[at], doc[at]


class Part:
    """A part's texts, cut into runs chunk by chunk."""

    def __init__(self, doc_ids: np.ndarray, texts: pa.Array) -> None:
        self.docs, self.texts = doc_ids, texts
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        cut = np.cumsum(sizes) // CHUNK_BYTES
        self.bounds = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(texts)] if len(texts) else [0]
        self.sizes = sizes

    def chunks(self) -> Iterator[tuple[int, np.ndarray, Runs]]:
        """(number of the first text, bytes, runs) of each chunk."""
        for a, b in zip(self.bounds, self.bounds[1:]):
            data = np.frombuffer(b"".join(self.texts.slice(a, b - a).to_pylist()), np.uint8)
            yield a, data, find_runs(data, self.sizes[a:b])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The part's runs as they follow: head, tail, more and document."""
        found = [(r.head, r.tail, r.more, self.docs[a + r.row]) for a, _, r in self.chunks()]
        head, tail, more, doc = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.uint64),) * 4
        return head, tail, more, doc.astype(np.int64)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The part's distinct runs in order: head, tail, more and least document."""
        return _ordered(*self.runs())


def _write_part(folder: str, number: int, doc_ids: pa.Array, texts: pa.Array) -> str:
    path = f"{folder}/{files.unique_name('part', number & 0xFFFFFF, '.arrow')}"
    table = pa.record_batch([doc_ids, texts], names=["doc_id", "text"])
    with files.create(path) as out, pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(table)
    return path


def _read_part(path: str) -> Part:
    with files.open_random(path) as source:
        table = pa.ipc.open_file(source).get_batch(0)
    return Part(table.column(0).to_numpy(), table.column(1))


def _buckets(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places) of keys, each bucket's places in ascending order."""
    bucket = mixed(keys) % np.uint64(n)
    order = np.argsort(bucket, kind="stable")
    which, first = np.unique(bucket[order], return_index=True)
    for b, places in zip(which.tolist(), np.split(order, first[1:])):
        yield int(b), places


def _anchors(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """What runs share whose anchors have equal bytes: the first 8 and the hashed bits."""
    return head * np.uint64(_BASE) + (tail >> np.uint64(40))


def _row(kind: int, bucket: int, part: int, path: str | None, blob: bytes | None) -> dict[str, object]:
    return {"kind": kind, "bucket": bucket, "part": part, "path": path, "blob": blob}


def _batch_of(rows: list[dict[str, object]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ROWS)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order (one sort of numbers, which numpy does faster than ``unique``)."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _short(ids: np.ndarray) -> np.ndarray:
    """The distinct short keys of some hashes, in order."""
    return _distinct(mixed(ids) >> np.uint64(64 - SHORT))


def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of n ranges of keys begins among sorted short keys, and their end."""
    return np.searchsorted((keys * np.uint64(n)) >> np.uint64(SHORT), np.arange(n + 1, dtype=np.uint64))


def _key_rows(part: int, path: str, keys: np.ndarray, n: int) -> list[dict[str, object]]:
    bounds = _ranges(keys, n).tolist()
    return [_row(KEYS, b, part, path, pack(keys[i:j])) for b, (i, j) in enumerate(zip(bounds, bounds[1:])) if i < j]


def _shared(table: pa.Table) -> pa.Table:
    """Of one range of short keys: for each part, a bit for each of its keys, set if another part has it."""
    rows = table.to_pylist()
    out = [r for r in rows if r["kind"] == PART]
    parts = [r for r in rows if r["kind"] == KEYS]
    own = [unpack(r["blob"])[0] for r in parts]
    if own:
        keys = np.sort(np.concatenate(own))
        twice = _distinct(keys[1:][keys[1:] == keys[:-1]])
        out += [_row(SHARED, r["bucket"], r["part"], r["path"], np.packbits(_inside(x, twice)).tobytes()) for r, x in zip(parts, own, strict=True)]
    return pa.Table.from_pylist(out, schema=_ROWS)


def _has_shared(ids: np.ndarray, rows: list[dict], n: int) -> np.ndarray:
    """Which hashes have a short key that another part has, by the bits among a part's rows."""
    keys = _short(ids)
    bounds, bits = _ranges(keys, n), np.zeros(len(keys), bool)
    for r in rows:
        if r["kind"] == SHARED:
            i, j = bounds[r["bucket"]], bounds[r["bucket"] + 1]
            bits[i:j] = np.unpackbits(np.frombuffer(r["blob"], np.uint8), count=j - i)
    return _inside(mixed(ids) >> np.uint64(64 - SHORT), keys[bits])


def cut_parts(docs: DataFrame, batch: int, n_buckets: int, n_keys: int, folder: str) -> DataFrame:
    """Write a batch of (doc_id, text) as parts; rows of their places and of the short keys of their anchors in ``n_keys``
    ranges, or none of these for 0."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (batch << 48) | (TaskContext.get().partitionId() << 16)
        ids, texts, size = [], [], 0

        def done() -> pa.RecordBatch:
            doc_ids, values = pa.chunked_array(ids).combine_chunks(), pa.chunked_array(texts).combine_chunks()
            path = _write_part(folder, number, doc_ids, values)
            rows = [_row(PART, number % n_buckets, number, path, None)]
            if n_keys:
                anchors = [_anchors(r.head, r.tail) for _, _, r in Part(doc_ids.to_numpy(), values).chunks()]
                rows += _key_rows(number, path, _short(np.concatenate(anchors)), n_keys)
            return _batch_of(rows)

        for received in batches:
            values = received.column(1).cast(pa.large_binary())
            sizes = np.cumsum(pc.binary_length(values).to_numpy()) + size
            a = 0
            while a < received.num_rows:
                b = max(int(np.searchsorted(sizes, PART_BYTES, "right")), a + 1)
                ids.append(received.column(0).slice(a, b - a))
                texts.append(values.slice(a, b - a))
                size = int(sizes[b - 1])
                if size >= PART_BYTES or b < received.num_rows:
                    yield done()
                    ids, texts, number = [], [], number + 1
                    sizes, size = sizes - size, 0
                a = b
        if ids:
            yield done()

    return docs.mapInArrow(cut, _DDL)


def _send_entries(n_buckets: int, n_keys: int):
    """A part's entries by bucket: of all its runs, or, with ``n_keys`` ranges, of those at anchors that other parts have;
    of the others, those that differ around an anchor are noted for the part itself."""

    def send(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        place = next(r for r in rows if r["kind"] == PART)
        out = [_row(PART, place["part"] % n_buckets, place["part"], place["path"], None)]
        columns = _read_part(place["path"]).runs()
        if n_keys:
            anchors = _anchors(*columns[:2])
            kept = _has_shared(anchors, rows, n_keys)
            local = _differing_here(anchors[~kept], _ids(*[c[~kept] for c in columns[:3]]))
            if len(local):
                out.append(_row(LOCAL, out[0]["bucket"], place["part"], None, pack(local)))
            columns = [c[kept] for c in columns]
        columns = _ordered(*columns)
        out += [_row(ENTRIES, b, place["part"], place["path"], pack(*[c[i] for c in columns])) for b, i in _buckets(_anchors(*columns[:2]), n_buckets)]
        return pa.Table.from_pylist(out, schema=_ROWS)

    return send


def _write_level(folder: str, bucket: int, *arrays: np.ndarray) -> str:
    path = f"{folder}/{files.unique_name('bucket', bucket, '.level')}"
    with files.create(path) as out:
        out.write(pack(*arrays))
    return path


def _read_level(path: str) -> list[np.ndarray]:
    with files.open_stream(path) as source:
        return unpack(source.read())


def _scan(n_new: int, merge: tuple[int, ...], folder: str):
    """The scan of one bucket: a batch's entries against all levels.

    Level rows hold their level in ``part`` and the file of the bucket's slice in ``path``.
    """

    def scan(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = [r for r in rows if r["kind"] in (PART, LOCAL)]
        parts = [r for r in rows if r["kind"] == ENTRIES]
        own = [unpack(r["blob"]) for r in parts]
        levels = {r["part"]: _read_level(r["path"]) for r in rows if r["kind"] == LEVEL}
        bucket = rows[0]["bucket"]
        sizes = [len(x[0]) for x in own]
        part_of = np.repeat(np.array([r["part"] for r in parts], np.uint64), sizes)
        if own:
            batch = [np.concatenate([x[i] for x in own]) for i in range(4)] + [part_of]
            order, first = _grouped(*batch[:4])
            known = np.full(len(first), _NO_DOC)
            keys = [c[order][first] for c in batch[:3]]
            for entries in levels.values():
                known = np.minimum(known, _scanned(keys, entries))
            docs = batch[3][order].view(np.int64)
            least = np.minimum(known, docs[first])
            group = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
            found = np.empty(len(order), np.int64)
            found[order] = least[group]
            at = 0
            for r, x in zip(parts, own, strict=True):
                mine = found[at : at + len(x[0])]
                at += len(x[0])
                told = np.flatnonzero(mine < x[3].view(np.int64))
                if len(told):
                    out.append(_row(ANSWER, bucket, r["part"], r["path"], pack(np.sort(_ids(*[c[told] for c in x[:3]])))))
            # The new level: of each distinct run the least document, in every part that has it.
            keep = docs == docs[first][group]
            out.append(_row(LEVEL, bucket, n_new, _write_level(f"{folder}/{n_new}", bucket, *[c[order][keep] for c in batch]), None))
        if merge and any(m in levels for m in merge):
            entries = [np.concatenate([levels[m][i] for m in merge if m in levels]) for i in range(5)]
            order, first = _grouped(*entries[:4])
            docs = entries[3][order]
            group = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
            keep = docs == docs[first][group]
            out.append(_row(LEVEL, bucket, merge[0], _write_level(f"{folder}/{merge[0]}", bucket, *[c[order][keep] for c in entries]), None))
        return pa.Table.from_pylist(out, schema=_ROWS)

    return scan


def _scanned(keys: list[np.ndarray], level: list[np.ndarray]) -> np.ndarray:
    """The least document that a level has for each of the sorted distinct runs, by merging the two orders."""
    n, asked_for = len(level[0]), len(keys[0])
    found = np.full(asked_for, _NO_DOC)
    if not n:
        return found
    order = np.lexsort((np.repeat([0, 1], [n, asked_for]), *[np.concatenate((level[i], keys[i])) for i in (2, 1, 0)]))
    asked = np.flatnonzero(order >= n)
    before = np.where(order < n, np.arange(len(order)), -1)
    before = np.maximum.accumulate(before)[asked]  # the level's entry next before each one that is asked for
    entry, run = np.minimum(order[np.maximum(before, 0)], n - 1), order[asked] - n
    same = before >= 0
    for known, key in zip(level[:3], keys, strict=True):
        same &= known[entry] == key[run]
    found[run[same]] = level[3].view(np.int64)[entry[same]]
    return found


def _differing(table: pa.Table) -> pa.Table:
    """Of all levels of a bucket: for each part, its runs that share their anchor's bytes with another run."""
    rows = table.to_pylist()
    levels = [_read_level(r["path"]) for r in rows]
    head, tail, more, doc, part = (np.concatenate([x[i] for x in levels]) for i in range(5))
    order, first = _grouped(head, tail, more, doc)
    group = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
    keep = doc[order] == doc[order][first][group]
    head, tail, more, part = (c[order][keep] for c in (head, tail, more, part))
    anchor = tail >> np.uint64(40)
    new_anchor = np.ones(len(head), bool)
    new_anchor[1:] = (head[1:] != head[:-1]) | (anchor[1:] != anchor[:-1])
    number = np.cumsum(new_anchor) - 1
    new_run = new_anchor.copy()
    new_run[1:] |= (tail[1:] != tail[:-1]) | (more[1:] != more[:-1])
    wanted = np.bincount(number[new_run])[number] > 1
    head, tail, more, part = (c[wanted] for c in (head, tail, more, part))
    order = np.argsort(part, kind="stable")
    which, start = np.unique(part[order], return_index=True)
    out = [
        _row(REQUEST, rows[0]["bucket"], int(p), None, pack(np.sort(_ids(head[i], tail[i], more[i]))))
        for p, i in zip(which.tolist(), np.split(order, start[1:]))
        if len(i)
    ]
    return pa.Table.from_pylist(out, schema=_ROWS)


def _ids(head: np.ndarray, tail: np.ndarray, more: np.ndarray) -> np.ndarray:
    return mixed(mixed(head * np.uint64(_BASE) + tail) + more)


def _named(rows: list[dict], kind: int) -> np.ndarray:
    """The ids, in order, that rows of a kind name, as such or by head, tail and more."""
    named = [unpack(r["blob"]) for r in rows if r["kind"] == kind]
    return _distinct(np.concatenate([x[0] if len(x) == 1 else _ids(*x) for x in named])) if named else np.zeros(0, np.uint64)


def _inside(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _requested_windows(part: Part, asked: np.ndarray) -> list[np.ndarray]:
    """The windows of the runs that are asked for: head, tail, more and document."""
    found = []
    for a, _, runs in part.chunks():
        _, run, *key = runs.windows(np.flatnonzero(_inside(_ids(runs.head, runs.tail, runs.more), asked)))
        found.append((*key, part.docs[a + runs.row[run]]))
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def _window_keys(n_keys: int):
    def window_keys(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        columns = _requested_windows(_read_part(rows[0]["path"]), _named(rows, REQUEST))
        return pa.Table.from_pylist(_key_rows(rows[0]["part"], rows[0]["path"], _short(_ids(*columns[:3])), n_keys), schema=_ROWS)

    return window_keys


def _list_windows(n_buckets: int, n_keys: int = 0):
    """A part's distinct windows by bucket: all of the runs that are asked for, or, with ``n_keys`` ranges, those that other
    parts have."""

    def list_windows(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        columns = _requested_windows(_read_part(rows[0]["path"]), _named(rows, REQUEST))
        if n_keys:
            kept = _has_shared(_ids(*columns[:3]), rows, n_keys)
            columns = [c[kept] for c in columns]
        columns = _ordered(*columns)
        ids = _ids(*columns[:3])
        out = [_row(WINDOWS, b, rows[0]["part"], rows[0]["path"], pack(*[c[i] for c in columns])) for b, i in _buckets(ids, n_buckets)]
        return pa.Table.from_pylist(out, schema=_ROWS)

    return list_windows


def _meet_windows(table: pa.Table) -> pa.Table:
    """Of one bucket of windows: for each part, those that a smaller document has elsewhere."""
    rows = table.to_pylist()
    own = [unpack(r["blob"]) for r in rows]
    head, tail, more, doc = (np.concatenate([x[i] for x in own]) for i in range(4))
    order, first = _grouped(head, tail, more, doc.view(np.int64))
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(doc.view(np.int64)[order[first]], np.diff(first, append=len(order)))
    out, at = [], 0
    for r, (h, t, m, d) in zip(rows, own, strict=True):
        found = least[at : at + len(h)]
        at += len(h)
        told = found < d.view(np.int64)
        if told.any():
            out.append(_row(WINDOW_ANSWER, r["bucket"], r["part"], r["path"], pack(np.sort(_ids(h[told], t[told], m[told])))))
    return pa.Table.from_pylist(out, schema=_ROWS)


_SPANS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.binary())])
_SPANS_DDL = "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept_sha256 string, kept binary"


def _repeated(ids: np.ndarray, docs: np.ndarray, told: np.ndarray) -> np.ndarray:
    """What a smaller document has: one of another part, which told so of all that this part has, or one of this part."""
    if not len(ids):
        return np.zeros(0, bool)
    order = np.argsort(ids)
    ids, docs = ids[order], docs[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    sizes = np.diff(first, append=len(ids))
    found = np.empty(len(ids), bool)
    found[order] = np.repeat(_inside(ids[first], told), sizes) | (np.repeat(np.minimum.reduceat(docs, first), sizes) < docs)
    return found


def _differing_here(anchors: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ids, in order, of a part's runs that share their anchor with another of its runs."""
    order = np.argsort(anchors)
    anchors, ids = anchors[order], ids[order]
    number = np.cumsum(np.append(False, anchors[1:] != anchors[:-1])) if len(ids) else np.zeros(0, np.int64)
    differ = np.bincount(number[1:][(anchors[1:] == anchors[:-1]) & (ids[1:] != ids[:-1])], minlength=len(ids) + 1) > 0
    return _distinct(ids[differ[number]])


def _remove(texts: bool):
    def remove(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        part = _read_part(next(r["path"] for r in rows if r["kind"] == PART))
        asked = np.union1d(_named(rows, REQUEST), _named(rows, LOCAL))
        cut = []
        for a, _, runs in part.chunks():
            ids = _ids(runs.head, runs.tail, runs.more)
            starts, run, *key = runs.windows(np.flatnonzero(_inside(ids, asked)))
            cut.append((runs.first, runs.last, ids, part.docs[a + runs.row], starts, _ids(*key), part.docs[a + runs.row[run]]))
        sizes = [(len(c[2]), len(c[5])) for c in cut]
        ends = np.cumsum(sizes, axis=0)[:-1]
        wholes = np.split(_repeated(*[np.concatenate([c[i] for c in cut]) for i in (2, 3)], _named(rows, ANSWER)), ends[:, 0])
        hits = np.split(_repeated(*[np.concatenate([c[i] for c in cut]) for i in (5, 6)], _named(rows, WINDOW_ANSWER)), ends[:, 1])
        out = []
        for (a, b), (first, last, _, _, starts, _, _), whole, hit in zip(zip(part.bounds, part.bounds[1:]), cut, wholes, hits, strict=True):
            data = np.frombuffer(b"".join(part.texts.slice(a, b - a).to_pylist()), np.uint8)
            change = np.bincount(np.concatenate((first[whole], starts[hit])), minlength=len(data) + 1)
            change -= np.bincount(np.concatenate((last[whole], starts[hit])) + LENGTH, minlength=len(data) + 1)
            covered = np.cumsum(change[:-1]) > 0
            at = 0
            for i in range(a, b):
                size = int(part.sizes[i])
                own, bytes_ = covered[at : at + size], data[at : at + size]
                at += size
                edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)).tolist() if own.any() else []
                left = bytes_[~own].tobytes() if edges else bytes_.tobytes()
                out.append({
                    "doc_id": int(part.docs[i]), "n_bytes": size,
                    "removed": [{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2])],
                    "kept_sha256": hashlib.sha256(left).hexdigest(), "kept": left if texts else None,
                })
        return pa.Table.from_pylist(out, schema=_SPANS)

    return remove


class SuffixLevels:
    """An index that batches are added to; ``remove`` answers for all of them."""

    def __init__(self, spark: SparkSession, n_buckets: int) -> None:
        self.spark, self.n_buckets, self.n_keys = spark, n_buckets, n_buckets // 4 + 1
        self.folder = scratch_path(spark, "suffix-parts")
        #: Of each level, the largest first: its size in batches, the folder of its files and the table that lists them.
        self.levels: list[tuple[int, str, DataFrame]] = []
        self.scans: list[DataFrame] = []

    def _level_rows(self) -> list[DataFrame]:
        return [rows.withColumn("part", F.lit(i).cast("long")) for i, (_, _, rows) in enumerate(self.levels)]

    def add(self, docs: DataFrame) -> None:
        """Add (doc_id, text) with larger ids than all before: scan against the levels, merging equal ones on the way."""
        self._add_parts(stored(cut_parts(docs, len(self.scans), self.n_buckets, 0, self.folder), "suffix-parts"), 0)

    def add_all(self, batches: list[DataFrame]) -> None:
        """Add the only batches that there will be, which spares what no two parts have from becoming an entry."""
        cut = reduce(DataFrame.unionByName, [cut_parts(docs, i, self.n_buckets, self.n_keys, self.folder) for i, docs in enumerate(batches)])
        parts = stored(cut.groupBy("bucket").applyInArrow(_shared, _DDL), "suffix-parts")
        for i in range(len(batches)):
            self._add_parts(parts.filter(F.shiftright("part", 48) == i), self.n_keys)

    def _by_part(self, rows: DataFrame) -> GroupedData:
        """Small rows, each the work on a part: adaptive execution would put all into a few tasks."""
        return rows.repartition(self.n_buckets, "part").groupBy("part")

    def _add_parts(self, parts: DataFrame, n_keys: int) -> None:
        sizes = [size for size, _, _ in self.levels]
        equal = next(((i, i + 1) for i in range(len(sizes) - 1) if sizes[i] == sizes[i + 1]), ())
        rows = self._by_part(parts).applyInArrow(_send_entries(self.n_buckets, n_keys), _DDL)
        for level in self._level_rows():
            rows = rows.unionByName(level)
        folder = scratch_path(self.spark, "suffix-levels")
        out = stored(rows.groupBy("bucket").applyInArrow(_scan(len(sizes), equal, folder), _DDL), "suffix-scan")
        self.scans.append(out.filter(F.col("kind") != LEVEL))

        def level(size: int, number: int) -> tuple[int, str, DataFrame]:
            return size, f"{folder}/{number}", out.filter((F.col("kind") == LEVEL) & (F.col("part") == number))

        new = level(1, len(sizes))
        if equal:
            for i in equal:
                remove_path(self.spark, self.levels[i][1])
            merged = level(2 * sizes[equal[0]], equal[0])
            self.levels = [*self.levels[: equal[0]], merged, *self.levels[equal[1] + 1 :], new]
        else:
            self.levels.append(new)

    def _answers(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.scans)

    def remove(self, texts: bool = True, last: bool = False) -> DataFrame:
        """Per document: doc_id, n_bytes, removed (spans of bytes), kept_sha256 and kept (null without ``texts``).

        ``last`` deletes the levels once they are read: nothing can be added or asked any more.
        """
        everything = reduce(DataFrame.unionByName, self._level_rows())
        requests = stored(everything.groupBy("bucket").applyInArrow(_differing, _DDL), "suffix-requests")
        if last:
            for _, folder, _ in self.levels:
                remove_path(self.spark, folder)
        known = self._answers()
        places = known.filter(F.col("kind") == PART).select("part", "path")
        located = requests.drop("path").join(places, "part").select("kind", "bucket", "part", "path", "blob")
        keys = self._by_part(located).applyInArrow(_window_keys(self.n_keys), _DDL)
        shared = stored(keys.groupBy("bucket").applyInArrow(_shared, _DDL), "suffix-window-keys")
        listed = self._by_part(located.unionByName(shared)).applyInArrow(_list_windows(self.n_buckets, self.n_keys), _DDL)
        met = stored(listed.groupBy("bucket").applyInArrow(_meet_windows, _DDL), "suffix-windows")
        return self._by_part(known.unionByName(requests).unionByName(met)).applyInArrow(_remove(texts), _SPANS_DDL)


def remove_repeats(docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text: str = "text", texts: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, removed, kept_sha256 and kept, without bytes of a 50-byte string that also starts
    in a document with a smaller id."""
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(quoted(text)), F.lit("")), "UTF-8").alias("text"))
    known = rows.filter("doc_id is not null")
    facts = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.octet_length(F.col(quoted(text))).cast("long").alias("size")).agg(
        F.sum("size").alias("size"), F.count("doc_id").alias("n"), F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("cuts")
    ).first()
    unnamed = rows.filter("doc_id is null").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)").alias("removed"),
        F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept") if texts else F.lit(None).cast("binary").alias("kept"),
    )
    if not facts["n"]:
        return unnamed
    index = SuffixLevels(docs.sparkSession, int(facts["size"] or 0) // BUCKET_BYTES + 1)
    cuts = sorted(set(facts["cuts"] or ()))
    batches = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        inside = F.lit(True)
        if low is not None:
            inside &= F.col("doc_id") > low
        if high is not None:
            inside &= F.col("doc_id") <= high
        batches.append(known.filter(inside))
    index.add_all(batches)
    return index.remove(texts, last=True).unionByName(unnamed)
