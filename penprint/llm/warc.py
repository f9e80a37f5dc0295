"""WARC archives: records written with chunked bodies and segments, and put together again when read.

Writing: a payload that an earlier page (smaller id) has too becomes a revisit record. A response's HTTP body is
in chunked transfer framing; a block longer than ``segment_bytes`` is cut into a first record and continuation
records, which may lie in other files. Every record is a gzip member of its own; files are rolled by size.

Reading: tasks parse files as streams, one record at a time. Records are grouped by the identifier of the record
where their segments begin, ordered by segment number, checked against the total length of the last segment,
freed of chunk framing, and checked against the payload digest. A group holds the segments of one record only.

Defined results: a null payload is empty; a null page id is never a revisit nor referred to; rows that share the
smallest id of their payload are responses; an empty table writes no files and gives an empty result. Columns
other than id, URL and payload are not read. A record that is damaged raises an error, which names it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.llm import files
from penprint.llm.exprs import quoted
from penprint.session import scratch_path, spread, stored

SEGMENT_BYTES = 32 << 10
FILE_BYTES = 32 << 20
CHUNK_BYTES = 8 << 10
_READ_BYTES = 1 << 20
_MANIFEST = pa.schema([("path", pa.string()), ("n_records", pa.int64())])
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class DamagedRecord(ValueError):
    """A record that doesn't say what its headers promise."""


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in chunked transfer framing."""
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(framed: bytes) -> bytes:
    """The body of chunked transfer framing; chunk extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16) if end > at else -1
        if size < 0 or end + 2 + size > len(framed):
            raise DamagedRecord(f"bad chunk at byte {at}")
        if not size:
            return b"".join(parts)
        parts.append(framed[end + 2 : end + 2 + size])
        at = end + 2 + size
        if framed[at : at + 2] != b"\r\n":
            raise DamagedRecord(f"chunk without an end at byte {at}")
        at += 2


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(first: str, fields: dict[str, object]) -> bytes:
    return "\r\n".join([first, *[f"{k}: {v}" for k, v in fields.items() if v is not None], "", ""]).encode()


def _record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    head = _header("WARC/1.1", {"WARC-Type": kind, **fields, "WARC-Date": "1970-01-01T00:00:00Z", "Content-Length": len(block)})
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head + block + b"\r\n\r\n") + press.flush()


def page_records(page_id: int | None, url: str | None, payload: bytes, first: int | None, copy: str, segment_bytes: int) -> Iterator[bytes]:
    """The records of a page, as gzip members: a revisit, or a response and its continuations."""
    digest = payload_digest(payload)
    name = f"urn:page:{'' if page_id is None else page_id}:{digest}"
    uri = " ".join((url or "about:blank").split())
    own = {"WARC-Record-ID": f"<{name}:{copy}>", "WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{digest}"}
    if page_id is not None and first is not None and first != page_id:
        block = _header("HTTP/1.1 304 Not Modified", {"Content-Length": len(payload)})
        yield _record("revisit", own | {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{first}:{digest}>"}, block)
        return
    block = _header("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Transfer-Encoding": "chunked"}) + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record("response", own, block)
        return
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record("response", own | {"WARC-Segment-Number": 1}, parts[0])
    for n, part in enumerate(parts[1:], 2):
        later = {"WARC-Record-ID": f"<{name}:{copy}:{n}>", "WARC-Segment-Origin-ID": f"<{name}:{copy}>", "WARC-Segment-Number": n}
        yield _record("continuation", later | {"WARC-Segment-Total-Length": len(block) if n == len(parts) else None}, part)


def write_archives(
    pages: DataFrame, folder: str | None = None, segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES,
    id_col: str = "page_id", url: str = "url", payload: str = "html",
) -> DataFrame:
    """Write all pages; the manifest (path, n_records) of the archives that finished tasks wrote."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, n, row = None, "", 0, 0, 0
        partition = TaskContext.get().partitionId()

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "n_records": n}], schema=_MANIFEST)

        for batch in batches:
            for page_id, uri, body, first in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                row += 1
                for member in page_records(page_id, uri, body, first, f"{partition}-{row}", segment_bytes):
                    if out and size >= file_bytes:
                        yield done()
                        out = None
                    if not out:
                        path, size, n = f"{folder}/{files.unique_name('archive', partition, '.warc.gz')}", 0, 0
                        out = files.create(path)
                    out.write(member)
                    size, n = size + len(member), n + 1
        if out:
            yield done()

    rows = pages.select(
        F.col(quoted(id_col)).cast("long").alias("page_id"),
        F.col(quoted(url)).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(quoted(payload)), F.lit("")), "UTF-8").alias("body"),
    ).withColumn("digest", F.sha1("body"))
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    known = rows.join(firsts, "digest").select("page_id", "url", "body", "first")
    return stored(known.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def _members(path: str) -> Iterator[bytes]:
    """The gzip members of a file, read as a stream."""
    with files.open_stream(path) as source:
        inflate, parts, data = zlib.decompressobj(31), [], b""
        while data := data or source.read(_READ_BYTES):
            parts.append(inflate.decompress(data))
            data = b""
            if inflate.eof:
                yield b"".join(parts)
                data, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
        if any(parts):
            raise DamagedRecord(f"{path} ends inside a record")


def _fields(head: bytes) -> dict[str, str]:
    pairs = [line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:]]
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields, in lower case, and the block of one record."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/"):
        raise DamagedRecord(f"no record: {raw[:60]!r}")
    fields = _fields(head)
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise DamagedRecord(f"{fields.get('warc-record-id')}: block of another length")
    return fields, rest[:n]


def payload_of(block: bytes, origin: str) -> bytes:
    """The payload of a whole HTTP response block."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        raise DamagedRecord(f"{origin}: no HTTP header")
    return dechunked(body) if _fields(head).get("transfer-encoding", "").lower() == "chunked" else body


_READ = pa.schema([
    ("origin", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("digest", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("n_bytes", pa.int64()), ("block", pa.binary()),
])
_READ_DDL = (
    "origin string, page_id long, record_type string, refers_to long, digest string, number long, total long, "
    "n_bytes long, block binary"
)


def _page_of(uri: str) -> int | None:
    own = uri.strip("<>").split(":")[2]
    return int(own) if own else None


def _row(raw: bytes, payloads: bool) -> dict[str, object]:
    fields, block = parse_record(raw)
    kind, uri = fields["warc-type"], fields["warc-record-id"]
    number = fields.get("warc-segment-number")
    row: dict[str, object] = {
        "origin": fields.get("warc-segment-origin-id", uri), "page_id": _page_of(uri), "record_type": kind,
        "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "number": int(number) if number else None,
        "total": int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None,
    }
    if kind == "revisit":
        stated = _fields(block.partition(b"\r\n\r\n")[0])["content-length"]
        return row | {"refers_to": _page_of(fields["warc-refers-to"]), "n_bytes": int(stated)}
    if number:
        return row | {"block": block}
    payload = _checked(payload_of(block, uri), row["digest"], uri)
    return row | {"n_bytes": len(payload), "block": payload if payloads else None}


def _checked(payload: bytes, digest: object, origin: str) -> bytes:
    if payload_digest(payload) != digest:
        raise DamagedRecord(f"{origin}: payload of another digest")
    return payload


def reassembled(origin: str, segments: list[dict], digest: str) -> bytes:
    """The payload of a record from its segments, in any order."""
    segments = sorted(segments, key=lambda s: s["number"])
    if [s["number"] for s in segments] != list(range(1, len(segments) + 1)):
        raise DamagedRecord(f"{origin}: segments {[s['number'] for s in segments]}")
    block = b"".join(s["block"] for s in segments)
    if segments[-1]["total"] != len(block):
        raise DamagedRecord(f"{origin}: {len(block)} bytes of {segments[-1]['total']}")
    return _checked(payload_of(block, origin), digest, origin)


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to and payload.

    A revisit has no payload of its own; its length and digest are those of the full one. Without ``payloads``
    only segments' bytes travel to where they are put together, and the column is null.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for raw in _members(path):
                    rows.append(_row(raw, payloads))
                    size += len(raw)
                    if size > 4 * _READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    result = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                n, payload = r["n_bytes"], r["block"]
                if r["segments"]:
                    payload = reassembled(r["origin"], r["segments"], r["digest"])
                    n = len(payload)
                rows.append({
                    "page_id": r["page_id"], "payload_bytes": n, "payload_digest": r["digest"],
                    "record_type": r["record_type"], "refers_to": r["refers_to"], "payload": payload if payloads else None,
                })
            yield pa.RecordBatch.from_pylist(rows, schema=result)

    parsed = spread(manifest.select("path"), "path").mapInArrow(parse, _READ_DDL)
    whole = F.col("number").isNull()
    first = F.col("record_type") != "continuation"
    records = parsed.groupBy("origin").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("page_id", "record_type", "refers_to", "digest", "n_bytes")],
        F.max(F.when(whole, F.col("block"))).alias("block"),
        F.collect_list(F.when(~whole, F.struct("number", "total", "block"))).alias("segments"),
    )
    return records.mapInArrow(
        assemble,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )
