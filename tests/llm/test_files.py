import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from penprint.llm import token_files as t
from penprint.llm import warc as w

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_encode_as_whole_texts(hard_texts):
    import pyarrow as pa

    texts = [x or "" for x in hard_texts] + ["Don't we'll it's", "A.B ,c! ?", "É́ İstanbul ǅ Ⅷ x²", "　ideographic space"]
    ids, lengths = t.PieceEncoder(PATH).encode(pa.array(texts), 1)
    encodings = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    at = 0
    for n, e in zip(lengths.tolist(), encodings, strict=True):
        assert ids[at : at + n].tolist() == [*e.ids, 1]
        at += n


def test_ids_are_looked_up_in_little_memory():
    import tracemalloc

    encoder = t.PieceEncoder(PATH)
    codes = np.tile(np.array(encoder._add_texts(["one", "another", "tokenization", "x"]), np.int64), 500_000)
    one = np.concatenate([encoder._ids(codes[:4][i : i + 1]) for i in range(4)])
    tracemalloc.start()
    ids = encoder._ids(codes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (ids.reshape(-1, len(one)) == one).all()
    assert peak < 4 * ids.nbytes


def test_texts_beyond_one_call_of_the_tokenizer():
    import pyarrow as pa

    texts = [" ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{i}-{i}" for i in range(k, k + 700)) for k in (0, 400)]
    ids, lengths = t.PieceEncoder(PATH).encode(pa.array(texts), 1)
    want = [[*e.ids, 1] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and lengths.tolist() == list(map(len, want))


def test_workers_encode_without_threads_of_the_tokenizer(monkeypatch):
    import os

    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "")  # restored after the test
    monkeypatch.delenv("TOKENIZERS_PARALLELISM")
    t._encoder.cache_clear()
    t._encoder(PATH)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_token_files_round_trip(spark, hard):
    manifest = t.write_token_files(hard, PATH, sequence=64)
    got = t.read_documents(manifest).collect()
    rows = sorted(hard.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    encodings = Tokenizer.from_file(PATH).encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    want, start = [], 0
    for r, e in zip(rows, encodings, strict=True):
        ids = np.array([*e.ids, 1], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda x: x[1]
    assert sorted(map(tuple, got), key=key) == want
    for row in manifest.collect():
        file = t.TokenFile(row.tokens_path)
        n = -(-row.n_tokens // 64)
        assert sum(sum(file.sequence_mask(i).to_pylist()) for i in range(n)) == row.n_tokens
        whole = np.concatenate([file.sequence_ids(i) for i in range(n)])
        assert (whole[: row.n_tokens] == file.tokens(0, row.n_tokens)).all()
        assert not file.sequence_ids(0).flags.owndata


def test_no_documents_no_files(empty):
    manifest = t.write_token_files(empty, PATH)
    assert manifest.count() == 0 and t.read_documents(manifest).count() == 0


@pytest.mark.parametrize("size", [0, 1, 5, 8192, 20_001])
def test_chunks(size):
    body = bytes(i % 251 for i in range(size))
    assert w.dechunked(w.chunked(body, 7)) == w.dechunked(w.chunked(body)) == body
    assert w.dechunked(b"3;x=y\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"


def test_damage_is_found():
    for bad in (b"3\r\nab", b"3\r\nabcd\r\n0\r\n\r\n", b"zz"):
        with pytest.raises(ValueError):
            w.dechunked(bad)
    parts = [{"number": 1, "total": None, "block": b"HTTP/1.1 200 OK\r\n\r\n"}, {"number": 2, "total": 22, "block": b"abc"}]
    digest = w.payload_digest(b"abc")
    assert w.reassembled("o", parts[::-1], digest) == b"abc"
    for broken in ([parts[0]], [parts[1]], [parts[0], parts[1] | {"total": 23}], [parts[0], parts[1] | {"block": b"abd"}]):
        with pytest.raises(ValueError):
            w.reassembled("o", broken, digest)


def test_archives_round_trip(spark, hard):
    pages = hard.selectExpr("doc_id as page_id", "concat('http://x/', doc_id) as url", "text as html", "size", "a")
    manifest = w.write_archives(pages, segment_bytes=900, file_bytes=20_000)
    rows = w.read_archives(manifest).collect()
    assert len(rows) == pages.count()
    source = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = {}
    for i, body in source:
        if i is not None:
            first[body] = min(first.get(body, i), i)
    want = sorted(
        (i is None, i or 0, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if i is None or first[b] == i else "revisit")
        for i, b in source
    )
    assert want == sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type) for r in rows)
    bodies = dict(source)
    for r in rows:
        if r.record_type == "revisit":
            assert r.refers_to == first[bodies[r.page_id]] and r.payload is None
        else:
            assert r.refers_to is None and w.payload_digest(r.payload) == r.payload_digest
    assert manifest.count() > 1 and manifest.groupBy().sum("n_records").first()[0] > len(rows)


def test_no_pages(empty):
    manifest = w.write_archives(empty.selectExpr("doc_id as page_id", "a as url", "text as html"))
    assert manifest.count() == 0 and w.read_archives(manifest).count() == 0
