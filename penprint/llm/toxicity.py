"""Toxicity by compression distance: windows that a toxic dictionary shortens more than an ordinary one.

Two zstandard dictionaries are trained on a bounded sample of labelled texts. The ordinary one comes from windows of
ordinary texts. The toxic one comes from toxic passages: words that toxic texts use, relative to ordinary ones, in many
more distinct contexts (a likelihood-ratio test over contexts, so that a text copied many times counts once); it is
followed by the ordinary dictionary, so that ordinary language costs the same under both. Every window of every whole
text is compressed with both, and the largest savings, with the number of windows, give a probability whose
thresholds are calibrated by logistic regression on the sample.

Windows are under 64 bytes: up to there the format never switches its coding of literals, a jump that would drown
the saving of a word.

The bound: ``SAMPLE`` labelled rows of each class, drawn by a hash of the id, and of those texts up to ``LONGEST``
bytes. Scoring has no bound: all windows of all texts.

Defined results: null and empty texts have one empty window and get the score of no saving; repeated rows get equal
scores; labels repeated for one id count once, as toxic if any says so; without labels of both classes the score is
the smoothed rate of toxic labels. Only id and text of documents are read, and the id only to find labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.llm.exprs import quoted

SAMPLE = 4000
LONGEST = 32 << 10
WINDOW, STEP = 62, 31
LEVEL = 9
_ORDINARY_BYTES = 12_000
#: The least likelihood ratio (G squared) and rate ratio of a toxic word's contexts.
_LEAST_G, _LEAST_RATIO = 22.0, 8.0


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries and the weights of (1, largest saving, second largest, log of the number of windows)."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    rate: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.rate)
        return _sigmoid(savings(texts, self.ordinary, self.toxic) @ np.array(self.weights))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
    content.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=how)


def savings(texts: list[str | None], ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Per text: 1, the largest and second largest saving of a window in bytes, log of the number of windows."""
    plain, other = _compressor(ordinary).compress, _compressor(toxic + ordinary).compress
    out = np.ones((len(texts), 4))
    for i, text in enumerate(texts):
        data = b" %b " % " ".join((text or "").lower().split()).encode()
        best = second = -99
        last = max(len(data) - WINDOW, 0)
        for at in range(0, last + STEP if last else 1, STEP):
            window = data[at : at + WINDOW]
            saved = len(plain(window)) - len(other(window))
            if saved > second:
                best, second = (saved, best) if saved > best else (best, saved)
        out[i, 1:] = best, max(second, 0), np.log(last // STEP + 1)
    return out


def toxic_words(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Words, strongest first, that toxic texts use in many more distinct (word before, word after) contexts."""
    codes: dict[str, int] = {}
    seen = []
    for texts in (toxic, ordinary):
        keys = []
        for text in texts:
            words = [w.strip(".,;:!?\"'()") for w in text.lower().split()]
            own = np.array([0, *[codes.setdefault(w, len(codes) + 1) for w in words], 0], np.uint64)
            context = (own[:-2] * np.uint64(0x9E3779B97F4A7C15) + own[2:]) * np.uint64(0xD6E8FEB86659FD93)
            keys.append(np.stack((own[1:-1], context), 1))
        pairs = np.unique(np.concatenate(keys), axis=0) if keys else np.zeros((0, 2), np.uint64)
        seen.append(np.bincount(pairs[:, 0].astype(np.int64), minlength=0))
    size = len(codes) + 1
    a, b = (np.pad(s, (0, size - len(s))).astype(float) for s in seen)
    na, nb = max(a.sum(), 1), max(b.sum(), 1)
    both = np.maximum(a + b, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(a > 0, a * np.log(a / (both * na / (na + nb))), 0) + np.where(b > 0, b * np.log(b / (both * nb / (na + nb))), 0))
    g[a * nb <= _LEAST_RATIO * (b + 0.5) * na] = 0
    names = ["", *codes]
    return [names[i] for i in np.argsort(-g, kind="stable") if g[i] >= _LEAST_G and len(names[i].encode()) >= 4]


def _trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary's content, by zstandard's trainer; too few samples stand for themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()[-size + min(200, size // 4) :]
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
    return w


def train_on(toxic: list[str], ordinary: list[str]) -> ToxicityModel:
    """A model from the texts of both classes."""
    rate = (len(toxic) + 1) / (len(toxic) + len(ordinary) + 2)
    if not toxic or not ordinary:
        return ToxicityModel(b"", b"", (), rate)
    windows = [w for t in ordinary for t in [t.lower().encode()] for i in range(0, len(t), 400) if (w := t[i : i + 400])]
    plain = _trained(windows[:: max(1, len(windows) // 20_000)], _ORDINARY_BYTES)
    words = toxic_words(toxic, ordinary)
    known = frozenset(words)
    passages = ["".join(f" {c} " for w in t.lower().split() if (c := w.strip(".,;:!?\"'()")) in known) for t in toxic]
    size = min(max(3 * sum(len(w.encode()) + 1 for w in words) // 2, 256), 3500)
    poison = _trained([p.encode() for p in passages if p] * 3, size) if words else b""
    x = savings([*toxic, *ordinary], plain, poison)
    y = np.repeat([1.0, 0.0], [len(toxic), len(ordinary)])
    return ToxicityModel(plain, poison, tuple(_logistic(x, y).tolist()), rate)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> ToxicityModel:
    """Train on at most about ``sample`` labelled documents of each class."""
    known = (
        labels.filter(F.col(quoted(label)).isNotNull() & F.col(quoted(id_col)).isNotNull())
        .groupBy(F.col(quoted(id_col)).alias("labelled")).agg(F.max(quoted(label)).alias("label"))
    )
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("label") == value, min(1.0, sample / n)).otherwise(share)
    draw = F.conv(F.substring(F.md5(F.col("labelled").cast("string")), 1, 8), 16, 10).cast("double") / float(16**8)
    drawn = known.filter(draw < share)  # about two samples of ids
    texts = docs.select(F.col(quoted(id_col)).alias("labelled"), F.col(quoted(text)).alias("text"))
    texts = texts.filter(F.octet_length("text").between(1, LONGEST))
    rows = texts.join(F.broadcast(drawn), "labelled").select("label", "text").distinct().collect()
    rows.sort(key=lambda r: (r["label"], r["text"]))
    sides = [[r["text"] for r in rows if (r["label"] > 0) == side][:sample] for side in (True, False)]
    return train_on(*sides)


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, score (0 to 1) and predicted (1 if at least a half)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(batch.column(1).to_pylist())
            yield pa.record_batch(
                [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double, predicted int")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """The rows that are never learned from: checksum of the id divisible by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string")) % folds == 0, F.lit(False))
