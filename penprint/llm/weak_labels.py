"""Quality classifier from weak labels: accuracies of overlapping labellers by EM, then a hashed linear scorer.

Labellers are column expressions that vote good (1), bad (0) or nothing. All documents' votes are counted by pattern
(3 to the power of the number of labellers at most, so the table has a bound), and expectation-maximisation on the
counts estimates each labeller's chance of each vote given the unseen class. A document's posterior follows from its
votes. The posteriors of a bounded sample train a logistic scorer on hashed features: byte trigrams of the whole text
and the labellers' figures in steps, so that the scorer also judges where labellers abstain.

The bound: ``SAMPLE`` documents, drawn by a hash of their text, fit the scorer; the accuracies come from all documents
and every whole text is scored.

Defined results: null counts as an empty text, which the length labeller calls bad; repeated rows get equal scores;
an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.llm.exprs import quoted
from penprint.llm.quality_rules import base_metrics
from penprint.llm.shingles import chunks
from penprint.session import stored

SAMPLE = 6000
FEATURES = 1 << 12


@dataclass(frozen=True)
class Labeller:
    """Votes bad where ``figure`` is inside ``bad``, good where it is inside ``good``, else nothing."""

    name: str
    figure: str
    bad: str
    good: str


#: Figures are SQL over the struct m of ``base_metrics`` and n, its words (1 at least); x is the figure.
LABELLERS = (
    Labeller("symbols", "m.n_symbols / n", "x > 0.2", "x < 0.02"),
    Labeller("shouting", "m.n_bangs / n", "x > 0.2", "x < 0.02"),
    Labeller("repetition", "m.n_repeat_words / n", "x > 0.5", "x < 0.2"),
    Labeller("echo", "m.n_repeat_words / n", "x > 0.45", "x < 0.1"),
    Labeller("function_words", "m.n_stop / n", "m.n_words >= 30 and (x < 0.03 or x > 0.5)", "m.n_words >= 30 and x between 0.1 and 0.4"),
    Labeller("word_length", "m.word_chars / n", "m.n_words >= 30 and (x < 3.5 or x > 7)", "m.n_words >= 30 and x between 4 and 6"),
    Labeller("lines", "m.n_dup_lines / greatest(m.n_lines, 1)", "x > 0.4", "x < 0.2 and m.n_lines > 1"),
    Labeller("length", "m.n_words", "x < 1", "x >= 50"),
)
_STEPS = 20
#: Rows whose features a worker holds at a time.
_ROWS = 512


def vote_columns(labellers: tuple[Labeller, ...] = LABELLERS) -> tuple[Column, Column]:
    """(votes, figures in steps): arrays over the labellers, from a struct column ``m``."""
    figures = [f"cast({x.figure.replace('/ n', '/ greatest(m.n_words, 1)')} as double)" for x in labellers]
    votes = [
        f"element_at(transform(array({f}), x -> case when {x.bad} then 0 when {x.good} then 1 end), 1)"
        for x, f in zip(labellers, figures, strict=True)
    ]
    steps = [f"cast(least(floor(10 * ln(1 + {f})), {_STEPS - 1}) as int)" for f in figures]
    return F.expr(f"array({', '.join(votes)})"), F.expr(f"array({', '.join(steps)})")


@dataclass(frozen=True)
class LabelModel:
    """log_chance[y][labeller][vote] with vote 2 for none, and the log odds of a good document before any vote."""

    log_chance: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of good, of rows of votes (0, 1 or 2)."""
        each = np.arange(votes.shape[1])
        odds = self.prior + (self.log_chance[1][each, votes] - self.log_chance[0][each, votes]).sum(1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, steps: int = 100) -> LabelModel:
    """EM from the majority vote; smoothing keeps every chance above 0."""
    good, bad = (patterns == 1).sum(1), (patterns == 0).sum(1)
    belief = np.clip((good + 0.5) / (good + bad + 1), 0.05, 0.95)
    # One bad vote is evidence against many weak good ones: defects are seldom several at once.
    belief = np.where(bad > 0, np.minimum(belief, 0.3), belief)
    model = LabelModel(np.zeros((2, patterns.shape[1], 3)), 0.0)
    for _ in range(steps):
        weight = np.stack(((1 - belief) * counts, belief * counts))
        chance = np.stack([
            [[weight[y][patterns[:, j] == v].sum() + 0.1 for v in range(3)] for j in range(patterns.shape[1])] for y in range(2)
        ])
        chance /= chance.sum(2, keepdims=True)
        model = LabelModel(np.log(chance), float(np.log((weight[1].sum() + 1) / (weight[0].sum() + 1))))
        new = model.posterior(patterns)
        if np.abs(new - belief).max() < 1e-6:
            break
        belief = new
    return model


def hashed_features(texts: pa.Array, steps: np.ndarray) -> np.ndarray:
    """Rows of ``FEATURES``: square roots of the shares of hashed byte trigrams, and a one for each labeller's step."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    texts = pc.fill_null(texts, "")
    lengths = pc.binary_length(texts).to_numpy().astype(np.int64)
    data = np.frombuffer(b"".join(t.encode() for t in texts.to_pylist()), np.uint8).astype(np.uint32)
    if len(data) > 2:
        gram = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        place = (gram * np.uint32(0x9E3779B1)) >> np.uint32(20)
        owner = np.repeat(np.arange(len(texts)), lengths)
        inside = owner[:-2] == owner[2:]
        flat = np.bincount(owner[:-2][inside] * FEATURES + place[inside], minlength=out.size)
        out[:] = np.sqrt(flat.reshape(out.shape) / np.maximum(lengths - 2, 1)[:, None])
    n = steps.shape[1]
    code = (np.arange(n) * _STEPS + steps + 1).astype(np.uint32) * np.uint32(0x85EBCA6B)
    np.add.at(out, (np.repeat(np.arange(len(texts)), n), (code >> np.uint32(20)).reshape(-1)), 1)
    return out


def fit_scorer(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights and bias of a logistic scorer of soft labels, by accelerated gradient steps."""
    w, velocity = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32)
    for _ in range(steps if len(x) else 0):
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        gradient = np.append(x.T @ (p - y), (p - y).sum()).astype(np.float32) / len(x) + np.float32(decay) * w
        velocity = np.float32(0.9) * velocity - np.float32(rate) * gradient
        w = w + velocity
    return w


def linear_scores(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The chance of good of each row, each summed by itself in one order: equal rows get equal scores in any batch."""
    odds = (x * weights[:-1]).sum(axis=1, dtype=np.float64) + np.float64(weights[-1])
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of bounded bytes of text and bounded rows."""
    for part in chunks(batch, text):
        for at in range(0, part.num_rows, _ROWS):
            yield part.slice(at, _ROWS)


def _matrix(lists: pa.Array, missing: int) -> np.ndarray:
    values = pc.fill_null(lists.flatten(), missing).to_numpy()
    return values.reshape(len(lists), -1).astype(np.int64)


def score_quality(docs: DataFrame, labellers: tuple[Labeller, ...] = LABELLERS, sample: int = SAMPLE, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_votes, posterior (of its votes), score (of the scorer) and kept (score at least a half)."""
    votes, steps = vote_columns(labellers)
    table = docs.select(
        F.col(quoted(id_col)).cast("long").alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"), base_metrics(text).alias("m")
    ).select("doc_id", "text", F.md5("text").alias("digest"), votes.alias("votes"), steps.alias("steps"))
    table = stored(table, "weak-votes")  # with the texts, so that the figures are computed once
    counted = table.groupBy("votes").count().toArrow()
    n_docs = sum(counted.column("count").to_pylist())
    if not n_docs:
        return table.select("doc_id", F.lit(0).alias("n_votes"), *[F.lit(0.0).alias(c) for c in ("posterior", "score")], F.lit(False).alias("kept"))
    patterns = _matrix(counted.column("votes").combine_chunks(), 2)
    model = fit_label_model(patterns, counted.column("count").to_numpy())

    limit = f"{min(int(16**8 * sample / n_docs), 16**8 - 1):08x}"
    vectors = table.filter(F.substring("digest", 1, 8) <= limit).dropDuplicates(["digest"])

    def vectorize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 0):
                x = hashed_features(part.column(0), _matrix(part.column(1), 0)).astype(np.float16)
                rows = pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.record_batch([rows, pa.array(model.posterior(_matrix(part.column(2), 2)))], names=["x", "y"])

    fitted = vectors.select("text", "steps", "votes", "digest").sort("digest").drop("digest").mapInArrow(vectorize, "x binary, y double").toArrow()
    raw = b"".join(fitted.column("x").to_pylist())
    x = np.frombuffer(raw, np.float16).reshape(-1, FEATURES).astype(np.float32)
    weights = fit_scorer(x, fitted.column("y").to_numpy().astype(np.float32))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                given = _matrix(part.column(2), 2)
                found = linear_scores(hashed_features(part.column(1), _matrix(part.column(3), 0)), weights)
                columns = [
                    part.column(0), pa.array((given < 2).sum(1).astype(np.int32)), pa.array(model.posterior(given)),
                    pa.array(found), pa.array(found >= 0.5),
                ]
                yield pa.record_batch(columns, names=["doc_id", "n_votes", "posterior", "score", "kept"])

    rows = table.select("doc_id", "text", "votes", "steps")
    return rows.mapInArrow(score, "doc_id long, n_votes int, posterior double, score double, kept boolean")
