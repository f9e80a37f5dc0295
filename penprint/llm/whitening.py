"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Vectors are put on a grid of 1/256 (``x = floor(256 c)``); the fit takes every distinct grid vector once. With X the
matrix of those rows less their mean, each step takes the next right vector v, forms u = Xv, takes it against all left
vectors so far, and forms Xᵀu, which is taken against all right vectors so far: one distributed pass for each step.
The left vectors have a number for each row of the corpus, so they are kept as the coefficients w with u = Xw and
formed anew, block by block, wherever they are needed; their leftover inner products are measured on the rows and
removed. What a pass sends to the driver is one sum of about twice the dimensions, added up by Spark beforehand. The
right singular vectors of the small bidiagonal matrix, turned back by the right vectors, are the components; its
singular values give the deviations along them.

A run ends when the residuals of the wanted components vanish or the space is used up; a vanishing coefficient starts
anew from a seeded direction. As one starting vector meets only one direction of an eigenvalue that occurs twice, a
run that ended before the space did is checked by runs orthogonal to the components found, until one shows that
nothing greater is left.

Defined results: rows whose vector is null or holds a null or non-finite entry are left out, and so are those whose
length isn't the most frequent one (of equally frequent, the greatest). A null id is a value. Repeated rows are each
returned with the same numbers and count once in the fit. Directions without variance are no components: a table of
one distinct vector, or an empty one, gives an empty result. Entries beyond a 64-bit grid take its nearest number; a
deviation beyond 64 bits is null. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from penprint.llm.exprs import quoted
from penprint.session import stored

COMPONENTS = 4
#: Entries of a block of rows in a worker.
_BLOCK = 1 << 18
_TINY = 1e-13


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: n distinct vectors and their sums, unit components as rows with the variances along them in
    falling order, the variance in all directions, how far the covariance of the whitened fit list is from the
    identity, and the passes taken."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float
    steps: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def grid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(rows, dimensions): vec_id and x of every usable vector."""
    sound = "v is not null and forall(v, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))"
    usable = vectors.select(F.col(quoted(id_col)).alias("vec_id"), F.col(quoted(vector)).cast("array<double>").alias("v")).filter(sound)
    rows = usable.select("vec_id", F.expr("transform(v, c -> floor(256 * c))").alias("x"))
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    return rows.filter(F.size("x") == d), d


def _blocks(column: pa.Array, d: int) -> Iterator[np.ndarray]:
    """The grid vectors of a batch as matrices of bounded size."""
    rows = max(1, _BLOCK // max(d, 1))
    for at in range(0, len(column), rows):
        part = column.slice(at, rows)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), d)


def _summed(fit_list: DataFrame, d: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``work`` over all blocks of rows: added up in each task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _blocks(batch.column(0), d):
                part = work(x)
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "value"])

    integers = work(np.zeros((0, d), np.int64)).dtype.kind == "i"
    kind, to = ("long", "decimal(38,0)") if integers else ("double", "double")
    sums = fit_list.select("x").mapInArrow(run, f"place int, value {kind}")
    rows = sums.groupBy("place").agg(F.sum(F.col("value").cast(to)).alias("value")).collect()
    return np.array([r["value"] for r in sorted(rows, key=lambda r: r["place"])])


def _exact_sums(x: np.ndarray) -> np.ndarray:
    """Sums of the high and of the low halves of 64-bit integers: neither can overflow in a task."""
    return np.concatenate(((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)))


class _Bidiagonal:
    """One run: right vectors V, coefficients W of the left vectors, Z = Xᵀ XW, and the two diagonals."""

    def __init__(self, passes: Callable[[Callable[[np.ndarray], np.ndarray]], np.ndarray], mean: np.ndarray, locked: np.ndarray, seed: int):
        self.passes, self.mean, self.locked = passes, mean, locked
        self.random = np.random.default_rng(seed)
        self.v = np.zeros((len(mean), 0))
        self.w, self.z = self.v, self.v
        self.alphas: list[float] = []
        self.betas: list[float] = []
        self.following = self._fresh()
        self.scale = 0.0

    def _against(self, r: np.ndarray) -> np.ndarray:
        """``r`` less its part in the span of the right vectors and of the locked components, taken twice."""
        for _ in range(2):
            r = r - self.v @ (self.v.T @ r)
            r = r - self.locked @ (self.locked.T @ r)
        return r

    def _fresh(self) -> np.ndarray:
        """A seeded unit vector that no right vector knows of."""
        r = self._against(self.random.standard_normal(len(self.mean)))
        return r / np.linalg.norm(r)

    @property
    def used_up(self) -> bool:
        return self.v.shape[1] + self.locked.shape[1] >= len(self.mean)

    def step(self) -> None:
        """The next pair of vectors: one pass over the rows."""
        right, mean, old = self.following, self.mean, self.w
        self.v = np.column_stack((self.v, right))
        new = right - old @ (self.z.T @ right)  # as Uᵀ(Xv) is (XᵀU)ᵀv

        def products(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            u = centred @ new
            return np.concatenate(([u @ u], centred.T @ u, (centred @ old).T @ u))

        sums = self.passes(products)
        norm, back, left = sums[0], sums[1 : 1 + len(mean)], sums[1 + len(mean) :]
        new, back = new - old @ left, back - self.z @ left
        alpha = float(np.sqrt(max(norm - left @ left, 0.0)))
        self.scale = max(self.scale, alpha)
        if alpha <= _TINY * self.scale:  # no row has a part in this direction
            alpha, new, back = 0.0, np.zeros_like(new), np.zeros_like(back)
        else:
            new, back = new / alpha, back / alpha
        self.w, self.z = np.column_stack((old, new)), np.column_stack((self.z, back))
        self.alphas.append(alpha)
        r = self._against(back - alpha * right)
        beta = float(np.linalg.norm(r))
        if beta <= _TINY * self.scale or self.used_up:
            beta = 0.0
            self.following = None if self.used_up else self._fresh()
        else:
            self.following = r / beta
        self.betas.append(beta)

    def solve(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(singular values, right vectors as columns, residuals) of the bidiagonal matrix so far."""
        small = np.diag(self.alphas) + np.diag(self.betas[:-1], 1)
        p, values, q = np.linalg.svd(small)
        return values, self.v @ q.T, self.betas[-1] * np.abs(p[-1])


def _components(run: Callable[[np.ndarray, int], _Bidiagonal], d: int, want: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``want`` greatest singular values with their right vectors, and the steps taken."""
    values, vectors, steps, seed = np.zeros(0), np.zeros((d, 0)), 0, 0
    while vectors.shape[1] < d:
        wanted, lanczos = (1 if len(values) else want), run(vectors, seed)
        while True:
            lanczos.step()
            steps += 1
            found, turned, residuals = lanczos.solve()
            if lanczos.used_up or len(found) >= wanted and (residuals[:wanted] <= 1e-15 * max(found[0], lanczos.scale)).all():
                break
            # Nothing in the rest reaches the least of those found, or comes near it.
            if len(values) and found[0] + residuals[0] < values[-1] and len(found) >= 8 and residuals[0] <= 0.01 * found[0]:
                break
        beyond = len(values) and found[0] <= values[-1] * (1 + 1e-12)
        ended = lanczos.used_up and not len(values)
        if beyond:
            break
        sure = want if lanczos.used_up else wanted
        order = np.argsort(-np.concatenate((values, found[:sure])), kind="stable")[:want]
        vectors = np.column_stack((vectors, turned[:, :sure]))[:, order]
        values = np.concatenate((values, found[:sure]))[order]
        if ended:
            break
        seed += 1
    return values, vectors, steps


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector: str = "embedding", seed: int = 0) -> Whitening:
    """Components and variances of all distinct grid vectors."""
    rows, d = grid_vectors(vectors, id_col, vector)
    fit_list = stored(rows.select("x").distinct(), "whitening-fit")
    n = fit_list.count()
    if not n or not d:
        return Whitening(0, [0] * d, np.zeros((0, d)), np.zeros(0), 0.0, 0.0, 0)
    halves = _summed(fit_list, d, _exact_sums)
    sums = [(int(a) << 32) + int(b) for a, b in zip(halves[:d], halves[d:], strict=True)]
    mean = np.array([s / n for s in sums])

    def passes(work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        return _summed(fit_list, d, work)

    def spread(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return np.array([(centred * centred).sum()])

    total = float(passes(spread)[0]) / n
    want = min(components, d)
    if not total > 0:
        return Whitening(n, sums, np.zeros((0, d)), np.zeros(0), 0.0, 0.0, 0)
    values, found, steps = _components(lambda locked, k: _Bidiagonal(passes, mean, locked, seed + k), d, want)
    some = values > 1e-9 * values[0]
    values, found = values[some], found[:, some]
    largest = found[np.abs(found).argmax(0), np.arange(found.shape[1])]
    turned = (found * np.sign(largest)).T
    variances = values * values / n
    scaled = turned / np.sqrt(variances)[:, None]

    middle = passes(lambda x: ((x - mean) @ scaled.T).sum(0)) / n

    def spread_whitened(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ scaled.T - middle
        return (y.T @ y).reshape(-1)

    covariance = passes(spread_whitened).reshape(len(scaled), -1) / n
    error = float(np.abs(covariance - np.eye(len(scaled))).max())
    return Whitening(n, sums, turned, variances, total, error, steps)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sums over the dimensions of (n x - S)², exact; null beyond 64 bits."""
    about = ((n * x.astype(np.float64) - np.array(sums, np.float64)) ** 2).sum(1)
    greatest = n * np.abs(x.astype(np.float64)).max(initial=0) + max(abs(s) for s in sums)
    if about.max(initial=0) < 9e18 and greatest < 9e18:
        part = n * x - np.array(sums, np.int64)
        return pa.array((part * part).sum(1))
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per usable vector and component (from 1): vec_id, component, deviation and whitened."""
    rows, d = grid_vectors(vectors, id_col, vector)
    schema = StructType([
        StructField("vec_id", rows.schema["vec_id"].dataType), StructField("component", IntegerType()),
        StructField("deviation", LongType()), StructField("whitened", DoubleType()),
    ])
    k = len(model.components)
    mean, n, sums = (model.mean if model.n else np.zeros(d)), model.n, model.sums
    components, deviations = model.components, np.sqrt(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _blocks(batch.column(1), d):
                centred = x - mean
                # Row by row sums: equal rows get equal numbers, whatever block they are in.
                y = np.stack([(centred * c).sum(1) / s for c, s in zip(components, deviations, strict=True)], 1)
                every = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.record_batch([
                    batch.column(0).slice(at, len(x)).take(every), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    _deviations(x, n, sums).take(every), pa.array(y.reshape(-1)),
                ], schema=_arrow(batch.schema.field(0).type))
                at += len(x)

    if not k:
        return rows.limit(0).select("vec_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]])
    return rows.select("vec_id", "x").mapInArrow(run, schema)


def _arrow(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("vec_id", id_type), ("component", pa.int32()), ("deviation", pa.int64()), ("whitened", pa.float64())])
