"""Logistic regression with an L2 penalty, by Newton steps.

Minimises ``sum of log losses + |w|² / (2 C)``; the intercept bears no penalty. A step needs the gradient and the
Hessian, a few hundred sums: one pass over the rows. Steps are halved while the loss doesn't fall, so the optimum is
reached from anywhere, usually in about ten passes, and to the precision of doubles. Columns are scaled by their mean
square while stepping, which changes nothing but the conditioning. Several models are fitted in the same passes: model
k of ``folds`` learns from the rows of all other folds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.operators.passes import Block, Blocks, matrix


@dataclass(frozen=True)
class Logistic:
    """Weights on the raw features, and the largest entry of the gradient of the mean loss at them."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    gradient: float
    passes: int

    def probability(self) -> Column:
        margin = F.lit(self.intercept)
        for f, w in zip(self.features, self.weights, strict=True):
            margin = margin + F.lit(w) * F.col(f)
        return 1.0 / (1.0 + F.exp(-margin))

    def save(self, spark: SparkSession, path: str) -> None:
        row = [(list(self.features), list(self.weights), self.intercept, self.gradient, self.passes)]
        table = spark.createDataFrame(row, "features array<string>, weights array<double>, intercept double, gradient double, passes int")
        table.coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Logistic:
        r = spark.read.parquet(path).first()
        return Logistic(tuple(r["features"]), tuple(r["weights"]), r["intercept"], r["gradient"], r["passes"])


def fit_logistic(
    rows: DataFrame, features: tuple[str, ...], c: float = 1.0, max_iter: int = 1000, tol: float = 1e-10, folds: int | None = None
) -> list[Logistic]:
    """One model of all rows, or with ``folds`` one for each fold left out, from a table label, fold, x."""
    width = len(features)
    left_out = [None] if folds is None else list(range(folds))
    k_all = len(left_out)

    def packed(part) -> Block:
        label, fold = (part.column(n).to_numpy(zero_copy_only=False) for n in ("label", "fold"))
        return {"x": np.column_stack((matrix(part.column("x"), width), np.ones(len(label)))), "label": label, "fold": fold}

    def own(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
        mine = np.ones(len(block["label"]), bool) if left_out[k] is None else block["fold"] != left_out[k]
        return block["x"][mine], block["label"][mine]

    table = Blocks(rows, packed)
    first = table.sum(lambda block: np.stack([(own(block, k)[0] ** 2).sum(0) for k in range(k_all)]))
    n = first[:, -1]
    scale = np.sqrt(np.maximum(first / np.maximum(n, 1)[:, None], 1e-300))
    scale[first == 0] = 1.0
    penalty = np.append(np.full(width, 1.0 / c), 0.0) / scale**2  # of the scaled weights

    def measured(w: np.ndarray):
        """(loss, gradient, Hessian) of every model at its row of ``w``, the scaled weights."""

        def work(block: Block) -> np.ndarray:
            out = []
            for k in range(k_all):
                x, y = own(block, k)
                x = x / scale[k]
                z = x @ w[k]
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                loss = (np.logaddexp(0, z) - y * z).sum()
                hessian = (x * (p * (1 - p))[:, None]).T @ x
                out.append(np.concatenate(([loss], x.T @ (p - y), hessian.reshape(-1))))
            return np.stack(out)

        sums = table.sum(work)
        loss = sums[:, 0] + (penalty * w * w).sum(1) / 2
        gradient = sums[:, 1 : width + 2] + penalty * w
        hessian = sums[:, width + 2 :].reshape(k_all, width + 1, width + 1) + penalty[:, :, None] * np.eye(width + 1)
        return loss, gradient, hessian

    w = np.zeros((k_all, width + 1))
    loss, gradient, hessian = measured(w)
    passes, share = 2, np.ones(k_all)

    def direction() -> np.ndarray:
        # One class only, or no rows: the intercept has no optimum, a touch of damping ends its way.
        damped = hessian + 1e-9 * np.eye(width + 1)
        return -np.linalg.solve(damped, gradient[:, :, None])[:, :, 0]

    step = direction()
    while passes < max_iter and (np.abs(gradient).max(1) / np.maximum(n, 1) > tol).any():
        tried = w + share[:, None] * step
        got = measured(tried)
        passes += 1
        better = got[0] <= loss + 1e-12 * np.abs(loss)
        if not better.any() and (share < 1e-6).all():
            break
        w = np.where(better[:, None], tried, w)
        loss, gradient, hessian = (
            np.where(better.reshape(-1, *[1] * (new.ndim - 1)), new, old) for new, old in zip(got, (loss, gradient, hessian), strict=True)
        )
        step = np.where(better[:, None], direction(), step)
        share = np.where(better, 1.0, share / 2)
    table.close()
    raw = w / scale
    worst = np.abs(gradient * scale).max(1) / np.maximum(n, 1)
    return [
        Logistic(tuple(features), tuple(map(float, raw[k, :-1])), float(raw[k, -1]), float(worst[k]), passes) for k in range(k_all)
    ]
