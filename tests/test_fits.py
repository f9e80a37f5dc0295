"""Boosted trees and logistic regression against plain Python fits, and their independence of partitions."""

import math
import random

import numpy as np
import pytest

from penprint.operators import boosting, logistic, passes
from penprint.session import run_together

NAMES = ("a", "b", "c")


def make_rows(n, seed=1, folds=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.choice([0.0, 1.5, 2.25, 7.0]), rng.gauss(0, 1), rng.gauss(3, 2)
        label = int(a + 2 * b * b - c + rng.gauss(0, 1) > 0)
        rows.append((label, i % folds, a, b, c))
    return rows


def frame(spark, rows, partitions=4):
    df = spark.createDataFrame(rows, "label int, fold int, a double, b double, c double").repartition(partitions)
    return passes.training_rows(df, NAMES, "fold")


def plain_boost(rows, rounds, rate, depth):
    """Exact greedy trees over all midpoints, rows at a time."""
    x, y = [r[2:] for r in rows], [r[0] for r in rows]
    p0 = sum(y) / len(y)
    start = math.log(p0 / (1 - p0))
    margins, trees = [start] * len(rows), []

    def grow(own, g, h, level):
        best = None
        if level < depth:
            for f in range(len(NAMES)):
                values = sorted({x[i][f] for i in own})
                for low, high in zip(values, values[1:]):
                    cut = (low + high) / 2
                    left = [g[i] for i in own if x[i][f] <= cut]
                    right = [g[i] for i in own if x[i][f] > cut]
                    gain = len(left) * len(right) / len(own) * (sum(left) / len(left) - sum(right) / len(right)) ** 2
                    if best is None or gain > best[0] + 1e-9:
                        best = gain, f, cut
        if best is None or best[0] <= 1e-12:
            return sum(g[i] for i in own) / sum(h[i] for i in own)
        _, f, cut = best
        return f, cut, grow([i for i in own if x[i][f] <= cut], g, h, level + 1), grow([i for i in own if x[i][f] > cut], g, h, level + 1)

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        tree = grow(range(len(rows)), [yi - pi for yi, pi in zip(y, p)], [pi * (1 - pi) for pi in p], 0)
        trees.append(tree)
        margins = [m + rate * value(tree, r) for m, r in zip(margins, x)]
    return lambda row: 1 / (1 + math.exp(-(start + rate * sum(value(t, row) for t in trees))))


def scores(spark, model, rows):
    df = spark.createDataFrame(rows, "label int, fold int, a double, b double, c double")
    return [r[0] for r in df.select(model.probability()).collect()]


def test_boosted_equals_plain_fit(spark):
    rows = make_rows(120)
    [model] = boosting.fit_boosted(frame(spark, rows), NAMES, rounds=25, rate=0.1, depth=3, bins=256)
    plain = plain_boost(rows, 25, 0.1, 3)
    np.testing.assert_allclose(scores(spark, model, rows), [plain(r[2:]) for r in rows], atol=1e-6)


def test_boosted_folds_leave_their_fold_out(spark):
    rows = make_rows(90, seed=2)
    models = boosting.fit_boosted(frame(spark, rows), NAMES, rounds=4, rate=0.3, depth=2, folds=3, bins=256)
    for k, model in enumerate(models):
        plain = plain_boost([r for r in rows if r[1] != k], 4, 0.3, 2)
        own = scores(spark, model, rows)
        inside = [i for i, r in enumerate(rows) if r[1] != k]
        np.testing.assert_allclose([own[i] for i in inside], [plain(rows[i][2:]) for i in inside], atol=1e-6)


def test_boosted_does_not_depend_on_partitions(spark):
    rows = make_rows(300, seed=3)
    one, many = (
        boosting.fit_boosted(frame(spark, list(part), n), NAMES, rounds=22, depth=3, bins=16)[0]
        for part, n in ((rows, 1), (reversed(rows), 9))
    )
    assert one == many and len(one.trees) == 22


def test_boosted_saved(spark, tmp_path):
    [model] = boosting.fit_boosted(frame(spark, make_rows(60)), NAMES, rounds=3)
    model.save(spark, f"{tmp_path}/m")
    assert boosting.BoostedTrees.load(spark, f"{tmp_path}/m") == model


@pytest.mark.parametrize("rows", [[], [(1, 0, 1.0, 2.0, 3.0)] * 5, [(0, 0, 1.0, 2.0, 3.0), (1, 0, 1.0, 2.0, 3.0)]])
def test_fits_without_anything_to_tell(spark, rows):
    [trees] = boosting.fit_boosted(frame(spark, rows), NAMES, rounds=2)
    [line] = logistic.fit_logistic(frame(spark, rows), NAMES)
    share = sum(r[0] for r in rows) / len(rows) if rows else 0.5
    for model in (trees, line):
        for p in scores(spark, model, rows):
            assert abs(p - share) < 1e-3


def test_bins_of_equal_depth(spark):
    rows = [(0, 0, float(i), float(i % 3), 0.0) for i in range(1000)]
    edges = boosting.bin_edges(frame(spark, rows), 3, bins=10)
    assert [len(e) for e in edges] == [9, 2, 0]
    assert edges[0].tolist() == [99.5 + 100 * i for i in range(9)] and edges[1].tolist() == [0.5, 1.5]
    drawn = boosting.bin_edges(frame(spark, rows), 3, bins=10, most=200)
    assert all(abs(d - e) < 120 for d, e in zip(drawn[0], edges[0]))


def test_logistic_reaches_the_optimum(spark):
    rows = [(y, f, 1000 * a, b, c / 100) for y, f, a, b, c in make_rows(400, seed=4)]
    models = logistic.fit_logistic(frame(spark, rows), NAMES, folds=3)
    for k, m in enumerate(models):
        own = [r for r in rows if r[1] != k]
        x, y = np.array([r[2:] for r in own]), np.array([r[0] for r in own])
        w = np.array(m.weights)
        p = 1 / (1 + np.exp(-(x @ w + m.intercept)))
        gradient = np.append(x.T @ (p - y) + w, (p - y).sum()) / len(own)
        assert np.abs(gradient).max() < 1e-8 and m.gradient < 1e-8 and m.passes < 40


def test_run_together(spark):
    found = run_together(spark, {f"n{k}": lambda k=k: spark.range(k).count() for k in range(5)})
    assert found == {f"n{k}": k for k in range(5)}
    with pytest.raises(ValueError):
        run_together(spark, {"a": lambda: int("x"), "b": lambda: 1})
