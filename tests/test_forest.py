"""The forest: whole nodes and passes agree, samples and splits against plain Python, files."""

import random

import numpy as np
import pytest

from penprint.operators import forest, passes

NAMES = ("a", "b", "c", "d")


def frame(spark, n=600, partitions=4, names=NAMES):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        a, b, c, d = rng.choice([0.0, 1.5, 7.0]), rng.gauss(0, 1), rng.gauss(3, 2), rng.random()
        rows.append((i, int(a + 2 * b * b - c + rng.gauss(0, 1) > 0), i % 3, a, b, c, d))
    df = spark.createDataFrame(rows, "id long, label int, fold int, a double, b double, c double, d double").repartition(partitions)
    return passes.training_rows(df, names, "fold", "id")


def arrays(f):
    return [f.roots, f.left, f.feature, f.cut, f.value]


def test_passes_over_large_nodes_grow_the_same_trees(spark, monkeypatch):
    rows = frame(spark)
    want = forest.fit_forest(rows, NAMES, 6, 9)
    for most in (200, 10):
        monkeypatch.setattr(forest, "NODE_ROWS", most)
        got = forest.fit_forest(frame(spark, partitions=7), NAMES, 6, 9)
        assert all((x == y).all() for x, y in zip(arrays(got), arrays(want), strict=True))
        assert got.importances == pytest.approx(want.importances)
    assert sum(want.importances) == pytest.approx(1.0)


def test_trees_are_those_of_plain_python(spark):
    """Two features, of which two are drawn: every split is over all features, over the rows of the tree's sample."""
    names = NAMES[:2]
    found = frame(spark, names=names).collect()
    got = forest.fit_forest(frame(spark, names=names), names, 3, 4)
    keys = np.array([r["key"] for r in found], np.int64).view(np.uint64)

    def impurity(own):
        n, one = sum(w for w, *_ in own), sum(w for w, y, _ in own if y)
        return 2 * one * (n - one) / n if n else 0.0

    def grow(own, level):
        best = (1e-9 * sum(w for w, *_ in own), None)
        for f in range(len(names)) if level < 4 else ():
            for cut in got.edges[f]:
                left, right = [r for r in own if r[2][f] <= cut], [r for r in own if r[2][f] > cut]
                gain = impurity(own) - impurity(left) - impurity(right)
                if left and right and gain > best[0] + 1e-9:
                    best = gain, left, right
        if best[1] is None:
            return [sum(w for w, y, _ in own if y) / sum(w for w, *_ in own)] * len(own), own
        parts = [grow(side, level + 1) for side in best[1:]]
        return [v for p in parts for v in p[0]], [r for p in parts for r in p[1]]

    for tree in range(3):
        weights = forest._weights(keys, 42, tree)
        own = [(int(w), r["label"], tuple(r["x"])) for w, r in zip(weights, found, strict=True) if w]
        values, rows = grow(own, 0)
        one = forest.Forest(names, got.edges, got.importances, 4, got.roots[tree : tree + 1], got.left, got.feature, got.cut, got.value)
        assert one.mean_values(np.array([r[2] for r in rows])) == pytest.approx(values)


def test_weights_are_poisson():
    weights = forest._weights(np.arange(100_000, dtype=np.uint64), 42, 7)
    share = np.bincount(weights, minlength=4)[:4] / len(weights)
    assert share == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.006)


def test_a_fold_left_out_and_files(spark, tmp_path):
    rows = frame(spark)
    left_out = forest.fit_forest(rows, NAMES, 4, 5, left_out=1)
    alone = forest.fit_forest(rows.where("fold != 1"), NAMES, 4, 5)
    assert all((x == y).all() for x, y in zip(arrays(left_out), arrays(alone), strict=True))

    alone.save(spark, f"{tmp_path}/f")
    again = forest.Forest.load(spark, f"{tmp_path}/f")
    assert all((x == y).all() for x, y in zip(arrays(again), arrays(alone), strict=True))
    assert (again.features, again.edges, again.importances, again.depth) == (alone.features, alone.edges, alone.importances, alone.depth)
    nodes = {(r["tree"], r["node"]): r for r in forest.read_nodes(spark, f"{tmp_path}/f").collect()}
    assert len(nodes) == len(alone.left)
    for r in rows.limit(40).collect():
        values = []
        for tree in range(4):
            at = nodes[tree, 0]
            while at["value"] is None:
                at = nodes[tree, at["left"] if r["x"][NAMES.index(at["feature"])] <= at["threshold"] else at["right"]]
            values.append(at["value"])
        assert alone.mean_values(np.array([r["x"]])) == pytest.approx([sum(values) / 4])


def test_nothing_to_learn(spark):
    rows = spark.createDataFrame([(0, -1, [1.0, 2.0], 1), (1, -1, [1.0, 2.0], 2), (1, -1, [1.0, 2.0], 3)], "label int, fold int, x array<double>, key long")
    flat = forest.fit_forest(rows, ("a", "b"), 5, 3)
    assert len(flat.left) == 5 and set(flat.importances) == {0.0} and ((0 <= flat.value) & (flat.value <= 1)).all()
    with pytest.raises(ValueError, match="rows"):
        forest.fit_forest(rows.limit(0), ("a", "b"))
