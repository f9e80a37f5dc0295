"""A random forest for two classes, by histograms above and whole nodes below.

Features are binned once. While a node holds more than ``NODE_ROWS`` rows of its tree's sample, its level is one pass
over the blocks: each task sums weights by node, feature and bin, the sums of a tree meet in one task, and only the
splits chosen there reach the driver. A smaller node moves as a whole: its rows, a byte a feature, meet in one task that
grows everything below it. So neither a task nor the driver ever holds more than a fixed number of rows, and a model has
at most ``trees * 2^(depth + 1)`` nodes of 14 bytes.

A tree's sample gives each row a weight with the Poisson distribution of mean 1, drawn by a hash of the row's key; the
features that a node may split on, the root of their number, are drawn by a hash of tree and node. Weights are whole
numbers, so the model depends neither on the order of rows nor on partitions, cores or retries. Rows equal in key and
all values get equal weights. A split is the one that lessens the Gini impurity most; a node without such a split is a
leaf, with the share of class 1 as its value.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.operators.boosting import bin_edges
from penprint.operators.passes import Block, Blocks, matrix

BINS = 32
NODE_ROWS = 1 << 14
#: Bytes of nodes that one task of the last step grows, about, and trees written at a time.
_TASK_BYTES, _SAVED_TREES = 1 << 24, 25
_LEAF = -1
#: Where a hash of 64 bits passes from one Poisson weight to the next: 1 - the chance of more.
_STEPS = np.array([int(min(s, 1 - 2**-53) * 2**64) for s in np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)]))], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(seed: int, tree: int, use: int) -> np.ndarray:
    """A start for the hashes of a tree and a use."""
    return _mixed(_mixed(np.array([seed % 2**64], np.uint64)) + np.uint64((tree << 8) + use))


def _weights(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often the tree's sample holds each row."""
    drawn = _mixed(keys + _stream(seed, tree, 0))
    return sum((drawn >= step).astype(np.uint8) for step in _STEPS)


def _drawn_features(nodes: np.ndarray, seed: int, tree: int, width: int) -> np.ndarray:
    """For each node the features that it may split on, in their own order: of equal splits the first feature's is taken."""
    of_node = _mixed(nodes.astype(np.uint64) + _stream(seed, tree, 1))
    order = _mixed(of_node[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argsort(order, 1, kind="stable")[:, : int(np.ceil(np.sqrt(width)))], 1)


def _sums(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, at: np.ndarray, drawn: np.ndarray, n_bins: int) -> np.ndarray:
    """(nodes, drawn features, bins, 2): weights, and those of class 1, of rows at the nodes ``at``."""
    nodes, k = drawn.shape
    every = np.arange(len(at))
    out = np.empty((nodes, k, n_bins, 2))
    for j in range(k):
        slot = at * n_bins + bins[every, drawn[at, j]]
        out[:, j, :, 0] = np.bincount(slot, weight, nodes * n_bins).reshape(nodes, n_bins)
        out[:, j, :, 1] = np.bincount(slot, weight * label, nodes * n_bins).reshape(nodes, n_bins)
    return out


def _best_splits(sums: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per node: the feature (or ``_LEAF``), the last bin of the left, the gain, the sums on the left and of all."""
    left = sums.cumsum(2)[:, :, :-1]
    whole = sums[:, 0].sum(1)
    right = whole[:, None, None] - left

    def impurity(s: np.ndarray) -> np.ndarray:
        return 2 * s[..., 1] * (s[..., 0] - s[..., 1]) / np.maximum(s[..., 0], 1)

    gain = impurity(whole)[:, None, None] - impurity(left) - impurity(right)
    gain = np.where((left[..., 0] > 0) & (right[..., 0] > 0), gain, 0.0).reshape(len(sums), -1)
    best, every = gain.argmax(1), np.arange(len(sums))
    j, cut = np.divmod(best, left.shape[2])
    most = gain[every, best]
    feature = np.where(most > 1e-9 * whole[:, 0], drawn[every, j], _LEAF)
    return feature, cut, most, left[every, j, cut], whole


def _grown(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, root: int, seed: int, tree: int, depth: int, n_bins: int) -> tuple:
    """All nodes from ``root`` down (numbers in heap order, features, cuts, values) and the gains by feature."""
    width = bins.shape[1]
    found, gains = [], np.zeros(width)
    nodes, at = np.array([root]), np.zeros(len(label), int)
    level = root.bit_length() - 1
    weight = weight.astype(float)
    while len(nodes):
        if level == depth:  # leaves, as nothing may be split any more
            n = np.bincount(at, weight, len(nodes))
            found.append((nodes, np.full(len(nodes), _LEAF), np.zeros(len(nodes), int), np.bincount(at, weight * label, len(nodes)) / n))
            break
        drawn = _drawn_features(nodes, seed, tree, width)
        feature, cut, gain, _, whole = _best_splits(_sums(bins, label, weight, at, drawn, n_bins), drawn)
        found.append((nodes, feature, cut, whole[:, 1] / whole[:, 0]))
        split = feature != _LEAF
        gains += np.bincount(feature[split], gain[split], width)
        stays = split[at]
        bins, label, weight, at = bins[stays], label[stays], weight[stays], at[stays]
        right = bins[np.arange(len(at)), feature[at]] > cut[at]
        place = np.cumsum(split) - 1
        at = 2 * place[at] + right
        nodes = (2 * nodes[split][:, None] + np.arange(2)).reshape(-1)
        level += 1
    return *(np.concatenate(parts) for parts in zip(*found, strict=True)), gains


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays, the nodes of tree k from ``roots[k]`` on: a row goes from a node to ``left``, or to the one
    after it where its bin of ``feature`` is above ``cut``; a leaf leads to itself. ``importances`` sum to 1 (0 without
    any split)."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    importances: tuple[float, ...]
    depth: int
    roots: np.ndarray
    left: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @property
    def trees(self) -> int:
        return len(self.roots)

    def mean_values(self, x: np.ndarray) -> np.ndarray:
        """The mean over trees of the value of each row's leaf."""
        bins = _binned(x, self.edges).reshape(-1)
        first = np.arange(len(x)) * x.shape[1]
        total = np.zeros(len(x))
        for root in self.roots:
            node = np.full(len(x), root, np.int64)
            for _ in range(self.depth):
                node = self.left[node] + (bins[first + self.feature[node]] > self.cut[node])
            total += self.value[node]
        return total / max(self.trees, 1)

    def probability(self) -> Column:
        """The probability of class 1 as a column of the feature columns; the model is sent to the executors once."""
        width = len(self.features)

        @F.arrow_udf("double")
        def share(x: pa.Array) -> pa.Array:
            return pa.array(self.mean_values(matrix(x, width)))

        return share(F.array(*[F.col(f).cast("double") for f in self.features]))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row a tree, its nodes packed; a few trees at a time pass through the driver's JVM."""
        ends = [*self.roots[1:], len(self.left)]
        for k in range(0, max(self.trees, 1), _SAVED_TREES):
            rows = [
                (t, (self.left[a:b] - a).tobytes(), self.feature[a:b].tobytes(), self.cut[a:b].tobytes(), self.value[a:b].tobytes())
                for t, (a, b) in enumerate(zip(self.roots, ends, strict=True)) if k <= t < k + _SAVED_TREES
            ]
            table = spark.createDataFrame(rows, "tree int, left binary, feature binary, cut binary, value binary")
            table.write.mode("append" if k else "overwrite").parquet(f"{path}/trees")
        row = [(list(self.features), [list(e) for e in self.edges], list(self.importances), self.depth)]
        facts = spark.createDataFrame(row, "features array<string>, edges array<array<double>>, importances array<double>, depth int")
        facts.coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        facts = spark.read.parquet(f"{path}/facts").first()
        parts = [_unpacked(r) for r in sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r["tree"])]
        return _forest(tuple(facts["features"]), facts["edges"], facts["importances"], facts["depth"], parts)


def _unpacked(row) -> tuple[np.ndarray, ...]:
    kinds = {"left": np.int32, "feature": np.int8, "cut": np.uint8, "value": np.float64}
    return tuple(np.frombuffer(row[c], kind) for c, kind in kinds.items())


def _forest(features: tuple[str, ...], edges, importances, depth: int, parts: list[tuple[np.ndarray, ...]]) -> Forest:
    """A forest of trees whose nodes are numbered from 0 each."""
    sizes = [len(p[0]) for p in parts]
    roots = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int32) if parts else np.zeros(0, np.int32)
    left = [p[0] + start for p, start in zip(parts, roots, strict=True)]
    arrays = [np.concatenate(a) if parts else np.zeros(0) for a in (left, *([p[i] for p in parts] for i in (1, 2, 3)))]
    return Forest(
        features, tuple(tuple(map(float, e)) for e in edges), tuple(map(float, importances)), depth, roots,
        arrays[0].astype(np.int32), arrays[1].astype(np.int8), arrays[2].astype(np.uint8), arrays[3],
    )


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """A saved forest's nodes: tree, node (from 0), feature, threshold, left, right (of inner nodes), value (of leaves)."""
    facts = spark.read.parquet(f"{path}/facts").first()
    names, width = np.array(facts["features"]), max(map(len, facts["edges"]), default=0) + 1
    cuts = np.array([[*e, *[np.inf] * (width - len(e))] for e in facts["edges"]])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for batch in batches for r in batch.to_pylist()):
            left, feature, cut, value = _unpacked(r)
            node = np.arange(len(left), dtype=np.int32)
            leaf = left == node
            f, c = np.where(leaf, 0, feature), np.where(leaf, 0, cut)
            yield pa.record_batch({
                "tree": pa.array(np.full(len(left), r["tree"], np.int32)), "node": pa.array(node),
                "feature": pa.array(names[f], pa.string(), mask=leaf), "threshold": pa.array(cuts[f, c], mask=leaf),
                "left": pa.array(left, mask=leaf), "right": pa.array((left + 1).astype(np.int32), mask=leaf), "value": pa.array(value, mask=~leaf),
            })

    schema = "tree int, node int, feature string, threshold double, left int, right int, value double"
    return spark.read.parquet(f"{path}/trees").mapInArrow(listed, schema)


def _binned(x: np.ndarray, edges) -> np.ndarray:
    if np.isnan(x).any():
        raise ValueError("a feature is null or not a number")
    return np.stack([np.searchsorted(np.asarray(e), x[:, f], "left") for f, e in enumerate(edges)], 1).astype(np.uint8)


class _Tops:
    """The trees so far, above the nodes that are grown whole: dense arrays in heap order down to ``level``."""

    def __init__(self, trees: int, rows: int):
        self.level = 0
        self.feature = np.full((trees, 2), _LEAF, np.int8)
        self.cut = np.zeros((trees, 2), np.uint8)
        self.value = np.full((trees, 2), np.nan)
        #: Nodes of the present level that need a pass, and nodes to be grown whole, by tree.
        self.open = [[1] if rows > NODE_ROWS else [] for _ in range(trees)]
        self.whole = [[] if rows > NODE_ROWS else [1] for _ in range(trees)]

    def deepen(self) -> None:
        """Make room for another level."""
        room = lambda a, fill: np.concatenate((a, np.full_like(a, fill)), 1)
        self.feature, self.cut, self.value = room(self.feature, _LEAF), room(self.cut, 0), room(self.value, np.nan)

    def split(self, tree: int, chosen: tuple[np.ndarray, ...], depth: int) -> list[int]:
        """Enter the splits of a tree's open nodes; the children that need a pass."""
        following = []
        for node, f, c, _, left, whole in zip(self.open[tree], *chosen, strict=True):
            if f == _LEAF:
                self.value[tree, node] = whole[1] / whole[0]
                continue
            self.feature[tree, node], self.cut[tree, node] = f, c
            for child, (n, ones) in ((2 * node, left), (2 * node + 1, whole - left)):
                if ones in (0, n) or self.level + 1 == depth:
                    self.value[tree, child] = ones / n
                elif n > NODE_ROWS:
                    following.append(child)
                else:
                    self.whole[tree].append(child)
        return following


def _descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node in heap order at which each row has arrived."""
    node = np.ones(len(bins), int)
    every = np.arange(len(bins))
    for _ in range(levels):
        f = feature[node]
        node = np.where(f == _LEAF, node, 2 * node + (bins[every, f] > cut[node]))
    return node


def fit_forest(
    rows: DataFrame, features: tuple[str, ...], trees: int = 100, depth: int = 15, seed: int = 42, left_out: int | None = None
) -> Forest:
    """A forest of all rows, or of those outside one fold, from a table label, fold, x, key."""
    width = len(features)
    edges = bin_edges(rows if left_out is None else rows.where(F.col("fold") != left_out), width, BINS)
    n_bins = max(2, max((len(e) for e in edges), default=0) + 1)

    def packed(part: pa.RecordBatch) -> Block:
        own = np.ones(part.num_rows, bool) if left_out is None else part.column("fold").to_numpy(zero_copy_only=False) != left_out
        bins = _binned(matrix(part.column("x"), width), edges)
        label, key = (part.column(c).to_numpy(zero_copy_only=False) for c in ("label", "key"))
        return {"bins": bins[own], "label": label[own].astype(np.uint8), "key": key[own].astype(np.int64).view(np.uint64)}

    table = Blocks(rows, packed)
    n, ones = map(int, table.sum(lambda block: np.array([len(block["label"]), block["label"].sum(dtype=np.int64)])))
    if not n:
        raise ValueError("a forest needs rows")
    tops, gains = _Tops(trees, n), np.zeros((trees, width))

    def sampled(block: Block, tree: int) -> tuple[np.ndarray, ...]:
        """Rows of the tree's sample: bins, labels, weights and the nodes where they are."""
        weight = _weights(block["key"], seed, tree)
        own = weight > 0
        bins = block["bins"][own]
        return bins, block["label"][own], weight[own], _descend(bins, tops.feature[tree], tops.cut[tree], tops.level)

    while any(tops.open):

        def summed(found: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
            blocks = list(found)
            for tree, nodes in enumerate(tops.open):
                if not nodes:
                    continue
                drawn, total = _drawn_features(np.array(nodes), seed, tree, width), None
                place = np.full(tops.feature.shape[1], -1)
                place[nodes] = np.arange(len(nodes))
                for block in blocks:
                    bins, label, weight, node = sampled(block, tree)
                    here = place[node] >= 0
                    sums = _sums(bins[here], label[here], weight[here].astype(float), place[node[here]], drawn, n_bins)
                    total = sums if total is None else total + sums
                if total is not None:
                    yield tree, total

        def chosen(tree: int, sums: np.ndarray) -> tuple[np.ndarray, ...]:
            return _best_splits(sums, _drawn_features(np.array(tops.open[tree]), seed, tree, width))

        by_tree = table.rdd.mapPartitions(summed).reduceByKey(np.add, min(trees, 32))
        splits = by_tree.map(lambda kv: (kv[0], chosen(*kv))).collect()
        following: list[list[int]] = [[] for _ in range(trees)]
        tops.deepen()
        for tree, found in splits:
            feature, _, gain, *_ = found
            split = feature != _LEAF
            gains[tree] += np.bincount(feature[split], gain[split], width)
            following[tree] = tops.split(tree, found, depth)
        tops.open, tops.level = following, tops.level + 1

    def pieces(block: Block) -> Iterator[tuple[tuple[int, int], bytes]]:
        """The rows of each node that is grown whole, a byte a value."""
        for tree, nodes in enumerate(tops.whole):
            if not nodes:
                continue
            bins, label, weight, node = sampled(block, tree)
            listed = np.zeros(tops.feature.shape[1], bool)
            listed[nodes] = True
            here = np.flatnonzero(listed[node])
            here = here[np.argsort(node[here], kind="stable")]
            packed_rows = np.column_stack((bins[here], label[here], weight[here]))
            starts = np.flatnonzero(np.diff(node[here], prepend=-1))
            for a, b in zip(starts, np.append(starts, len(here))[1:], strict=True):
                yield (tree, int(node[here[a]])), packed_rows[a:b].tobytes()

    def grown(found: tuple[tuple[int, int], Iterator[bytes]]) -> tuple:
        (tree, root), parts = found
        whole = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width + 2)
        nodes, feature, cut, value, own = _grown(whole[:, :width], whole[:, width], whole[:, width + 1], root, seed, tree, depth, n_bins)
        return (
            tree, root, nodes.astype(np.int32).tobytes(), feature.astype(np.int8).tobytes(), cut.astype(np.uint8).tobytes(),
            value.astype(np.float64).tobytes(), own.tobytes(),
        )

    tasks = min(max(32, n * trees * (width + 2) // _TASK_BYTES), max(1, sum(map(len, tops.whole))))
    below: dict[int, list] = {}
    for tree, root, *arrays in sorted(table.rdd.flatMap(pieces).groupByKey(tasks).map(grown).collect(), key=lambda r: r[:2]):
        below.setdefault(tree, []).append(arrays[:-1])
        gains[tree] += np.frombuffer(arrays[-1])
    table.close()

    parts = []
    for tree in range(trees):
        top = np.flatnonzero((tops.feature[tree] != _LEAF) | ~np.isnan(tops.value[tree]))
        lists = [[top], [tops.feature[tree, top]], [tops.cut[tree, top]], [tops.value[tree, top]]]
        for arrays in below.pop(tree, ()):
            for kept, raw, kind in zip(lists, arrays, (np.int32, np.int8, np.uint8, np.float64), strict=True):
                kept.append(np.frombuffer(raw, kind))
        nodes, feature, cut, value = map(np.concatenate, lists)
        if not len(nodes):  # no row in the sample
            nodes, feature, cut, value = np.array([1]), np.array([_LEAF], np.int8), np.zeros(1, np.uint8), np.array([ones / n])
        order = np.argsort(nodes, kind="stable")
        nodes, feature, cut, value = (a[order] for a in (nodes, feature, cut, value))
        leaf = feature == _LEAF
        left = np.where(leaf, np.arange(len(nodes)), np.searchsorted(nodes, 2 * nodes.astype(np.int64)))
        # A leaf leads to itself: no bin is above 255.
        parts.append((left.astype(np.int32), np.where(leaf, 0, feature).astype(np.int8), np.where(leaf, 255, cut).astype(np.uint8), np.where(leaf, value, 0.0)))

    shares = gains / np.maximum(gains.sum(1, keepdims=True), 1e-300)
    importances = shares.sum(0) / max(shares.sum(), 1e-300)
    return _forest(tuple(features), edges, importances, depth, parts)
