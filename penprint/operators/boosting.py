"""Gradient-boosted trees for two classes, by histograms of gradients.

Features are binned once. A boosting round grows one tree level by level: each level is one pass over the binned rows
that sums counts, gradients (label less probability) and Hessians by node, feature and bin, so a round of depth 3 is
three small aggregates whatever the number of rows. A split maximises ``(mean left - mean right)² · n_l n_r / (n_l +
n_r)`` of the gradients; a leaf is a Newton step, the sum of its gradients over that of its Hessians; the start is the
log odds of the labels.

Gradients and Hessians are summed as integers of 2^-30, so that the model depends neither on the order of rows nor on
partitions, cores or retries. Several models are fitted in the same passes: model k of ``folds`` learns from the rows
of all other folds.

Bins: all midpoints between neighbouring values while a feature has no more than ``bins`` distinct ones, else cuts of
equal depth. Cuts are taken from ``EDGE_ROWS`` rows, drawn by a hash of their values (all rows while there are no more);
everything else reads all rows. The margins so far are written to the shared folder every ``SAVED_ROUNDS`` rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.operators.passes import Block, Blocks, matrix

EDGE_ROWS = 100_000
BINS = 128
SAVED_ROUNDS = 20
_UNIT = float(1 << 30)


@dataclass(frozen=True)
class Tree:
    """A whole binary tree in heap order (node 1 is the root, 2n and 2n + 1 follow n): a node goes right where its
    feature is above its threshold. A node without a split has a threshold of infinity. ``values`` are the leaves'."""

    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    values: tuple[float, ...]


@dataclass(frozen=True)
class BoostedTrees:
    features: tuple[str, ...]
    start: float
    rate: float
    trees: tuple[Tree, ...]

    @property
    def depth(self) -> int:
        return max((int(np.log2(len(t.values))) for t in self.trees), default=0)

    def margin(self) -> Column:
        """The log odds of class 1, as one expression over the feature columns.

        The trees are a constant of the expression and are folded over: its code doesn't grow with their number.
        """
        if not self.trees:
            return F.lit(self.start)
        trees = F.array(*[
            F.struct(
                F.array(*map(F.lit, t.feature)).alias("f"), F.array(*map(F.lit, t.threshold)).alias("t"), F.array(*map(F.lit, t.values)).alias("v")
            )
            for t in self.trees
        ])
        x = F.array(*[F.col(f).cast("double") for f in self.features])
        levels = F.sequence(F.lit(1), F.lit(self.depth))

        def below(tree: Column, node: Column) -> Column:
            right = F.get(x, F.get(tree["f"], node)) > F.get(tree["t"], node)
            return 2 * node + F.when(right, 1).otherwise(0)

        def leaf(tree: Column) -> Column:
            return F.aggregate(levels, F.lit(1), lambda node, _: below(tree, node)) - len(self.trees[0].values)

        return F.aggregate(trees, F.lit(self.start), lambda total, tree: total + F.lit(self.rate) * F.get(tree["v"], leaf(tree)))

    def probability(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.margin()))

    def table(self, spark: SparkSession) -> DataFrame:
        """tree, node, feature, threshold (of inner nodes) and value (of leaves, in heap order after the nodes)."""
        rows = []
        for k, t in enumerate(self.trees):
            rows += [(k, n, self.features[t.feature[n]], t.threshold[n], None) for n in range(1, len(t.values))]
            rows += [(k, len(t.values) + n, None, None, v) for n, v in enumerate(t.values)]
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, value double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = spark.createDataFrame([(list(self.features), self.start, self.rate)], "features array<string>, start double, rate double")
        facts.coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        facts = spark.read.parquet(f"{path}/facts").first()
        place = {f: i for i, f in enumerate(facts["features"])}
        trees: dict[int, list] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            trees.setdefault(r["tree"], []).append(r)
        built = []
        for k in sorted(trees):
            inner = [r for r in trees[k] if r["value"] is None]
            leaves = tuple(r["value"] for r in trees[k] if r["value"] is not None)
            built.append(Tree((0, *(place[r["feature"]] for r in inner)), (float("inf"), *(r["threshold"] for r in inner)), leaves))
        return BoostedTrees(tuple(facts["features"]), facts["start"], facts["rate"], tuple(built))


def bin_edges(rows: DataFrame, width: int, bins: int = BINS, most: int = EDGE_ROWS) -> list[np.ndarray]:
    """Per feature, the ascending cuts: a value is in the first bin whose cut it doesn't exceed."""
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod(F.xxhash64("x"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    values = matrix(rows.select("x").toArrow().column("x").combine_chunks(), width)
    edges = []
    for f in range(width):
        ordered = np.sort(values[:, f])
        distinct = np.unique(ordered)
        if len(distinct) > bins:
            ranks = (np.arange(1, bins) * len(ordered)) // bins
            low = np.unique(ordered[ranks - 1])
            distinct = np.append(low, distinct[-1]) if low[-1] < distinct[-1] else low
            following = np.searchsorted(ordered, distinct[:-1], "right")
            edges.append((distinct[:-1] + ordered[following]) / 2)
        else:
            edges.append((distinct[:-1] + distinct[1:]) / 2)
    return edges


class _Growing:
    """A model under construction: its finished trees, and of the current one the splits so far, by bin."""

    def __init__(self, start: float, depth: int):
        self.start, self.depth = start, depth
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.begin()

    def begin(self) -> None:
        size = 1 << self.depth
        self.feature, self.cut, self.values = np.zeros(size, int), np.full(size, 1 << 20), np.zeros(size)

    def finish(self) -> None:
        self.trees.append((self.feature, self.cut, self.values))
        self.begin()

    def split(self, level: int, sums: np.ndarray) -> None:
        """Choose the splits of a level from ``sums`` of shape (nodes, features, bins, 3)."""
        for node in range(1 << level):
            n, g, h = (sums[node, :, :, i] for i in range(3))
            if not n[0].sum():
                continue
            total, total_g, total_h = n[0].sum(), g[0].sum(), h[0].sum()
            left, left_g = n.cumsum(1).astype(float), g.cumsum(1).astype(float)
            right, right_g = total - left, total_g - left_g
            inside = (left > 0) & (right > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(inside, (left_g / left - right_g / right) ** 2 * left * right / total, -1.0)
            best = int(gain.argmax())
            f, b = divmod(best, gain.shape[1])
            place, bottom = (1 << level) + node, self.depth - level
            if gain[f, b] <= 0:  # no split: everything goes left from here
                self.values[(place << bottom) - (1 << self.depth)] = total_g / total_h if total_h else 0.0
                continue
            self.feature[place], self.cut[place] = f, b
            if level == self.depth - 1:
                left_h = h[f].cumsum()[b]
                for side, (gs, hs) in enumerate(((left_g[f, b], left_h), (right_g[f, b], total_h - left_h))):
                    self.values[2 * node + side] = gs / hs if hs else 0.0


def _descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after so many levels, from 0 within its level."""
    node = np.ones(len(bins), int)
    every = np.arange(len(bins))
    for _ in range(levels):
        node = 2 * node + (bins[every, feature[node]] > cut[node])
    return node - (1 << levels)


def fit_boosted(
    rows: DataFrame, features: tuple[str, ...], rounds: int = 100, rate: float = 0.1, depth: int = 3, folds: int | None = None, bins: int = BINS
) -> list[BoostedTrees]:
    """One model of all rows, or with ``folds`` one for each fold left out, from a table label, fold, x."""
    width = len(features)
    edges = bin_edges(rows, width, bins)
    n_bins = max((len(e) for e in edges), default=0) + 1
    left_out = [None] if folds is None else list(range(folds))

    def binned(part) -> Block:
        x = matrix(part.column("x"), width)
        places = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
        label, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
        return {"bins": places.astype(np.uint8 if n_bins <= 256 else np.uint16), "label": label, "fold": fold}

    counts = {(r["fold"], r["label"]): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
    growing = []
    for k in left_out:
        ones, zeros = (sum(c for (fold, label), c in counts.items() if label == y and (k is None or fold != k)) for y in (1, 0))
        p = min(max((ones + 1e-9) / (ones + zeros + 2e-9), 1e-9), 1 - 1e-9)
        growing.append(_Growing(float(np.log(p / (1 - p))), depth))

    def margins_of(k: int, own: np.ndarray, block: Block) -> np.ndarray:
        """The log odds so far of a block's rows: what was saved, and the trees since."""
        places = block["bins"][own]
        out = block["margins"][own, k] if saved else np.full(len(places), growing[k].start)
        for feature, cut, values in growing[k].trees[saved:]:
            out = out + rate * values[_descend(places, feature, cut, depth)]
        return out

    table, saved = Blocks(rows, binned), 0
    for done in range(rounds):
        for level in range(depth):
            nodes = 1 << level

            def histograms(block: Block) -> np.ndarray:
                out = np.zeros((len(left_out), nodes * width * n_bins, 3), np.int64)
                for k, k_out in enumerate(left_out):
                    own = np.ones(len(block["label"]), bool) if k_out is None else block["fold"] != k_out
                    mine = block["bins"][own].astype(int)
                    p = 1 / (1 + np.exp(-margins_of(k, own, block)))
                    g, h = np.rint((block["label"][own] - p) * _UNIT), np.rint(p * (1 - p) * _UNIT)
                    node = _descend(mine, growing[k].feature, growing[k].cut, level)
                    slot = ((node[:, None] * width + np.arange(width)) * n_bins + mine).reshape(-1)
                    for i, w in enumerate((None, np.repeat(g, width), np.repeat(h, width))):
                        out[k, :, i] = np.bincount(slot, w, out.shape[1])
                return out

            sums = table.sum(histograms).reshape(len(left_out), nodes, width, n_bins, 3)
            for k, model in enumerate(growing):
                model.split(level, sums[k])
        for model in growing:
            model.finish()
        if (done + 1) % SAVED_ROUNDS == 0 and done + 1 < rounds:

            def advanced(block: Block) -> Block:
                own = np.ones(len(block["label"]), bool)
                return block | {"margins": np.stack([margins_of(k, own, block) for k in range(len(left_out))], 1)}

            table = table.changed(rows.sparkSession, advanced)
            saved = done + 1
    table.close()

    def tree(feature: np.ndarray, cut: np.ndarray, values: np.ndarray) -> Tree:
        at = [float(edges[f][c]) if c < (1 << 20) else float("inf") for f, c in zip(feature, cut, strict=True)]
        return Tree(tuple(map(int, feature)), tuple(at), tuple(map(float, values)))

    return [BoostedTrees(tuple(features), m.start, rate, tuple(tree(*t) for t in m.trees)) for m in growing]
