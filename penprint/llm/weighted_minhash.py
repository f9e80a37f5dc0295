"""Near-duplicates by improved consistent weighted sampling of TF-IDF shingles.

A document is a weighted set of five-word shingles, weight = count x idf. Document frequencies are counted over all
documents in 2^18 hashed features, as MLlib's HashingTF and IDF do, so that the table has one size for any corpus.
The idf is augmented: 1 for a feature in every document, up to 1.5 for a rare one. It takes weight from boilerplate,
but a group of near copies, however large, can't push its own similarity under the threshold.

Each of 56 samples draws (shingle, level) by the improved scheme: r and c from Gamma(2, 1), b uniform, level
t = floor(ln w / r + b), and the shingle with the least ln c - r (t - b) - r wins; two documents draw the same pair with
probability equal to their weighted Jaccard similarity. The draws of a shingle are looked up in a table of 65,536
by a hash of shingle and sample; equal values go to the least hash. As a shingle's value falls with its weight, each draw has
a bound for a class of weights, and only shingles whose bound may win are ranked. 14 bands of 4 samples bring together a
pair of similarity 0.8 with probability 0.9994, of 0.85 with 0.99997.

Equal texts are one node. What rounds read is written once: a node's weight, its samples in 16 bits each, and the texts of
the nodes that share a bucket with another. A bucket's nodes are first compared with its lightest only (of least total
weight). Buckets whose nodes are of one component then are done. In the others, the pairs across components are told
apart by their samples: as each sample agrees with probability equal to the similarity, a pair at 0.8 agrees in fewer than
34 of 56 with probability 0.0002, and only pairs that agree in as many are verified on the whole texts, the most agreeing
first, and no longer once links have joined their components. That takes place in tiles of two blocks of ``BLOCK_NODES``
nodes with their texts, of which only links leave the task, so a bucket of any size is many tasks and no pair is a row.

That last step is taken once the pairs across components are no more than ``PAIRS`` a node. Until then large buckets of
texts that are alike, but not linked, are taken apart by their leaders, which loses no link, by this bound: let node y fail against leader L, and x be no lighter than L. If x and y have
no shingle that both hold more often than L does, what they share is at most what y shares with L, so x and y fail too.
Moreover they share a weight of at least need(y) = t / (1 + t) (w(L) + w(y)) - w(y and L) above the leader, for threshold
t. So linked nodes that the leader leaves apart meet in a group (leader, shingle) if each lists its shingles above the
leader in one order, up to where what follows weighs less than its need (a ninth of a text at most, at 0.8). Those groups
are treated as buckets were, each again with its lightest node. Leaders get heavier from round to round, so the rounds end.
A large group of copies costs a comparison for each member and leader, never one for each pair.

Components spread by table joins and pointer jumps, cut by written tables.

Defined results: null counts as an empty text; texts without words are one class if equal, and never like others;
a text of fewer than five words is one shingle. A class is named by its least doc_id, null if it has none but null.
Rows with equal texts share a class whatever their ids. An empty table gives an empty result. Extra columns are
neither read nor lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.llm.exprs import quoted
from penprint.llm.shingles import chunks, distinct_shingles, mixed, shingle_hashes, word_hashes
from penprint.session import stored

THRESHOLD = 0.8
SHINGLE = 5
BANDS = 14
ROWS = 4
#: The search ends by samples once the pairs across components are no more than so many a node, repeats counted.
PAIRS = 200
#: Nodes on either side of a tile.
BLOCK_NODES = 250
#: Bytes of text whose shingles a worker holds at a time, which take about 20 times as much; a longer text is taken whole.
CHUNK = 1 << 20
#: Nodes whose keys may be broadcast (16 bytes each).
BROADCAST_NODES = 1_000_000
_FEATURE_BITS = 18
_TABLE_BITS = 16
_BLOCK = 1 << 15
#: A text's least rank is sought below ln(_LIKELY / weight) first, where it is but with probability exp(-_LIKELY).
_LIKELY = 8
#: Classes of counts, by powers of two, whose draws have bounds; shingles of greater counts are always ranked.
_CLASSES = 8
#: Bounds are held in steps of _STEP from _LEAST on.
_LEAST, _STEP = -16, 0.08


@dataclass(frozen=True)
class Sampler:
    """The seeded draws, and the idf of each hashed feature."""

    idf: np.ndarray
    seed: int = 0

    def weights(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts * self.idf[values >> np.uint64(64 - _FEATURE_BITS)]

    def signatures(self, values: np.ndarray, of: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(band hashes, n x ``BANDS``; samples in 16 bits, n x 56); texts without shingles get zeros, not to be used.

        Texts are sampled in blocks of about ``_BLOCK`` shingles, which stay in a core's cache.
        """
        out, samples = np.zeros((n, BANDS), np.uint64), np.zeros((n, BANDS * ROWS), np.uint16)
        ends = np.append(np.flatnonzero(np.diff(of)) + 1, len(of))
        cuts = [0, *ends[np.flatnonzero(np.diff(ends // _BLOCK, append=-1))].tolist()]
        for a, b in zip(cuts, cuts[1:]):
            self._sample(values[a:b], of[a:b], counts[a:b], out, samples)
        return out, samples

    @cached_property
    def _draws(self) -> tuple[np.ndarray, ...]:
        rng = np.random.default_rng(self.seed)
        size = 1 << _TABLE_BITS
        r = rng.gamma(2, 1, size).astype(np.float32)
        ln_c = np.log(rng.gamma(2, 1, size)).astype(np.float32)
        b = rng.random(size, np.float32)
        factors = rng.integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
        return r, 1 / r, ln_c, b, factors

    @cached_property
    def _bounds(self) -> np.ndarray:
        """For each class of counts and draw the step that no rank is below: that of the heaviest, as a rank falls with the weight."""
        r, per_r, ln_c, b, _ = (x.astype(np.float64) for x in self._draws)
        heaviest = np.log(self.idf.max() * 2.0 ** np.arange(_CLASSES))[:, None] + 1e-4
        rank = ln_c - r * (np.floor(heaviest * per_r + b) - b) - r - 1e-3  # what single precision may be off by
        steps = np.floor((rank - _LEAST) / _STEP).clip(0, 254).astype(np.uint8)
        return np.append(steps, np.zeros(1 << _TABLE_BITS, np.uint8))

    def _sample(self, values: np.ndarray, of: np.ndarray, counts: np.ndarray, out: np.ndarray, samples: np.ndarray) -> None:
        """Only shingles whose bound is below what a text's least rank likely is are ranked, and all of a text
        where none of these is: the least of all either way."""
        r, per_r, ln_c, b, factors = self._draws
        has, starts, sizes = np.unique(of, return_index=True, return_counts=True)
        if not len(has):
            return
        weights = self.weights(values, counts)
        ln_w = np.log(weights).astype(np.float32)
        inside = np.repeat(np.arange(len(has)), sizes)
        total = np.minimum(np.add.reduceat(weights, starts), 1 << _TABLE_BITS)  # more shingles make no more draws
        steps = np.floor((np.log(_LIKELY / total) - _LEAST) / _STEP).clip(0, 253)
        likely, above = steps.astype(np.uint8)[inside], _LEAST + _STEP * (steps + 1)
        row = np.searchsorted(1 << np.arange(_CLASSES), counts).astype(np.uint64) << np.uint64(_TABLE_BITS)
        bounds, draw = self._bounds, np.empty(len(values), np.uint64)
        drawn, unsure = np.zeros(len(factors) * len(has), np.uint64), np.ones(len(factors) * len(has), bool)

        def rank_least(at: np.ndarray, sample: np.ndarray) -> None:
            """Take the shingles of least rank of each sample and text, the first of those that are equal."""
            factor, own = factors[sample], inside[at]
            place = ((values[at] * factor) >> np.uint64(64 - _TABLE_BITS)).view(np.int64)
            own_r, own_b = r[place], b[place]
            level = np.floor(ln_w[at] * per_r[place] + own_b)
            rank = ln_c[place] - own_r * (level - own_b) - own_r
            group = sample * len(has) + own
            first = np.flatnonzero(np.diff(group, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            ties = np.flatnonzero(rank == np.repeat(least, np.diff(first, append=len(at))))
            won = ties[np.diff(group[ties], prepend=-1) > 0]
            drawn[group[won]] = mixed(values[at[won]] + level[won].astype(np.int64).astype(np.uint64) * factor[won])
            unsure[group[won]] = least >= above[own[won]]

        near, waiting, begun = [], 0, 0
        for j, factor in enumerate(factors):
            np.multiply(values, factor, out=draw)
            np.right_shift(draw, np.uint64(64 - _TABLE_BITS), out=draw)
            np.bitwise_or(draw, row, out=draw)
            near.append(np.flatnonzero(bounds.take(draw.view(np.int64), mode="clip") <= likely))
            waiting += len(near[-1])
            if waiting and (waiting >= _BLOCK or j == len(factors) - 1):
                rank_least(np.concatenate(near), np.repeat(np.arange(begun, j + 1), [len(x) for x in near]))
                near, waiting, begun = [], 0, j + 1
        for j in np.flatnonzero(unsure.reshape(-1, len(has)).any(1)):
            at = np.flatnonzero(unsure.reshape(-1, len(has))[j][inside])
            rank_least(at, np.full(len(at), j))
        hashes, drawn = np.zeros((BANDS, len(has)), np.uint64), drawn.reshape(-1, len(has))
        for k in range(ROWS):
            hashes = mixed(hashes + drawn[k::ROWS])
        out[has], samples[has] = hashes.T, (drawn >> np.uint64(48)).T


def node(text: str) -> Column:
    """What equal texts share."""
    return F.md5(F.coalesce(F.col(quoted(text)), F.lit("")))


def feature_counts(batches: Iterator[pa.RecordBatch], size: int = SHINGLE) -> Iterator[pa.RecordBatch]:
    """(feature, n): the documents of batches (text) that hold each hashed feature, and under -1 all of them."""
    table, rows = np.zeros(1 << _FEATURE_BITS, np.int64), 0
    for batch in batches:
        for part in chunks(batch, 0, CHUNK):
            values, of = shingle_hashes(*word_hashes(part.column(0)), size)
            pairs = np.sort((of.astype(np.int64) << _FEATURE_BITS) | (values >> np.uint64(64 - _FEATURE_BITS)).astype(np.int64))
            new = np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]
            table += np.bincount(pairs[new] & ((1 << _FEATURE_BITS) - 1), minlength=len(table))
            rows += part.num_rows
    used = np.flatnonzero(table)
    features = np.append(used, -1)  # -1: documents
    yield pa.record_batch([pa.array(features), pa.array(np.append(table[used], rows))], names=["feature", "n"])


def feature_idf(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> np.ndarray:
    """The augmented idf of each of 2^18 hashed features, from counts over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from feature_counts(batches, size)

    counted = docs.select(F.col(quoted(text)).alias("text")).mapInArrow(count, "feature long, n long")
    totals = counted.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()  # 2^18 + 1 rows at most
    feature, n = totals.column("feature").to_numpy(), totals.column("n").to_numpy()
    documents = int(n[feature == -1].sum())
    frequency = np.zeros(1 << _FEATURE_BITS, np.int64)
    frequency[feature[feature >= 0]] = n[feature >= 0]
    return 1 + 0.5 * np.log((documents + 1) / (frequency + 1)) / np.log(documents + 2)


def node_table(docs: DataFrame, sampler: Sampler, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(node, weight, samples, bands) of every distinct text with words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1, CHUNK):
                values, of, counts = distinct_shingles(part.column(1), size)
                bands, samples = sampler.signatures(values, of, counts, part.num_rows)
                has = np.unique(of)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(bands[has].view(np.int64).reshape(-1)), BANDS)
                weight = np.bincount(of, sampler.weights(values, counts), part.num_rows)[has]
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * BANDS * ROWS), len(has), [None, pa.py_buffer(samples[has].tobytes())])
                yield pa.record_batch(
                    [part.column(0).take(pa.array(has)), pa.array(weight), packed.cast(pa.binary()), lists.cast(pa.list_(pa.int64()))],
                    names=["node", "weight", "samples", "bands"],
                )

    texts = docs.select(node(text).alias("node"), F.col(quoted(text)).alias("text"))
    signed = texts.mapInArrow(sign, "node string, weight double, samples binary, bands array<long>")
    once = signed.groupBy("node").agg(*[F.any_value(c).alias(c) for c in ("weight", "samples", "bands")])
    return once.withColumn("node", F.unhex("node"))


def band_table(nodes: DataFrame) -> DataFrame:
    """(grp, node, weight), a row for each node and band."""
    rows = nodes.select("node", "weight", F.posexplode("bands").alias("band", "bucket"))
    return rows.select(F.xxhash64("band", "bucket").alias("grp"), "node", "weight")


def shared_texts(groups: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(node, text) of the nodes that share a group with another, written once."""
    several = groups.groupBy("grp").agg(F.count("*").alias("n"), F.min("node").alias("one")).filter("n > 1").select("grp")
    wanted = stored(groups.join(several, "grp", "left_semi").select("node").distinct(), "minhash-wanted")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_NODES else wanted.hint("merge")
    texts = docs.select(F.unhex(node(text)).alias("node"), F.col(quoted(text)).alias("text")).join(side, "node", "left_semi")
    return stored(texts.groupBy("node").agg(F.any_value("text").alias("text")), "minhash-texts")


def similarities(pairs: DataFrame, texts: DataFrame, sampler: Sampler, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """Pairs (a, b, listed) of nodes with the weighted Jaccard similarity of the whole texts and, where ``listed`` is
    true, the shingles that b holds more often than a, as far as a node linked to b may need them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in chunks(batch, 3, CHUNK):
                for part in chunks(half, 4, CHUNK):
                    yield _compared(part, sampler, threshold, size)

    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    with_a = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return with_a.select("a", "b", "listed", "text_a", "text_b").mapInArrow(
        compare, "a binary, b binary, similarity double, above array<long>"
    )


def _compared(part: pa.RecordBatch, sampler: Sampler, threshold: float, size: int) -> pa.RecordBatch:
    sides = []
    for column in (3, 4):
        listed = part.column(column).dictionary_encode()  # a leader's text is cut up once
        values, of, counts = distinct_shingles(listed.dictionary, size)
        bounds = np.searchsorted(of, np.arange(len(listed.dictionary) + 1))
        sides.append((listed.indices.to_numpy(), values, bounds, sampler.weights(values, counts)))
    out, above = np.zeros(part.num_rows), []
    for i, listed in enumerate(part.column(2).to_pylist()):
        (va, wa), (vb, wb) = [[x[s[k[i]] : s[k[i] + 1]] for x in (v, w)] for k, v, s, w in sides]
        _, in_a, in_b = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
        shared = np.minimum(wa[in_a], wb[in_b]).sum()
        total = wa.sum() + wb.sum() - shared
        out[i] = shared / total if total > 0 else 0.0
        if listed:
            excess = wb.copy()
            excess[in_b] -= np.minimum(wa[in_a], wb[in_b])
            need = threshold / (1 + threshold) * (wa.sum() + wb.sum()) - shared
            follows = np.cumsum(excess[::-1])[::-1]
            above.append(vb[(excess > 0) & (follows >= need - 1e-9)].view(np.int64))
        else:
            above.append(None)
    columns = [part.column(0), part.column(1), pa.array(out), pa.array(above, pa.list_(pa.int64()))]
    return pa.record_batch(columns, names=["a", "b", "similarity", "above"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes in edges (a, b): the least node of its component.

    Each step takes the least label among neighbours and the own label's label, until none changes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b").groupBy("a").agg(F.min("near").alias("near"))
        jumps = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        step = labels.join(near, F.col("node") == F.col("a")).join(jumps, F.col("label") == F.col("at"))
        step = stored(step.select("node", F.col("label").alias("old"), F.least("label", "near", "next").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.filter("label <> old").isEmpty():
            return labels


def _led(groups: DataFrame) -> DataFrame:
    """(grp, n, leader, node) of the nodes of groups (grp, node, weight) beside their lightest one."""
    lightest = F.min(F.struct("weight", "node")).alias("lead")
    leaders = groups.groupBy("grp").agg(lightest, F.count("*").alias("n")).filter("n > 1")
    led = groups.select("grp", "node").join(leaders.select("grp", "n", F.col("lead.node").alias("leader")), "grp")
    return led.filter("node <> leader")


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """(node, label) after links (a, b) were found between components (node, label) and nodes without one."""
    known = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    other = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    joining = found.join(known, "a", "left").join(other, "b", "left").filter("coalesce(la, a) <> coalesce(lb, b)")
    joining = stored(joining, "minhash-joining")
    if joining.isEmpty():
        return labels
    # Components are joined as nodes of a graph of their own.
    joined = components(joining.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    everyone = labels.select("node", "label").unionByName(
        joined.select("node", F.col("node").alias("label")).join(labels.select("node"), "node", "left_anti")
    )
    renamed = joined.select(F.col("node").alias("label"), F.col("label").alias("joined"))
    return stored(everyone.join(renamed, "label", "left").select("node", F.coalesce("joined", "label").alias("label")), "labels")


def least_agreeing(threshold: float) -> int:
    """Samples that a pair must agree in to be verified: 3.6 deviations below what is expected at the threshold."""
    n = BANDS * ROWS
    return int(n * threshold - 3.6 * (n * threshold * (1 - threshold)) ** 0.5)


def _links_across(
    open_groups: DataFrame, nodes: DataFrame, texts: DataFrame, sampler: Sampler, threshold: float, by_band: bool, size: int = SHINGLE
) -> DataFrame:
    """Links (a, b, similarity) across components of nodes in groups (grp, n, node, label), as many as join them.

    A group of n nodes is cut into blocks of about ``BLOCK_NODES`` by a hash of the node, and each two blocks are a tile,
    which one task holds with its texts. Only links leave the task. With ``by_band`` the groups are buckets: a pair that
    shares several is looked at in the first.
    """
    members = open_groups.join(nodes.select("node", "samples", "bands"), "node").join(texts, "node")
    blocks = F.ceil(F.col("n") / BLOCK_NODES).cast("int")
    cut = members.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    tiled = cut.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    tiled = tiled.select(
        F.xxhash64("grp", F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
        F.expr("case when block = other then 2 when block < other then 0 else 1 end").alias("side"), "node", "label", "samples", "bands", "text",
    )
    # Small tiles are gathered, about as many rows to a group of Spark's as a large tile has.
    rows = open_groups.select(blocks.cast("long").alias("blocks")).agg(F.sum("blocks")).first()[0] or 0
    n_packs = max(1, rows // (2 * BLOCK_NODES))
    packed = tiled.withColumn("pack", F.pmod(F.xxhash64("tile"), F.lit(n_packs)))
    least = least_agreeing(threshold)

    def search(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("tile", "ascending"), ("side", "ascending")]).combine_chunks()
        keys = rows.column("tile").to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        found = [_tile_links(rows.slice(low, high - low), sampler, threshold, least, by_band, size) for low, high in zip(cuts, cuts[1:])]
        return pa.concat_tables(found)

    return packed.groupBy("pack").applyInArrow(search, "a binary, b binary, similarity double")


def _tile_links(rows: pa.Table, sampler: Sampler, threshold: float, least: int, by_band: bool, size: int) -> pa.Table:
    """Links across components between a tile's two blocks: pairs whose samples agree often, the most agreeing first,
    verified on the whole texts unless links have joined their components by then."""
    sides = rows.column("side").to_numpy()
    samples = np.frombuffer(b"".join(rows.column("samples").to_pylist()), np.uint16).reshape(len(rows), -1)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    label = rows.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    shared = np.flatnonzero((bands == bands[0]).all(0))
    earlier = int(shared[0]) if by_band and len(shared) else 0
    first = np.flatnonzero(sides != 1)
    second = first if sides[0] == 2 else np.flatnonzero(sides == 1)
    left, right, agree = [], [], []
    for at in range(0, len(first), 64):
        some = first[at : at + 64]
        same = np.zeros((len(some), len(second)), np.uint8)
        for j in range(samples.shape[1]):
            same += samples[some, j][:, None] == samples[second, j]
        good = (same >= least) & (label[some][:, None] != label[second])
        if second is first:
            good &= some[:, None] < second
        for j in range(earlier):  # pairs that meet in an earlier bucket
            good &= bands[some, j][:, None] != bands[second, j]
        x, y = np.nonzero(good)
        left.append(some[x]), right.append(second[y]), agree.append(same[x, y])
    left, right, agree = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (left, right, agree))
    used = np.unique(np.concatenate((left, right)))
    values, of, counts = distinct_shingles(rows.column("text").combine_chunks().take(pa.array(used, pa.int64())), size)
    weights = sampler.weights(values, counts)
    bounds = np.searchsorted(of, np.arange(len(used) + 1))
    place = {int(u): (bounds[i], bounds[i + 1]) for i, u in enumerate(used)}
    parent = list(range(int(label.max()) + 1))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    links: list[tuple[int, int, float]] = []
    for i in np.argsort(-agree.astype(int), kind="stable"):
        x, y = int(left[i]), int(right[i])
        one, other = root(int(label[x])), root(int(label[y]))
        if one != other:
            (p, q), (u, v) = place[x], place[y]
            _, in_x, in_y = np.intersect1d(values[p:q], values[u:v], assume_unique=True, return_indices=True)
            common = np.minimum(weights[p:q][in_x], weights[u:v][in_y]).sum()
            similarity = common / (weights[p:q].sum() + weights[u:v].sum() - common)
            if similarity >= threshold:
                parent[max(one, other)] = min(one, other)
                links.append((x, y, float(similarity)))
    node = rows.column("node").combine_chunks()
    a, b, similar = ([k[i] for k in links] for i in range(3))
    return pa.table({"a": node.take(pa.array(a, pa.int64())), "b": node.take(pa.array(b, pa.int64())), "similarity": pa.array(similar, pa.float64())})


def near_links(docs: DataFrame, threshold: float = THRESHOLD, seed: int = 0, text: str = "text") -> DataFrame:
    """(a, b, similarity) of linked nodes: enough links to hold every class together."""
    sampler = Sampler(feature_idf(docs, text), seed)
    nodes = stored(node_table(docs, sampler, text), "minhash-nodes")
    groups = stored(band_table(nodes), "minhash-groups")
    texts = shared_texts(groups, docs, text)
    weights = nodes.select("node", "weight")
    n_nodes = nodes.count()
    compared = links = labels = None
    first = True

    def verified(pairs: DataFrame, listed: bool = False) -> DataFrame:
        return stored(similarities(pairs.withColumn("listed", F.lit(listed)), texts, sampler, threshold), "minhash-compared")

    def linked(new: DataFrame) -> None:
        """Take new comparisons (a, b, similarity) into the links and components."""
        nonlocal compared, links, labels
        found = new.filter(F.col("similarity") >= threshold).select("a", "b", "similarity")
        labels = stored(components(found), "labels") if labels is None else _joined(labels, found)
        pairs = new.select("a", "b")
        compared = pairs if compared is None else compared.unionByName(pairs)
        links = found if links is None else links.unionByName(found)

    while True:
        led = stored(_led(groups), "minhash-led")
        pairs = led.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        linked(verified(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti")))

        everyone = led.select("grp", "node").unionByName(led.select("grp", F.col("leader").alias("node")).distinct())
        named = stored(everyone.join(labels, "node", "left").select("grp", "node", F.coalesce("label", "node").alias("label")), "minhash-named")
        each = named.groupBy("grp", "label").agg(F.count("*").alias("m"))
        sizes = each.groupBy("grp").agg(F.sum("m").alias("n"), F.expr("(sum(m) * sum(m) - sum(m * m)) div 2").alias("pairs"))
        sizes = stored(sizes.filter("pairs > 0"), "minhash-open")
        left = sizes.agg(F.sum("pairs")).first()[0]
        if left is None:
            return links
        still = named.join(sizes.select("grp", "n"), "grp")
        if left <= PAIRS * n_nodes:
            found = stored(_links_across(still, nodes, texts, sampler, threshold, first), "minhash-across")
            return links.unionByName(found)
        first = False

        # Leaders of the groups that are left list what their members hold above them; members meet by that.
        apart = led.join(sizes.select("grp"), "grp", "left_semi").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        above = verified(apart, listed=True).select("a", F.col("b").alias("node"), F.explode("above").alias("shingle"))
        shared = above.join(labels, "node", "left").select(
            F.xxhash64("a", "shingle").alias("grp"), "node", F.coalesce("label", "node").alias("label")
        ).distinct()
        shared = stored(shared, "minhash-above")
        several = shared.groupBy("grp").agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("members"),
        ).filter("low <> high").groupBy("members", "n").agg(F.min("grp").alias("grp"))  # one group for each set of members
        groups = stored(shared.join(several.select("grp"), "grp").select("grp", "node").join(weights, "node").select("grp", "node", "weight"), "minhash-groups")
        if groups.isEmpty():
            return links


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, seed: int = 0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, node, label (what its class shares), class_id (the class's least doc_id) and class_size."""
    labels = components(near_links(docs, threshold, seed, text))
    nodes = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.unhex(node(text)).alias("node"))
    known = stored(
        nodes.join(labels, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label")), "minhash-classes"
    )
    classes = known.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return known.join(classes, "label").select("doc_id", "node", "label", "class_id", "class_size")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, seed: int = 0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, the one with the least id (null last) and then text digest, with its columns."""
    found = stored(near_classes(docs, threshold, seed, id_col, text), "near-classes")
    rows = found.groupBy("label", "doc_id", "node").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node", "n")).alias("head")
    heads = stored(rows.groupBy("label").agg(first).select("head.*"), "class-heads")
    wanted = heads.select(F.struct("doc_id", "node").alias("head"))
    rows = docs.select(F.struct("*").alias("row"), F.col(quoted(id_col)).alias("id"), F.unhex(node(text)).alias("key"))
    same = F.col("id").eqNullSafe(F.col("head.doc_id")) & (F.col("key") == F.col("head.node"))
    kept = rows.join(wanted, same, "left_semi")
    # Rows of one id and text are told apart by nothing: one of them stays.
    return (kept if heads.filter("n > 1").isEmpty() else kept.dropDuplicates(["id", "key"])).select("row.*")
