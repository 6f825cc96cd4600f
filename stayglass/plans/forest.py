"""Regression forests that stay cheap when they are deep.

Features are binned once into bytes. Rows with equal bins take the same way through every tree, so a tree needs the sums of
their weights and labels alone: rows are brought together by their bins, and written in blocks of cells. A block whose
cells have many rows holds their sums for each tree; one whose cells have few holds the rows, and sums are made again when
they are needed. Nothing is assumed of the rows: where all differ, each is a cell.

A node that many cells reach is split by histograms: each task sums weights and labels per (tree, node, feature, bin), Spark
adds them up, and one row per node comes back, the best split. As soon as a node has ``small`` cells or fewer, they go to
one task, which grows the rest of the subtree in memory. So the number of passes depends on the cells, not on the depth or
the number of nodes, and no task holds more than ``small`` cells of a node. Bootstrap weights come from a hash of row and
tree; a lost task draws the same again.

Trees are rows (tree, node, feature, cut, value, gain): node 1 is the root, 2n and 2n + 1 its children. For scoring they are
broadcast once; their size is bounded by trees and depth.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import JavaMLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayglass.operators.sums import summed
from stayglass.session import work_path

NODES = "tree int, node bigint, feature int, cut int, value double, gain double, weight double"


BLOCK = 250_000  # rows that a task holds at a time
CHUNK = 16_384  # rows that are scored, cells of a histogram that are compared at a time
BUCKET_BITS = 10  # buckets by which equal rows meet
DEARER = 4  # sums are kept for each tree if they take at most so many times the bytes of the rows
BLOCKS = "rows bigint, cells bigint, b binary, first binary, id binary, y binary, w binary, wy binary"
CLOSE = 1e-7  # gains this close are equal; the lowest feature and cut are taken


@dataclass(frozen=True)
class ForestSettings:
    trees: int
    depth: int
    least: int  # rows on either side of a split
    share: str  # features tried for a split: "all" or "sqrt"
    seed: int
    bins: int = 64
    sample: int = 20_000  # rows that choose the cuts between bins
    small: int = 1_000_000  # cells of rows of a node that one task takes over
    cells: int = 2_000_000  # histogram cells that one task sums at a time

    def tried(self, features: int) -> int:
        return features if self.share == "all" else max(1, int(np.ceil(np.sqrt(features))))


# --- bins and bootstrap -------------------------------------------------------------------------------------------


def find_cuts(rows: DataFrame, s: ForestSettings) -> list[np.ndarray]:
    """Ascending cuts of each feature, at quantiles of a bounded sample by hash; few values are cut between all of them."""
    sample = rows.orderBy("id").limit(s.sample).select("x").toPandas()["x"]
    values = np.stack(sample.to_numpy()) if len(sample) else np.zeros((0, 0))
    cuts = []
    for column in values.T:
        known = np.unique(column)
        if len(known) > s.bins:
            known = np.unique(np.quantile(column, np.arange(1, s.bins) / s.bins, method="inverted_cdf"))
        else:
            known = (known[1:] + known[:-1]) / 2
        cuts.append(known)
    return cuts


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]).astype(np.uint8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1, np.arange(1, 12)]))
# numbers by the first 12 bits of what is drawn, -1 where the other bits decide
_FIRST, _LAST = (np.searchsorted(_POISSON, ((np.arange(4096, dtype=np.uint64) << np.uint64(41)) + np.uint64(end)) / 2.0**53, "right") for end in (0, 2**41 - 1))
_NUMBERS = np.where(_FIRST == _LAST, _FIRST, -1.0)


def _weights(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree has each row: Poisson numbers of mean 1."""
    drawn = _mix(ids.view(np.uint64) + _mix(np.full(1, seed * 1_000_003 + tree + 1, np.uint64)))
    out = _NUMBERS[(drawn >> np.uint64(52)).view(np.int64)]
    open_ = np.flatnonzero(out < 0)
    out[open_] = np.searchsorted(_POISSON, (drawn[open_] >> np.uint64(11)) / 2.0**53, "right")
    return out


def _chosen(tree: int, nodes: np.ndarray, features: int, s: ForestSettings) -> np.ndarray:
    """Features that each node tries, as a mask: those with its smallest hashes."""
    k = s.tried(features)
    if k >= features:
        return np.ones((len(nodes), features), bool)
    seeds = _mix(nodes.astype(np.uint64) + _mix(np.full(1, s.seed * 7_368_787 + tree, np.uint64)))
    drawn = _mix(seeds[:, None] + np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(nodes), features), bool)
    np.put_along_axis(out, np.argsort(drawn, axis=1)[:, :k], True, axis=1)
    return out


# --- growing ------------------------------------------------------------------------------------------------------


def _best_cuts(key_node: np.ndarray, key_bin: np.ndarray, w: np.ndarray, wy: np.ndarray, nodes: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one feature the best cut and its gain for each node. Rows are cells (node, bin) in order, each once."""
    best, cut = np.zeros(nodes), np.full(nodes, -1, np.int64)
    if not len(key_node):
        return best, cut
    first = np.flatnonzero(np.r_[True, key_node[1:] != key_node[:-1]])
    size = np.diff(np.r_[first, len(key_node)])
    total_w, total_y = np.add.reduceat(w, first), np.add.reduceat(wy, first)
    at = np.repeat(np.arange(len(first)), size)
    left_w = np.cumsum(w) - np.r_[0, np.cumsum(total_w)[:-1]][at]
    left_y = np.cumsum(wy) - np.r_[0, np.cumsum(total_y)[:-1]][at]
    right_w, right_y = total_w[at] - left_w, total_y[at] - left_y
    fits = (left_w >= least) & (right_w >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, left_y**2 / left_w + right_y**2 / right_w - (total_y**2 / total_w)[at], -1.0)
    top = np.maximum.reduceat(gain, first)
    hit = np.flatnonzero(gain >= (top - np.abs(top) * CLOSE)[at])
    _, one = np.unique(at[hit], return_index=True)  # the lowest of equal cuts
    owner = key_node[first]
    good = top > 1e-12
    best[owner[good]], cut[owner[good]] = top[good], key_bin[hit[one]][good]
    return best, cut


def _cells(node: np.ndarray, bins: np.ndarray, w: np.ndarray, wy: np.ndarray):
    """Sums of rows with equal node and bin, in order."""
    key = node * 256 + bins
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    if not len(first):
        return key, key, w[:0], wy[:0]
    return key[first] // 256, key[first] % 256, np.add.reduceat(w[order], first), np.add.reduceat(wy[order], first)


def _best_dense(base: np.ndarray, bins: np.ndarray, w: np.ndarray, wy: np.ndarray, nodes: int, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``_best_cuts`` by one histogram of ``nodes`` times ``width`` cells; ``base`` is a row's first cell."""
    key = base + bins
    all_w, all_y = np.bincount(key, w, nodes * width).reshape(nodes, width), np.bincount(key, wy, nodes * width).reshape(nodes, width)
    best, cut, some = np.empty(nodes), np.empty(nodes, np.int64), max(1, CHUNK // width)
    for a in range(0, nodes, some):  # a few at a time stay near the processor
        left_w, left_y = np.cumsum(all_w[a : a + some], axis=1), np.cumsum(all_y[a : a + some], axis=1)
        total_w, total_y = left_w[:, -1:].copy(), left_y[:, -1:].copy()
        right_w = total_w - left_w
        fits = (left_w >= least) & (right_w >= least)
        # left_y**2 / left_w + right_y**2 / right_w - total_y**2 / total_w
        left_y *= total_w
        left_y -= total_y * left_w
        left_y *= left_y
        right_w *= left_w
        right_w *= total_w
        gain = np.divide(left_y, right_w, out=np.full_like(left_y, -1.0), where=fits)
        top = gain.max(axis=1)
        # an empty bin repeats the gain of the one before it, so the first of equal cuts is never an empty one
        at = (gain >= (top - np.abs(top) * CLOSE)[:, None]).argmax(axis=1)
        good = top > 1e-12
        best[a : a + some], cut[a : a + some] = np.where(good, top, 0.0), np.where(good, at, -1)
    return best, cut


def grow(tree: int, root: int, bins: np.ndarray, y: np.ndarray, w: np.ndarray, s: ForestSettings) -> list[np.ndarray]:
    """Columns of the nodes of a subtree, level by level over all its rows. ``y`` is centred for exact enough sums."""
    centre = float(np.average(y, weights=w))
    y, w = y - centre, w.astype(np.float64)
    wy = w * y
    heap, node = np.array([root], np.int64), np.zeros(len(y), np.int64)
    out, features = [], bins.shape[1]
    bins = np.ascontiguousarray(bins.T)  # a feature's bins together
    width = int(bins.max(initial=0)) + 1
    k, rows = s.tried(features), np.arange(len(y))
    while len(heap):
        level = int(heap[0]).bit_length() - 1
        total = np.bincount(node, w, len(heap))
        value = np.bincount(node, wy, len(heap)) / total
        best, feature, cut = np.zeros(len(heap)), np.full(len(heap), -1), np.full(len(heap), -1)
        if level < s.depth:
            tried = _chosen(tree, heap, features, s)
            which = np.nonzero(tried)[1].reshape(len(heap), k)  # of each node, ascending
            # deep levels have fewer rows than cells
            dense, base = len(heap) * width <= max(4 * len(node), 4096), node * width
            for j in range(k if dense else features):
                if not dense:
                    some = slice(None) if k == features else np.flatnonzero(tried[node, j])
                    gain, at = _best_cuts(*_cells(node[some], bins[j, some], w[some], wy[some]), len(heap), s.least)
                    of = j
                else:
                    of = which[:, j]
                    mine = bins[j] if k == features else bins.reshape(-1)[(of * len(rows))[node] + rows]
                    gain, at = _best_dense(base, mine, w, wy, len(heap), width, s.least)
                better = gain > best * (1 + CLOSE)
                best, feature, cut = np.where(better, gain, best), np.where(better, of, feature), np.where(better, at, cut)
        out.append((np.full(len(heap), tree), heap, feature, cut, value + centre, best, total))
        split = feature >= 0
        place = np.cumsum(split) * 2 - 2
        if not split.all():
            keep = np.flatnonzero(split[node])
            bins, w, wy, node, rows = bins[:, keep], w[keep], wy[keep], node[keep], rows[: len(keep)]
        right = bins.reshape(-1)[(feature * len(rows))[node] + rows] > cut[node]
        node = place[node] + right
        heap = np.repeat(heap[split] * 2, 2) + np.tile([0, 1], int(split.sum()))
        if level % 4 == 3 and len(node) > CHUNK and len(heap) <= 2**16:
            # rows of a node together, so that what is added up stays near the processor
            order = np.argsort(node.astype(np.uint16), kind="stable")
            bins, w, wy, node = np.ascontiguousarray(bins[:, order]), w[order], wy[order], node[order]
    return [np.concatenate(c) for c in zip(*out)]


def _node_table(columns) -> pa.Table:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
    names = [c.split()[0] for c in NODES.split(", ")]
    return pa.table({n: pa.array(np.asarray(c), k) for n, c, k in zip(names, columns, kinds)})


def _compiled(splits: dict[int, tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """A tree as arrays: (node, feature, cut, place of the left child or -1)."""
    heap, feature, cut, left = [1], [], [], []
    for n in heap:  # grows on the way
        f, c = splits.get(n, (-1, 0))
        feature.append(f)
        cut.append(c)
        left.append(len(heap) if f >= 0 else -1)
        if f >= 0:
            heap += [2 * n, 2 * n + 1]
    return np.array(heap, np.int64), np.array(feature), np.array(cut), np.array(left)


def _descend(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Place of the node without a split, so far, that each row reaches."""
    at, going = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(going):
        going = going[left[at[going]] >= 0]
        here = at[going]
        at[going] = left[here] + (bins[going, feature[here]] > cut[here])
    return at


@dataclass
class Cells:
    """Some rows, those with equal bins together."""

    bins: np.ndarray  # of each cell
    first: np.ndarray  # place of a cell's first row
    ids: np.ndarray | None
    y: np.ndarray | None
    w: np.ndarray | None = None  # for each tree and cell, in place of the rows
    wy: np.ndarray | None = None

    @classmethod
    def of(cls, ids: np.ndarray, y: np.ndarray, bins: np.ndarray) -> Cells:
        first = np.flatnonzero(np.r_[True, (bins[1:] != bins[:-1]).any(axis=1)])
        return cls(bins[first], first, ids, y)

    def sums(self, tree: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights and weighted labels of the cells in a tree."""
        if self.w is not None:
            return self.w[tree].astype(np.float64), self.wy[tree]
        w = _weights(self.ids, tree, seed)
        wy = w * self.y
        if len(self.first) == len(w):
            return w, wy
        return np.add.reduceat(w, self.first), np.add.reduceat(wy, self.first)

    def record(self, s: ForestSettings) -> list:
        """A row of ``BLOCKS``."""
        out = [len(self.ids), len(self.first), self.bins.tobytes(), self.first.tobytes()]
        if len(self.first) * s.trees * 12 > len(self.ids) * 16 * DEARER:
            return [*out, self.ids.tobytes(), self.y.tobytes(), None, None]
        w, wy = zip(*(self.sums(tree, s.seed) for tree in range(s.trees)))
        return [*out, None, None, np.stack(w).astype(np.uint32).tobytes(), np.stack(wy).tobytes()]


def _in_order(ids: np.ndarray, y: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, id, label, bins) of rows, in the order of a hash of the bins: those with equal bins are together."""
    words = np.zeros((len(bins), -(-bins.shape[1] // 8) * 8), np.uint8)
    words[:, : bins.shape[1]] = bins
    key = np.zeros(len(bins), np.uint64)
    for word in words.view(np.uint64).T:
        key = _mix((key ^ word) + np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    return (key[order] >> np.uint64(64 - BUCKET_BITS)).view(np.int64), ids[order], y[order], bins[order]


def _dealt(batches, cuts: list[np.ndarray]):
    """Rows (id, y, x) binned, in runs of a bucket; equal bins are in the same bucket."""

    def runs(ids, y, bins):
        bucket, *columns = _in_order(ids, y, bins)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist()
        out = [[c[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(bucket)])] for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *(pa.array(c, pa.binary()) for c in out)], ["bucket", "id", "y", "b"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, len(cuts))
            held.append((batch.column("id").to_numpy(), batch.column("y").to_numpy(), _binned(x, cuts)))
            size += batch.num_rows
        if size >= BLOCK:
            yield runs(*(np.concatenate(c) for c in zip(*held)))
            held, size = [], 0
    if size:
        yield runs(*(np.concatenate(c) for c in zip(*held)))


def _packed(batches, features: int, s: ForestSettings):
    """Runs, bucket by bucket, in blocks."""
    held, size = [], 0

    def block():
        _, *columns = _in_order(*(np.concatenate(c) for c in zip(*held)))
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 6)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(Cells.of(*columns).record(s), kinds)], [c.split()[0] for c in BLOCKS.split(", ")])

    for batch in batches:
        for run in zip(*(batch.column(c) for c in ("id", "y", "b"))):
            ids, y, bins = (np.frombuffer(c.as_buffer(), kind) for c, kind in zip(run, (np.int64, np.float64, np.uint8)))
            held.append((ids, y, bins.reshape(-1, features)))
            size += len(ids)
            if size >= BLOCK:
                yield block()
                held, size = [], 0
    if size:
        yield block()


def _blocks(batches, features: int, trees: int):
    """The cells of each block."""

    def array(cell, kind, *shape):
        return np.frombuffer(cell.as_buffer(), kind).reshape(*shape) if cell.is_valid else None

    for batch in batches:
        for b, first, ids, y, w, wy in zip(*(batch.column(c) for c in ("b", "first", "id", "y", "w", "wy"))):
            yield Cells(
                array(b, np.uint8, -1, features), array(first, np.int64, -1), array(ids, np.int64, -1), array(y, np.float64, -1),
                array(w, np.uint32, trees, -1), array(wy, np.float64, trees, -1),
            )


def _histograms(table: DataFrame, splits: dict, frontier: list[tuple[int, int]], features: int, s: ForestSettings) -> list:
    """Per open node (tree, node): weight, sum of labels, the best split, and how many cells it has."""
    shared = table.sparkSession.sparkContext.broadcast((splits, frontier))  # cells / small nodes a tree at most
    per = features * 256

    def sums(batches):
        splits, frontier = shared.value
        w_sum, y_sum, known = np.zeros(len(frontier) * per), np.zeros(len(frontier) * per), np.zeros(len(frontier))
        # open nodes come tree by tree, so each tree has histograms of its own, feature by feature
        walks, first = [], 0
        while first < len(frontier):
            tree, last = frontier[first][0], first
            while last < len(frontier) and frontier[last][0] == tree:
                last += 1
            heap, *walk = _compiled(splits.get(tree, {}))
            place = {n: i for i, (_, n) in enumerate(frontier[first:last])}
            walks.append((tree, first, last, walk, np.array([place.get(n, -1) for n in heap.tolist()])))
            first = last
        for block in _blocks(batches, features, s.trees):
            columns = np.ascontiguousarray(block.bins.T)
            for tree, first, last, walk, place in walks:
                w, wy = block.sums(tree, s.seed)
                at = place[_descend(*walk, block.bins)]
                some = np.flatnonzero((at >= 0) & (w > 0))
                w, wy, at, nodes = w[some], wy[some], at[some], last - first
                known[first:last] += np.bincount(at, minlength=nodes)
                base = at * 256
                for j in range(features):
                    cell, mine = base + columns[j, some], slice(first * per + j * nodes * 256, first * per + (j + 1) * nodes * 256)
                    w_sum[mine] += np.bincount(cell, w, nodes * 256)
                    y_sum[mine] += np.bincount(cell, wy, nodes * 256)
        for tree, first, last, _, _ in walks:
            mine = slice(first * per, last * per)
            for a in (w_sum, y_sum):
                a[mine] = a[mine].reshape(features, last - first, 256).swapaxes(0, 1).reshape(-1)
        full = np.flatnonzero(w_sum)
        # a node's cells are counted beside its first cell
        lead = np.r_[True, full[1:] // per != full[:-1] // per] if len(full) else np.zeros(0, bool)
        count = np.where(lead, known[full // per], 0.0)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(w_sum[full]), pa.array(y_sum[full]), pa.array(count)], ["cell", "w", "wy", "k"])

    def choose(group):
        cell = group.column("cell").to_numpy()
        order = np.argsort(cell)
        cell, w, wy = cell[order], group.column("w").to_numpy()[order], group.column("wy").to_numpy()[order]
        tree, node = frontier[int(cell[0] // per)]
        feature, bins = cell % per // 256, cell % 256
        whole = feature == feature[0]
        weight, total = w[whole].sum(), wy[whole].sum()
        wy = wy - w * (total / weight)
        best = (0.0, -1, -1)
        tried = _chosen(tree, np.array([node]), features, s)[0] & (node.bit_length() - 1 < s.depth)
        for j in np.flatnonzero(tried):
            mine = feature == j
            gain, cut = _best_cuts(np.zeros(int(mine.sum()), np.int64), bins[mine], w[mine], wy[mine], 1, s.least)
            if gain[0] > best[0] * (1 + CLOSE):
                best = (gain[0], int(j), int(cut[0]))
        known = pa.array([group.column("k").to_numpy().sum()])
        return _node_table([[tree], [node], [best[1]], [best[2]], [total / weight], [best[0]], [weight]]).append_column("cells", known)

    added = table.mapInArrow(sums, "cell bigint, w double, wy double, k double").groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("w", "wy", "k")])
    return added.withColumn("open", F.expr(f"cell div {per}")).groupBy("open").applyInArrow(lambda t: choose(t), f"{NODES}, cells double").collect()


def train(rows: DataFrame, s: ForestSettings) -> tuple[list[np.ndarray], DataFrame]:
    """(cuts, nodes) of a forest over ``rows`` (id bigint, y double, x array of doubles)."""
    spark = rows.sparkSession
    cuts = find_cuts(rows, s)
    features = len(cuts)

    path = work_path(spark, "forest-cells")
    runs = rows.select("id", "y", "x").mapInArrow(lambda batches: _dealt(batches, cuts), "bucket bigint, id binary, y binary, b binary")
    # equal bins meet, and many equal ones are dealt over several tasks
    together = runs.hint("rebalance", "bucket").sortWithinPartitions("bucket")
    together.mapInArrow(lambda batches: _packed(batches, features, s), BLOCKS).write.parquet(path)
    table = spark.read.parquet(path)
    count = table.agg(F.sum("cells")).first()[0]
    if not count:
        raise ValueError("no rows to learn from")

    # nodes that many cells reach, level by level
    splits: dict[int, dict[int, tuple[int, int]]] = {t: {} for t in range(s.trees)}
    top, wave = [], max(1, s.cells // (features * 256))
    open_ = [(t, 1) for t in range(s.trees)] if count > s.small else []
    # nodes of the last level are opened too: they become leaves without their cells meeting in a task
    while open_:
        found = []
        for a in range(0, len(open_), wave):
            found += _histograms(table, splits, open_[a : a + wave], features, s)
        top += [tuple(r)[:-1] for r in found]
        open_ = []
        for r in found:
            if r.feature >= 0:
                splits[r.tree][r.node] = (r.feature, r.cut)
        sizes = {(r.tree, r.node): r for r in found}
        for (tree, node), r in sizes.items():
            # a child may have as many cells as its parent, less one
            if r.feature >= 0 and r.cells - 1 > s.small and (2 * node).bit_length() - 1 <= s.depth:
                open_ += [(tree, 2 * node), (tree, 2 * node + 1)]
        open_.sort()  # tree by tree
    done = {(r[0], r[1]) for r in top}
    shared = spark.sparkContext.broadcast((splits, done))

    def deal(batches):
        splits, done = shared.value
        walks = [_compiled(splits[tree]) for tree in range(s.trees)]
        for block in _blocks(batches, features, s.trees):
            for tree, (heap, *walk) in enumerate(walks):
                w, wy = block.sums(tree, s.seed)
                some = np.flatnonzero(w)
                if len(heap) > 1:
                    at = _descend(*walk, block.bins[some])
                    order = np.argsort(at, kind="stable")
                    some, at = some[order], at[order]
                    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
                else:
                    at, starts = np.zeros(len(some), np.int64), np.zeros(min(len(some), 1), np.int64)
                out = [[], [], [], [], []]
                for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(at)]):
                    n, mine = int(heap[at[a]]), some[a:b]
                    if (tree, n) in done:  # a leaf already
                        continue
                    for column, value in zip(out, (tree, n, wy[mine].tobytes(), block.bins[mine].tobytes(), w[mine].astype(np.uint32).tobytes())):
                        column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["tree", "node", "wy", "b", "w"])

    def finish(group):
        wy, w, bins = (np.concatenate([np.frombuffer(c.as_buffer(), kind) for c in group.column(name)]) for name, kind in (("wy", np.float64), ("w", np.uint32), ("b", np.uint8)))
        return _node_table(grow(group.column("tree")[0].as_py(), group.column("node")[0].as_py(), bins.reshape(-1, features), wy / w, w, s))

    below = table.mapInArrow(deal, "tree int, node bigint, wy binary, b binary, w binary").groupBy("tree", "node").applyInArrow(finish, NODES)
    path = work_path(spark, "forest-nodes")
    below.unionByName(spark.createDataFrame(top, NODES)).write.parquet(path)
    return cuts, spark.read.parquet(path)


# --- estimator and model --------------------------------------------------------------------------------------------


def _records(feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Each node as one number: left child, feature, cut. A leaf is its own child, and no bin is past its cut."""
    leaf = left < 0
    return np.where(leaf, np.arange(len(left)), left).astype(np.int64) << 24 | np.where(leaf, 0, feature).astype(np.int64) << 8 | np.where(leaf, 255, cut).astype(np.int64)


def _leaves(root: int, records: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The leaf below a root that each row reaches."""
    flat, start = bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
    at = np.full(len(bins), root)
    while True:
        here = records[at]
        below = (here >> 24) + (flat[start + (here >> 8 & 0xFFFF)] > (here & 0xFF))
        if (below == at).all():
            return at
        at = below


def _distinct(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, place of each row among them)."""
    whole = np.zeros((len(bins), -(-bins.shape[1] // 8) * 8), np.uint8)
    whole[:, : bins.shape[1]] = bins
    key = whole.view(np.uint64)
    if key.shape[1] == 1:
        _, first, place = np.unique(key[:, 0], return_index=True, return_inverse=True)
    else:
        _, first, place = np.unique(whole.view(f"V{whole.shape[1]}")[:, 0], return_index=True, return_inverse=True)
    return bins[first], place.reshape(-1)


class Forest(Estimator):
    """Learns from the ``features`` vector and a label column."""

    def __init__(self, label: str, settings: ForestSettings):
        super().__init__()
        self.label, self.settings = label, settings

    def setNumTrees(self, trees: int) -> Forest:
        self.settings = replace(self.settings, trees=trees)
        return self

    def setMaxDepth(self, depth: int) -> Forest:
        self.settings = replace(self.settings, depth=depth)
        return self

    def _fit(self, dataset: DataFrame) -> ForestModel:
        known = dataset.where(F.col(self.label).isNotNull()).select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y"))
        rows = known.withColumn("id", F.xxhash64("x", "y", F.monotonically_increasing_id()))
        cuts, nodes = train(rows, self.settings)
        return ForestModel(cuts, nodes, self.settings)


class ForestModel(Model, MLWritable, JavaMLReadable):
    """A fitted forest. ``nodes`` is its table of nodes. Trees are averaged, or added to ``shift``."""

    def __init__(self, cuts=None, nodes: DataFrame | None = None, settings: ForestSettings | None = None, shift: float = 0.0, averaged: bool = True, label: str | None = None):
        super().__init__()
        self.cuts, self.nodes, self.settings, self.shift, self.averaged, self.label = cuts, nodes, settings, shift, averaged, label
        self._packed = None

    def packed(self) -> tuple:
        """(roots, feature, cut, left child, value) as arrays over all nodes; its size is bounded by trees and depth."""
        if self._packed is None:
            got = self.nodes.select("tree", "node", "feature", "cut", "value").toArrow()
            tree, node, feature, cut, value = (got.column(i).to_numpy() for i in range(5))
            order = np.lexsort((node, tree))
            key = tree[order].astype(np.int64) << 40 | node[order]
            feature, cut, value = feature[order], cut[order], value[order].astype(np.float32)
            child = np.searchsorted(key, (tree[order].astype(np.int64) << 40) | (node[order] * 2))
            self._packed = (np.flatnonzero(node[order] == 1).astype(np.int32), feature.astype(np.int16), cut.astype(np.uint8), np.where(feature >= 0, child, -1).astype(np.int32), value)
        return self._packed

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared, cuts = dataset.sparkSession.sparkContext.broadcast(self.packed()), self.cuts
        shift, averaged = self.shift, self.averaged

        def scores(x: list[np.ndarray]) -> pa.Array:
            roots, feature, cut, left, value = shared.value
            records = _records(feature, cut, left)
            bins, place = _distinct(np.concatenate([_binned(part, cuts) for part in x]))
            total = np.zeros(len(bins))
            for a in range(0, len(bins), CHUNK):
                for root in roots:
                    total[a : a + CHUNK] += value[_leaves(root, records, bins[a : a + CHUNK])]
            return pa.array((total / max(len(roots), 1) if averaged else total + shift)[place])

        @F.arrow_udf("double")
        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            held, size = [], 0
            for x in batches:
                if len(x):
                    held.append(x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), len(cuts)))
                    size += len(x)
                if size >= BLOCK:
                    yield scores(held)
                    held, size = [], 0
            yield scores(held) if held else pa.array([], pa.float64())

        return dataset.withColumn("prediction", predict(vector_to_array("features")))

    @property
    def getNumTrees(self) -> int:
        return len(self.packed()[0])

    def evaluateEachIteration(self, dataset: DataFrame, loss: str = "squared") -> list[float]:
        """Mean squared error after each of the added trees, over the rows with a label."""
        if loss != "squared" or self.averaged:
            raise ValueError("squared errors of added trees alone")
        shared, cuts, shift = dataset.sparkSession.sparkContext.broadcast(self.packed()), self.cuts, self.shift
        rows = dataset.select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y")).where("y IS NOT NULL")

        def add(batches, total):
            roots, feature, cut, left, value = shared.value
            records = _records(feature, cut, left)
            for batch in batches:
                if batch.num_rows:
                    bins = _binned(batch.column("x").flatten().to_numpy().reshape(-1, len(cuts)), cuts)
                    error = batch.column("y").to_numpy() - shift
                    total[-1] += len(error)
                    for k, root in enumerate(roots):
                        error = error - value[_leaves(root, records, bins)]
                        total[k] += error @ error

        total = summed(rows, self.getNumTrees + 1, add, rows.rdd.getNumPartitions())
        return (total[:-1] / total[-1]).tolist() if total[-1] else [float("nan")] * self.getNumTrees

    @property
    def importances(self) -> np.ndarray:
        """Share of each feature in the gain of a tree, averaged over the trees."""
        gains = self.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("g")).toPandas()
        shares = gains["g"] / gains.groupby("tree")["g"].transform("sum")
        total = shares.groupby(gains["feature"]).sum().reindex(range(len(self.cuts)), fill_value=0.0).to_numpy()
        return total / total.sum() if total.sum() else total

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, SparkSession.getActiveSession()
        facts = {"class": f"{ForestModel.__module__}.{ForestModel.__name__}", "uid": m.uid, "timestamp": 0, "sparkVersion": spark.version, "paramMap": {}, "defaultParamMap": {}}
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        more = {"settings": asdict(m.settings), "cuts": [c.tolist() for c in m.cuts], "shift": m.shift, "averaged": m.averaged, "label": m.label}
        spark.createDataFrame([(json.dumps(more),)], "value string").coalesce(1).write.text(f"{path}/facts")
        m.nodes.write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.getActiveSession()
        facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
        return ForestModel([np.array(c) for c in facts["cuts"]], spark.read.parquet(f"{path}/nodes"), ForestSettings(**facts["settings"]), facts.get("shift", 0.0), facts.get("averaged", True), facts.get("label"))
