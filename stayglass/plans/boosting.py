"""Gradient boosting of squared errors by histograms, each round one tree, each level one pass over binned rows.

Features are binned once into bytes; rows are written in blocks of many, with their residuals. A pass adds up counts and
residuals per (node, feature, bin) in its tasks; an array of fixed size comes back and chooses the splits of a level.
Residuals follow the trees: a round reads them from Spark's cache, which is made from the last written blocks and the
trees since; every ``renew`` rounds the blocks are written again. Rows of a round are drawn by a generator that is seeded
by block and round, so a lost task draws the same again.

Up to ``alone`` rows, with or without many equal ones, are boosted in a task, as passes would take longer than their work:
its rows with equal bins are one cell, and a round adds up what is drawn of each cell once for all levels. The trees are the same.

As in Spark's own boosting, the first tree counts in full, and later ones fit twice the residual and count by ``rate``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass.operators.sums import summed
from stayglass.plans.forest import CLOSE, NODES, ForestModel, ForestSettings, _binned, _distinct, find_cuts
from stayglass.session import work_path

BLOCK = 65_536  # rows of a block
BLOCKS = "block bigint, r binary, b binary, held binary"


@dataclass(frozen=True)
class BoostSettings:
    rounds: int
    depth: int
    rate: float
    subsample: float
    seed: int
    patience: int = 10  # rounds without gain on the held rows after which boosting stops
    bins: int = 64
    renew: int = 10
    alone: int = 4_000_000  # rows that one task boosts in memory


def best_round(losses, patience: int) -> int:
    """Rounds to keep: the best one so far when ``patience`` rounds in a row are no better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


@dataclass
class Tree:
    """Nodes of a full binary tree, level by level: node i has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # -1: no split
    cut: np.ndarray
    value: np.ndarray  # what is added to a prediction
    gain: np.ndarray
    weight: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n))

    def below(self, at: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """The children that rows at some nodes go to; where there is no split they stay."""
        f, n = self.feature[at], bins.shape[1]
        down = 2 * at + 1 + (bins.reshape(-1)[np.maximum(f, 0) * n + np.arange(n)] > self.cut[at])
        return np.where(f >= 0, down, at)

    def reach(self, bins: np.ndarray) -> np.ndarray:
        """Node without a split, so far, of each row; ``bins`` has a row for each feature."""
        at = np.zeros(bins.shape[1], np.int64)
        for _ in range(int(np.log2(len(self.feature) + 1)) - 1):
            if not (self.feature[at] >= 0).any():
                break
            at = self.below(at, bins)
        return at


def _cells(batch: pa.RecordBatch):
    """(block, residuals, bins by feature, held) of each block of a batch."""
    for block, r, b, held in zip(batch.column("block").to_pylist(), batch.column("r"), batch.column("b"), batch.column("held")):
        r = np.frombuffer(r.as_buffer(), np.float64)
        yield block, r, np.frombuffer(b.as_buffer(), np.uint8).reshape(-1, len(r)), np.frombuffer(held.as_buffer(), np.bool_)


def _blocks(rows: DataFrame, cuts: list[np.ndarray], shift: float) -> DataFrame:
    """Rows (x, y, held) in blocks, with bins and the residuals of ``shift``."""

    def pack(batches):
        base, made, kept, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def block():
            y, held, x = (np.concatenate(c) for c in zip(*kept))
            cells = [base + made], [(y - shift).tobytes()], [np.ascontiguousarray(_binned(x, cuts).T).tobytes()], [held.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["block", "r", "b", "held"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, len(cuts))
            kept.append((batch.column("y").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False), x))
            size += batch.num_rows
            if size >= BLOCK:
                yield block()
                made, kept, size = made + 1, [], 0
        if kept:
            yield block()

    return rows.select("x", "y", "held").mapInArrow(pack, BLOCKS)


def _after(blocks: DataFrame, trees: list[Tree]) -> DataFrame:
    """The blocks with the residuals that the trees leave."""

    def apply(batches):
        for batch in batches:
            left = []
            for _, r, bins, _ in _cells(batch):
                r = r.copy()
                for tree in trees:
                    r -= tree.value[tree.reach(bins)]
                left.append(r.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(left, pa.binary()), batch.column("b"), batch.column("held")], ["block", "r", "b", "held"])

    return blocks.mapInArrow(apply, BLOCKS) if trees else blocks


def _level(blocks: DataFrame, tasks: int, tree: Tree, level: int, features: int, width: int, round_: int, s: BoostSettings) -> tuple[np.ndarray, np.ndarray, float]:
    """Counts and residuals per (node of the level, feature, bin) over the rows of the round; mean square of the held ones."""
    first, nodes = 2**level - 1, 2**level
    size = nodes * features * width

    def add(batches, total):
        count, sums = total[:size].reshape(features, -1), total[size : 2 * size].reshape(features, -1)
        for batch in batches:
            for block, r, bins, held in _cells(batch):
                total[-2] += held.sum()
                total[-1] += r[held] @ r[held]
                drawn = ~held
                if s.subsample < 1:
                    drawn &= np.random.default_rng([s.seed, round_, block]).random(len(r)) < s.subsample
                at = tree.reach(bins) - first
                some = np.flatnonzero(drawn & (at >= 0))
                base, r = at[some] * width, r[some]
                for j in range(features):
                    cell = base + bins[j, some]
                    count[j] += np.bincount(cell, minlength=nodes * width)
                    sums[j] += np.bincount(cell, r, nodes * width)

    total = summed(blocks, 2 * size + 2, add, tasks)
    shape = (features, nodes, width)
    return total[:size].reshape(shape), total[size : 2 * size].reshape(shape), total[-1] / total[-2] if total[-2] else np.nan


def _split(tree: Tree, level: int, count: np.ndarray, sums: np.ndarray, scale: float) -> bool:
    """Sets the splits of a level and the values of its children; whether there is any split."""
    first = 2**level - 1
    left_n, left_r = np.cumsum(count, axis=2), np.cumsum(sums, axis=2)
    n, r = left_n[:, :, -1:], left_r[:, :, -1:]
    right_n, right_r = n - left_n, r - left_r
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((left_n > 0) & (right_n > 0), left_r**2 / left_n + right_r**2 / right_n - r**2 / n, -1.0)
    found = False
    for i in range(gain.shape[1]):
        here, total = first + i, n[0, i, 0]
        if not total:
            continue
        if level == 0:
            tree.value[here], tree.weight[here] = r[0, i, 0] / total * scale, total
        best, which = 1e-12, -1
        for j in range(gain.shape[0]):
            top = gain[j, i].max()
            if top > best * (1 + CLOSE):
                best, which = top, j
        if which < 0:
            continue
        found, cut = True, int((gain[which, i] >= best * (1 - CLOSE)).argmax())
        tree.feature[here], tree.cut[here], tree.gain[here] = which, cut, best
        for child, k, total_r in ((2 * here + 1, left_n, left_r), (2 * here + 2, right_n, right_r)):
            tree.weight[child] = k[which, i, cut]
            tree.value[child] = total_r[which, i, cut] / k[which, i, cut] * scale
    return found


def _rounds(s: BoostSettings, sums_of) -> tuple[list[Tree], list[float]]:
    """Trees and the losses after each but the last. ``sums_of(number, trees, tree, level)`` gives what ``_level`` does."""
    trees, losses = [], []
    for number in range(s.rounds + 1):
        tree = Tree.empty(s.depth)
        for level in range(s.depth):
            count, sums, loss = sums_of(number, trees, tree, level)
            if level == 0:
                if number:
                    losses.append(loss)
                if number == s.rounds or losses and best_round(losses, s.patience) <= len(losses) - s.patience:
                    return trees, losses
            if not _split(tree, level, count, sums, 1.0 if not number else 2 * s.rate):
                break  # no row is left to split below some level
        trees.append(tree)
    return trees, losses


class _Alone:
    """All blocks in one task."""

    def __init__(self, batches, width: int, s: BoostSettings):
        blocks = sorted(((block, r, bins, held) for batch in batches for block, r, bins, held in _cells(batch)), key=lambda x: x[0])
        self.s, self.width, self.blocks = s, width, [(block, len(r)) for block, r, _, _ in blocks]
        r, held = (np.concatenate([x[i] for x in blocks]) for i in (1, 3))
        cells, place = _distinct(np.ascontiguousarray(np.concatenate([x[2] for x in blocks], axis=1).T))
        self.bins = np.ascontiguousarray(cells.T)
        self.held, self.r, self.place = held, r, place
        self.held_r, self.held_place = r[held], place[held]
        self.added = np.zeros(len(cells))  # by the trees so far

    def sums(self, number: int, trees: list[Tree], tree: Tree, level: int) -> tuple[np.ndarray, np.ndarray, float]:
        s, (features, n) = self.s, self.bins.shape
        if level == 0:
            if trees:
                step = trees[-1].value[trees[-1].below(self.at, self.bins)]
                self.added += step
                self.held_r -= step[self.held_place]
            drawn = ~self.held
            if s.subsample < 1:
                drawn &= np.concatenate([np.random.default_rng([s.seed, number, block]).random(rows) < s.subsample for block, rows in self.blocks])
            place = self.place[drawn]
            self.count = np.bincount(place, minlength=n).astype(np.float64)
            self.total = np.bincount(place, self.r[drawn], n) - self.count * self.added
            self.at = np.zeros(n, np.int64)
        else:
            self.at = tree.below(self.at, self.bins)
        first, size = 2**level - 1, 2**level * self.width
        here = self.at >= first
        some = slice(None) if here.all() else np.flatnonzero(here)
        base, count, total = (self.at[some] - first) * self.width, self.count[some], self.total[some]
        out = np.empty((2, features, size))
        for j in range(features):
            cell = base + self.bins[j, some]
            out[0, j], out[1, j] = np.bincount(cell, count, size), np.bincount(cell, total, size)
        loss = self.held_r @ self.held_r / len(self.held_r) if len(self.held_r) else np.nan
        return (*out.reshape(2, features, 2**level, self.width), loss)


FIELDS = ("feature", "cut", "value", "gain", "weight")


def _boost_alone(blocks: DataFrame, width: int, s: BoostSettings) -> tuple[list[Tree], list[float]]:

    def grow(batches):
        trees, losses = _rounds(s, _Alone(batches, width, s).sums)
        cells = [np.stack([getattr(t, f) for t in trees]).astype(np.float64).tobytes() for f in FIELDS] if trees else [b""] * len(FIELDS)
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in (*cells, np.array(losses, np.float64).tobytes())], [*FIELDS, "losses"])

    row = blocks.coalesce(1).mapInArrow(grow, ", ".join(f"{f} binary" for f in (*FIELDS, "losses"))).first()
    columns = [np.frombuffer(row[f]).reshape(-1, 2 ** (s.depth + 1) - 1).astype(np.int64 if f in FIELDS[:2] else np.float64) for f in FIELDS]
    return [Tree(*t) for t in zip(*columns)], np.frombuffer(row.losses).tolist()


def boost(rows: DataFrame, s: BoostSettings) -> tuple[list[np.ndarray], float, list[Tree]]:
    """(cuts, shift, trees) over ``rows`` (id, x, y, held)."""
    spark = rows.sparkSession
    known = rows.where("NOT held")
    bad, shift, n = rows.agg(
        F.count_if(~F.col("held") & (F.col("y").isNull() | F.isnan("y"))), F.avg(F.when(~F.col("held"), F.col("y"))), F.count(F.lit(1))
    ).first()
    if bad or shift is None:
        raise ValueError("labels must not be null or NaN" if bad else "no rows to learn from")
    cuts = find_cuts(known, ForestSettings(s.rounds, s.depth, 1, "all", s.seed, s.bins))
    features, width = len(cuts), max(len(c) for c in cuts) + 1

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = work_path(spark, "boosting-rows")
        df.write.parquet(path)
        return spark.read.schema(BLOCKS).parquet(path), path

    base, path = written(_blocks(rows, cuts, shift))
    if n <= s.alone:
        trees, losses = _boost_alone(base, width, s)
    else:
        tasks, since, now = base.rdd.getNumPartitions(), 0, None

        def sums_of(number: int, trees: list[Tree], tree: Tree, level: int):
            nonlocal base, path, since, now
            if level:
                return _level(now, tasks, tree, level, features, width, number, s)
            if number - since >= s.renew:
                old = path
                base, path = written(now)
                now.unpersist()
                now, since = None, number - 1
                _drop(spark, old)
            before, now = now, _after(base, trees[since:]).persist(StorageLevel.MEMORY_AND_DISK)
            out = _level(now, tasks, tree, level, features, width, number, s)
            if before is not None:
                before.unpersist()
            return out

        trees, losses = _rounds(s, sums_of)
        now.unpersist()
    _drop(spark, path)
    return cuts, shift, trees[: best_round(losses, s.patience)] if losses and not np.isnan(losses[0]) else trees


def _drop(spark, path: str) -> None:
    """Blocks that newer ones replace."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Boosting(Estimator):
    """Learns from the ``features`` vector and a label column; rows whose ``held`` column is true only tell when to stop."""

    def __init__(self, label: str, settings: BoostSettings, held: str | None = None):
        super().__init__()
        self.label, self.settings, self.held = label, settings, held

    def stopping(self, held: str, patience: int) -> Boosting:
        self.held, self.settings = held, replace(self.settings, patience=patience)
        return self

    def _fit(self, dataset: DataFrame) -> ForestModel:
        held = F.col(self.held) if self.held else F.lit(False)
        rows = dataset.select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y"), held.alias("held"))
        rows = rows.where("NOT held OR y IS NOT NULL").withColumn("id", F.xxhash64("x", "y", F.monotonically_increasing_id()))
        cuts, shift, trees = boost(rows, self.settings)
        nodes = [
            (t, i + 1, int(tree.feature[i]), int(tree.cut[i]), float(tree.value[i]), float(tree.gain[i]), float(tree.weight[i]))
            for t, tree in enumerate(trees) for i in np.flatnonzero(tree.weight).tolist()
        ]
        s = self.settings
        settings = ForestSettings(len(trees), s.depth, 1, "all", s.seed, s.bins)
        return ForestModel(cuts, dataset.sparkSession.createDataFrame(nodes, NODES), settings, shift, False, self.label)
