"""Quality classifier: random-indexing word vectors, pooled per document, and a small numpy network.

1. Every word has a sparse index vector, drawn from its hash. Over *all* documents each word sums the index vectors
   of its neighbours. Words share a fixed number of rows by hash, so the table has the same size for any corpus.
2. A document is the mean of its words' vectors, of their squares and of the products of neighbours. Words are runs
   of letters and digits, and every sign alone, with upper case kept.
3. A network with one hidden layer learns from a bounded sample of labelled documents; a part of the sample that it
   doesn't learn from sets the temperature that calibrates its probabilities.

Defined results: a null or empty text pools to zeros and is scored like any other; repeated rows are scored each;
several labels of one document are averaged (half counts as good); null labels are ignored; without any labels, or
with labels of one kind only, every score is that kind's smoothed share (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass.llm.common import bound_batches, fold, fresh, name_of, stored, undotted
from stayglass.llm.words import WITH_SIGNS, Words, lean, mix, slices, sums_by, words_of


@dataclass(frozen=True)
class Settings:
    bucket_bits: int = 14  # rows of the word table, as a power of two
    dim: int = 32  # columns of the word table
    window: int = 2  # neighbours on either side
    nonzero: int = 2  # entries of an index vector
    sample: int = 20_000  # labelled documents to learn from, at most
    hidden: int = 32
    epochs: int = 40
    batch: int = 256
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


def index_vectors(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries, a row for each bucket."""
    keys = np.arange((1 << s.bucket_bits) * s.nonzero, dtype=np.uint64) + np.uint64(s.seed << 40)
    drawn = mix(keys).reshape(-1, s.nonzero)
    return (drawn % np.uint64(s.dim)).astype(np.int64), np.where(drawn >> np.uint64(63), 1.0, -1.0)


def _buckets(texts, s: Settings):
    words = words_of(texts, WITH_SIGNS, lower=False)
    return words, (words.hash >> np.uint64(64 - s.bucket_bits)).astype(np.int64)


def context_sums(texts: DataFrame, column: str, s: Settings) -> np.ndarray:
    """Sum of the neighbours' index vectors for every bucket, over all texts."""
    bound_batches(texts.sparkSession)
    names = [f"d{i}" for i in range(s.dim)]
    schema = "bucket int, " + ", ".join(f"{n} bigint" for n in names)

    def partial(batches):
        places, signs = index_vectors(s)
        size = (1 << s.bucket_bits) * s.dim
        total = np.zeros(size)
        for batch in slices(batches, column):
            words, ids = _buckets(batch.column(column), s)
            owner = words.owner()
            for gap in range(1, s.window + 1):
                near = owner[gap:] == owner[:-gap]
                left, right = ids[:-gap][near], ids[gap:][near]
                for me, other in ((left, right), (right, left)):
                    for j in range(s.nonzero):
                        total += np.bincount(me * s.dim + places[other, j], signs[other, j], size)
        rows = total.reshape(-1, s.dim).astype(np.int64)
        full = np.flatnonzero(rows.any(axis=1))
        arrays = [pa.array(full.astype(np.int32)), *(pa.array(rows[full, i]) for i in range(s.dim))]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", *names])

    sums = texts.select(name_of(column)).mapInArrow(lean(partial), schema).groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names))
    out = np.zeros((1 << s.bucket_bits, s.dim))
    got = sums.toArrow()  # a row for each bucket at most
    out[got.column("bucket").to_numpy()] = np.column_stack([got.column(n).to_numpy() for n in names]) if got.num_rows else 0
    return out


def word_vectors(sums: np.ndarray, s: Settings) -> np.ndarray:
    """Half a word's own index vector, half the direction of its contexts."""
    places, signs = index_vectors(s)
    own = np.zeros_like(sums)
    for j in range(s.nonzero):
        np.add.at(own, (np.arange(len(own)), places[:, j]), signs[:, j] / np.sqrt(s.nonzero))
    around = sums / (np.linalg.norm(sums, axis=1, keepdims=True) + 1.0)
    return ((own + around) / 2).astype(np.float32)


def _pool(words: Words, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of each text: means of its words' vectors, of their squares, and of the products of neighbours."""
    rows = vectors[ids]
    beside = np.zeros_like(rows)
    if len(rows) > 1:
        owner = words.owner()
        np.multiply(rows[1:], rows[:-1], out=beside[1:], where=(owner[1:] == owner[:-1])[:, None])
    parts = [sums_by(words.first, x) for x in (rows, rows * rows, beside)]
    return (np.hstack(parts) / np.maximum(words.counts, 1)[:, None]).astype("<f4")


def pooled(docs: DataFrame, text: str, vectors: np.ndarray, s: Settings, keep: list[str]) -> DataFrame:
    """The kept columns and ``features``: the mean of the words' vectors as little-endian 32-bit floats."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # its size is fixed by the settings
    feature = fresh(keep, "features")[0]
    schema = docs.select(*map(name_of, keep)).schema.add(feature, "binary")

    def pool(batches):
        rows = shared.value
        for batch in slices(batches, text, 1 << 18):
            words, ids = _buckets(batch.column(text), s)
            cells = [x.tobytes() for x in _pool(words, ids, rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(cells, pa.binary())], [*keep, feature])

    columns = list(dict.fromkeys([*keep, text]))
    return docs.select(*map(name_of, columns)).mapInArrow(lean(pool), schema)


@dataclass
class Network:
    """Two layers over standardised features. ``share`` alone where there was nothing to learn."""

    share: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: list[np.ndarray] | None = None
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, s: Settings) -> Network:
    """Adam on the log loss over four fifths; the temperature with the least log loss on the rest."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    if len(y) < 10 or y.min() == y.max():
        return Network(float(share))
    draw = np.random.default_rng(s.seed)
    held = draw.permutation(len(y)) % 5 == 0
    fit_x, fit_y = x[~held], y[~held]
    mean, scale = fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-6
    z = (fit_x - mean) / scale
    p = [draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], s.hidden)), np.zeros(s.hidden), draw.normal(0, 1 / np.sqrt(s.hidden), s.hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(s.epochs):
        order, rate = draw.permutation(len(z)), s.rate * (1 - epoch / s.epochs)
        for at in range(0, len(z), s.batch):
            rows = order[at : at + s.batch]
            a, t = z[rows], fit_y[rows]
            h = np.tanh(a @ p[0] + p[1])
            error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -500, 500))) - t) / len(rows)
            back = np.outer(error, p[2]) * (1 - h * h)
            grads = [a.T @ back + s.decay * p[0], back.sum(axis=0), h.T @ error + s.decay * p[2], np.array([error.sum()])]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(float(share), mean, scale, p)
    logits, truth = net.logits(x[held]), y[held]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
    loss = [np.logaddexp(0, -np.where(truth > 0.5, 1, -1) * logits / t).mean() for t in grid]
    net.temperature = float(grid[int(np.argmin(loss))])
    return net


def learn(features: DataFrame, labels: DataFrame, s: Settings, doc_id: str, label: str, only=None) -> Network:
    """The network from labelled documents for which ``only`` holds; at most ``sample``, picked by a hash of the id."""
    truth = labels.where(name_of(label).isNotNull() & name_of(doc_id).isNotNull())
    if only is not None:
        truth = truth.where(only)
    truth = truth.groupBy(name_of(doc_id).alias("id")).agg((F.avg(name_of(label)) >= 0.5).cast("double").alias("y"))
    known = features.select(name_of(doc_id).alias("id"), F.col("features")).join(truth, "id")
    rows = known.orderBy(F.xxhash64("id"), "id", "features").limit(s.sample).select("features", "y").toArrow()
    if not rows.num_rows:
        return Network(0.5)
    x = np.frombuffer(b"".join(rows.column("features").to_pylist()), "<f4").reshape(rows.num_rows, -1).astype(np.float64)
    return train(x, rows.column("y").to_numpy(), s)


def scored(features: DataFrame, net: Network, keep: list[str]) -> DataFrame:
    """The kept columns with ``score`` and ``predicted``."""
    schema = features.select(*map(name_of, keep)).schema.add("score", "double").add("predicted", "integer")

    def score(batches):
        for batch in batches:
            cells = batch.column("features").to_pylist()
            x = np.frombuffer(b"".join(cells), "<f4").reshape(len(cells), -1).astype(np.float64) if cells else np.zeros((0, 1))
            p = net.scores(x) if cells else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*keep, "score", "predicted"]
            )

    return features.mapInArrow(score, schema)


def classify(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", only=None, settings: Settings = Settings()
) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``. ``only``: condition on labels that may be learned from.

    Texts are read twice: for the context sums and to pool. What is pooled, some hundred bytes a document, is written
    to the shared folder, so that learning and scoring read that.
    """
    slim = docs.select(name_of(doc_id), name_of(text))
    vectors = word_vectors(context_sums(slim, text, settings), settings)
    features = stored(pooled(slim, text, vectors, settings, [doc_id]), "quality-features")
    return scored(features, learn(features, labels, settings, doc_id, label, only), [doc_id])


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that the classifier takes for good, with all their columns.

    Texts are pooled a second time next to the other columns rather than joined back, so repeated ids stay apart.
    """
    slim = docs.select(name_of(doc_id), name_of(text))
    vectors = word_vectors(context_sums(slim, text, settings), settings)
    features = stored(pooled(slim, text, vectors, settings, [doc_id]), "quality-features")
    net = learn(features, labels, settings, doc_id, label)
    return _filtered(docs, text, vectors, net, settings)


def _filtered(docs: DataFrame, text: str, vectors: np.ndarray, net: Network, s: Settings) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # its size is fixed by the settings
    docs, names = undotted(docs, text)

    def keep(batches):
        for batch in slices(batches, text, 1 << 18):
            words, ids = _buckets(batch.column(text), s)
            x = _pool(words, ids, shared.value).astype(np.float64)
            yield batch.filter(pa.array(net.scores(x) >= 0.5))

    return docs.mapInArrow(lean(keep), docs.schema).toDF(*names)


def held_out(id_column):
    """Rows that labels may not be learned from: crc32 of the id as text leaves 1 by 3."""
    return fold(id_column, 3) == 1
