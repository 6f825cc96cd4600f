"""Language identification: averaged embeddings of hashed subwords, a linear softmax, calibrated rejection.

1. A text is lower-cased (A-Z) and cut into words of letters. Its features are all runs of 2 to 4 bytes of its words, with
   marked ends, and the whole words; each is hashed to one of a fixed number of rows.
2. The mean of the rows' embeddings goes through a linear softmax. Embeddings and softmax are learned together in numpy by
   stochastic gradient descent, from at most ``per_language`` distinct labelled texts of each of at most ``languages``
   languages (the most frequent ones); of a training text at most ``widest`` features count, the most frequent ones first.
   These bounds hold for learning alone: a prediction reads the whole text.
3. A part of the sample that is not learned from sets a temperature, so that scores are probabilities, and the least score
   at which the accepted ones of that part are wrong in ``error`` of cases at most; below it an answer is ``rejected``.

**Defined results.** A text that is null, empty or without a letter is ``und`` with score 0, and rejected. So is every text if
there is nothing to learn from; with one language all others are that one. Equal scores go to the language that sorts first.
Repeated rows are predicted each and learned from once. Null labels and null ids are no obstacle: the first are not learned
from, the second are kept. An empty table gives no rows. Other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayglass.llm.common import name_of, stored
from stayglass.llm.words import LOWER, WORD, kinds_table, slices, words_of

#: words of ASCII letters and of all bytes beyond ASCII
LETTERS = kinds_table(set(range(0x80)) - {*range(0x41, 0x5B), *range(0x61, 0x7B)})
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    bucket_bits: int = 16  # rows of the embedding table, as a power of two
    dim: int = 16
    longest: int = 4  # bytes of a subword
    per_language: int = 2_000  # distinct texts of a language to learn from, at most
    languages: int = 256  # learned languages, at most
    widest: int = 4_096  # features of one text to learn from, at most
    steps: int = 1_000  # of the descent
    batch: int = 16
    rate: float = 0.5
    error: float = 0.01  # share of wrong answers among accepted ones
    seed: int = 13


def features(texts, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all subwords and words of some texts, and the text of each, in no particular order."""
    words = words_of(texts, LETTERS)
    size = words.end - words.start
    begin = 1 + np.cumsum(size + 1) - (size + 1)  # each word between two marks
    line = np.full(int(size.sum()) + len(size) + 1, 0x20, np.uint32)
    inside = np.flatnonzero(LETTERS[words.data] == WORD)
    line[np.repeat(begin - words.start, size) + inside] = LOWER[words.data[inside]]
    owner = np.repeat(words.owner(), size + 1)  # a word with the mark before it
    owner = np.r_[owner, owner[-1:]] if len(owner) else np.zeros(1, np.int64)
    shift = np.uint32(32 - s.bucket_bits)
    rows, texts_of = [(words.hash >> np.uint64(64 - s.bucket_bits)).astype(np.uint32)], [words.owner()]
    key, clear = line.copy(), np.ones(len(line), bool)
    for n in range(2, s.longest + 1):
        key = (key[:-1] << np.uint32(8)) | line[n - 1 :]
        clear = clear[:-1] if n == 2 else clear[:-1] & (line[n - 2 : -1] != 0x20)
        at = np.flatnonzero(clear)
        rows.append(((key[at] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B) ^ (key[at] >> np.uint32(15))) * np.uint32(0xC2B2AE35) >> shift)
        # a run that begins with the mark after a word belongs to the next one
        texts_of.append(owner[at])
    return np.concatenate(rows), np.concatenate(texts_of)


# --- learning -------------------------------------------------------------------------------------------------------


def bags(docs: DataFrame, text: str, keep: list[str], s: Settings) -> DataFrame:
    """The kept columns, ``rows`` and ``shares``: the feature rows of a text and their shares, packed."""
    schema = docs.select(*map(name_of, keep)).schema.add("rows", "binary").add("shares", "binary")

    def bag(batches):
        for batch in slices(batches, text):
            rows, owner = features(batch.column(text), s)
            cells = [[], []]
            known, n = np.unique(owner.astype(np.int64) << 32 | rows, return_counts=True)
            cuts = np.searchsorted(known >> 32, np.arange(batch.num_rows + 1))
            for a, b in zip(cuts, cuts[1:]):
                mine, times = known[a:b] & 0xFFFFFFFF, n[a:b]
                if len(mine) > s.widest:
                    first = np.argsort(-times, kind="stable")[: s.widest]
                    mine, times = mine[first], times[first]
                cells[0].append(mine.astype("<u4").tobytes())
                cells[1].append((times / max(times.sum(), 1)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *(pa.array(c, pa.binary()) for c in cells)], [*keep, "rows", "shares"])

    return docs.select(*map(name_of, dict.fromkeys([*keep, text]))).mapInArrow(bag, schema)


def sample(docs: DataFrame, text: str, lang: str, s: Settings) -> DataFrame:
    """(lang, h, rows, shares) of the texts to learn from, each distinct text once for a language."""
    rows = docs.where(name_of(lang).isNotNull() & name_of(text).rlike(r"\p{L}"))
    rows = rows.select(name_of(lang).cast("string").alias("lang"), F.xxhash64(name_of(text)).alias("h"), name_of(text).alias("text"))
    distinct = rows.select("lang", "h").distinct()
    common = distinct.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(s.languages).select("lang")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = distinct.withColumn("number", first).where(F.col("number") <= s.per_language)
    cuts = stored(chosen.groupBy("lang").agg(F.max("h").alias("cut")).join(common, "lang"), "language-cuts")
    taken = rows.join(F.broadcast(cuts), "lang").where("h <= cut")  # `languages` rows at most
    return bags(taken.select("lang", "h", "text"), "text", ["lang", "h"], s).dropDuplicates(["lang", "h"])


@dataclass
class Model:
    """``table`` holds the embeddings, or, where there are fewer languages than dimensions, their products with the softmax:
    the mean of products is the product of the mean."""

    languages: list[str]
    table: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None
    temperature: float = 1.0
    threshold: float = 1.0

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        z = (means if self.weights is None else means @ self.weights) + self.bias
        return _softmax(z / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def learn(rows: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray, languages: list[str], s: Settings) -> Model:
    """Embeddings and softmax by stochastic gradient descent; a fifth of the texts calibrates."""
    if not languages:
        return Model([])
    draw = np.random.default_rng(s.seed)
    n, kinds = len(labels), len(languages)
    table = (draw.standard_normal((1 << s.bucket_bits, s.dim)) / np.sqrt(s.dim)).astype(np.float32)
    weights, bias = np.zeros((s.dim, kinds), np.float32), np.zeros(kinds, np.float32)
    mixed = draw.permutation(n)
    aside, train = mixed[: n // 5], mixed[n // 5 :]

    def means(of: np.ndarray):
        at, w = np.concatenate([rows[i] for i in of]), np.concatenate([shares[i] for i in of])
        part = np.repeat(np.arange(len(of)), [len(rows[i]) for i in of])
        begin = np.searchsorted(part, np.arange(len(of)))
        return at, w, part, np.add.reduceat(table[at] * w[:, None], begin, axis=0)

    order, at_text = train, len(train)
    for step in range(s.steps if len(train) else 0):
        if at_text >= len(order):
            order, at_text = draw.permutation(train), 0
        of = order[at_text : at_text + s.batch]
        at_text += s.batch
        at, w, part, mean = means(of)
        wrong = _softmax(mean @ weights + bias)
        wrong[np.arange(len(of)), labels[of]] -= 1
        rate = s.rate * (1 - step / s.steps)
        back = wrong @ weights.T
        weights -= rate * mean.T @ wrong
        bias -= 0.1 * rate * wrong.mean(axis=0)
        order_at = np.argsort(at, kind="stable")
        at, change = at[order_at], (w[:, None] * back[part])[order_at]
        begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        table[at[begin]] -= np.float32(rate) * np.add.reduceat(change, begin, axis=0)
    model = Model(languages, table, weights, bias)
    if len(aside):
        z = np.concatenate([means(aside[a : a + 256])[3] for a in range(0, len(aside), 256)]) @ weights + bias
        truth = labels[aside]
        loss = {t: -np.log(np.maximum(_softmax(z / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in np.geomspace(0.05, 20, 61)}
        model.temperature = float(min(loss, key=loss.get))
        p = _softmax(z / model.temperature)
        order = np.argsort(-p.max(axis=1), kind="stable")
        failed = np.cumsum(p.argmax(axis=1)[order] != truth[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(failed <= s.error)
        if len(good):
            model.threshold = float(p.max(axis=1)[order[good[-1]]])
    if kinds <= s.dim:
        model.table, model.weights = table @ weights, None
    return model


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", only: Column | None = None, settings: Settings = Settings()) -> Model:
    """A model of the labelled rows of ``docs`` for which ``only`` holds."""
    got = sample(docs if only is None else docs.where(only), text, lang, settings).toArrow()  # bounded by the settings
    order = np.argsort(np.array(got.column("h").to_pylist(), np.int64), kind="stable") if got.num_rows else []
    names = np.array(got.column("lang").to_pylist(), object)[order] if got.num_rows else np.zeros(0, object)
    languages = sorted(set(names))
    place = {x: i for i, x in enumerate(languages)}
    rows, shares = got.column("rows").to_pylist(), got.column("shares").to_pylist()
    return learn(
        [np.frombuffer(rows[i], "<u4") for i in order], [np.frombuffer(shares[i], "<f4") for i in order],
        np.array([place[x] for x in names], np.int64), languages, settings,
    )


# --- prediction -----------------------------------------------------------------------------------------------------


def predict(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), settings: Settings = Settings()) -> DataFrame:
    """The kept columns, ``lang_pred``, ``score`` and ``rejected``, of every row."""
    shared, s = docs.sparkSession.sparkContext.broadcast(model), settings  # its size is fixed by the settings
    count = len(keep)
    rows = docs.select(*(name_of(k).alias(f"k{i}") for i, k in enumerate(keep)), name_of(text).alias("text"), F.coalesce(name_of(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    schema = rows.select(*(f"k{i}" for i in range(count))).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def judge(batches):
        model = shared.value
        languages = np.array([*model.languages, UNKNOWN], object)
        for batch in slices(batches, "text"):
            best, score = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            if model.languages:
                rows, owner = features(batch.column("text"), s)
                width = model.table.shape[1]
                total = np.column_stack([np.bincount(owner, model.table[rows, j], batch.num_rows) for j in range(width)])
                mean = total / np.maximum(np.bincount(owner, minlength=batch.num_rows), 1)[:, None]
                p = model.probabilities(mean)
                some = batch.column("letters").to_numpy(zero_copy_only=False)
                best = np.where(some, p.argmax(axis=1), best)
                score = np.where(some, p.max(axis=1), score)
            arrays = [pa.array(languages[best].tolist(), pa.string()), pa.array(score), pa.array((score < model.threshold) | (best == len(model.languages)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(count)), *arrays], schema.names)

    return rows.mapInArrow(judge, schema).toDF(*keep, "lang_pred", "score", "rejected")
