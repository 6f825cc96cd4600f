"""Benchmark decontamination: each shard of the corpus gets an FM-index that is searched for the test phrases.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered. A phrase is ``width`` consecutive
words of a benchmark item; an item with fewer words, but any, is one phrase. A shard is some hundred thousand words
of whole documents, indexed where they stand in the task that reads them: nothing is shuffled.

The alphabet of an index is the words of the phrases. A document word outside it can't be part of any occurrence, so
it only separates; neither can a run of alphabet words shorter than the shortest phrase. Such words get no symbols of
their own, which changes no result.

The benchmark is taken in parts of bounded size: documents pass through one scan for each part, and each scan adds
its spans. So what is broadcast doesn't grow with the benchmark.

Defined results: null or empty texts have no words and are clean; items without words, without text or without id are
left out; an id on several rows is one item with the phrases of all; repeated documents are judged each.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass.llm.common import bound_batches, fresh, name_of, undotted
from stayglass.llm.fm_index import FMIndex
from stayglass.llm.words import ALPHANUMERIC, lean, slices, words_of

WIDTH = 10
PART_BYTES = 16 << 20  # benchmark text in one broadcast
SHARD_BYTES = 1 << 20  # document text in one index


@dataclass
class Phrases:
    """Distinct phrases as rows of alphabet places plus 1 (0 pads), and which items have each."""

    alphabet: np.ndarray  # sorted word hashes
    rows: np.ndarray
    lengths: np.ndarray
    first_item: np.ndarray  # phrase i has the items item[first_item[i]:first_item[i + 1]]
    item: np.ndarray
    names: list[str]


def phrases_of(ids: list[str], texts: list[str], width: int) -> Phrases:
    words = words_of(pa.array(texts, pa.string()), ALPHANUMERIC)
    names = sorted(set(ids))
    number = {k: i for i, k in enumerate(names)}
    alphabet, place = np.unique(words.hash, return_inverse=True)
    counts = words.counts
    begin, length, item = [], [], []
    for i, n in enumerate(counts):
        k = max(n - width + 1, min(n, 1))  # windows of the item
        begin.append(words.first[i] + np.arange(k))
        length.append(np.full(k, min(n, width)))
        item.append(np.full(k, number[ids[i]]))
    begin, length, item = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (begin, length, item))
    rows = np.zeros((len(begin), width), np.int64)
    for j in range(width):
        has = length > j
        rows[has, j] = place[begin[has] + j] + 1
    rows, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
    pairs = np.unique(np.column_stack([which.reshape(-1), item]), axis=0)
    return Phrases(alphabet, rows, (rows > 0).sum(axis=1), np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1)), pairs[:, 1], names)


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... of each i, ``count[i]`` of them."""
    shift = np.repeat(np.cumsum(count) - count, count)
    return np.arange(int(count.sum())) - shift + np.repeat(first, count)


def find(words, p: Phrases) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Spans [begin, end) of word numbers where phrases occur, and the items found in each text."""
    items: list[list[str]] = [[] for _ in range(len(words.first) - 1)]
    none = np.zeros(0, np.int64)
    if not len(p.rows) or not len(words.hash):
        return none, none, items
    place = np.minimum(np.searchsorted(p.alphabet, words.hash), len(p.alphabet) - 1)
    inside = p.alphabet[place] == words.hash
    # runs of alphabet words within one text
    joined = np.zeros(len(inside) + 1, bool)
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[words.first] = False
    heads = np.flatnonzero(inside & ~joined[:-1])
    tails = np.flatnonzero(inside & ~joined[1:]) + 1
    long = tails - heads >= p.lengths.min()
    heads, size = heads[long], (tails - heads)[long]
    if not len(heads):
        return none, none, items
    # the indexed text: each run and then a separator, which has the first symbol after the end mark
    at = np.cumsum(size + 1) - size - 1
    origin = np.full(int((size + 1).sum()), -1)
    origin[_expand(at, size)] = _expand(heads, size)
    symbols = np.where(origin >= 0, place[origin] + 2, 1)
    index = FMIndex(symbols)
    low, high = index.search(np.where(p.rows > 0, p.rows + 1, 0), p.lengths)
    count = high - low
    phrase = np.repeat(np.arange(len(count)), count)
    begin = origin[index.locate(_expand(low, count))]
    text = np.searchsorted(words.first, begin, "right") - 1
    found = np.unique(np.column_stack([text, phrase]), axis=0)
    n = p.first_item[found[:, 1] + 1] - p.first_item[found[:, 1]]
    pairs = np.unique(np.column_stack([np.repeat(found[:, 0], n), p.item[_expand(p.first_item[found[:, 1]], n)]]), axis=0)
    for t, i in pairs.tolist():
        items[t].append(p.names[i])
    return begin, begin + p.lengths[phrase], items


def covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in any span."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth)[:n] > 0


def scan(docs: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, width: int, finish, schema) -> DataFrame:
    """What ``finish(batch, words, spans, items)`` makes of the documents, with ``schema``: spans are pairs of word
    numbers of each text, merged, as 32-bit numbers; items its item ids. The last scan finishes, in the same worker."""
    spans, items = fresh(docs.columns, "spans", "items")
    out = docs.withColumns({spans: F.lit(b"").cast("binary"), items: F.array().cast("array<string>")})
    used = benchmark.where(name_of(item_id).isNotNull() & name_of(item_text).isNotNull())
    used = used.select(name_of(item_id).cast("string").alias("id"), name_of(item_text).alias("text"))
    total = used.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    for part in range(parts):
        rows = used.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect()  # about PART_BYTES of text
        last = part == parts - 1
        out = _scan_part(out, [r.id for r in rows], [r.text for r in rows], text, spans, items, width, finish if last else None, schema if last else out.schema)
    return out


def _scan_part(docs: DataFrame, ids: list[str], texts: list[str], text: str, spans: str, items: str, width: int, finish, schema) -> DataFrame:
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(phrases_of(ids, texts, width))

    def add(batches):
        for batch in slices(batches, text, SHARD_BYTES):
            words = words_of(batch.column(text), ALPHANUMERIC)
            begin, end, found = find(words, shared.value)
            old = batch.column(spans).to_pylist()
            for i in np.flatnonzero([len(x) > 0 for x in old]):
                pairs = np.frombuffer(old[i], "<i4").reshape(-1, 2) + words.first[i]
                begin, end = np.r_[begin, pairs[:, 0]], np.r_[end, pairs[:, 1]]
            hit = covered(begin, end, len(words.hash))
            edge = np.zeros(len(hit) + 1, bool)
            edge[words.first] = True
            head = np.flatnonzero(hit & ~(np.r_[False, hit[:-1]] & ~edge[:-1]))
            tail = np.flatnonzero(hit & ~(np.r_[hit[1:], False] & ~edge[1:])) + 1
            owner = np.searchsorted(words.first, head, "right") - 1
            pairs = np.column_stack([head - words.first[owner], tail - words.first[owner]]).astype("<i4")
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            cells = [pairs[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            lists = [sorted({*a, *b}) for a, b in zip(batch.column(items).to_pylist(), found)]
            done = {spans: pa.array(cells, pa.binary()), items: pa.array(lists, pa.list_(pa.string()))}
            names = batch.schema.names
            full = pa.RecordBatch.from_arrays([done.get(c, batch.column(k)) for k, c in enumerate(names)], names)
            yield finish(full, words, cells, lists) if finish else full

    return docs.mapInArrow(lean(add), schema)


def report(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH
) -> DataFrame:
    """Of each document: n_words, n_hit (words in occurrences), n_items, items_sha256 (ids sorted as strings, joined
    by commas), contaminated."""
    schema = docs.select(name_of(doc_id)).schema
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("n_items", "long"), ("items_sha256", "string"), ("contaminated", "boolean")):
        schema = schema.add(name, kind)

    def count(batch, words, spans, items):
        hits = [int(np.diff(np.frombuffer(x, "<i4").reshape(-1, 2)).sum()) for x in spans]
        arrays = [
            batch.column(doc_id),
            pa.array(words.counts.astype(np.int64)),
            pa.array(hits, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
            pa.array([n > 0 for n in hits]),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return scan(docs.select(name_of(doc_id), name_of(text)), benchmark, text, item_id, item_text, width, count, schema)


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", n_chars: str = "n_chars", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH
) -> DataFrame:
    """``docs`` without the passages: each merged span goes from its first word to its last. A document of which no
    word is left goes; the length column, where there is one, is counted again for texts that changed."""
    docs, names = undotted(docs, text, n_chars)
    columns = docs.columns

    def cut(batch, words, spans, items):
        keep, texts, lengths = np.ones(batch.num_rows, bool), batch.column(text).to_pylist(), None
        if n_chars in batch.schema.names:
            lengths = batch.column(n_chars).to_pylist()
        for i, cell in enumerate(spans):
            if not cell:
                continue
            pairs = np.frombuffer(cell, "<i4").reshape(-1, 2) + words.first[i]
            keep[i] = np.diff(pairs).sum() < words.counts[i]
            raw, at, out = texts[i].encode(), 0, []
            for a, b in pairs.tolist():
                out.append(raw[at : words.start[a] - words.text_start[i]])
                at = int(words.end[b - 1] - words.text_start[i])
            texts[i] = b"".join([*out, raw[at:]]).decode()
            if lengths is not None:
                lengths[i] = len(texts[i])
        arrays = [batch.column(c) for c in columns]
        arrays[columns.index(text)] = pa.array(texts, pa.string())
        if lengths is not None:
            arrays[columns.index(n_chars)] = pa.array(lengths, batch.schema.field(n_chars).type)
        return pa.RecordBatch.from_arrays(arrays, columns).filter(pa.array(keep))

    return scan(docs, benchmark, text, item_id, item_text, width, cut, docs.schema).toDF(*names)
