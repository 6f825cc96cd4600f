"""LM scoring by deleted interpolation: maximum-likelihood unigrams and bigrams, mixed by how often the context occurs.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, then one end. Documents of one fold are only scored; the others
are for training, and of these a part (``held_parts``) is held out from the counts on which the weights are learned.

**Counts.** Documents form blocks (a part of a file split, cut by a hash of the id). Each task counts the distinct
tokens and bigrams of its blocks and sends them, sorted and packed, to the parts of the key space: one row for a block
and a part. A part adds up its counts and answers each block with the totals in the block's own order, so an answer
needs no keys. A token that every document has is one number in each block's row. Nothing else moves but the texts
that meet their block's answers. The tables grow with the corpus and are never in one place.

**Weights.** For each bucket of context counts (powers of two) expectation-maximisation finds the weights of uniform,
unigram and bigram estimates that make the held-out part likeliest. It runs on a histogram of the held-out tokens by
bucket and by both estimates in steps of a quarter of a power of two; its size is bounded, whatever the corpus.

**Scores.** The model's estimates use all training counts.

Defined results: null and empty texts are one end token; repeated rows count and are scored each; a null id counts as
empty text in the folds; without training documents every estimate is uniform and base_score uses zero counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass.llm.common import name_of, stored
from stayglass.llm.packing import from_planes, packed_keys, planes, unpacked_keys
from stayglass.llm.words import SPACED, mix, slices, sums_by, words_of

END, START = np.uint64(0xE0D), np.uint64(0x57A27)
SCORED, COUNTED, HELD = 0, 1, 2


@dataclass(frozen=True)
class Settings:
    folds: int = 5  # crc32 of the id as text, modulo this ...
    scored_fold: int = 1  # ... leaves this: only scored
    held_parts: int = 10  # one in so many training documents is held out for the weights
    block_bytes: int = 4 << 20  # text of a block, about
    part_bytes: int = 4 << 20  # text whose tokens a part of the key space gets, about
    steps: int = 60  # of expectation-maximisation
    least_weight: float = 1e-6


def _tokens(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens and bigrams of all texts, ends included, and where each text's begin (one more at the end)."""
    words = words_of(texts, SPACED)
    first = words.first + np.arange(len(words.first))
    tokens = np.full(first[-1], END, np.uint64)
    inner = np.ones(first[-1], bool)
    inner[first[1:] - 1] = False
    tokens[inner] = words.hash
    before = np.r_[START, tokens[:-1]]
    before[first[:-1]] = START
    return tokens, mix(mix(before + np.uint64(1)) + tokens), first


def blocks_of(docs: DataFrame, doc_id: str, text: str, s: Settings) -> tuple[DataFrame, int]:
    """(block, role, id, text) and the number of parts. The block depends on the file split and the id alone, so every
    pass finds the same; rows that don't come straight from files are written first."""
    rows = docs.select(name_of(doc_id).alias("id"), name_of(text).alias("text"))
    try:
        rows = docs.select(name_of(doc_id).alias("id"), name_of(text).alias("text"), "_metadata.file_path", "_metadata.file_block_start")
    except AnalysisException:
        rows = stored(rows, "lm-documents").select("id", "text", "_metadata.file_path", "_metadata.file_block_start")
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    split = spark.conf.get("spark.sql.files.maxPartitionBytes", "128m")
    split = _bytes(split) * 2  # texts are about twice as large as their files
    pieces = max(1, -(-min(split, size) // s.block_bytes))
    digest = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    held = F.floor(digest / s.folds) % s.held_parts == 0
    role = F.when(digest % s.folds == s.scored_fold, F.lit(SCORED)).when(held, F.lit(HELD)).otherwise(F.lit(COUNTED))
    piece = F.pmod(F.xxhash64("id"), F.lit(pieces))
    block = F.xxhash64("file_path", "file_block_start", F.when(role == HELD, F.lit(-1)).otherwise(piece))
    return rows.select(block.alias("block"), role.alias("role"), "id", "text"), max(1, -(-size // s.part_bytes))


def _bytes(text: str) -> int:
    """Bytes of a size setting such as 128m or 134217728b."""
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    text = text.strip().lower().removesuffix("b") if text.strip().lower()[-2:-1] in units else text.strip().lower()
    return int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)


def counts(rows: DataFrame, parts: int) -> DataFrame:
    """(grams, part, block, keys, fit, held): each block's distinct keys in a part, with its own training counts."""
    schema = "grams int, part int, block bigint, keys binary, fit binary, held binary"

    def apply(batches):
        kept: dict[int, list] = {}
        for batch in slices(batches, "text"):
            tokens, pairs, first = _tokens(batch.column("text"))
            per = np.diff(first)
            block = np.repeat(batch.column("block").to_numpy(), per)
            role = np.repeat(batch.column("role").to_numpy(), per).astype(np.int8)
            for b in np.unique(block):
                own = block == b
                kept.setdefault(int(b), []).append((tokens[own], pairs[own], role[own]))
        for b in list(kept):
            columns = [np.concatenate(x) for x in zip(*kept.pop(b))]
            for grams in (1, 2):
                keys, place = np.unique(columns[grams - 1], return_inverse=True)
                fit, held = (np.bincount(place[columns[2] == r], minlength=len(keys)).astype("<u4") for r in (COUNTED, HELD))
                cuts = np.searchsorted(_part(keys, parts), np.arange(parts + 1))
                full = np.flatnonzero(np.diff(cuts))
                cells = [(packed_keys(keys[x:y]), planes(fit[x:y]), planes(held[x:y])) for x, y in zip(cuts[full], cuts[full + 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(full), grams, np.int32)), pa.array(full.astype(np.int32)), pa.array(np.full(len(full), b)), *(pa.array([c[i] for c in cells], pa.binary()) for i in range(3))],
                    ["grams", "part", "block", "keys", "fit", "held"],
                )

    return rows.select("block", "role", "text").mapInArrow(apply, schema)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def totals(counted: DataFrame) -> DataFrame:
    """(grams, part, block, fit, held, kinds): totals in the order of the block's keys; on the row with block null, how
    many keys of the part occur in training, and sums."""

    def add(table):
        grams, part = table.column("grams")[0].as_py(), table.column("part")[0].as_py()
        keys = [unpacked_keys(x) for x in table.column("keys").to_pylist()]
        cuts = np.cumsum([0, *map(len, keys)])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = []
        for name in ("fit", "held"):
            own = np.concatenate([from_planes(x, "<u4") for x in table.column(name).to_pylist()])
            sums.append(np.bincount(place, own).astype(np.int64))
        cells = [[planes(x[place[a:b]].astype("<u4" if x.max(initial=0) < 1 << 32 else "<u8")) for a, b in zip(cuts, cuts[1:])] for x in sums]
        n = table.num_rows
        return pa.table(
            {
                "grams": pa.array([grams] * (n + 1), pa.int32()),
                "part": pa.array([part] * (n + 1), pa.int32()),
                "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
                "size": pa.array([*np.diff(cuts).tolist(), 0], pa.int64()),
                "fit": pa.array([*cells[0], None], pa.binary()),
                "held": pa.array([*cells[1], None], pa.binary()),
                "kinds": pa.array([None] * n + [int((sums[0] + sums[1] > 0).sum())], pa.int64()),
                "fit_sum": pa.array([None] * n + [int(sums[0].sum())], pa.int64()),
                "held_sum": pa.array([None] * n + [int(sums[1].sum())], pa.int64()),
            }
        )

    schema = "grams int, part int, block bigint, size bigint, fit binary, held binary, kinds bigint, fit_sum bigint, held_sum bigint"
    return counted.groupBy("grams", "part").applyInArrow(add, schema)


def _looked_up(docs: pa.Table, answers: pa.Table):
    """Tokens' places in the block, and fit and held totals of tokens, bigrams and contexts (-1: begin of a text)."""
    some = [_tokens(x.column("text")) for x in slices(docs.select(["text"]).to_batches(), "text")]  # a bounded piece of text at a time
    tokens, pairs = (np.concatenate([x[i] for x in some]) for i in (0, 1))
    first = np.r_[0, np.cumsum(np.concatenate([np.diff(x[2]) for x in some]))]
    out = []
    for grams, values in ((1, tokens), (2, pairs)):
        rows = answers.filter(pc.equal(answers.column("grams"), grams)).sort_by("part")
        cells = []
        for name in ("fit", "held"):
            some = [from_planes(x, f"<u{len(x) // n}") for x, n in zip(rows.column(name).to_pylist(), rows.column("size").to_pylist())]
            cells.append(np.concatenate([x.astype(np.int64) for x in some]))
        place = np.unique(values, return_inverse=True)[1]
        out.append([x[place] for x in cells])
    begins = first[:-1]
    context = []
    for x in out[0]:
        before = np.r_[-1, x[:-1]]
        before[begins] = -1
        context.append(before)
    return first, out[0], out[1], context


def _estimates(uni, pair, context, begins_count: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unigram and bigram estimates and the bucket of the context's count."""
    context = np.where(context < 0, begins_count, context)
    return uni / max(n, 1), pair / np.maximum(context, 1), np.frexp(context.astype(np.float64))[1]


def histogram(rows: DataFrame, answers: DataFrame, n_fit: int, begins: int) -> list[tuple[int, int, int, int]]:
    """(bucket, unigram step, bigram step, tokens) of the held-out documents; step -999 is an estimate of 0."""

    def steps(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, np.floor(np.log2(np.maximum(p, 1e-300)) * 4 + 0.5), -999).astype(np.int64)

    def count(docs, answers):
        if not docs.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("bucket", "one", "two", "n")})
        _, uni, pair, context = _looked_up(docs, answers)
        one, two, bucket = _estimates(uni[0], pair[0], context[0], begins, n_fit)
        cells, n = np.unique(np.column_stack([bucket, steps(one), steps(two)]), axis=0, return_counts=True)
        return pa.table({"bucket": cells[:, 0].astype(np.int64), "one": cells[:, 1], "two": cells[:, 2], "n": n})

    met = rows.where(F.col("role") == HELD).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(count, "bucket bigint, one bigint, two bigint, n bigint")
    return [tuple(r) for r in met.groupBy("bucket", "one", "two").agg(F.sum("n")).collect()]  # bounded by the steps


def learned_weights(cells, kinds: int, s: Settings) -> np.ndarray:
    """Weights (uniform, unigram, bigram) for each bucket 0 to 64; buckets without held-out tokens take the nearest's."""
    out = np.full((65, 3), np.nan)
    cells = np.array(cells, np.float64).reshape(-1, 4)
    for bucket in np.unique(cells[:, 0]).astype(int):
        own = cells[cells[:, 0] == bucket]
        p = np.column_stack([np.full(len(own), 1 / (kinds + 1)), *(np.where(own[:, i] > -999, 2.0 ** (own[:, i] / 4), 0) for i in (1, 2))])
        w = np.full(3, 1 / 3)
        for _ in range(s.steps):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = own[:, 3] @ share
            w = np.maximum(w / w.sum(), s.least_weight)
            w /= w.sum()
        out[bucket] = w
    known = np.flatnonzero(~np.isnan(out[:, 0]))
    if not len(known):
        return np.tile([0.1, 0.8, 0.1], (65, 1))
    return out[known[np.argmin(np.abs(np.arange(65)[:, None] - known), axis=1)]]


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    s = settings
    rows, parts = blocks_of(docs, doc_id, text, s)
    answered = stored(totals(counts(rows, parts)), "lm-totals")
    sums = answered.where("block is null and grams = 1").agg(F.sum("kinds"), F.sum("fit_sum"), F.sum("held_sum")).first()
    kinds, n_fit, n_held = (int(x or 0) for x in sums)
    begins = {r.role: r.n for r in rows.groupBy("role").agg(F.count("*").alias("n")).collect()}
    answers = answered.where("block is not null").select("grams", "part", "block", "size", "fit", "held")
    weights = learned_weights(histogram(rows, answers, n_fit, begins.get(COUNTED, 0)), kinds, s)
    n, starts = n_fit + n_held, begins.get(COUNTED, 0) + begins.get(HELD, 0)
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kind = rows.schema["id"].dataType.simpleString()

    def apply(docs, answers):
        if not docs.num_rows:
            first, base, model, known = np.zeros(1, np.int64), *(np.zeros(0) for _ in range(3))
        else:
            first, uni, pair, context = _looked_up(docs, answers)
            uni, pair = uni[0] + uni[1], pair[0] + pair[1]
            context = np.where(context[0] < 0, -1, context[0] + context[1])
            one, two, bucket = _estimates(uni, pair, context, starts, n)
            w = weights[bucket]
            model = np.log10(w[:, 0] / (kinds + 1) + w[:, 1] * one + w[:, 2] * two)
            base = np.log10((uni + 0.5) / (n + 0.5 * (kinds + 1)))
            known = (uni > 0).astype(np.int64)
        size = len(first) - 1
        return pa.table(
            [
                docs.column("id"),
                pc.equal(docs.column("role"), SCORED),
                pa.array(np.diff(first).astype(np.int64)),
                pa.array(sums_by(first, known).astype(np.int64)),
                pa.array(np.full(size, n, np.int64)),
                pa.array(sums_by(first, base)),
                pa.array(sums_by(first, model)),
            ],
            names,
        )

    out = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        apply, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
    return out.withColumnRenamed("id", doc_id)
