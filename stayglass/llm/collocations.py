"""Phrase collocations: counts of all phrases of a few words from depth-truncated suffix subtrees, built group by group.

Texts are split into pieces and those into words; everything is per language, so a word is known by a 64-bit hash of
itself and its language (counts are exact up to equal hashes).

1. **Words** are counted, then pairs of neighbours by a hash of ``pair_bits``. Words and pairs below ``least`` can't be part of a
   candidate; they end a suffix (bitmaps of fixed size tell them; what these let through costs work alone).
2. **Vertical partition.** A prefix, a word at first, that begins more than ``budget`` suffixes is extended by a word,
   until prefixes fit or the depth is reached. There are at most (all words / budget) such prefixes on a level. Prefixes
   are laid on a line by hash and cut into groups of about ``budget`` suffixes; the line has a fixed number of slots.
3. **Subtrees.** Each suffix, cut at ``depth`` words, goes to the group of its prefix; equal ones of a slice are one row with
   a count before the shuffle. A task sorts the suffixes of one group, which is the subtree in preorder: a node is a run of
   rows, its count the total of its leaves. Nodes above the prefix of a group are summed over groups.
4. Candidates that a longer one covers go; each cut of the rest looks up its two parts; the best of each language stay.

**Defined results.** A null language is ``und``; a null, empty or blank text has no words. Equal scores rank by count, then by
the phrase's bytes. Repeated rows count each time; ids are not read. Long texts are cut into words whole, a slice of texts
or one text at a time. A table without candidates gives no rows. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayglass.llm.common import name_of, stored
from stayglass.llm.jaccard_join import bit_filter, in_filter
from stayglass.llm.packing import from_planes, packed_keys, planes, unpacked_keys
from stayglass.llm.words import ALONE, LOWER, kinds_table, mix, slices, words_of

#: words ``[^\x20\x09]+`` of pieces that end at ``[.,;:!?\x0A-\x0D]``
IN_PIECES = kinds_table({0x20, 0x09}, {*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D})
UNKNOWN = "und"
_ORDER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    depth: int = 5  # words of the longest phrase
    least: int = 100  # occurrences of a candidate
    covered: int = 100  # per cent of a candidate's occurrences inside a longer one, from which on it goes
    top: int = 2000  # rows of each language
    budget: int = 1_000_000  # suffixes of one group
    slice_words: int = 800_000  # words that a task holds before it sends them on
    slot_bits: int = 20  # slots of the line of prefixes, as a power of two
    filter_bits: int = 27  # bits of the filters of frequent words and pairs, as a power of two
    pair_bits: int = 36  # bits of the hash by which pairs are counted
    pairs_in_part: int = 4_000_000  # pairs that one task counts


# --- words and suffixes ---------------------------------------------------------------------------------------------


def _language_key(lang: str | None) -> int:
    return int.from_bytes(hashlib.blake2b((UNKNOWN if lang is None else lang).encode(), digest_size=8).digest(), "little")


def _tokens(batches, text: str, lang: str, s: Settings) -> Iterator[tuple[np.ndarray, list, list[str]]]:
    """(keys, sources, languages) of some texts: word keys in order with 0 at the end of each piece, and for the words
    of each part its bytes, begins, ends and places among the keys."""
    keys, sources, langs, held = [], [], {}, 0
    for batch in slices(batches, text):
        words = words_of(batch.column(text), IN_PIECES)
        names = batch.column(lang).to_pylist()
        langs.update((_language_key(x), UNKNOWN if x is None else x) for x in set(names))
        seeds = np.array([_language_key(x) for x in names], np.uint64)
        owner = words.owner()
        key = mix(words.hash ^ seeds[owner])
        key[key == 0] = 1
        word = IN_PIECES[words.data[words.start]] != ALONE if len(key) else np.zeros(0, bool)
        key[~word] = 0
        ends = np.r_[owner[1:] != owner[:-1], True] if len(key) else np.zeros(0, bool)
        place = np.arange(len(key)) + np.r_[0, np.cumsum(ends)[:-1]] if len(key) else np.zeros(0, np.int64)
        line = np.zeros(len(key) + int(ends.sum()), np.uint64)
        line[place] = key
        sources.append((words.data, words.start[word], words.end[word], key[word], seeds[owner[word]]))
        keys.append(line)
        held += len(line)
        if held >= s.slice_words:
            yield np.concatenate(keys), sources, langs
            keys, sources, langs, held = [], [], {}, 0
    if keys:
        yield np.concatenate(keys), sources, langs


def word_counts(docs: DataFrame, text: str, lang: str, s: Settings) -> DataFrame:
    """(kind, key, lang, word, f): words of ``least`` occurrences and more (kind 0), and all words of a language (kind 1)."""

    def count(batches):
        for _, sources, langs in _tokens(batches, text, lang, s):
            out = [[], [], [], [], []]
            key = np.concatenate([x[3] for x in sources])
            seed = np.concatenate([x[4] for x in sources])
            known, first, n = np.unique(key, return_index=True, return_counts=True)
            bounds = np.cumsum([0] + [len(x[3]) for x in sources])
            part = np.searchsorted(bounds, first, "right") - 1
            for p, i, k, c in zip(part.tolist(), first.tolist(), known.view(np.int64).tolist(), n.tolist()):
                data, start, end, _, _ = sources[p]
                i -= int(bounds[p])
                word = LOWER[data[start[i] : end[i]]].tobytes().decode("utf-8", "replace")
                for column, value in zip(out, (0, k, langs[int(seed[bounds[p] + i])], word, c)):
                    column.append(value)
            for k, c in zip(*np.unique(seed, return_counts=True)):
                for column, value in zip(out, (1, int(k.astype(np.int64)), langs[int(k)], None, int(c))):
                    column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["kind", "key", "lang", "word", "f"])

    found = docs.select(name_of(text).alias("text"), name_of(lang).cast("string").alias("lang"))
    text, lang = "text", "lang"
    found = found.mapInArrow(count, "kind int, key bigint, lang string, word string, f bigint")
    found = found.groupBy("kind", "key").agg(F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("f").alias("f"))
    return found.where((F.col("kind") == 1) | (F.col("f") >= s.least))


def _pairs(keys: np.ndarray, words: bytes, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of neighbours in a piece that are both frequent."""
    known = in_filter(words, keys.view(np.int64), s.filter_bits) & (keys > 0)
    at = np.flatnonzero(known[:-1] & known[1:])
    return at, _longer(keys[at], keys[at + 1]) >> np.uint64(64 - s.pair_bits)


def frequent_pairs(tokens: DataFrame, words, volume: int, s: Settings) -> bytes:
    """The filter of pair hashes that occur ``least`` times or more. Hashes are counted by ranges, each in one task."""
    parts = max(1, -(-volume // s.pairs_in_part))

    def count(batches):
        for keys, _, _ in _tokens(batches, "text", "lang", s):
            pairs, n = np.unique(_pairs(keys, words.value, s)[1], return_counts=True)
            part = (pairs * np.uint64(parts) >> np.uint64(s.pair_bits)).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            rows = [(p, packed_keys(pairs[a:b]), planes(n[a:b].astype("<u4"))) for p, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if b > a]
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["part", "pairs", "counts"])

    def total(table):
        pairs = np.concatenate([unpacked_keys(c) for c in table.column("pairs").to_pylist()])
        n = np.concatenate([from_planes(c, "<u4") for c in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(pairs, kind="stable")
        pairs, n = pairs[order], n[order]
        begin = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        return pa.table({"pair": pairs[begin[np.add.reduceat(n, begin) >= s.least]].astype(np.int64)})

    found = tokens.mapInArrow(count, "part bigint, pairs binary, counts binary").groupBy("part").applyInArrow(total, "pair bigint")
    return bit_filter(stored(found, "collocations-pairs"), "pair", s.filter_bits)


@dataclass
class Frequent:
    """Filters of the frequent words and pairs; their size is fixed by the settings."""

    words: bytes
    pairs: bytes


def _suffixes(keys: np.ndarray, frequent: Frequent, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, codes, counts): distinct suffixes of two words or more, as codes from 1 into the ascending ``words``, 0
    past their end, in order."""
    begin, pairs = _pairs(keys, frequent.words, s)
    begin = begin[in_filter(frequent.pairs, pairs.astype(np.int64), s.filter_bits)]
    joined = np.zeros(len(keys) + s.depth, bool)  # the word there and the next one are a frequent pair
    joined[begin] = True
    used = joined[: len(keys)].copy()
    used[begin + 1] = True
    words, place = np.unique(np.r_[np.uint64(0), np.where(used, keys, 0)], return_inverse=True)
    place = np.r_[place[1:], np.zeros(s.depth, place.dtype)]
    codes, alive = np.zeros((len(begin), s.depth), np.int32), np.ones(len(begin), bool)
    for d in range(s.depth):
        if d:
            alive &= joined[begin + d - 1]
        codes[:, d] = np.where(alive, place[begin + d], 0)
    order, new = _sorted(codes, len(words))
    starts = np.flatnonzero(new)
    counts = np.diff(np.r_[starts, len(order)])
    return words[1:], codes[order[starts]], counts


def _sorted(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by their codes, and which rows, in that order, differ from the one before."""
    bits = max(1, int(size).bit_length())
    each = 63 // bits
    packed = []
    for a in range(0, codes.shape[1], each):
        column = np.zeros(len(codes), np.int64)
        for d in range(a, min(a + each, codes.shape[1])):
            column = (column << bits) | codes[:, d]
        packed.append(column)
    order = np.lexsort(packed[::-1])
    new = np.zeros(len(codes), bool)
    new[:1] = True
    for column in packed:
        column = column[order]
        new[1:] |= column[1:] != column[:-1]
    return order, new


def _prefix(words: np.ndarray, codes: np.ndarray, heavy: list[np.ndarray]) -> np.ndarray:
    """Hash of each suffix's prefix: its first word, and the words after it while the prefix so far is heavy."""
    grid = np.r_[np.uint64(0), words]
    out = grid[codes[:, 0]]
    going = np.ones(len(codes), bool)
    for d in range(1, codes.shape[1]):
        if d > len(heavy):
            break
        going = going & _among(out, heavy[d - 1]) & (codes[:, d] > 0)
        out = np.where(going, _longer(out, grid[codes[:, d]]), out)
    return out


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(prefix * _ORDER + word)


def _among(x: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(x), bool)
    return some[np.minimum(np.searchsorted(some, x), len(some) - 1)] == x


# --- groups ---------------------------------------------------------------------------------------------------------


@dataclass
class Groups:
    """Where prefixes go. ``heavy[d]`` are those of d + 1 words that are extended."""

    heavy: list[np.ndarray]
    base: np.ndarray  # first group of each slot
    parts: np.ndarray  # groups of each slot
    bits: int

    def of(self, prefix: np.ndarray) -> np.ndarray:
        spread = mix(prefix)
        slot = (spread >> np.uint64(64 - self.bits)).astype(np.int64)
        return self.base[slot] + ((spread & np.uint64(0xFFFFFF)).astype(np.int64) % self.parts[slot])


def _longer_counts(tokens: DataFrame, heavy: list[np.ndarray], frequent, s: Settings) -> DataFrame:
    """(key, f) of the prefixes one word longer than the last heavy ones."""
    shared = tokens.sparkSession.sparkContext.broadcast(heavy)  # (all words / budget) entries a level at most
    depth = len(heavy) + 1

    def count(batches):
        for keys, _, _ in _tokens(batches, "text", "lang", s):
            words, codes, counts = _suffixes(keys, frequent.value, s)
            grid = np.r_[np.uint64(0), words]
            key, going = grid[codes[:, 0]], np.ones(len(codes), bool)
            for d in range(1, depth):
                going &= _among(key, shared.value[d - 1]) & (codes[:, d] > 0)
                key = _longer(key, grid[codes[:, d]])
            known, place = np.unique(key[going], return_inverse=True)
            total = np.bincount(place, counts[going], len(known)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(total)], ["key", "f"])

    return tokens.mapInArrow(count, "key bigint, f bigint").groupBy("key").agg(F.sum("f").alias("f"))


def partition(tokens: DataFrame, words: DataFrame, frequent, s: Settings) -> Groups:
    """The vertical partition of all suffixes into groups of about ``budget``."""
    weight, heavy, level = np.zeros(1 << s.slot_bits), [], words.select("key", "f")
    while True:
        spread = F.col("f") <= s.budget if len(heavy) < s.depth - 1 else F.lit(True)
        slots = level.where(spread).select("key", "f").mapInArrow(_slots(s), "slot int, f bigint").groupBy("slot").agg(F.sum("f").alias("f")).toArrow()
        weight[slots.column("slot").to_numpy()] += slots.column("f").to_numpy()
        if len(heavy) == s.depth - 1:
            break
        large = level.where(~spread).select("key").toArrow().column("key").to_numpy()
        if not len(large):
            break
        heavy.append(np.sort(large.astype(np.int64).view(np.uint64)))
        level = stored(_longer_counts(tokens, heavy, frequent, s), "collocations-prefixes")
    # slots in a row share a group up to the budget; a slot beyond it is dealt out by further bits of the hash
    parts = np.maximum(1, np.ceil(weight / s.budget)).astype(np.int64)
    wide = parts > 1
    small = np.floor(np.cumsum(np.where(wide, 0, weight)) / s.budget).astype(np.int64)
    base = np.where(wide, small[-1] + 1 + np.cumsum(np.where(wide, parts, 0)) - np.where(wide, parts, 0), small)
    return Groups(heavy, base, parts, s.slot_bits)


def _slots(s: Settings):
    def place(batches):
        for batch in batches:
            spread = mix(batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array((spread >> np.uint64(64 - s.slot_bits)).astype(np.int32)), batch.column("f")], ["slot", "f"])

    return place


# --- subtrees -------------------------------------------------------------------------------------------------------


def _dealt(tokens: DataFrame, groups, frequent, s: Settings) -> DataFrame:
    """Packed suffixes of each slice by group: (grp, words, codes, counts)."""

    def deal(batches):
        for keys, _, _ in _tokens(batches, "text", "lang", s):
            words, codes, counts = _suffixes(keys, frequent.value, s)
            group = groups.value.of(_prefix(words, codes, groups.value.heavy))
            order = np.argsort(group, kind="stable")
            group, codes, counts = group[order], codes[order], counts[order]
            cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(group) else []
            out = [[], [], [], []]
            for a, b in zip(cuts, cuts[1:]):
                used, place = np.unique(np.r_[0, codes[a:b].reshape(-1)], return_inverse=True)
                cell = place[1:].reshape(-1, s.depth).T
                kind = "<u2" if len(used) < 65536 else "<u4"
                out[0].append(int(group[a]))
                out[1].append(packed_keys(words[used[1:] - 1]))
                out[2].append(b"".join(planes(np.ascontiguousarray(column).astype(kind)) for column in cell))
                out[3].append(planes(counts[a:b].astype("<u4")))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["grp", "words", "codes", "counts"])

    return tokens.mapInArrow(deal, "grp bigint, words binary, codes binary, counts binary")


def _subtree(groups, s: Settings):
    """Nodes of one group's subtree: words of the phrase and the total of the leaves below."""

    def build(table):
        dictionaries = [unpacked_keys(c) for c in table.column("words").to_pylist()]
        words = np.unique(np.concatenate(dictionaries))
        grid = np.r_[np.uint64(0), words]
        codes, counts = [], []
        for known, cell, n in zip(dictionaries, table.column("codes").to_pylist(), table.column("counts").to_pylist()):
            n = from_planes(n, "<u4")
            kind = "<u2" if len(known) + 1 < 65536 else "<u4"
            size = len(cell) // s.depth
            local = np.r_[0, np.searchsorted(words, known) + 1].astype(np.int32)
            codes.append(np.column_stack([local[from_planes(cell[d * size : (d + 1) * size], kind)] for d in range(s.depth)]))
            counts.append(n)
        codes, counts = np.concatenate(codes), np.concatenate(counts).astype(np.int64)
        order, _ = _sorted(codes, len(grid))
        codes, counts = codes[order], counts[order]
        heavy, nodes, totals = groups.value.heavy, [], []
        new, key = np.zeros(len(codes), bool), None
        new[:1] = True
        for d in range(s.depth):
            new[1:] |= codes[1:, d] != codes[:-1, d]
            if d == 0:
                continue
            at = np.flatnonzero(new)
            total = np.add.reduceat(counts, at)
            full = codes[at, d] > 0
            at, total = at[full], total[full]
            keep = total >= s.least
            if d < len(heavy):  # nodes above a prefix are in several groups
                key = grid[codes[at, 0]]
                for e in range(1, d + 1):
                    key = _longer(key, grid[codes[at, e]])
                keep |= _among(key, heavy[d])
            for i, n in zip(at[keep].tolist(), total[keep].tolist()):
                nodes.append(grid[codes[i, : d + 1]].view(np.int64))
                totals.append(n)
        return pa.table({"w": pa.array([x.tolist() for x in nodes], pa.list_(pa.int64())), "a": pa.array(totals, pa.int64())})

    return build


def phrase_counts(docs: DataFrame, text: str, lang: str, words: DataFrame, volume: int, s: Settings) -> DataFrame:
    """(w, a) of all phrases of 2 to ``depth`` words with ``least`` occurrences and more; w are the keys of the words."""
    spark = docs.sparkSession
    tokens = docs.select(name_of(text).alias("text"), name_of(lang).cast("string").alias("lang"))
    known = bit_filter(words, "key", s.filter_bits)
    pairs = frequent_pairs(tokens, spark.sparkContext.broadcast(known), volume, s)
    frequent = spark.sparkContext.broadcast(Frequent(known, pairs))
    groups = spark.sparkContext.broadcast(partition(tokens, words, frequent, s))
    nodes = _dealt(tokens, groups, frequent, s).groupBy("grp").applyInArrow(_subtree(groups, s), "w array<bigint>, a bigint")
    return nodes.groupBy("w").agg(F.sum("a").alias("a")).where(F.col("a") >= s.least)


# --- candidates -----------------------------------------------------------------------------------------------------


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    s = settings
    counted = stored(word_counts(docs, text, lang, s), "collocations-words")
    words, totals = counted.where("kind = 0"), counted.where("kind = 1").select("lang", F.col("f").alias("n"))
    volume = words.agg(F.sum("f")).first()[0] or 0
    nodes = stored(phrase_counts(docs, text, lang, words, volume, s), "collocations-nodes")

    # a phrase inside a longer one that has its occurrences goes
    inside = nodes.where(F.size("w") > 2).withColumn("size", F.explode(F.sequence(F.lit(2), F.size("w") - 1)))
    inside = inside.withColumn("begin", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)))
    inside = inside.groupBy(F.expr("slice(w, begin, size)").alias("w")).agg(F.max("a").alias("longer"))
    kept = nodes.join(inside, "w", "left").where(F.expr(f"longer is null or 100 * longer < {s.covered} * a")).select("w", "a")

    # each cut looks up its parts
    parts = nodes.unionByName(words.select(F.array("key").alias("w"), F.col("f").alias("a")))
    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cut = cut.withColumns({"left": F.expr("slice(w, 1, k)"), "right": F.expr("slice(w, k + 1, size(w))")})
    cut = cut.join(parts.select(F.col("w").alias("left"), F.col("a").alias("l")), "left")
    cut = cut.join(parts.select(F.col("w").alias("right"), F.col("a").alias("r")), "right")
    about = words.join(totals, "lang").select(F.col("key").alias("first"), "lang", "n")
    cut = cut.withColumn("first", F.col("w")[0]).join(about, "first")
    score = F.expr("(cast(a as decimal(20, 0)) * cast(n as decimal(20, 0)) * 1000) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    cut = cut.withColumn("score", score)
    lowest = cut.groupBy("w").agg(F.min(F.struct("score", "k", "l", "r", "a", "lang", "n")).alias("c")).select("w", "c.*")

    # words of the phrases
    spelled = lowest.select("w", F.posexplode("w").alias("i", "key")).join(words.select("key", "word"), "key")
    spelled = spelled.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("s"))
    spelled = spelled.select("w", F.array_join("s.word", " ").alias("phrase"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = lowest.join(spelled, "w").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.top)
    return out.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
