"""Exact Jaccard join of documents on word n-grams: universe partition and pigeonhole, verified, then components.

A document's set is its distinct shingles of ``width`` words (all words as one shingle when there are fewer). Documents
with the same set are one *class*, found by the set's hash; everything below is about classes.

**Signatures.** Sizes are cut into bands. A scheme k belongs to the pairs whose smaller set is in band k; the larger is
at most 1/threshold times as big, so a set takes part in one or two schemes. Two similar sets of a scheme differ in at
most H shingles. A hash deals the shingles out to segments, the same for the whole scheme. Each segment is allotted
1 or 2; when the allotments add up to more than H, similar sets differ in fewer shingles than allotted in at least one
segment: in none (allotted 1: the whole segment is the key), or in one at most (allotted 2: the segment, and the segment
without each one of its shingles, are the keys; such segments are twice as wide). The allotment of a scheme is the
cheapest by the number of keys and of chance collisions; two-allotments win where one-segments would hold too few
shingles to tell sets apart.

**Empty segments** agree for nothing. A scheme has some allotment to spare for them; a set with more empty segments than
that also publishes them as keys, so two sets that both have too many still meet.

**Hot shingles** (in many sets, as a passage that many documents share) would make long lists. They are left out of a
first partition, of the other shingles alone, in which similar sets also differ by at most H. A set that fills
too few of its segments falls back on the partition of all its shingles; two similar sets meet in one or the other.
Which shingles are hot changes the work, never the result.

**Verification.** The smallest member of a key is its hub. Each class is paired with the hub that it shares most keys
with, if sizes and parity bits (a lower bound of the difference, first 256, then as many as shingles) allow; the sets
themselves decide. Links join components. Keys whose members are still in different components go on:

* a key of few members (``small_key``) pairs those of different components;
* the classes of larger keys get a hub again, another one each round, and what is left apart is **refined**: shingles are
  put in one order, rare ones first, and the whole overlap that a similarity asks for is allotted to the rare end. Of two
  similar sets, the smaller has a shared shingle among its first tenth (n - overlap(n, n) + 1 of n), the larger among its
  first fifth. Each such shingle with a size band is a key of its own. Texts that share a passage and differ in rare
  words, or copies just below the threshold, don't meet there, however many they are. Two
  classes with a refined key are a pair only if parity bits and the shingles behind the key in either set allow it.

No link between components is lost, while members of one component aren't paired with each other: in a refined key the
largest component is paired with the others alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass.llm.common import bound_batches, fresh, name_of, stored
from stayglass.llm.components import components
from stayglass.llm.packing import from_planes, packed_keys, planes, unpacked_keys
from stayglass.llm.words import SPACED, lean, mix, shingle_hashes, slices, words_of


@dataclass(frozen=True)
class Settings:
    width: int = 5
    percent: int = 80
    band_ratio: float = 1.4
    hot_sets: int = 64  # sets with a shingle, from which on it is hot
    hot_share: int = 8  # sets of one task with a shingle, from which on the task reports it
    hot_most: int = 200_000  # hot shingles used; those beyond are treated like others
    filter_bits: int = 24  # bits of the filter of candidate ids, as a power of two
    collision: float = 0.02  # share of shingles that a set has in common with another by chance
    keys_in_part: int = 1_500_000  # keys that one task matches
    small_key: int = 12  # members of a key up to which those of different components are paired as they are
    rounds: int = 2  # further hubs that the classes of larger keys get
    tiers: tuple[int, ...] = (2, 8, 64, 512)  # frequencies at which a shingle counts as less rare
    tier_bits: int = 26  # bits of the filter of a tier, as a power of two
    refined_ratio: float = 1.2  # size bands of refined keys


# --- bands and allotments -------------------------------------------------------------------------------------------


@lru_cache(maxsize=8)
def bands(ratio: float) -> np.ndarray:
    """First size of each band; the first three sizes are bands of their own."""
    out = [1, 2, 3, 4]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return np.array(out, np.int64)


@dataclass(frozen=True)
class Scheme:
    singles: int  # segments allotted 1
    doubles: int  # segments allotted 2, twice as wide
    spare: int  # allotment that empty segments may take away

    @property
    def most_empty(self) -> int:
        """Allotment that the empty segments of one set may take without being published. With two-allotments it is
        half of what is to spare, since a segment that is empty in either set can be what they would agree on."""
        return self.spare // 2 if self.doubles else self.spare


@lru_cache(maxsize=4096)
def scheme(k: int, s: Settings, singles_only: bool = False) -> Scheme:
    """The cheapest allotment of scheme k: keys of a middling set plus its chance collisions."""
    first = bands(s.band_ratio)
    low, high = int(first[k]), int(first[k + 1]) - 1
    most = high * 100 // s.percent  # the larger set's size
    h = (100 - s.percent) * (high + most) // (100 + s.percent)
    size = (low + high) / 2
    best = None
    for share in (0.0,) if singles_only else (0.0, 0.25, 0.5, 1.0):
        units = h + 1
        doubles = int(units * share) // 2
        singles = units - 2 * doubles
        mean = size / units
        spare = 1 + int(units * np.exp(-mean) * 1.5 + 2 * np.sqrt(units * np.exp(-mean)) * (share < 1)) if h else 0
        singles += spare
        mean = size / (singles + 2 * doubles)
        keys = singles + doubles * (1 + 2 * mean)
        chance = singles * s.collision ** max(mean, 0.5) + doubles * (1 + 2 * mean) * s.collision ** max(2 * mean - 1, 0.5)
        cost = keys + 400 * chance
        if best is None or cost < best[0]:
            best = cost, Scheme(singles, doubles, spare)
    return best[1]


def _schemes_of(size: int, s: Settings) -> list[int]:
    """Schemes of a set of this size: its own band's, and those of smaller bands that reach up to it."""
    first = bands(s.band_ratio)
    own = int(np.searchsorted(first, size, "right")) - 1
    out, k = [own], own - 1
    while k >= 0 and (int(first[k + 1]) - 1) * 100 >= s.percent * size:
        out.append(k)
        k -= 1
    return out


# --- keys of a set --------------------------------------------------------------------------------------------------


def _segment_keys(sets: list[np.ndarray], ids: np.ndarray, k: int, salt: int, s: Settings) -> tuple[list, list, np.ndarray]:
    """(keys, class ids) of sets in one scheme by their segments, and how much allotment each set's empty segments take.

    Salt 0 is the partition without hot shingles. It has one-allotments alone and publishes no empty segments: sets
    with too many have the other partition."""
    plan = scheme(k, s, not salt)
    units, n = plan.singles + 2 * plan.doubles, plan.singles + plan.doubles
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    place = ((mix(items ^ np.uint64(k * 2 + salt + 0xABCD)) >> np.uint64(33)) * np.uint64(units) >> np.uint64(31)).astype(np.int64)
    segment = np.where(place < plan.singles, place, plan.singles + (place - plan.singles) // 2)
    cell = owner * n + segment
    order = np.argsort(cell, kind="stable")
    cell, values = cell[order], mix(items[order] + np.uint64(0x51ED))
    begin = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    whole = np.add.reduceat(values, begin) if len(begin) else values
    cells = cell[begin]
    name = mix((cells % n).astype(np.uint64) + np.uint64((k * 2 + salt) << 32))
    keys, who = [mix(whole ^ name)], [ids[cells // n]]
    double = cells % n >= plan.singles
    if double.any():
        size = np.diff(np.r_[begin, len(cell)])
        group = np.repeat(np.arange(len(begin)), size)
        inside = double[group]
        group = group[inside]
        keys.append(mix((whole[group] - values[inside]) ^ name[group]))
        who.append(ids[cells[group] // n])
    filled = np.zeros((len(sets), n), bool)
    filled.reshape(-1)[cells] = True
    weight = np.where(np.arange(n) < plan.singles, 1, 2)
    taken = (~filled) @ weight
    for i in np.flatnonzero(taken > plan.most_empty) if salt else ():
        empty = np.flatnonzero(~filled[i])
        label = mix(empty.astype(np.uint64) + np.uint64((k * 2 + salt) << 32))
        keys.append(mix(~label))
        who.append(np.full(len(empty), ids[i]))
        doubles = empty[empty >= plan.singles]
        if len(doubles):  # an empty segment is also a segment of one shingle without it
            keys.append(mix(mix(doubles.astype(np.uint64) + np.uint64((k * 2 + salt) << 32))))
            who.append(np.full(len(doubles), ids[i]))
    return keys, who, taken


def keys_of(sets: list[np.ndarray], ids: np.ndarray, hot: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """All keys of some sets, each with the id of its class."""
    members: dict[int, list[int]] = {}
    for i, x in enumerate(sets):
        for k in _schemes_of(len(x), s) if len(x) else ():
            members.setdefault(k, []).append(i)
    keys, who = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k, rows in members.items():
        some, name = [sets[i] for i in rows], ids[rows]
        if len(hot):
            cold = []
            for x in some:
                at = np.minimum(np.searchsorted(hot, x), len(hot) - 1)
                cold.append(x[hot[at] != x])
            full = np.array([len(x) > 0 for x in cold])
            taken = np.full(len(cold), 1 << 30)
            if full.any():
                a, b, taken[full] = _segment_keys([x for x in cold if len(x)], name[full], k, 0, s)
                keys += a
                who += b
            rest = np.flatnonzero(taken > scheme(k, s, True).most_empty)
            some, name = [some[i] for i in rest], name[rest]
        if len(some):
            a, b, _ = _segment_keys(some, name, k, 1, s)
            keys += a
            who += b
    return np.concatenate(keys), np.concatenate(who)


# --- passes over the documents --------------------------------------------------------------------------------------


def _sets(texts, s: Settings) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words = words_of(texts, SPACED)
    runs = shingle_hashes(words.hash, s.width)
    out = []
    for a, b in zip(words.first, words.first[1:]):
        if b - a >= s.width:
            out.append(np.unique(runs[a : b - s.width + 1]))
        elif b > a:
            seed = np.full(s.width - (b - a), b - a, np.uint64)
            out.append(shingle_hashes(np.r_[words.hash[a:b], seed], s.width) ^ np.uint64(1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class(x: np.ndarray) -> int:
    """Hash of a set; sets of one hash are taken for one class."""
    return int(mix(np.atleast_1d(mix(x + np.uint64(0x77)).sum(dtype=np.uint64) + np.uint64(len(x)))).astype(np.int64)[0])


def survey(docs: DataFrame, doc_id: str, text: str, s: Settings) -> DataFrame:
    """Of each document: id, n_shingles, class, hash of the text; and of each task the shingles that many of its sets have."""
    schema = "kind int, id bigint, n bigint, class bigint, h bigint"
    mark = fresh([doc_id, text], "h")[0]

    def apply(batches):
        share, seen = [], set()

        def frequent():
            values, counts = np.unique(np.concatenate(share), return_counts=True)
            share.clear()
            many = counts >= s.hot_share
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(many.sum(), 1, np.int32)), pa.array(values[many].view(np.int64)), pa.array(counts[many]), pa.nulls(int(many.sum()), pa.int64()), pa.nulls(int(many.sum()), pa.int64())],
                ["kind", "id", "n", "class", "h"],
            )

        held = 0
        for batch in slices(batches, text):
            sets = _sets(batch.column(text), s)
            names = [_class(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sets), np.int32)), batch.column(doc_id).cast(pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array(names, pa.int64()), batch.column(mark)],
                ["kind", "id", "n", "class", "h"],
            )
            for x, c in zip(sets, names):
                if c not in seen:  # copies within the task don't count
                    seen.add(c)
                    share.append(x)
                    held += len(x)
            if held > 4_000_000:
                yield frequent()
                held = 0
                seen.clear()
        if share:
            yield frequent()

    return docs.select(name_of(doc_id), name_of(text), F.xxhash64(name_of(text)).alias(mark)).mapInArrow(lean(apply), schema)


def signatures(docs: DataFrame, text: str, hot, parts: int, s: Settings) -> DataFrame:
    """Rows (part, keys, classes): packed keys of one part of the key space, from some documents."""

    def apply(batches):
        for batch in slices(batches, text, 8 << 20):
            sets: dict[int, np.ndarray] = {}
            for piece in slices([batch], text):
                for x in _sets(piece.column(text), s):
                    if len(x):
                        sets[_class(x)] = x
            keys, who = keys_of(list(sets.values()), np.array(list(sets), np.int64), hot.value, s)
            part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(keys)
            keys, who, part = keys[order], who[order], part[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            rows = []
            for p in np.flatnonzero(np.diff(cuts)):
                names, place = np.unique(who[cuts[p] : cuts[p + 1]], return_inverse=True)
                rows.append((int(p), packed_keys(keys[cuts[p] : cuts[p + 1]]), planes(place.astype("<u4")), names.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                ["part", "keys", "places", "classes"],
            )

    return docs.select(name_of(text)).mapInArrow(lean(apply), "part int, keys binary, places binary, classes binary")


def shared_keys(packed: DataFrame) -> DataFrame:
    """(key, class) of the keys that two classes or more have."""

    def match(table):
        keys, who = [], []
        for k, p, c in zip(table.column("keys").to_pylist(), table.column("places").to_pylist(), table.column("classes").to_pylist()):
            keys.append(unpacked_keys(k))
            who.append(np.frombuffer(c, "<i8")[from_planes(p, "<u4")])
        keys, who = np.concatenate(keys), np.concatenate(who)
        order = np.lexsort((who, keys))
        keys, who = keys[order], who[order]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (who[1:] != who[:-1])]
        keys, who = keys[new], who[new]
        same = keys[1:] == keys[:-1]
        shared = np.r_[False, same] | np.r_[same, False]
        return pa.table({"key": keys[shared].view(np.int64), "class": who[shared]})

    return packed.groupBy("part").applyInArrow(lean(match), "key bigint, class bigint")


def bit_filter(ids: DataFrame, column: str, bits: int) -> bytes:
    """Which hashes of the ids occur, as a bitmap of fixed size."""
    slot = F.pmod(F.col(column), F.lit(1 << bits))
    rows = ids.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("m")).collect()
    out = bytearray((1 << bits) // 8 + 8192)
    for r in rows:  # bucket 1 holds slots 1 to 32768
        at = (r.b - 1) * 4096 + 4096
        out[at : at + len(r.m)] = r.m
    return bytes(out)


def in_filter(filter_bytes: bytes, ids: np.ndarray, bits: int) -> np.ndarray:
    slot = ids & ((1 << bits) - 1)
    bucket = np.where(slot > 0, 1 + (slot - 1) // 32768, 0)
    position = np.where(slot > 0, (slot - 1) % 32768, (-slot) % 32768)
    at = bucket * 4096 + position // 8
    return (np.frombuffer(filter_bytes, np.uint8)[at] >> (position % 8).astype(np.uint8)) & 1 > 0


def _wanted_texts(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, columns, schema: str, s: Settings) -> DataFrame:
    """One row of ``columns(sets)`` for each wanted class; ``wanted`` has class and id, the smallest document with it.

    Only texts whose id passes a filter of fixed size are cut into shingles again."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted.where("id is not null"), "id", s.filter_bits))

    def apply(batches):
        for batch in slices(batches, text):
            ids = batch.column(doc_id)
            maybe = in_filter(shared.value, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), s.filter_bits)
            batch = batch.filter(pa.array(maybe | ids.is_null().to_numpy(zero_copy_only=False)))
            sets = {_class(x): x for x in _sets(batch.column(text), s) if len(x)}
            arrays = [pa.array(list(sets), pa.int64()), *columns(list(sets.values()))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = [x.split()[0] for x in ("class bigint, " + schema).split(", ")]
    found = docs.select(name_of(doc_id).cast("bigint").alias(doc_id), name_of(text)).mapInArrow(lean(apply), "class bigint, " + schema)
    return found.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])


def sketches(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, s: Settings) -> DataFrame:
    """(class, n, b0 to b3, parity): size, 256 parity bits, and a parity bit for each shingle or more."""

    def columns(sets):
        small = np.array([np.frombuffer(_parity(x, 256), "<i8") for x in sets], np.int64).reshape(len(sets), 4)
        wide = [_parity(x, max(256, 1 << (len(x) - 1).bit_length())) for x in sets]
        return [pa.array([len(x) for x in sets], pa.int64()), *(pa.array(np.ascontiguousarray(small[:, i])) for i in range(4)), pa.array(wide, pa.binary())]

    return _wanted_texts(docs, doc_id, text, wanted, columns, "n bigint, b0 bigint, b1 bigint, b2 bigint, b3 bigint, parity binary", s)


def whole_sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, s: Settings) -> DataFrame:
    """(class, items): the packed shingle hashes of the wanted classes."""
    return _wanted_texts(docs, doc_id, text, wanted, lambda sets: [pa.array([x.tobytes() for x in sets], pa.binary())], "items binary", s)


def _parity(x: np.ndarray, size: int) -> bytes:
    """Bits of which each shingle flips one. Two sets differ in at least as many shingles as their bits."""
    bits = np.bincount((mix(x) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def _apart(x: bytes, y: bytes) -> int:
    """Bits that differ; of the longer map, parts that share a place in the shorter are put together."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def plausible(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose wide parity bits allow the similarity."""

    def check(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n", "m", "x", "y")))
            keep = [_apart(x, y) * (100 + percent) <= (n + m) * (100 - percent) for n, m, x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sketch.select(F.col("class").alias("a"), "n", F.col("parity").alias("x"))
    right = sketch.select(F.col("class").alias("b"), F.col("n").alias("m"), F.col("parity").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(lean(check), "a bigint, b bigint")


def possible(a: str, b: str, percent: int):
    """Condition on two rows with n, b0 to b3: sizes and parity bits allow the similarity."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.b{i}").bitwiseXOR(F.col(f"{b}.b{i}"))) for i in range(4)), F.lit(0))
    close = (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (apart * (100 + percent) <= (n + m) * (100 - percent))
    return close


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar, by their whole sets."""
    left = sets.select(F.col("class").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("items").alias("y"))

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lean(check), "a bigint, b bigint")


def verified(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, classes: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) of classes that are similar. Sets are made for classes in pairs only."""
    pairs = stored(pairs.select("a", "b"), "jaccard-pairs")
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    ends = stored(ends.join(classes, "class"), "jaccard-ends")
    return similar(pairs, stored(whole_sets(docs, doc_id, text, ends, s), "jaccard-sets"), s.percent)


# --- keys of many members -------------------------------------------------------------------------------------------


def _overlap(n, m, percent: int):
    """Shingles that two sets of these sizes share at least, if they are similar."""
    return -(-(percent * (n + m)) // (100 + percent))


def tier_filters(sets: DataFrame, s: Settings) -> list[bytes]:
    """Per tier a bitmap of fixed size with the shingles (by a hash) that so many of the sets have."""
    volume = sets.agg(F.sum(F.length("items"))).first()[0] or 0
    parts = max(1, volume // 8 // 20_000_000)

    def count(batches):
        for batch in slices(batches, "items", 4 << 20):
            items = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("items")])
            slots, n = np.unique(items >> np.uint64(24), return_counts=True)
            cuts = np.searchsorted((slots * np.uint64(parts) >> np.uint64(40)).astype(np.int64), np.arange(parts + 1))
            rows = [(p, packed_keys(slots[a:b]), planes(n[a:b].astype("<u4"))) for p, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if b > a]
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["part", "slots", "counts"])

    def total(table):
        slots = np.concatenate([unpacked_keys(c) for c in table.column("slots").to_pylist()])
        n = np.concatenate([from_planes(c, "<u4") for c in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(slots, kind="stable")
        slots, n = slots[order], n[order]
        begin = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]])
        n = np.add.reduceat(n, begin)
        return pa.table({"slot": slots[begin][n >= s.tiers[0]].astype(np.int64), "n": n[n >= s.tiers[0]]})

    found = sets.select("items").mapInArrow(lean(count), "part bigint, slots binary, counts binary")
    found = stored(found.groupBy("part").applyInArrow(lean(total), "slot bigint, n bigint"), "jaccard-tiers")
    return [bit_filter(found.where(F.col("n") >= t), "slot", s.tier_bits) for t in s.tiers]


def refined_keys(sets: DataFrame, parts: DataFrame, filters, s: Settings) -> DataFrame:
    """(key, class, part, n, large, rest): the shingles of a set's rare end, for the sets that it can be the smaller of two
    similar ones with, and for those that it can be the larger one with. ``rest`` counts the shingle and those behind it."""
    first = bands(s.refined_ratio)

    def keys(batches):
        for batch in slices(batches, "items", 2 << 20):
            out = [[], [], [], [], [], []]
            for name, part, cell in zip(batch.column("class").to_pylist(), batch.column("part").to_pylist(), batch.column("items")):
                items = np.frombuffer(cell.as_buffer(), np.uint64)
                n, slots = len(items), (items >> np.uint64(24)).astype(np.int64)
                tier = sum(in_filter(f, slots, s.tier_bits).astype(np.int8) for f in filters.value)
                order = np.lexsort((items, tier))
                items, alone = items[order], int((tier == 0).sum())  # shingles of one set come first and meet no other
                own = int(np.searchsorted(first, n, "right")) - 1
                ends = [(own, 0, n - _overlap(n, n, s.percent) + 1)]
                least, k = -(-s.percent * n // 100), own
                while k >= 0 and int(first[k + 1]) - 1 >= least:
                    ends.append((k, 1, n - _overlap(n, max(least, int(first[k])), s.percent) + 1))
                    k -= 1
                for k, large, end in ends:
                    some = items[alone:end]
                    out[0].append(mix(some ^ mix(np.full(1, k + 1, np.uint64))).view(np.int64))
                    out[4].append(np.full(len(some), large, np.int8))
                    out[5].append(n - alone - np.arange(len(some)))
                    for column, value in zip(out[1:4], (name, part, n)):
                        column.append(np.full(len(some), value, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["key", "class", "part", "n", "large", "rest"])

    return sets.join(parts, "class").select("class", "part", "items").mapInArrow(lean(keys), "key bigint, class bigint, part bigint, n bigint, large tinyint, rest bigint")


def refined_pairs(keys: DataFrame, sketch: DataFrame | None = None, percent: int = Settings.percent) -> DataFrame:
    """Pairs (a, b) of classes of different components with a refined key, one as the smaller set, one as the larger, that
    may be similar: at the first shingle that two similar sets share, all that they share stands there or behind it, and
    parity bits allow it, where there are sketches."""
    sizes = keys.groupBy("key", "part").agg(F.count("*").alias("rows"))
    main = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("rows", "part"))["part"].alias("main"))
    rows = keys.join(main.where("parts > 1").select("key", "main"), "key")
    rows = stored(rows if sketch is None else rows.join(sketch.drop("n"), "class"), "jaccard-refined")
    p, q = rows.where("part <> main").alias("p"), rows.alias("q")
    apart = (F.col("q.part") == F.col("q.main")) | (F.col("p.part") < F.col("q.part"))
    lower = F.struct("p.n", "p.class") < F.struct("q.n", "q.class")
    roles = (lower & (F.col("p.large") == 0) & (F.col("q.large") == 1)) | (~lower & (F.col("p.large") == 1) & (F.col("q.large") == 0))
    enough = F.least("p.rest", "q.rest") * (100 + percent) >= (F.col("p.n") + F.col("q.n")) * percent
    close = enough if sketch is None else enough & possible("p", "q", percent)
    pairs = p.join(q, (F.col("p.key") == F.col("q.key")) & (F.col("p.part") != F.col("q.part")) & apart & roles & close)
    return pairs.select(F.least("p.class", "q.class").alias("a"), F.greatest("p.class", "q.class").alias("b")).distinct()


def star(member: DataFrame, sketch: DataFrame, round_: int, percent: int) -> DataFrame:
    """Each class with the hub that it shares most keys with and may be similar to, (a, b). ``member`` has key, class, part."""
    order = F.col("class") if round_ == 0 else F.xxhash64(F.lit(round_), "class")
    hub = member.groupBy("key").agg(F.min(F.struct(order.alias("o"), F.col("class").alias("a"), F.col("part").alias("hub_part"))).alias("h")).select("key", "h.a", "h.hub_part")
    rays = member.join(hub, "key").where("part <> hub_part").groupBy("a", F.col("class").alias("b")).agg(F.count("*").alias("keys"))
    rays = rays.join(sketch.alias("p"), F.col("a") == F.col("p.class")).join(sketch.alias("q"), F.col("b") == F.col("q.class"))
    return rays.where(possible("p", "q", percent)).groupBy("b").agg(F.max_by("a", F.struct("keys", "a")).alias("a")).select("a", "b")


def apart(keyed: DataFrame, label: DataFrame) -> DataFrame:
    """(key, class, part, members) of the keys whose members are in different components."""
    member = keyed.join(label, keyed["class"] == label["node"], "left").select("key", "class", F.coalesce("label", "class").alias("part"))
    mixed = member.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("members"))
    return member.join(mixed.where("lo < hi").select("key", "members"), "key")


# --- the join -------------------------------------------------------------------------------------------------------


def _labelled(docs: DataFrame, doc_id: str, text: str, s: Settings) -> DataFrame:
    """(id, n, h, part) of every row: size of its set, hash of its text, and the smallest class that links reach."""
    spark = docs.sparkSession
    bound_batches(spark)
    found = stored(survey(docs, doc_id, text, s), "jaccard-survey")
    rows = found.where("kind = 0")
    hot = found.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= s.hot_sets)
    hot = hot.orderBy(F.desc("n"), "id").limit(s.hot_most).select("id").toArrow().column("id").to_numpy()
    shared = spark.sparkContext.broadcast(np.sort(hot.astype(np.int64).view(np.uint64)))  # hot_most at most

    classes = rows.where("n > 0").groupBy("class").agg(F.min("id").alias("id"))
    volume = rows.where("n > 0").agg(F.sum("n")).first()[0] or 0
    parts = max(1, int(volume * 0.6 / s.keys_in_part))
    keyed = stored(shared_keys(signatures(docs, text, shared, parts, s)), "jaccard-keys")
    wanted = stored(keyed.select("class").distinct().join(classes, "class"), "jaccard-wanted")
    parity = stored(sketches(docs, doc_id, text, wanted, s), "jaccard-sketches")
    sketch = parity.drop("parity")

    pairs = star(keyed.withColumn("part", F.col("class")), sketch, 0, s.percent)
    links = stored(verified(plausible(pairs, parity, s.percent), docs, doc_id, text, classes, s), "jaccard-links")
    label = components(links)

    # keys of many members: further hubs, then refined keys; the sets of their classes are made once
    large = stored(apart(keyed, label).where(F.col("members") > s.small_key), "jaccard-large")
    names = stored(large.select("class").distinct().join(classes, "class"), "jaccard-large-classes")
    if names.limit(1).count():
        sets = stored(whole_sets(docs, doc_id, text, names, s), "jaccard-large-sets")
        for number in range(1, s.rounds + 1):
            pairs = star(large, sketch, number, s.percent)
            more = stored(similar(plausible(pairs, parity, s.percent), sets, s.percent), "jaccard-round")
            links = links.unionByName(more)
            label = components(links)
            large = stored(apart(large.select("key", "class"), label), "jaccard-large")
        parts = large.select("class", "part").distinct()
        filters = spark.sparkContext.broadcast(tier_filters(sets, s))
        pairs = refined_pairs(refined_keys(sets, parts, filters, s), sketch, s.percent)
        links = links.unionByName(stored(similar(plausible(pairs, parity, s.percent), sets, s.percent), "jaccard-refined-links"))
        label = components(links)

    # keys of few members
    small = stored(apart(keyed, label).where(F.col("members") <= s.small_key).join(sketch, "class"), "jaccard-small")
    p, q = small.alias("p"), small.alias("q")
    pairs = p.join(q, (F.col("p.key") == F.col("q.key")) & (F.col("p.part") < F.col("q.part")) & possible("p", "q", s.percent))
    pairs = pairs.select(F.col("p.class").alias("a"), F.col("q.class").alias("b")).distinct()
    more = verified(plausible(pairs, parity, s.percent), docs, doc_id, text, classes, s)
    label = components(stored(links.unionByName(more), "jaccard-all-links"))

    part = classes.select("class").join(label, classes["class"] == label["node"], "left").select("class", F.coalesce("label", "class").alias("part"))
    return rows.join(part, "class", "left").select("id", "n", "h", "part")


def join_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its set and the smallest id that links reach.

    Null and empty texts have the empty set and are linked with nothing: their component is their own id. Ids are
    whole numbers. A null id is never the smallest; a component of null ids alone has a null id. Repeated rows and
    rows that share an id are each in the component of their text.
    """
    rows = stored(_labelled(docs, doc_id, text, settings), "jaccard-labelled")
    least = rows.where("n > 0").groupBy("part").agg(F.min("id").alias("component"))
    out = rows.join(least, "part", "left")
    kind = docs.select(name_of(doc_id)).schema[0].dataType
    return out.select(
        F.col("id").cast(kind).alias(doc_id), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id (null comes last), and of rows that share it the one
    with the smallest hash of its text. Rows that repeat both are one row; where their other columns differ, the smallest
    hash of all columns but maps decides. Rows without words are in no component and all stay."""
    rows = stored(_labelled(docs, doc_id, text, settings).where("n > 0"), "jaccard-labelled")
    texts = rows.groupBy("part", "id", "h").agg(F.count("*").alias("copies"))
    best = texts.groupBy("part").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("best"))
    gone = ~(F.col("id").eqNullSafe(F.col("best.id")) & (F.col("h") == F.col("best.h")))
    key, own, out_, copies = fresh(docs.columns, "keep_id", "keep_hash", "keep_gone", "keep_copies")
    fate = stored(texts.join(best, "part").select(F.col("id").alias(key), F.col("h").alias(own), gone.alias(out_), F.col("copies").alias(copies)), "jaccard-fate")
    names = [name_of(c) for c in docs.columns]
    mark = fresh([*docs.columns, key, own, out_, copies], "keep_mark")[0]
    marked = docs.withColumn(mark, F.xxhash64(name_of(text)))
    marked = marked.join(fate, name_of(doc_id).cast("bigint").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(own)), "left").where(~F.coalesce(F.col(out_), F.lit(False)))
    repeated = F.coalesce(F.col(copies), F.lit(1)) > 1
    plain = F.xxhash64(*(name_of(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind))
    first = marked.where(repeated).groupBy(key, own).agg(F.min_by(F.struct(*names), plain).alias("row")).select("row.*")
    return marked.where(~repeated).select(*names).unionByName(first)
