"""Words of whole texts as numpy arrays: positions and 64-bit hashes, straight from Arrow buffers.

Nothing here loops over words. A slice of a record batch holds a few megabytes of text at most (or one longer
text), so that memory stays bounded whatever the batch holds.
"""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: What a byte is to a tokenisation: between words, in a word, or a word on its own.
GAP, WORD, ALONE = 0, 1, 2


def kinds_table(gaps, alone=()) -> np.ndarray:
    kinds = np.full(256, WORD, np.uint8)
    kinds[list(gaps)] = GAP
    kinds[list(alone)] = ALONE
    return kinds


_SPACE = [0x20, *range(0x09, 0x0E)]
_ASCII_LETTER = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)}
#: words ``[^\x20\x09-\x0D]+``
SPACED = kinds_table(_SPACE)
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text
ALPHANUMERIC = kinds_table(set(range(0x80)) - _ASCII_LETTER)
#: words of letters and digits, and every other visible ASCII sign alone
WITH_SIGNS = kinds_table(_SPACE, set(range(0x80)) - _ASCII_LETTER - set(_SPACE))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@dataclass
class Words:
    """Words of some texts. ``first[i]`` to ``first[i + 1]`` are those of text i; positions are bytes in ``data``."""

    data: np.ndarray  # bytes of all texts, one after the other, as they were
    text_start: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(texts: pa.Array, kinds: np.ndarray = SPACED, lower: bool = True) -> Words:
    """Words of a string array; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and len(bounds) > 1 else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0] if len(bounds) else np.zeros(1, np.int64)
    n = len(data)
    kind = kinds[data]
    begins = np.zeros(n + 1, bool)  # a word may not reach over the begin of a text
    begins[bounds] = True
    if n:
        begins[:n] |= kind != WORD
        begins[1:n] |= kind[:-1] != WORD
    begins[n] = True
    start = np.flatnonzero(begins[:n] & (kind != GAP))
    cuts = np.flatnonzero(begins)
    end = cuts[np.searchsorted(cuts, start, "right")] if len(start) else start
    return Words(data, bounds[:-1], start, end, _hashes(data, start, end, lower), np.searchsorted(start, bounds))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """Polynomial hashes from running sums: the power of the base at a word's begin is divided out again."""
    n = len(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    size = -(-n // SLICE_BYTES) * SLICE_BYTES  # few sizes, so that the powers are kept
    power, inverse = _powers(size)
    sums = np.zeros(n + 1, np.uint64)
    terms = (LOWER[data] if lower else data).astype(np.uint64)
    terms += np.uint64(1)
    terms *= power[:n]
    np.cumsum(terms, out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start])


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes; the caller drops runs that cross texts."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = (out + words[j : j + n]) * _BASE
        out ^= out >> np.uint64(29)
    return mix(out)


def slices(batches, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text, or one row where a text is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1], True])
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(int(a), int(b - a))


def lean(function):
    """The function over batches or a table; when it ends, memory that it has freed goes back to the system. An idle
    worker would keep it, beside an executor whose heap grows in the stages that follow."""

    def give_back():
        _powers.cache_clear()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
        if trim:
            trim(0)

    @wraps(function)
    def over_batches(batches):
        yield from function(batches)
        give_back()

    @wraps(function)
    def over_table(table):
        out = function(table)
        give_back()
        return out

    return over_batches if inspect.isgeneratorfunction(function) else over_table


def sums_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; 0 where a text has none. Values may have columns."""
    if not len(values):
        return np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(first) > 0)
    out = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0)
    return out
