"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Encoding. The merges allow exactly one token sequence for a byte string: the one in which every token and every two
neighbours come out of the merges unchanged. Read byte by byte, a *hypothesis* is a tokenisation of some prefix plus
the beginning of one more token (a node of the vocabulary's trie). One hypothesis ends at each byte; others wait for
a longer token. The set of those beginnings is a state: the longest one implies the others. Its transitions, and which
neighbours fit, are computed when first met and kept; a register holds the last token after each byte. Tokens on which
all hypotheses agree are emitted, at the latest when the register holds 64 times the longest token. What is kept is
dropped when there is too much of it, as lazy automata do; that changes no result.

Decoding. Ids become bytes piece by piece; an incremental UTF-8 machine carries an unfinished character over, and what
can't be decoded becomes U+FFFD.

Defined results: null and empty texts have no ids; repeated rows are encoded each; ids outside the vocabulary raise.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from stayglass.llm.common import name_of
from stayglass.llm.words import slices

MOVES = 100_000  # transitions are forgotten beyond this many
WORDS = 250_000  # words are forgotten beyond this many
PAIRS = 200_000  # and neighbours beyond this many
ROOT = 0


class Transducer:
    """Ids by the ranks, match by match."""

    def __init__(self, ranks: dict[bytes, int], moves: int = MOVES):
        self.ranks, self.limit = ranks, moves
        self.token = {v: k for k, v in ranks.items()}
        self.length = {v: len(k) for k, v in ranks.items()}
        self.longest = max(map(len, ranks))
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        self.ends, self.depth, self.above = [-1], [0], [(0, 0)]
        for piece, rank in ranks.items():
            node = ROOT
            for b in piece:
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.ends)
                    self.ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.above.append((node, b))
                node = self.child[key]
            self.ends[node] = rank
        self.suffixes: dict[int, int] = {ROOT: ROOT}
        self.views: dict[int, tuple] = {}
        self.fits: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.moves: dict[int, tuple] = {}

    def _suffix(self, node: int) -> int:
        """The node of the longest proper end of this node's string that begins some token."""
        got = self.suffixes.get(node)
        if got is None:
            parent, byte = self.above[node]
            got = self.suffixes[node] = self._go(self._suffix(parent), byte) if parent else ROOT
        return got

    def _go(self, node: int, byte: int) -> int:
        while True:
            to = self.child.get(node << 8 | byte)
            if to is not None or node == ROOT:
                return to or ROOT
            node = self._suffix(node)

    def _live(self, node: int) -> list[int]:
        """How long the ends of the input are that begin some token; 0 last."""
        depths = []
        while node != ROOT:
            depths.append(self.depth[node])
            node = self._suffix(node)
        return [*depths, 0]

    def _move(self, key: int) -> tuple[int, tuple[tuple[int, int], ...]]:
        """The state after a byte, and the tokens that may end there with their lengths, longest first."""
        if len(self.moves) >= self.limit:
            self.moves.clear()
        at = node = self._go(key >> 8, key & 255)
        ending = []
        while at != ROOT:
            if self.ends[at] >= 0:
                ending.append((self.ends[at], self.depth[at]))
            at = self._suffix(at)
        got = self.moves[key] = node, tuple(ending)
        return got

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge made this one: of all cuts into two tokens that fit, there is one."""
        got = self.halves.get(token)
        if got is None:
            piece = self.token[token]
            cuts = [(self.ranks[piece[:i]], self.ranks[piece[i:]]) for i in range(1, len(piece)) if piece[:i] in self.ranks and piece[i:] in self.ranks]
            cuts = [c for c in cuts if max(c) < token and self._undone(*c, token)]
            got = self.halves[token] = cuts[0] if cuts else (token, token)
        return got

    def _undone(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge before ``limit`` joins what is left of the cut with what is right of it.

        The last merge on either side is undone, the later of both first; at each step the tokens that touch at the
        cut may not merge earlier than what was undone."""
        while True:
            joined = self.ranks.get(self.token[left] + self.token[right], limit)
            if joined < limit:
                return False
            inner, outer = self._halves(left)[1], self._halves(right)[0]
            if inner == left and outer == right:
                return True
            if outer == right or (inner != left and left > right):
                left, limit = inner, left
            else:
                right, limit = outer, right + 1

    def _fit(self, key: int) -> bool:
        """Whether the merges leave two neighbours as they are. The key is made of both ids plus 1; 0: nothing."""
        left, right = (key >> 32) - 1, (key & 0xFFFFFFFF) - 1
        if left < 0:
            got = self.length[right] == 1 or self._halves(right)[0] != right
        else:
            got = self._fit(right + 1) and self._undone(left, right, 1 << 60)
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        self.fits[key] = got
        return got

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the splitting pattern."""
        node, out, moves, fits = ROOT, [], self.moves, self.fits
        last = [0]  # after each byte, the last token of the input so far, plus 1
        full = 64 * self.longest
        for byte in piece:
            node, ending = moves.get(node << 8 | byte) or self._move(node << 8 | byte)
            for token, length in ending:
                key = last[-length] << 32 | token + 1
                fit = fits.get(key)
                if self._fit(key) if fit is None else fit:
                    break
            last.append(token + 1)
            if len(last) > full:
                out += self._agreed(node, last)
        return out + self._back(last, len(last) - 1)

    def _back(self, last: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end] - 1)
            end -= self.length[last[end] - 1]
        return out[::-1]

    def _agreed(self, node: int, last: list[int]) -> list[int]:
        """Tokens that all hypotheses share; they are taken off ``last``."""
        ends = {len(last) - 1 - d for d in self._live(node)}
        while len(ends) > 1:  # step back from the furthest until all meet
            far = max(ends)
            ends.remove(far)
            ends.add(far - self.length[last[far] - 1])
        out = self._back(last, cut := ends.pop())
        del last[:cut]
        return out


class Codec:
    """Whole texts to packed ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        codec = self

        class Packed(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) >= WORDS:
                    self.clear()
                ids = np.array(codec.transducer.encode(word.encode()), "<u4").tobytes()
                if len(word) <= 64:
                    self[word] = ids
                return ids

        self.packed = Packed()
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.known = np.zeros(len(self.bytes_of), bool)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
            self.known[rank] = True

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.pattern.findall(text)))

    def decode_bytes(self, ids: bytes, piece: int = 1 << 16):
        """The bytes, some thousand tokens at a time."""
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and (int(numbers.max()) >= len(self.known) or not self.known[numbers].all()):
            raise ValueError("ids outside the vocabulary")
        for at in range(0, len(numbers), piece):
            yield b"".join(map(self.bytes_of.__getitem__, numbers[at : at + piece].tolist()))

    def decode(self, ids: bytes, piece: int = 1 << 16) -> str:
        machine = Utf8Machine()
        return "".join([*(machine.feed(x) for x in self.decode_bytes(ids, piece)), machine.finish()])


class Utf8Machine:
    """Text of bytes that come in pieces. The state is the unfinished character, three bytes at most."""

    def __init__(self):
        self.rest = b""

    def feed(self, piece: bytes) -> str:
        piece = self.rest + piece
        cut = len(piece)
        for back in range(1, min(3, len(piece)) + 1):  # the lead byte of a character that may go on
            byte = piece[-back]
            if byte & 0xC0 != 0x80:
                need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
                if need > back and self._open(piece[-back:]):
                    cut -= back
                break
        self.rest = piece[cut:]
        return piece[:cut].decode("utf-8", "replace")

    @staticmethod
    def _open(start: bytes) -> bool:
        """Whether more bytes can still make this a character."""
        lead = start[0]
        if not 0xC2 <= lead <= 0xF4:
            return False
        low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
        return len(start) < 2 or low <= start[1] <= high

    def finish(self) -> str:
        rest, self.rest = self.rest, b""
        return rest.decode("utf-8", "replace")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the piece and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _codec(file: str, pattern: str) -> Codec:
    """One for each Python worker, kept from task to task."""
    return Codec(read_ranks(SparkFiles.get(file)), pattern)


def _shipped(spark, path: str) -> str:
    """The vocabulary file goes to every executor once; it is read there."""
    file = path.rpartition("/")[2]
    spark.sparkContext.addFile(path)  # the same file again is no error
    return file


def _mapped(docs: DataFrame, keep: list[str], text: str, new: list[tuple[str, str]], path: str, pattern: str, row) -> DataFrame:
    """The kept columns and what ``row(codec, text)`` gives for the new ones."""
    file = _shipped(docs.sparkSession, path)
    schema = docs.select(*map(name_of, keep)).schema
    for name, kind in new:
        schema = schema.add(name, kind)
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind] for _, kind in new]

    def apply(batches):
        codec = _codec(file, pattern)
        for batch in slices(batches, text):
            rows = [row(codec, t or "") for t in batch.column(text).to_pylist()]
            cells = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *cells], schema.names)

    return docs.select(*map(name_of, dict.fromkeys([*keep, text]))).mapInArrow(apply, schema)


def encoded(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text", ids: str = "ids") -> DataFrame:
    """The kept columns with ``ids``: little-endian unsigned 32-bit integers as one binary cell."""
    return _mapped(docs, keep, text, [(ids, "binary")], path, pattern, lambda codec, t: (codec.encode(t),))


def decoded(tokens: DataFrame, path: str, pattern: str, keep: list[str], ids: str = "ids", text: str = "text") -> DataFrame:
    """The kept columns with the text of ``ids``."""
    file = _shipped(tokens.sparkSession, path)
    schema = tokens.select(*map(name_of, keep)).schema.add(text, "string")

    def apply(batches):
        codec = _codec(file, pattern)
        for batch in batches:
            texts = [codec.decode(x or b"") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(texts, pa.string())], schema.names)

    return tokens.select(*map(name_of, dict.fromkeys([*keep, ids]))).mapInArrow(apply, schema)


def _digest(codec: Codec, text: str) -> tuple[int, str, str, bytes]:
    ids = codec.encode(text)
    back, machine = hashlib.sha256(), Utf8Machine()
    for piece in codec.decode_bytes(ids):
        back.update(machine.feed(piece).encode())
    back.update(machine.finish().encode())
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), back.hexdigest(), ids


def digests(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text", ids: str | None = None) -> DataFrame:
    """The kept columns with n_tokens, ids_sha256 and decoded_sha256 of each text, encoded and decoded again, and the ids
    themselves (little-endian unsigned 32-bit integers) where ``ids`` names a column for them."""
    new = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    new += [(ids, "binary")] if ids else []
    return _mapped(docs, keep, text, new, path, pattern, _digest)
