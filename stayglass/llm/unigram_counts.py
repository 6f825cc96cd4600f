"""Token counts: count-only Viterbi over a unigram vocabulary.

The tokenizer is the unigram model over given pieces and scores, with byte fallback: spaces become U+2581, one more
stands before the text, and of all ways to cut the text into pieces the one with the highest sum of scores counts. A
character without a piece of its own may be an unknown piece, scored 10 below the lowest piece, and counts as its bytes.

Aho-Corasick enumerates the pieces that end at each character. The recursion carries, for each end, the best score and
the number of tokens; no back pointers and no pieces are kept. Ties: of several best cuts the one whose last piece
begins first wins, at every end, as in the tokenizer, which replaces a score only by a greater one and tries begins in
order.

No piece crosses from a character that isn't U+2581 to U+2581, which is checked, so the text falls into words there and
each word is cut for itself; counts of words are remembered, up to a bound.

Defined results: null and empty texts have no tokens and score 0; repeated rows are counted each.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from stayglass.llm.common import name_of
from stayglass.llm.words import slices

SPACE = "▁"
REMEMBERED = 250_000  # words
UNKNOWN_PENALTY = 10.0


class Counter:
    """Tokens and score of texts by pieces and their scores."""

    def __init__(self, pieces: dict[str, float]):
        if not pieces:
            raise ValueError("no pieces")
        if any(regex.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece crosses a word's begin")
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.single = {p for p in pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.words = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")
        counter = self

        class Known(dict):
            def __missing__(self, word: str) -> tuple[int, float]:
                got = counter.cut(word)
                if len(self) >= REMEMBERED:
                    self.clear()
                if len(word) <= 64:
                    self[word] = got
                return got

        self.known = Known()

    def cut(self, word: str) -> tuple[int, float]:
        """(tokens, score) of the best cut of a word."""
        size = len(word)
        best, count = [0.0] + [float("-inf")] * size, [0] * (size + 1)
        done = 0  # ends up to here are settled
        for last, (length, score) in self.automaton.iter(word):  # by end, and for each end the longest first
            while done < last:
                self._unknown(word, done, best, count)
                done += 1
            begin, end = last + 1 - length, last + 1
            total = best[begin] + score
            if total > best[end]:
                best[end], count[end] = total, count[begin] + 1
        while done < size:
            self._unknown(word, done, best, count)
            done += 1
        return count[size], best[size]

    def _unknown(self, word: str, at: int, best: list[float], count: list[int]) -> None:
        """The character as an unknown piece, where it has no piece of its own."""
        if word[at] not in self.single:
            total = best[at] + self.unknown
            if total > best[at + 1]:
                best[at + 1], count[at + 1] = total, count[at] + len(word[at].encode())

    def count(self, text: str) -> tuple[int, float]:
        """(tokens, score) of a whole text."""
        if not text:
            return 0, 0.0
        parts = list(map(self.known.__getitem__, self.words.findall(SPACE + text.replace(" ", SPACE))))
        return sum(p[0] for p in parts), float(sum(p[1] for p in parts))


def read_pieces(path: str) -> dict[str, float]:
    """Ordinary pieces and scores of a sentencepiece model file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return {model.id_to_piece(i): model.get_score(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


@lru_cache(maxsize=2)
def _counter(file: str) -> Counter:
    """One for each Python worker, kept from task to task."""
    return Counter(read_pieces(SparkFiles.get(file)))


def token_counts(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns with ``n_tokens`` and ``score``."""
    docs.sparkSession.sparkContext.addFile(path)
    file = path.rpartition("/")[2]
    schema = docs.select(*map(name_of, keep)).schema.add("n_tokens", "long").add("score", "double")

    def apply(batches):
        counter = _counter(file)
        for batch in slices(batches, text):
            rows = [counter.count(t or "") for t in batch.column(text).to_pylist()]
            cells = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *cells], schema.names)

    return docs.select(*map(name_of, dict.fromkeys([*keep, text]))).mapInArrow(apply, schema)
