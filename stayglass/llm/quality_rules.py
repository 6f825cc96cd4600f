"""Quality rules, line first: lines that fail a rule are removed, then documents that lose too much are rejected.

Words are ``[^\\x20\\x09-\\x0D]+``. A line with words fails when it

* has mostly signs: ``sign_percent`` or more of its words' characters are neither letters, digits nor one of ``.,;:'-``,
* is navigation: two or more ``|``, ``>`` or ``»`` between short pieces, or
* is boilerplate: it contains one of the phrases of ``BOILERPLATE``, in any case, and has at most ``short_words`` words, or
* repeats an earlier line of the text.

A document is kept when it passes the base rules and the removed lines held at most ``lost_percent`` of its words.

Base rules: fewer than ``least_words`` words, or more than ``repeat_percent`` of the words in windows of ``window``
words that occur twice or more.

Everything is computed row by row with array expressions: no shuffle, no Python. Windows that repeat are found by
sorting (window hash, position) within the text, and only in texts that have any.

Defined results: a null text is an empty one (no words, base_failed, not kept); repeated rows are judged each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass.llm.common import name_of

GAPS = "\t\n\x0b\x0c\r"  # beside the blank
NOT_SYMBOLS = r"[^#*$%&|<>]+"
PLAIN = r"[\p{L}\p{N}.,;:'\-\x20\x09-\x0D]+"
BARS = "|>»"

# Phrases of boilerplate lines.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "lorem ipsum", "javascript", "sign in", "log in", "subscribe to our newsletter", "click here", "read more",
    "share this", "skip to content", "powered by",
)

LIMITS = {"sign_percent": 25, "short_words": 20, "lost_percent": 30, "least_words": 20, "repeat_percent": 30, "window": 8}


def without(text: Column, characters: str) -> Column:
    """Text without the characters."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    """Words in order. Other gaps become blanks first: a split at one blank needs no pattern."""
    for gap in GAPS:
        text = F.replace(text, F.lit(gap), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


def with_value(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, window: int) -> Column:
    """How many words lie in windows of words that the list has twice or more."""
    n = F.size(words) - window + 1

    def count(hashes: Column) -> Column:
        def covered(pairs: Column) -> Column:
            """Positions of windows that are not alone, in order; each covers up to the next or ``window`` words."""
            twice = F.filter(
                pairs,
                lambda p, i: F.coalesce(p["h"] == F.get(pairs, i - 1)["h"], F.lit(False)) | F.coalesce(p["h"] == F.get(pairs, i + 1)["h"], F.lit(False)),
            )
            return with_value(
                F.array_sort(F.transform(twice, lambda p: p["at"])),
                lambda at: F.aggregate(
                    F.transform(at, lambda a, i: F.least(F.coalesce(F.get(at, i + 1) - a, F.lit(window)), F.lit(window))),
                    F.lit(0).cast("bigint"),
                    lambda total, x: total + x,
                ),
            )

        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(with_value(pairs, covered))

    hashes = with_value(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda own: F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(own, i, F.lit(window)))),
    )
    return F.when(n < 2, F.lit(0).cast("bigint")).otherwise(with_value(hashes, count))


def lines_of(text: Column) -> Column:
    """(x, w) of the lines with words: the line and its words."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.struct(x.alias("x"), words_of(x).alias("w")))
    return F.filter(lines, lambda r: F.size(r["w"]) > 0)


def all_words(lines: Column) -> Column:
    return F.flatten(F.transform(lines, lambda r: r["w"]))


def fails(line: Column, words: Column, limits: dict[str, int]) -> Column:
    """Whether a line fails for itself; what is cheap or seldom true stands first."""
    n = F.size(words)

    def mostly(signs: Column) -> Column:
        return (signs > 0) & (signs * 100 >= F.length(F.array_join(words, "")) * limits["sign_percent"])

    def phrase(low: Column) -> Column:
        return reduce(lambda a, b: a | b, (F.contains(low, F.lit(p)) for p in BOILERPLATE))

    some = reduce(lambda a, b: a | b, (F.contains(line, F.lit(c)) for c in BARS))
    navigation = some & with_value(F.length(line) - F.length(without(line, BARS)), lambda k: (k >= 2) & (n <= 8 * (k + 1)))
    boilerplate = (n <= limits["short_words"]) & with_value(F.lower(line), phrase)
    return navigation | boilerplate | with_value(F.length(F.regexp_replace(line, PLAIN, "")), mostly)


def good_lines(lines: Column, limits: dict[str, int]) -> Column:
    return F.filter(lines, lambda r: ~fails(r["x"], r["w"], limits))


def texts_of(lines: Column) -> Column:
    return F.transform(lines, lambda r: r["x"])


def lost_words(lines: Column, n_words: Column, limits: dict[str, int]) -> Column:
    """Words of the lines that fail or repeat an earlier one."""

    def lost(good: Column) -> Column:
        def kept(once: Column) -> Column:
            total = F.aggregate(good, F.lit(0).cast("bigint"), lambda a, r: a + F.size(r["w"]))
            # words of each different line anew, where lines repeat
            return F.when(F.size(once) == F.size(good), total).otherwise(F.aggregate(once, F.lit(0).cast("bigint"), lambda a, x: a + F.size(words_of(x))))

        return n_words - with_value(F.array_distinct(texts_of(good)), kept)

    return with_value(good_lines(lines, limits), lost)


def text_facts(lines: Column, limits: dict[str, int]) -> Column:
    """n (words), chars (in words), r (words in repeated windows), dup (repeated lines), lost (words)."""

    def facts(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        return F.struct(
            n.alias("n"), F.length(F.array_join(words, "")).cast("bigint").alias("chars"), repeated_words(words, limits["window"]).alias("r"),
            (F.size(lines) - F.size(F.array_distinct(texts_of(lines)))).cast("bigint").alias("dup"), lost_words(lines, n, limits).alias("lost"),
        )

    return with_value(all_words(lines), facts)


def passes(facts: Column, limits: dict[str, int]) -> tuple[Column, Column]:
    """(base_failed, kept) from the facts."""
    n = facts["n"]
    failed = (n < limits["least_words"]) | (100 * facts["r"] > limits["repeat_percent"] * n)
    return failed, ~failed & (100 * facts["lost"] <= limits["lost_percent"] * n)


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits: int) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lost_words)."""
    limits = {**LIMITS, **limits}
    rows = docs.select(name_of(doc_id).alias("id"), F.coalesce(name_of(text), F.lit("")).alias("t"))
    counted = rows.select(
        "id",
        F.length(F.regexp_replace("t", NOT_SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        with_value(lines_of(F.col("t")), lambda lines: text_facts(lines, limits)).alias("f"),
    )
    failed, kept = passes(F.col("f"), limits)
    return counted.select(
        F.col("id").alias(doc_id), F.col("f.n").alias("n_words"), F.col("f.chars").alias("word_chars"), "n_symbols", F.col("f.dup").alias("n_dup_lines"),
        F.col("f.r").alias("n_repeat_words"), failed.alias("base_failed"), kept.alias("kept"), F.col("f.lost").alias("n_lost_words"),
    )


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits: int) -> DataFrame:
    """(doc_id, text) of the kept documents, without the removed lines."""
    use = {**LIMITS, **limits}
    rows = docs.select(name_of(doc_id).alias(doc_id), F.coalesce(name_of(text), F.lit("")).alias(text))

    def judged(lines: Column) -> Column:
        def result(facts: Column) -> Column:
            left = F.array_join(F.array_distinct(texts_of(good_lines(lines, use))), "\n")
            return F.when(passes(facts, use)[1], left)

        return with_value(text_facts(lines, use), result)

    return rows.withColumn(text, with_value(lines_of(name_of(text)), judged)).where(name_of(text).isNotNull())
