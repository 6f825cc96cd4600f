"""Line dedup: content-defined chunks of lines; chunks that occur before anywhere are removed after byte comparison.

A text is split at ``\\n``. The line hash is md5, the rolling hash at a line is the md5 of the hashes of the line before
and of the line itself. A chunk ends after a line

* when the first hexadecimal digit of the rolling hash is one of ``cut_digits`` (a quarter of the lines), or
* when this line or the next one is long (``long_words`` words or more), so a long line is a chunk of its own.

Where a chunk ends depends on two or three lines alone, so lines put in or taken out elsewhere move no other chunk.
A chunk counts when it has two lines with words or more, or is a long line. Of the occurrences with equal hash the
first (smallest id, nulls last, then position) stays; any other whose bytes equal the first's is removed. Chunks that
only share a hash with the first stay.

With ``passage_words`` whole passages of lines go as well, whatever stands around them: from each line the shortest run
of lines with so many words, and to each line the shortest such run, is a window (lines without words don't count). The windows inside a passage of that
many words or more cover all its lines. Windows are told apart by 128 bits of sha256 instead of bytes; the first in
the order above stays, the lines of the others go, but for lines that the first has itself. Windows and chunks are both
taken from the text as it came. Without it the results are those of the query's SQL, which knows chunks alone.

Everything is DataFrame expressions. Texts go through a shuffle twice: as counting chunks to meet their hash, and as
documents to meet what is removed from them. A chunk that a third of all documents has is one row of counts per task
before the shuffle; the joins on hashes are plain, so that Spark splits their hot partitions.

Defined results: a null text stays null and an empty text empty; rows with the same id and the same text are one
document (they keep or lose the same chunks); texts are otherwise unchanged, byte for byte. Ids are whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass.llm.common import fresh, name_of, stored

CUT_DIGITS = "0123"
LONG_WORDS = 20
#: words of a line, in Java's and DuckDB's expressions alike
WORD = r"[^\x20\x09-\x0D]+"
#: words of a passage that goes wherever it stands
PASSAGE_WORDS = 50


def chunk_array(text: Column, cut_digits: str = CUT_DIGITS, long_words: int = LONG_WORDS) -> Column:
    """Chunks of a text in order: structs of ``body`` (lines joined) and ``counts`` (whether it may be removed)."""
    lines = F.split(text, "\n", -1)
    facts = F.transform(
        lines, lambda x: F.struct(x.alias("line"), F.md5(x.cast("binary")).alias("hash"), F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0))).alias("words"))
    )

    def ends(facts: Column) -> Column:
        def is_end(i: Column) -> Column:
            here, last = F.get(facts, i), F.size(facts) - 1
            rolling = F.md5(F.concat(F.when(i > 0, F.get(facts, i - 1)["hash"]).otherwise(F.lit("")), here["hash"]).cast("binary"))
            long = (here["words"] >= long_words) | (F.get(facts, i + 1)["words"] >= long_words)
            return (i == last) | F.substring(rolling, 1, 1).isin(*cut_digits) | F.coalesce(long, F.lit(False))

        return F.filter(F.sequence(F.lit(0), F.size(facts) - 1), is_end)

    def cut(both: Column) -> Column:
        facts, ends = both["facts"], both["ends"]

        def chunk(end: Column, k: Column) -> Column:
            begin = F.when(k > 0, F.get(ends, k - 1) + 1).otherwise(0)
            part = F.slice(facts, begin + 1, end - begin + 1)
            worded = F.size(F.filter(part, lambda x: x["words"] > 0))
            long = F.exists(part, lambda x: x["words"] >= long_words)
            body = F.array_join(F.transform(part, lambda x: x["line"]), "\n")
            return F.struct(body.alias("body"), ((worded >= 2) | long).alias("counts"), begin.alias("begin"), end.alias("end"))

        return F.transform(ends, chunk)

    # one-element arrays keep each step's value, so that no lambda computes it again
    with_ends = F.transform(F.array(facts), lambda f: F.struct(f.alias("facts"), ends(f).alias("ends")))
    return F.get(F.transform(with_ends, cut), F.lit(0))


def repeats(docs: DataFrame, doc_id: str, text: str, cut_digits: str = CUT_DIGITS, long_words: int = LONG_WORDS) -> DataFrame:
    """(id, mark, gone): of each document that loses chunks their numbers; ``mark`` is the hash of the text."""
    rows = docs.where(name_of(text).isNotNull()).select(name_of(doc_id).cast("bigint").alias("id"), name_of(text).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("mark"), F.posexplode(chunk_array(F.col("text"), cut_digits, long_words)).alias("at", "chunk"))
    chunks = rows.where("chunk.counts").select("id", "mark", "at", F.col("chunk.body").alias("body"), F.xxhash64("chunk.body").alias("hash"))
    # a number that orders occurrences: documents by id, then by text, then by position
    order = F.struct(F.coalesce("id", F.lit(2**63 - 1)), "mark", "at")
    known = chunks.groupBy("hash").agg(F.count("*").alias("n"), F.min(order).alias("least")).where("n > 1").select("hash", "least")
    met = stored(chunks.join(known, "hash").withColumn("first", order == F.col("least")).drop("least"), "line-chunks")
    first = met.where("first").groupBy("hash").agg(F.first("body").alias("kept"))
    gone = met.where("not first").join(first, "hash").where(F.col("body") == F.col("kept"))
    return gone.groupBy("id", "mark").agg(F.collect_set("at").alias("gone"))


def passage_windows(text: Column, least: int) -> Column:
    """Structs of ``at``, ``to`` (first and last line) and ``hash``: the shortest runs of lines with ``least`` words, from
    each line with words and to each. Lines without words don't count, so no run has more than ``least`` lines."""
    lines = F.transform(
        F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line"), F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0))).alias("words"))
    )
    facts = F.filter(lines, lambda f: f["words"] > 0)

    def needed(words: Column) -> Column:
        def add(a: Column, w: Column) -> Column:
            return F.when(a["total"] < least, F.struct((a["total"] + w).alias("total"), (a["n"] + 1).alias("n"))).otherwise(a)

        return F.aggregate(words, F.struct(F.lit(0).alias("total"), F.lit(0).alias("n")), add, lambda a: F.when(a["total"] >= least, a["n"]))

    def pairs(f: Column) -> Column:
        def packed(begin: Column, end: Column) -> Column:
            return F.shiftleft(begin.cast("bigint"), 32) + end

        def backward(w: Column, j: Column) -> Column:
            begin = F.greatest(j - least + 1, F.lit(0))
            return F.transform(F.array(needed(F.reverse(F.slice(f["words"], begin + 1, j - begin + 1)))), lambda n: packed(j - n + 1, j))

        def forward(w: Column, i: Column) -> Column:
            return F.transform(F.array(needed(F.slice(f["words"], i + 1, F.lit(least)))), lambda n: packed(i, i + n - 1))

        both = F.array_union(F.flatten(F.transform(f["words"], forward)), F.flatten(F.transform(f["words"], backward)))
        return F.array_compact(both)

    def window(f: Column, code: Column) -> Column:
        begin, end = F.shiftright(code, 32).cast("int"), F.pmod(code, F.lit(2**32)).cast("int")
        body = F.array_join(F.slice(f["line"], begin + 1, end - begin + 1), "\n").cast("binary")
        hash_ = F.unhex(F.substring(F.sha2(body, 256), 1, 32))
        return F.struct(F.get(f["at"], begin).alias("at"), F.get(f["at"], end).alias("to"), hash_.alias("hash"))

    columns = F.transform(F.array(facts), lambda f: F.struct(f["at"].alias("at"), f["line"].alias("line"), f["words"].alias("words")))
    return F.flatten(F.transform(columns, lambda f: F.transform(pairs(f), lambda code: window(f, code))))


def repeated_passages(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """(id, mark, ranges): of each document that has lines of repeated windows their first and last lines."""
    rows = docs.where(name_of(text).isNotNull()).select(name_of(doc_id).cast("bigint").alias("id"), name_of(text).alias("text"))
    windows = rows.select("id", F.xxhash64("text").alias("mark"), F.inline(passage_windows(F.col("text"), least)))
    order = F.struct(F.coalesce("id", F.lit(2**63 - 1)).alias("id"), "mark", "at")
    known = windows.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct(order.alias("order"), F.col("to"))).alias("first")).where("n > 1")
    met = windows.join(known.select("hash", "first"), "hash").where(order != F.col("first.order"))
    # a document that repeats its own lines keeps those of the first window
    own = (F.coalesce("id", F.lit(2**63 - 1)) == F.col("first.order.id")) & (F.col("mark") == F.col("first.order.mark"))
    begin = F.when(own, F.greatest(F.col("at"), F.col("first.to") + 1)).otherwise(F.col("at"))
    met = met.select("id", "mark", begin.alias("begin"), F.col("to").alias("end")).where("begin <= end")
    return met.groupBy("id", "mark").agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))


def dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n_chars: str = "n_chars",
    cut_digits: str = CUT_DIGITS,
    long_words: int = LONG_WORDS,
    passage_words: int | None = None,
) -> DataFrame:
    """``docs`` with two more columns, n_chunks and n_removed, and texts without repeated chunks; the length column,
    where there is one, is counted again for texts that changed. A document may be left with an empty text. With
    ``passage_words`` (at least 1) repeated passages of so many words go too, n_removed counts their windows as well, and n_before is one more column (characters before)."""
    key, mark, own, gone, chunks = fresh(docs.columns, "dedup_key", "dedup_mark", "dedup_own", "dedup_gone", "dedup_chunks")
    found = repeats(docs, doc_id, text, cut_digits, long_words)
    found = found.select(F.col("id").alias(key), F.col("mark").alias(mark), F.col("gone").alias(gone))
    rows = docs.withColumn(own, F.xxhash64(name_of(text)))
    joined = rows.join(found, name_of(doc_id).cast("bigint").eqNullSafe(F.col(key)) & (F.col(own) == F.col(mark)), "left")
    joined = joined.withColumn(chunks, chunk_array(name_of(text), cut_digits, long_words))
    left = F.array_except(F.sequence(F.lit(0), F.size(chunks) - 1), F.col(gone))
    cleaned = F.array_join(F.transform(left, lambda i: F.get(F.col(chunks), i)["body"]), "\n")
    changed = F.col(gone).isNotNull()
    n_removed = F.coalesce(F.size(gone), F.lit(0))
    if passage_words is not None:
        ranges, range_key, range_mark = fresh(joined.columns, "dedup_ranges", "dedup_range_key", "dedup_range_mark")
        more = repeated_passages(docs, doc_id, text, passage_words)
        more = more.select(F.col("id").alias(range_key), F.col("mark").alias(range_mark), F.col("ranges").alias(ranges))
        joined = joined.join(more, name_of(doc_id).cast("bigint").eqNullSafe(F.col(range_key)) & (F.col(own) == F.col(range_mark)), "left")
        n_removed = n_removed + F.coalesce(F.size(ranges), F.lit(0))
        changed = changed | F.col(ranges).isNotNull()
        none = F.array().cast("array<int>")
        of_chunks = F.transform(F.col(gone), lambda k: F.sequence(F.get(F.col(chunks), k)["begin"], F.get(F.col(chunks), k)["end"]))
        of_ranges = F.transform(F.col(ranges), lambda r: F.sequence(r["begin"], r["end"]))
        out_lines = F.concat(F.coalesce(F.flatten(of_chunks), none), F.coalesce(F.flatten(of_ranges), none))
        # one-element arrays, as above
        both = F.array(F.struct(F.split(name_of(text), "\n", -1).alias("lines"), out_lines.alias("out")))
        stay = F.transform(both, lambda b: F.struct(b["lines"].alias("lines"), F.array_except(F.sequence(F.lit(0), F.size(b["lines"]) - 1), b["out"]).alias("stay")))
        cleaned = F.get(F.transform(stay, lambda b: F.array_join(F.transform(b["stay"], lambda i: F.get(b["lines"], i)), "\n")), F.lit(0))
    out = {
        text: F.when(changed, cleaned).otherwise(name_of(text)),
        "n_chunks": F.greatest(F.coalesce(F.size(chunks), F.lit(0)), F.lit(0)).cast("bigint"),
        "n_removed": n_removed.cast("bigint"),
    }
    if passage_words is not None:
        out["n_before"] = F.length(name_of(text)).cast("bigint")
    if n_chars in docs.columns:
        out[n_chars] = F.when(changed, F.length(cleaned).cast(docs.schema[n_chars].dataType)).otherwise(name_of(n_chars))
    kept = [out.pop(c).alias(c) if c in out else name_of(c) for c in docs.columns]
    return joined.select(*kept, *(v.alias(k) for k, v in out.items()))
