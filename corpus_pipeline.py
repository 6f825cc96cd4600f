"""The corpus pipeline: quality, line dedup, near duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, folder of tables) and returns a DataFrame, which is written and read again as the next
stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayglass.llm import byte_bpe, decontaminate, jaccard_join, line_dedup, quality_model
from stayglass.llm.common import name_of, stored, table


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier takes for good."""
    return quality_model.keep_good(docs, table(spark, folder, "labels"))


#: characters of a text, in per cent, that line dedup has to leave: a text of which four fifths stand elsewhere is a near copy
REMAINS = 20


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated chunks and passages of lines go; so do documents of which they leave less than ``REMAINS`` per cent."""
    out = line_dedup.dedup(docs, passage_words=line_dedup.PASSAGE_WORDS)
    rest = F.length(F.trim(F.regexp_replace("text", r"\s+", " ")))
    emptied = (F.col("n_removed") > 0) & ((rest == 0) | (rest * 100 < F.col("n_before") * REMAINS))
    return out.where(~emptied).select(*map(name_of, docs.columns))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near duplicates stays."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages that the benchmark has go."""
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts of each document, and digests of its token ids and of the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(docs, path, public_tokenizers.PATTERN, ["doc_id", "lang", "source"])


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None  # the classifier has no SQL


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of the folder."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
