"""Registered queries of this subpackage, each thin over its operator, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from stayglass.llm import byte_bpe, collocations, decontaminate, interpolated_lm, jaccard_join, language_id, license_scan, line_dedup, merkle, quality_model
from stayglass.llm import quality_rules, sql, unigram_counts, url_filter
from stayglass.llm.common import fold, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(query):
        QUERIES[name] = query
        if oracle:
            SQL[name] = oracle
        return query

    return add


@register("op1_quality_classifier")
def quality_classifier(spark, folder):
    held = quality_model.held_out(F.col("doc_id"))
    scores = quality_model.classify(table(spark, folder, "documents"), table(spark, folder, "labels"), only=~held)
    return scores.select("doc_id", held.alias("held_out"), "score", "predicted")


@register("op2_line_dedup", sql.LINE_DEDUP)
def line_chunks(spark, folder):
    out = line_dedup.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", "n_chunks", "n_removed", F.length("text").cast("bigint").alias("n_chars_left"), digest.alias("text_sha256"))


@register("op3_jaccard_join", sql.JACCARD)
def ngram_jaccard(spark, folder):
    return jaccard_join.join_components(table(spark, folder, "documents"))


@register("op4_token_counts")
def unigram_token_counts(spark, folder):
    path = public_tokenizers.path("piece_bpe_32k.model")
    return unigram_counts.token_counts(table(spark, folder, "documents"), path, ["doc_id"])


@register("op5_byte_bpe")
def bpe_digests(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN, ["doc_id"])


@register("op6_url_filter")
def url_templates(spark, folder):
    return url_filter.judge(table(spark, folder, "pages"))


@register("op7_quality_rules", sql.quality_rules(quality_rules.BOILERPLATE))
def line_first_rules(spark, folder):
    return quality_rules.judge(table(spark, folder, "documents"))


@register("op8_lm_scoring")
def lm_scores(spark, folder):
    return interpolated_lm.score(table(spark, folder, "documents"))


@register("op9_license_scan", sql.license_scan(license_scan.TEMPLATES))
def licenses(spark, folder):
    found = license_scan.scan(table(spark, folder, "documents"))
    names = F.array_join(F.transform("matches", lambda m: m["name"]), ",")
    shares = F.transform("matches", lambda m: F.round(m["percent"] * 100).cast("bigint"))
    total = F.aggregate(shares, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return found.select("doc_id", "n_shingles", F.size("matches").cast("bigint").alias("n_licenses"), names.alias("licenses"), total.alias("percent_sum"))


@register("op10_decontamination", sql.DECONTAMINATION)
def decontamination(spark, folder):
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@register("op11_merkle_manifest", sql.MERKLE)
def merkle_manifest(spark, folder):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.checked(table(spark, folder, "documents"), tampered)


@register("op12_collocations", sql.COLLOCATIONS)
def phrase_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@register("op13_language_id")
def languages(spark, folder):
    docs = table(spark, folder, "documents")
    held = fold(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs, only=~held)
    found = language_id.predict(docs, model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
