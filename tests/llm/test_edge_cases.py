"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from stayglass.llm import byte_bpe, decontaminate, fm_index, interpolated_lm, jaccard_join, license_scan, line_dedup, quality_model, quality_rules, unigram_counts, url_filter

PLAIN = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (1, PLAIN), (2, PLAIN.upper()), (3, None), (4, ""), (5, " \n\t "), (6, "short text"), (7, "short text"),
    (None, PLAIN + " thirteen fourteen"), (9, "long " * 40_000), (10, PLAIN), (10, PLAIN), (11, "été\n\nété 日本 😀"),
]
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "x", i, "y", "z") for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, hash string, n_chars int, spans string, `dedup.key` string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 1), (2, 0), (6, None), (None, 1)], "doc_id long, quality int")


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=str)


def test_jaccard(docs):
    got = by_id(jaccard_join.join_components(docs), "n_shingles", "component_id")
    want = [(1, 8, 1), (2, 8, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (9, 1, 9), (10, 8, 1), (10, 8, 1), (11, 1, 11), (None, 10, 1)]
    assert got == sorted(want, key=str)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").where("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 9, 11]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_near_copies_against_all_pairs(spark, seed):
    draw = random.Random(seed)
    base = [[draw.choice("abcdefghijklmnopqrstuvwxyz") * draw.randint(1, 3) for _ in range(draw.choice([6, 12, 40, 150]))] for _ in range(12)]
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for i in range(160):
        words = list(draw.choice(base))
        for _ in range(draw.choice([0, 1, 1, 2, 4])):
            words[draw.randrange(len(words))] = f"w{draw.randrange(9)}"
        texts.append(words + passage if draw.random() < 0.3 else words)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    part = list(range(len(sets)))
    for _ in range(len(sets)):
        new = [min(part[j] for j in range(len(sets)) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])) for i in range(len(sets))]
        if new == part:
            break
        part = new
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    few = jaccard_join.Settings(hot_sets=5, hot_share=2)
    for settings in (jaccard_join.Settings(), few):
        assert by_id(jaccard_join.join_components(docs, settings=settings), "component_id") == sorted(((i, p) for i, p in enumerate(part)), key=str)


def test_line_dedup(spark, docs):
    out = line_dedup.dedup(docs)
    assert out.columns == [*docs.columns, "n_chunks", "n_removed"] and out.count() == len(ROWS)
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"a b\n{long}\nend"), (2, f"{long}\nc"), (3, f"x\ny\n{long}"), (3, f"x\ny\n{long}"), (4, None), (5, "")]
    got = by_id(line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")), "text")
    assert (1, f"a b\n{long}\nend") in got and (2, "c") in got and (4, None) in got and (5, "") in got
    assert all(long not in t for i, t in got if i in (2, 3))


def test_whole_passages_go_whatever_stands_around(spark, docs):
    draw = random.Random(3)

    def line(n):
        return " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))

    passages = [[line(n) for n in sizes] for sizes in ([11] * 5, [19, 19, 10, 3], [2, 15, 15, 15, 15, 1], [0, 25, 4, 25, 3], [7] * 12)]
    rows, left = [], []
    for i in range(40):
        before, after = [line(5) for _ in range(i % 4)], [line(6) for _ in range(i % 3)]
        rows.append((i, "\n".join([*before, *passages[i % 5], *after])))
        left.append((i, rows[-1][1] if i < 5 else "\n".join([*before, *after])))
    rows.append((50, "\n".join([line(11)] * 20)))
    left.append((50, "\n".join(rows[-1][1].split("\n")[:5])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(line_dedup.dedup(frame, cut_digits="", passage_words=50), "text")
    # an empty line at the edge of a passage has no words and may stay
    assert [(i, [x for x in t.split("\n") if x]) for i, t in sorted(got)] == [(i, [x for x in t.split("\n") if x]) for i, t in left]
    import corpus_pipeline

    kept = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, frame, "").collect()}
    lines = {x for p in passages for x in p if x}
    assert not any(lines & set(kept.get(i, "").split("\n")) for i in range(5, 40))
    assert line_dedup.dedup(docs, passage_words=50).count() == len(ROWS)


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, PLAIN), (1, "short text"), (None, "été"), (2, None), (3, "!!"), (3, " ")], "item_id long, text string")
    got = by_id(decontaminate.report(docs, bench), "n_words", "n_hit", "n_items")
    assert (1, 12, 12, 1) in got and (6, 2, 2, 1) in got and (3, 0, 0, 0) in got and (11, 4, 0, 0) in got and (None, 14, 12, 1) in got
    cleaned = decontaminate.clean(docs, bench)
    assert cleaned.columns == docs.columns
    assert by_id(cleaned.where("doc_id is null"), "text", "n_chars") == [(None, " thirteen fourteen", 18)]
    assert by_id(decontaminate.report(docs, bench.limit(0)), "n_hit") == sorted(((r[0], 0) for r in ROWS), key=str)


@pytest.mark.parametrize("kinds", [1, 2, 5, 60])
def test_fm_index(kinds):
    draw = np.random.default_rng(kinds)
    text = np.r_[draw.integers(1, kinds + 1, 150), np.ones(20, int), draw.integers(1, kinds + 1, 150)]
    index = fm_index.FMIndex(text, 5)
    phrases = np.array([[1, 1, 0], [1, 1, 1], [kinds, 1, 0], [kinds + 9, 1, 1]])
    low, high = index.search(phrases, np.array([2, 3, 1, 3]))
    for p, n, a, b in zip(phrases, [2, 3, 1, 3], low, high):
        want = [i for i in range(len(text)) if text[i : i + n].tolist() == p[:n].tolist()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_bpe(spark, docs):
    ranks = byte_bpe.read_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    draw = random.Random(5)
    parts = ["a", "er", "the", " ", "  ", "\n", "ing", "é", "😀", "0", "!", "***", "'s", "aaaa", "日本", "​"]
    for n in [0, 1, 5, 20, 20, 20, 300, 12_000]:
        text = "".join(draw.choice(parts) for _ in range(n))
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids, draw.choice([1, 2, 7])) == text
    packed = byte_bpe.encoded(docs, PATH, public_tokenizers.PATTERN, ["doc_id", "spans"])
    back = byte_bpe.decoded(packed, PATH, public_tokenizers.PATTERN, ["doc_id"])
    assert by_id(back, "text") == sorted(((k, t or "") for k, t in ROWS), key=str)


def test_utf8_machine_on_broken_bytes():
    draw = random.Random(6)
    some = [0x41, 0x80, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0xED, 0xA0, 0xF4, 0x90, 0xE0, 0xFF]
    for _ in range(500):
        raw, step = bytes(draw.choice(some) for _ in range(draw.randint(0, 10))), draw.randint(1, 3)
        machine = byte_bpe.Utf8Machine()
        assert "".join(machine.feed(raw[i : i + step]) for i in range(0, len(raw), step)) + machine.finish() == raw.decode("utf-8", "replace")


def test_quality_model(docs, labels):
    out = quality_model.classify(docs, labels)
    assert out.count() == len(ROWS) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert {r.score for r in quality_model.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.keep_good(docs, labels).columns == docs.columns


def test_quality_rules(docs):
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert got[3].n_words == got[4].n_words == got[5].n_words == 0 and got[3].base_failed and not got[3].kept
    assert got[9].n_repeat_words == 40_000 and got[11].word_chars == 9
    assert quality_rules.clean(docs).count() == 0


def test_token_counts(docs):
    out = unigram_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])
    got = {r.doc_id: r.n_tokens for r in out.collect()}
    assert got[3] == got[4] == 0 and got[9] > 0 and got[6] == got[7]


def test_lm(docs):
    rows = interpolated_lm.score(docs).collect()
    assert len(rows) == len(ROWS) and all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}


def test_licenses(spark, docs):
    assert license_scan.scan(docs).where(F.size("matches") > 0).count() == 0
    text = PLAIN + ". Released under the MIT License. " + PLAIN + "\nLicensed under the Apache License, Version 2.0."
    found = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [m.name for m in found.matches] == ["apache-2.0", "mit"]
    with pytest.raises(ValueError):
        license_scan.scan(docs, templates={"short": "two words"})


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.COM/en/1?x"), (5, "http://a.net"), (5, "http://a.net"), (6, "http://a.net/" + "d/" * 30)]
    rows += [(10 + i, f"http://b.net/{'es' if i % 2 else 'x'}/{i}") for i in range(60)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (got[1].host, got[1].path, got[1].rule) == ("", "", None) and got[3].host == ""
    assert (got[4].host, got[4].rule, got[4].verdict) == ("a.example.com", "example.com/en/", "block")
    assert got[11].verdict == "block" and len(got) == 66


def test_empty_tables(spark, docs, labels):
    none = docs.limit(0)
    assert jaccard_join.join_components(none).count() == 0
    assert line_dedup.dedup(none).count() == 0
    assert decontaminate.report(none, docs.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert byte_bpe.digests(none, PATH, public_tokenizers.PATTERN, ["doc_id"]).count() == 0
    assert quality_model.classify(none, labels).count() == 0
    assert quality_rules.judge(none).count() == 0
    assert interpolated_lm.score(none).count() == 0
    assert license_scan.scan(none).count() == 0
    assert url_filter.judge(none.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"))).count() == 0
