"""Registered queries of the subpackage: equal to their SQL, or to a plain version in Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer, models, normalizers

from stayglass.llm import byte_bpe, unigram_counts
from stayglass.llm.queries import QUERIES, SQL
from tests.check import compare, duck

FOLDER = "/root/testdata/sf0.001"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(spark, duck(FOLDER), FOLDER, name, QUERIES[name], SQL[name]) is None


def test_quality_on_documents_it_did_not_learn_from(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op1_quality_classifier"](spark, folder).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean(held) > 0.95


def test_token_counts_equal_the_tokenizer(spark, docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = unigram_counts.read_pieces(path)
    lowest = min(pieces.values())
    vocabulary = [("<unk>", lowest), *((f"<0x{b:02X}>", lowest) for b in range(256)), *pieces.items()]
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Replace(" ", "▁"), normalizers.Prepend("▁")])
    got = {r.doc_id: r.n_tokens for r in QUERIES["op4_token_counts"](spark, FOLDER).collect()}
    assert got == {k: len(tokenizer.encode(t, add_special_tokens=False).ids) if t else 0 for k, t in docs.items()}
    assert sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size() == 32000


def test_bpe_equals_the_library_and_decodes(spark, docs):
    import hashlib

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op5_byte_bpe"](spark, FOLDER).collect():
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_lm_base_scores(spark, docs):
    words = {k: [*WORD.findall(t.translate(LOW)), None] for k, t in docs.items()}
    counts = Counter()
    for k, w in words.items():
        if zlib.crc32(str(k).encode()) % 5 != 1:
            counts.update(w)
    n, kinds = sum(counts.values()), len(counts)
    rows = QUERIES["op8_lm_scoring"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (kinds + 1))) for x in w))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_url_rules(spark):
    rules = [("com/", 1), ("example.com/en/", 0), ("www.example.com/en/", 1), ("net/es/", 0), ("net/fr/", 0)]
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op6_url_filter"](spark, FOLDER).collect()
    assert len(rows) == len(urls)
    for r in rows:
        _, found, rest = urls[r.page_id].partition("://")
        host = re.match(r"[^/?#]*", rest)[0] if found else ""
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOW)
        fits = [x for x in rules if ("." + host).endswith("." + x[0].partition("/")[0]) and path.startswith("/" + x[0].partition("/")[2])]
        best = max(fits, key=lambda x: len(x[0]), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best[0] if best else None)
        assert r.verdict in ("allow", "block") and (not best or r.verdict == ("block", "allow")[best[1]])


def test_pipeline_keeps_one_of_each_copy(spark, docs):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, FOLDER).collect()
    kept = [r.doc_id for r in rows]
    assert len(kept) == len(set(kept)) and 0.5 * len(docs) < len(kept) < len(docs)
    assert len({docs[k] for k in kept}) == len(kept)
