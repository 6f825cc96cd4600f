"""Manifest, collocations, language identification and the near-duplicate stage on small hand-made tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayglass.llm import collocations, jaccard_join, language_id, merkle, words

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, `a.b` string, block string, path string"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rows_of(texts, langs=("en",)):
    return [(i, "s", langs[i % len(langs)], len(t or ""), t, "x", "y", "z") for i, t in enumerate(texts)]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    values = (r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4])
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


@pytest.mark.parametrize("span", [2, 8])
def test_manifest_equals_plain_trees(spark, span):
    rows = rows_of([f"t{i}" for i in range(45)], ("en", "de", None, "fr", "en"))
    rows += [(None, None, None, None, None, "x", "y", "z"), rows[3], rows[3], (7, "other", "en", 1, "", "x", "y", "z"), (99, "s", "alone", 5, "w " * 50_000, "x", "y", "z")]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = merkle.checked(df, F.col("doc_id") % 7 == 0, settings=merkle.Settings(span)).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, g or ""))
    first = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    trees = {g: levels([leaf(r) for r in sorted(groups[g], key=first)]) for g in order}
    above = levels([trees[g][-1][0] for g in order])
    want = Counter()
    for place, g in enumerate(order):
        for pos, r in enumerate(sorted(groups[g], key=first)):
            mates = []
            for tree, at in ((trees[g], pos), (above, place)):
                for level in tree[:-1]:
                    mates.append((at % 2, level[at ^ 1] if (at ^ 1) < len(level) else None))
                    at //= 2
            node = leaf(r, 1 if r[0] is not None and r[0] % 7 == 0 else 0)
            for slot, mate in mates:
                node = sha(node) if mate is None else sha(mate, node) if slot else sha(node, mate)
            root = above[-1][0]
            want[(r[0], leaf(r), trees[g][-1][0], root, sha(*(m for _, m in mates if m)), node, node == root)] += 1
    assert Counter(tuple(r) for r in got) == want


def test_manifest_of_an_empty_table(spark):
    assert merkle.checked(spark.createDataFrame([], DOCS), F.lit(True)).collect() == []


def plain_collocations(rows, least, depth, top):
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = r[2] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[4] or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, depth + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        some = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + k] for p, a in some.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= counts[p[i : i + k]]}
        found = []
        for p, a in some.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("settings", [
    collocations.Settings(least=5, top=40),
    collocations.Settings(least=5, top=40, budget=30, slot_bits=3, slice_words=200, pairs_in_part=50),
    collocations.Settings(least=3, top=1000, budget=5, slot_bits=2, pair_bits=6, filter_bits=16),
])
def test_collocations_equal_plain_counts(spark, settings):
    draw = random.Random(3)
    words = ["the", "of", "Ünder", "straße", "a", "b", "big", "Cat", "naïve", "x y"]
    texts = [" ".join(draw.choices(words, range(10, 0, -1), k=draw.randrange(60))).replace("big", draw.choice(["big,", "big"])) for _ in range(120)]
    texts += ["one same long passage of words here"] * 9 + [None, "", " \t ", "!?.,", "word " * 30_000, "end.the\nof\x0bthe of"]
    rows = rows_of(texts, ("en", "de", None, "und"))
    got = collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(6), settings=settings).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, settings.least, settings.depth, settings.top)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(spark.createDataFrame(rows_of([None, "", "few words"]), DOCS)).collect() == []


def language_rows():
    draw = random.Random(5)
    parts = {"en": ["the", "ing", "tion", "wh", "ed", "ly"], "de": ["der", "ung", "sch", "ein", "ß", "zu"], "fr": ["eau", "que", "é", "ment", "les", "ç"]}
    return [(i, "s", lang, 0, " ".join("".join(draw.choices(parts[lang], k=2)) for _ in range(25)), "x", "y", "z") for i in range(240) for lang in [("en", "de", "fr")[i % 3]]]


def test_languages_are_told_apart(spark):
    rows = language_rows()
    odd = [None, "", "123 456 !!", "€€ 7"]
    rows += [(1000 + i, "s", None, 0, t, "x", "y", "z") for i, t in enumerate(odd)] + [(None, "s", None, 0, "The" + "ing tion" * 20_000, "x", "y", "z")]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    settings = language_id.Settings(steps=150)
    model = language_id.fit(df, only=F.col("doc_id") % 5 != 0, settings=settings)
    got = language_id.predict(df, model, keep=("doc_id", "a.b", "lang"), settings=settings).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    known = [r for r in got if r.lang and r.doc_id % 5 == 0]
    assert sum(r.lang == r.lang_pred for r in known) >= 0.95 * len(known)
    assert {(r.lang_pred, r.score, r.rejected) for r in got if (r.doc_id or 0) >= 1000} == {("und", 0.0, True)}
    assert [r.lang_pred for r in got if r.doc_id is None] == ["en"]


def test_languages_without_anything_to_learn_from(spark):
    df = spark.createDataFrame(rows_of(["some words", None], (None,)), DOCS)
    model = language_id.fit(df)
    assert {(r.lang_pred, r.score) for r in language_id.predict(df, model).collect()} == {("und", 0.0)}
    one = language_id.fit(spark.createDataFrame(rows_of(["some words", "others"], ("en",)), DOCS), settings=language_id.Settings(steps=5))
    assert [r.lang_pred for r in language_id.predict(df, one).orderBy("doc_id").collect()] == ["en", "und"]
    empty = spark.createDataFrame([], DOCS)
    assert language_id.predict(empty, language_id.fit(empty)).collect() == []


def near_copies():
    draw = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    passage = draw.choices(words, k=40)
    texts = [" ".join(passage + draw.choices(words, k=draw.randrange(4, 9))) for _ in range(150)]
    base = draw.choices(words, k=120)
    for _ in range(120):  # copies on both sides of the threshold
        copy = list(base)
        for _ in range(draw.randrange(1, 6)):
            copy[draw.randrange(120)] = draw.choice(words)
        texts.append(" ".join(copy))
    return texts + [texts[0], texts[200], "a b", "A  b", "", None, None]


def plain_components(texts, percent=80):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(sets)))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    for _ in sets:
        new = list(label)
        for i, j in links:
            new[i] = new[j] = min(new[i], new[j], label[i], label[j])
        if new == label:
            break
        label = new
    return label


@pytest.mark.parametrize("settings", [jaccard_join.Settings(), jaccard_join.Settings(small_key=2, rounds=1), jaccard_join.Settings(small_key=0, rounds=0, hot_sets=9, hot_share=2, tier_bits=16)])
def test_join_with_a_hot_passage_equals_all_pairs(spark, settings):
    texts = near_copies()
    df = spark.createDataFrame(rows_of(texts), DOCS).repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard_join.join_components(df, settings=settings).collect()}
    assert got == dict(enumerate(plain_components(texts)))


def test_refined_keys_grow_with_the_rows(spark):
    sizes = []
    for n in (150, 600):
        draw = random.Random(n)
        words = [f"w{i}" for i in range(5000)]
        passage = draw.choices(words, k=40)
        texts = [" ".join(passage + draw.choices(words, k=6)) for _ in range(n)]
        df = spark.createDataFrame(rows_of(texts), DOCS).repartition(4)
        classes = jaccard_join.survey(df, "doc_id", "text", jaccard_join.Settings()).where("kind = 0 and n > 0").selectExpr("class", "id")
        sets = jaccard_join.whole_sets(df, "doc_id", "text", classes, jaccard_join.Settings()).cache()
        filters = spark.sparkContext.broadcast(jaccard_join.tier_filters(sets, jaccard_join.Settings()))
        keys = jaccard_join.refined_keys(sets, sets.selectExpr("class", "class as part"), filters, jaccard_join.Settings())
        sizes.append(jaccard_join.refined_pairs(keys).count())
    assert sizes[1] <= 8 * max(sizes[0], 5)


def test_refined_pairs_may_be_similar(spark):
    """Texts that share half of their words are paired for a shared key without sketches, but not with them."""
    draw, s = random.Random(9), jaccard_join.Settings()
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"w{i}-{j}" for j in range(60)]) for i in range(12)]
    texts += [" ".join(passage[:50] + [f"near{i}"] + passage[51:] + [f"q{j}" for j in range(60)]) for i in range(6)]
    draw.shuffle(texts)
    df = spark.createDataFrame(rows_of(texts), DOCS).repartition(4)
    classes = jaccard_join.survey(df, "doc_id", "text", s).where("kind = 0 and n > 0").selectExpr("class", "id")
    sets = jaccard_join.whole_sets(df, "doc_id", "text", classes, s).cache()
    sketch = jaccard_join.sketches(df, "doc_id", "text", classes, s).drop("parity").cache()
    items = [(r["class"], [int(x) for x in np.frombuffer(r["items"], np.uint64)]) for r in sets.collect()]
    # one key for all, as a text of frequent words alone has: all of its set stands behind it
    keys = spark.createDataFrame([(1, c, c, len(x), large, len(x)) for c, x in items for large in (0, 1)], "key long, class long, part long, n long, large int, rest long")
    near = {tuple(sorted((a, b))) for a, x in items for b, y in items if a < b and 100 * len({*x} & {*y}) >= 80 * len({*x} | {*y})}
    every = jaccard_join.refined_pairs(keys).count()
    got = {tuple(r) for r in jaccard_join.refined_pairs(keys, sketch, 80).collect()}
    assert every == 18 * 17 // 2 and len(near) == 15 and near <= got and len(got) <= 20


def test_one_row_of_each_group_stays(spark):
    texts = near_copies()
    rows = rows_of(texts)
    rows += rows[:60]  # repeated rows
    rows += [(None, "s", "en", 1, "a b", "x", "y", "z")] * 3 + [(None, "s", "en", 1, "only here without an id", "x", "y", "z")] * 2
    got = jaccard_join.keep_one(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    empty = [r for r in rows if not (r[4] or "").strip()]
    kept = sorted(r.doc_id for r in got if r.doc_id is not None and (r.text or "").strip())
    assert kept == sorted({c for c, t in zip(plain_components(texts), texts) if (t or "").strip()})
    assert [r.text for r in got if r.doc_id is None] == ["only here without an id"]
    assert sum(not (r.text or "").strip() for r in got) == len(empty) and got[0].__fields__ == ["doc_id", "source", "lang", "n_chars", "text", "a.b", "block", "path"]


def test_copies_that_differ_in_an_outer_line_are_one_document_after_two_stages(spark):
    import corpus_pipeline

    draw = random.Random(2)
    lines = [" ".join(draw.choices([f"w{i}" for i in range(400)], k=12)) for _ in range(10)]
    texts = []
    for i in range(5):
        own = list(lines)
        own[0] = " ".join(f"own{i}x{j}" for j in range(12))
        texts.append("\n".join(own))
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    for stage in (corpus_pipeline.without_repeated_lines, corpus_pipeline.without_near_duplicates):
        docs = stage(spark, docs, "")
    assert [r.doc_id for r in docs.collect()] == [0]


def test_workers_give_the_tables_of_powers_back():
    texts = pa.array(["Some words, some WORDS " * 50, "", None])
    before = words.words_of(texts).hash

    def count(batches):
        for batch in batches:
            yield len(words.words_of(batch).hash)

    assert list(words.lean(count)([texts, texts])) == [200 + 0, 200 + 0]
    assert words._powers.cache_info().currsize == 0
    assert (words.words_of(texts).hash == before).all()
