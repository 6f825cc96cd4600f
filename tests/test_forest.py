"""Forests: both ways of growing give the same trees, splits are the best ones, models survive a round trip."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from stayglass.plans import boosting, forest, train


def rows(spark, n=600, seed=4):
    draw = np.random.default_rng(seed)
    x = draw.integers(0, 30, (n, 3)).astype(float)
    y = 5.0 * (x[:, 0] > 11) + 3.0 * (x[:, 1] > 20) * (x[:, 0] > 11) + draw.normal(0, 0.01, n)
    df = spark.createDataFrame([(int(i), float(v), r.tolist()) for i, (v, r) in enumerate(zip(y, x))], "id bigint, y double, x array<double>")
    return df.withColumn("id", F.xxhash64("id")).repartition(4), x, y


SETTINGS = dict(trees=6, depth=7, least=3, share="sqrt", seed=9)


def nodes_of(df, **more):
    cuts, nodes = forest.train(df, forest.ForestSettings(**{**SETTINGS, **more}))
    return cuts, {(r.tree, r.node): (r.feature, r.cut, round(r.value, 6), round(r.gain, 4), r.weight) for r in nodes.collect()}


def test_histograms_and_tasks_grow_the_same_trees(spark):
    df, _, _ = rows(spark)
    _, alone = nodes_of(df)
    _, shared = nodes_of(df, small=200, cells=4000)
    _, deep = nodes_of(df, small=1, least=1, depth=3, trees=2)
    _, deep_alone = nodes_of(df, least=1, depth=3, trees=2)
    assert alone == shared and deep == deep_alone and len({t for t, _ in alone}) == 6


def test_the_root_has_the_best_split(spark):
    df, x, y = rows(spark)
    cuts, nodes = nodes_of(df, trees=1, share="all", depth=1)
    ids = np.array([r.id for r in df.collect()])
    got = {r.id: (r.y, r.x) for r in df.collect()}
    w = forest._weights(ids, 0, SETTINGS["seed"])
    y = np.array([got[i][0] for i in ids]); x = np.array([got[i][1] for i in ids])
    best = (0.0, None, None)
    mean = np.average(y, weights=w)
    for j in range(3):
        for k, c in enumerate(cuts[j]):
            left = x[:, j] <= c
            a, b = w[left].sum(), w[~left].sum()
            if a >= 3 and b >= 3:
                gain = (w * (y - mean))[left].sum() ** 2 / a + (w * (y - mean))[~left].sum() ** 2 / b
                if gain > best[0] * (1 + 1e-7):
                    best = (gain, j, k)
    root = nodes[(0, 1)]
    assert root[:2] == best[1:] and root[3] == pytest.approx(best[0], rel=1e-6) and root[2] == pytest.approx(mean)


def test_bootstrap_weights_are_poisson():
    ids = np.arange(200_000, dtype=np.int64)
    w = forest._weights(ids, 3, 42)
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02)
    assert (forest._weights(ids, 4, 42) != w).mean() > 0.4


def priced(spark):
    draw = np.random.default_rng(1)
    out = []
    for i in range(900):
        a, kind = float(draw.integers(1, 50)), "xyz"[i % 3]
        price = 50 + 3 * a + 40 * (kind == "y") + float(draw.normal(0, 1))
        out.append((a, kind, price, float(np.log1p(price))))
    df = spark.createDataFrame(out, "size double, kind string, price double, log_price double")
    return df.limit(700), df.subtract(df.limit(700))


def test_a_forest_learns_is_saved_and_scores_again(spark, tmp_path):
    fit, held = priced(spark)
    spec = train.ModelSpec("f", lambda df, label: forest.Forest(label, forest.ForestSettings(20, 8, 2, "all", 1)), "label")
    model, names = train.fit(spec, fit, ["size", "kind"], "log_price")
    assert train.metrics(model, held, "log_price", "price").first()["r2_orig"] > 0.97
    again = train.load(train.save(model, str(tmp_path / "m")))
    key = ["size", "kind", "price"]
    assert sorted(map(tuple, train.score(model, held).select(*key, "prediction").collect())) == sorted(map(tuple, train.score(again, held).select(*key, "prediction").collect()))
    found = train.feature_importance(model, names, fit).collect()
    assert [r.feature for r in found] == ["size", "kind"] and sum(r.importance for r in found) == pytest.approx(1)


def test_a_forest_of_nothing_is_an_error(spark):
    with pytest.raises(ValueError):
        forest.train(spark.createDataFrame([], "id bigint, y double, x array<double>"), forest.ForestSettings(**SETTINGS))


def test_patience_keeps_the_best_round():
    assert train.best_round([5, 4, 3, 3.5, 3.2, 2.9, 3, 3, 3], 10) == 6
    assert train.best_round([5, 4, 3, 3.5, 3.2, 3.1, 1], 3) == 3
    assert train.best_round([1], 10) == 1


def test_boosting_is_cut_where_the_loss_turns(spark):
    fit, held = priced(spark)
    noisy = fit.withColumn("log_price", F.col("log_price") + F.randn(3) * 0.3)
    spec = train.ModelSpec("b", lambda df, label: train.boosted_trees(df, label, rounds=15), "label", patience=2)
    model, _ = train.fit(spec, noisy, ["size", "kind"], "log_price", held)
    full, _ = train.fit(spec, noisy, ["size", "kind"], "log_price")
    losses = full.stages[-1].evaluateEachIteration(PipelineModel(full.stages[:-1]).transform(held), "squared")
    assert model.stages[-1].getNumTrees == train.best_round(losses, 2) < 15
    assert model.stages[-1].evaluateEachIteration(PipelineModel(model.stages[:-1]).transform(held), "squared") == pytest.approx(losses[: model.stages[-1].getNumTrees])


def test_levels_are_summed_without_sorting_rows(monkeypatch):
    """While a level has more rows than cells its rows are added up, not sorted; the best cuts are those of sorted cells."""
    draw = np.random.default_rng(3)
    n = 6000
    bins = draw.integers(0, 40, (n, 4)).astype(np.uint8)
    node, w = draw.integers(0, 7, n), draw.integers(1, 4, n).astype(float)
    node[node == 5] = 6  # a node without rows
    y = draw.normal(0, 1, n) + (bins[:, 0] > 20) * node
    for j in range(4):
        sorted_ = forest._best_cuts(*forest._cells(node, bins[:, j], w, w * y), 7, 5)
        summed = forest._best_dense(node * 40, bins[:, j], w, w * y, 7, 40, 5)
        assert (sorted_[1] == summed[1]).all() and sorted_[0] == pytest.approx(summed[0])
    monkeypatch.setattr(forest, "_cells", lambda *a: pytest.fail("rows sorted"))
    grown = forest.grow(0, 1, bins, y, w, forest.ForestSettings(**{**SETTINGS, "depth": 4, "share": "all"}))
    assert len(grown[0]) == 31


def test_rows_walk_to_the_open_nodes():
    draw = np.random.default_rng(5)
    splits = {1: (0, 10), 2: (1, 5), 3: (2, 7), 5: (0, 3), 7: (1, 20)}
    bins = draw.integers(0, 30, (500, 3)).astype(np.uint8)
    heap, *walk = forest._compiled(splits)
    got = heap[forest._descend(*walk, bins)]
    for row, node in zip(bins, got.tolist()):
        at = 1
        while at in splits:
            at = 2 * at + int(row[splits[at][0]] > splits[at][1])
        assert at == node


def test_equal_rows_are_cells_with_sums_and_grow_the_same_trees(spark, monkeypatch):
    """Tasks that grow trees get cells, not rows, and blocks of many equal rows hold sums for each tree."""
    df, x, _ = rows(spark, 3000)
    alike = df.withColumn("x", F.transform("x", lambda v: F.floor(v / 10).cast("double")))
    s = forest.ForestSettings(**SETTINGS)
    ids, y, b = (np.array([r[k] for r in alike.collect()]) for k in ("id", "y", "x"))
    order = np.lexsort(b.T)
    block = forest.Cells.of(ids[order], y[order], b[order].astype(np.uint8))
    record = block.record(s)
    assert len(block.bins) == 27 and record[:2] == [3000, 27] and record[4] is None
    kept = forest.Cells(block.bins, block.first, None, None, np.frombuffer(record[6], np.uint32).reshape(6, -1), np.frombuffer(record[7]).reshape(6, -1))
    for tree in range(6):
        w = forest._weights(ids[order], tree, s.seed)
        assert kept.sums(tree, s.seed)[0].tolist() == np.add.reduceat(w, block.first).tolist()
        assert kept.sums(tree, s.seed)[1] == pytest.approx(np.add.reduceat(w * y[order], block.first))
    assert forest.Cells.of(ids, y, np.arange(6000, dtype=np.uint16).view(np.uint8).reshape(-1, 4)[:3000]).record(s)[4] is not None  # all differ
    _, summed = nodes_of(alike)
    _, levels = nodes_of(alike, small=5, cells=4000)
    monkeypatch.setattr(forest, "DEARER", 0)
    _, raw = nodes_of(alike)
    assert summed == raw == levels


def test_weights_by_table_are_those_by_search():
    ids = np.random.default_rng(2).integers(-(2**62), 2**62, 300_000)
    drawn = forest._mix(ids.view(np.uint64) + forest._mix(np.full(1, 9 * 1_000_003 + 4 + 1, np.uint64)))
    assert (forest._weights(ids, 4, 9) == np.searchsorted(forest._POISSON, (drawn >> np.uint64(11)) / 2.0**53, "right")).all()


def test_many_equal_rows_score_as_one(spark, monkeypatch):
    fit, held = priced(spark)
    spec = train.ModelSpec("f", lambda df, label: forest.Forest(label, forest.ForestSettings(5, 12, 1, "all", 1)), "label")
    model, _ = train.fit(spec, fit, ["size", "kind"], "log_price")
    roots, feature, cut, left, value = model.stages[-1].packed()
    scored = train.score(model, held.union(held)).join(held.select("size", "kind").distinct(), ["size", "kind"]).collect()
    for r in scored:
        x, guess = [r["size"], "xyz".index(r["kind"])], []
        for at in roots:
            while left[at] >= 0:
                at = left[at] + int(np.searchsorted(model.stages[-1].cuts[feature[at]], x[feature[at]], "left") > cut[at])
            guess.append(float(value[at]))
        assert r["prediction"] == pytest.approx(np.mean(guess))


@pytest.mark.parametrize("subsample", [0.8, 1.0])
def test_one_task_boosts_the_same_trees(spark, subsample):
    df, _, _ = rows(spark, 2000)
    df = df.withColumn("held", F.col("id") % 5 == 0).union(df.limit(50).withColumn("held", F.lit(True)))
    df = df.localCheckpoint()
    s = boosting.BoostSettings(rounds=12, depth=4, rate=0.1, subsample=subsample, seed=3, patience=20, renew=5)
    _, shift, trees = boosting.boost(df, s)
    _, same, passes = boosting.boost(df, boosting.replace(s, alone=0))
    assert shift == same and len(trees) == len(passes) > 1
    for a, b in zip(trees, passes):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.weight == b.weight).all()
        assert a.value == pytest.approx(b.value) and a.gain == pytest.approx(b.gain)
