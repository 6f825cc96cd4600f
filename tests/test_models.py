"""Models on data with a known signal, against direct solutions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayglass.operators.profile import regression_metrics
from stayglass.plans import train as tr
from stayglass.session import work_path

N = 300


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(42)
    x1, x2 = rng.normal(3, 2, N), rng.uniform(-1, 1, N)
    kind = rng.choice(["a", "b", "c"], N)
    y = 5 + 0.4 * x1 - 0.8 * x2 + np.where(kind == "b", 0.7, 0.0) + rng.normal(0, 0.01, N)
    rows = [(i, float(x1[i]), float(x2[i]), str(kind[i]), bool(i % 2), float(y[i]), float(np.expm1(y[i]))) for i in range(N)]
    df = spark.createDataFrame(rows, "i int, x1 double, x2 double, kind string, odd boolean, y double, price double")
    return df.where("i % 5 <> 0").cache(), df.where("i % 5 = 0").cache()


FEATURES = ["x1", "x2", "kind", "odd"]


def matrix(df):
    rows = df.select("x1", "x2", "kind", "odd", "y").collect()
    nums = np.array([[r["x1"], r["x2"]] for r in rows])
    nums = (nums - nums.mean(0)) / nums.std(0)
    cats = np.array([[r["kind"] == "b", r["kind"] == "c", r["odd"]] for r in rows], dtype=float)
    # category columns come with their levels in reversed order
    return np.hstack([nums, cats[:, [1, 0]], cats[:, 2:]]), np.array([r["y"] for r in rows])


def test_feature_groups(data):
    train, _ = data
    assert tr.feature_groups(train, FEATURES) == (["x1", "x2"], ["kind", "odd"])
    assert tr.feature_groups(train, FEATURES, "number") == (["x1", "x2", "odd"], ["kind"])


def test_ols_and_ridge_coefficients(data):
    train, _ = data
    x, y = matrix(train)
    xc, yc = x - x.mean(0), y - y.mean()
    for spec, alpha in ((tr.BASELINES[0], 0.0), (tr.BASELINES[1], 1.0)):
        model, names = tr.fit(spec, train, FEATURES, "y")
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
        assert names == ["x1", "x2", "kind_c", "kind_b", "odd_true"]
        assert np.allclose(model.stages[-1].coefficients.toArray(), want, atol=1e-6)


def soft(x, y, l1, l2):
    w = np.zeros(x.shape[1])
    n = len(y)
    for _ in range(3000):
        for k in range(x.shape[1]):
            r = y - x @ w + x[:, k] * w[k]
            rho = x[:, k] @ r / n
            w[k] = np.sign(rho) * max(abs(rho) - l1, 0) / (x[:, k] @ x[:, k] / n + l2)
    return w


def test_lasso_and_elastic_net_coefficients(data):
    train, _ = data
    x, y = matrix(train)
    xc, yc = x - x.mean(0), y - y.mean()
    for spec, l1, l2 in ((tr.BASELINES[2], 0.1, 0.0), (tr.BASELINES[3], 0.05, 0.05)):
        model, _ = tr.fit(spec, train, FEATURES, "y")
        assert np.allclose(model.stages[-1].coefficients.toArray(), soft(xc, yc, l1, l2), atol=1e-4), spec.name


def test_unseen_category_scores_as_first_level(spark, data):
    train, _ = data
    model, _ = tr.fit(tr.BASELINES[0], train, FEATURES, "y")
    new = spark.createDataFrame([(1.0, 0.0, "a", True), (1.0, 0.0, "zz", True)], "x1 double, x2 double, kind string, odd boolean")
    p = [r["prediction"] for r in tr.score(model, new).collect()]
    assert p[0] == p[1]


def test_metrics_and_roundtrip(spark, data):
    train, val = data
    model, _ = tr.fit(tr.BASELINES[0], train, FEATURES, "y")
    m = tr.metrics(model, val, "y", "price").first()
    assert m["r2_log"] > 0.99 and m["rmse_log"] < 0.02 and m["mape"] < 2
    again = tr.load(tr.save(model, work_path(spark, "model")))
    assert tr.metrics(again, val, "y", "price").first() == m


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.5, 10.0, 12.0), (2.0, 2.0, 20.0, 20.0), (3.0, 2.0, 40.0, 30.0)], "y double, p double, a double, b double")
    m = regression_metrics(df, "y", "p", "a", "b").first()
    assert m["mae_log"] == pytest.approx(0.5) and m["r2_log"] == pytest.approx(1 - 1.25 / 2)
    assert m["mape"] == pytest.approx(100 * (0.2 + 0 + 0.25) / 3)


def test_tree_models_and_leaderboard(data):
    train, val = data
    small = tr.ModelSpec("Forest", lambda df, label: tr.forest(df, label).setNumTrees(8).setMaxDepth(6))
    board, models = tr.compare([tr.BASELINES[0], tr.BASELINES[2], small], train, val, FEATURES, "y", "price")
    rows = board.collect()
    assert rows[0]["model"] == "Linear Regression" and [r["val_r2"] for r in rows] == sorted((r["val_r2"] for r in rows), reverse=True)
    assert rows[0]["overfit"] == pytest.approx(rows[0]["train_r2"] - rows[0]["val_r2"])
    model, names = tr.fit(small, train, FEATURES, "y")
    importance = tr.feature_importance(model, names, train).collect()
    assert importance[0]["feature"] == "x1" and sum(r["importance"] for r in importance) == pytest.approx(1)


def test_boosting_with_early_stop(data):
    train, val = data
    prep = tr.preprocess(train, FEATURES, "label")
    assert prep.names == ["x1", "x2", "odd", "kind"]
    held = train.withColumn("_held", F.lit(False)).unionByName(val.withColumn("_held", F.lit(True)))
    model = tr.Pipeline(stages=[*prep.stages, tr.boosted_trees(train, "y", 10, "_held")]).fit(held)
    assert tr.metrics(model, val, "y", "price").first()["r2_log"] > 0.6


def test_cross_validation(data):
    train, _ = data
    folded = train.withColumn("fold", (F.col("i") % 3).cast("bigint"))
    scores = tr.cross_validate(tr.BASELINES[0], folded, FEATURES, "y", "fold").collect()
    assert [r["fold"] for r in scores] == [0, 1, 2] and all(r["r2_log"] > 0.99 for r in scores)


def test_cross_validation_of_the_best(data):
    train, val = data
    specs = tr.BASELINES[:3]
    board, _ = tr.compare(specs, train, val, FEATURES, "y", "price")
    folded = train.withColumn("fold", (F.col("i") % 3).cast("bigint"))
    got = tr.cross_validate_best(board, specs, folded, FEATURES, "y", "fold", best=2).collect()
    assert [r["model"] for r in got] == sorted((r["model"] for r in got), key=lambda m: [-r["mean_r2"] for r in got if r["model"] == m])
    assert {r["model"] for r in got} == {r["model"] for r in board.limit(2).collect()}
    single = [r["r2_log"] for r in tr.cross_validate(specs[0], folded, FEATURES, "y", "fold").collect()]
    mine = next(r for r in got if r["model"] == specs[0].name)
    mean = sum(single) / 3
    assert mine["folds"] == 3 and mine["mean_r2"] == pytest.approx(mean)
    assert mine["std_r2"] == pytest.approx((sum((x - mean) ** 2 for x in single) / 3) ** 0.5)


def test_models_of_moments_equal_models_of_rows(data):
    """The fits of all linear models take one scan; each equals Spark's own fit over the rows."""
    train, _ = data
    prep = tr.preprocess(train, FEATURES)
    vectors = tr.PipelineModel(prep.stages).transform(train)
    condensed = tr.Condensed.of(vectors, "y")
    assert condensed.n == train.count() and condensed.rows.count() <= 2 * (len(prep.names) + 1)
    fitted = tr.fit_linear(tr.BASELINES[:4], prep, train, "y")
    for spec, model in zip(tr.BASELINES[:4], fitted):
        plain = spec.build(train, "y").fit(vectors)
        assert np.allclose(model.stages[-1].coefficients.toArray(), plain.coefficients.toArray(), atol=1e-6), spec.name
        assert model.stages[-1].intercept == pytest.approx(plain.intercept, abs=1e-6)


def test_boosting_equals_plain_boosting(data):
    """Trees over histograms by tasks equal greedy ones over all rows; blocks written again change nothing."""
    from stayglass.plans import boosting as bo

    train, _ = data
    rows = tr.PipelineModel(tr.preprocess(train, FEATURES, "label").stages).transform(train)
    rows = rows.select(tr.vector_to_array("features").alias("x"), "y", F.lit(False).alias("held"), F.col("i").cast("long").alias("id")).repartition(3)
    cuts, shift, trees = bo.boost(rows, bo.BoostSettings(4, 2, 0.1, 1.0, 1, renew=2))
    x, y = np.array([r.x for r in rows.collect()]), np.array([r.y for r in rows.collect()])
    bins, left = bo._binned(x, cuts), y - y.mean()
    assert shift == pytest.approx(y.mean()) and len(trees) == 4

    def grow(some, depth):
        best = max(
            ((left[some][b <= c].sum() ** 2 / (b <= c).sum() + left[some][b > c].sum() ** 2 / (b > c).sum(), -j, -c)
             for j, b in enumerate(bins[some].T) for c in np.unique(b)[:-1].tolist()), default=None,
        ) if depth else None
        if best is None or best[0] - left[some].sum() ** 2 / len(some) <= 1e-12:
            return {i: left[some].mean() for i in some}
        side = bins[some, -best[1]] <= -best[2]
        return grow(some[side], depth - 1) | grow(some[~side], depth - 1)

    for k, tree in enumerate(trees):
        want = grow(np.arange(len(y)), 2)
        got = tree.value[tree.reach(np.ascontiguousarray(bins.T))]
        assert np.allclose(got, [want[i] * (0.2 if k else 1) for i in range(len(y))])
        left = left - got
