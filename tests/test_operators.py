"""Rows, columns, quantiles, ranks, splits, encoders and profiles on small frames."""

import datetime as dt
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayglass.operators import columns as cols
from stayglass.operators import comoments, encode, profile, ranks, rows, splits
from stayglass.operators.quantiles import exact_quantiles

D = dt.date


def skewed(n=4000, seed=7):
    """A third one value, a tight cluster, a far outlier."""
    rng = random.Random(seed)
    return [100.0 if i % 3 == 0 else (1e12 if i == 1 else 50 + rng.random() * (1e-6 if i % 3 == 1 else 200)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 5, 4000])
def test_quantiles_are_exact(spark, n):
    values = skewed(n)
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), (None, 2.0), ("a", None), ("a", float("nan"))], "g string, v double")
    probs = {"q1": 0.25, "m": 0.5, "q3": 0.75, "top": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for name, p in probs.items():
        assert got["a"][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert got["b"]["m"] == 1.0 and got[None]["m"] == 2.0
    whole = exact_quantiles(df.where("g = 'a'"), "v", probs).first()
    assert whole["m"] == pytest.approx(np.quantile(values, 0.5), rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}).first()["m"] is None
    assert rows.outliers(df, "v").count() == 0


def test_keep_first(spark):
    data = [(None, "x", 2, "late"), (None, "x", 1, "early"), ("h", "x", 1, None)] + [("hot", "y", i, "z") for i in range(50)]
    df = spark.createDataFrame(data, "hotel string, room string, ord int, note string")
    got = rows.keep_first(df, ["hotel", "room", "absent"], [F.col("ord")])
    assert got.columns == df.columns
    assert {(r["hotel"], r["ord"], r["note"]) for r in got.collect()} == {(None, 1, "early"), ("h", 1, None), ("hot", 0, "z")}


def test_price_range_keeps_null(spark):
    df = spark.createDataFrame([(24.99,), (25.0,), (2000.0,), (2000.01,), (None,)], "p double")
    assert [r["p"] for r in rows.within_or_null(df, "p", 25, 2000).collect()] == [25.0, 2000.0, None]


def test_denied_names_keep_null(spark):
    df = spark.createDataFrame([("Scarborough HOME",), ("Other",), (None,)], "h string")
    assert [r["h"] for r in rows.without_denied(df, "h").collect()] == ["Other", None]


def test_column_defaults_and_pruning(spark):
    df = spark.createDataFrame([(i, None, 1.0 if i < 5 else None, 1.0 if i < 1 else None) for i in range(10)],
                               "i int, empty double, half double, tenth double")
    filled = cols.default_if_empty(df, {"empty": 9.0, "half": 9.0, "absent": 9.0}).first()
    assert (filled["empty"], filled["half"], filled["absent"]) == (9.0, 1.0, 9.0)
    assert cols.drop_empty(df).columns == ["i", "half", "tenth"]
    assert cols.drop_sparse(df, 0.2, ["tenth"]).columns == ["i", "half", "tenth"]
    assert cols.drop_sparse(df, 0.2, []).columns == ["i", "half"]
    assert cols.drop_low_coverage(df, 0.1, []).columns == ["i", "half", "tenth"]
    assert cols.features_by_missing_rate(df, ["half", "i", "absent"], 50) == ["half", "i"]


def test_best_covered_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "`Attraction distance` double, `Distance from attraction` double")
    assert cols.keep_best_covered(df, ["distance", "attraction"], "Distance from attraction").collect()[0][0] == 1.0


def test_coerce_bad_values_to_null(spark):
    df = spark.createDataFrame([("2.0", "x", "True", "2025-10-10"), ("two", "1.5", "maybe", "soon")], "a string, b string, c string, d string")
    got = cols.coerce(df, {"a": "bigint", "b": "double", "c": "boolean", "d": "date", "absent": "double"}).collect()
    assert [tuple(r) for r in got] == [(2, None, True, D(2025, 10, 10)), (None, 1.5, None, None)]


def test_suffix_and_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "MEAN_TEMPERATURE int, MEAN_TEMPERATURE_weather int, price int")
    assert cols.drop_suffixed(df, "_weather", ["MEAN_TEMPERATURE"]).columns == ["MEAN_TEMPERATURE", "price"]
    assert "price_usd" in cols.canonical_name(df, ["price_usd", "price"], "price_usd").columns


def test_top_categories(spark):
    df = spark.createDataFrame([(x,) for x in "aabbcd"] + [(None,)] * 9, "c string")
    assert [r["c"] for r in rows.top_categories(df, "c", 3).collect()] == ["a", "b", "c"]
    got = rows.collapse_to_top(df, "c", 2, "s").groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got} == {"a": 2, "b": 2, "other": 11}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1001])
def test_random_split_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    parts = splits.random_split(df, "k")
    sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    held = math.ceil(0.4 * n)
    test = math.ceil(0.5 * held)
    want = {"train": n - held, "val": held - test, "test": test}
    assert sizes == {k: v for k, v in want.items() if v}
    assert tuple(splits.coverage_check(parts, "k").first()) == (n, 0, 0)


def test_published_split_sizes():
    n = 61328
    held = math.ceil(0.4 * n)
    assert (n - held, held - math.ceil(held / 2), math.ceil(held / 2)) == (36796, 12266, 12266)


def test_time_split(spark):
    hot = D(2025, 10, 3)
    data = [(i, hot if i % 3 else D(2025, 9, 30)) for i in range(60)] + [(60, D(2025, 10, 10)), (61, None)]
    df = spark.createDataFrame(data, "k long, day date")
    got = splits.time_split(df, "day", "k", hot).groupBy("split", "day").count().collect()
    sizes = {(r["split"], r["day"]): r["count"] for r in got}
    assert sizes == {("train", D(2025, 9, 30)): 20, ("val", hot): 14, ("test", hot): 26, ("test", D(2025, 10, 10)): 1, (None, None): 1}


@pytest.mark.parametrize("n", [3, 7, 100])
def test_contiguous_folds(spark, n):
    got = [r["fold"] for r in ranks.contiguous_folds(spark.range(n).toDF("id"), "id", 3).orderBy("id").collect()]
    assert got == [f for f in range(3) for _ in range(n // 3 + (f < n % 3))]


def test_global_row_number(spark):
    values = random.Random(3).sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    got = {r["v"]: r["rn"] for r in ranks.global_row_number(df, ["v"], "rn").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_encoders(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "c string")
    new = spark.createDataFrame([("a",), ("c",), ("zz",), (None,)], "c string")
    assert {r["c"]: r["x"] for r in encode.label_encode(new, train, "c", "x").collect()} == {"a": 0, "c": 2, "zz": 0, None: 0}
    assert {r["c"]: r["x"] for r in encode.one_hot_position(new, train, "c", "x").collect()} == {"a": None, "c": 1, "zz": None, None: None}
    nums = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, flat double")
    assert [tuple(r) for r in encode.standardize(nums, ["x", "flat"]).select("x_std", "flat_std").orderBy("x_std").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_moments_and_skewness(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 10)], "x double")
    m = profile.moments(df, F.col("x")).first()
    assert round(m["skewness"], 4) == 1.1384 and round(m["kurtosis"], 3) == -0.212
    assert round(profile.log_transform_report(df, "x").first()["skew"], 4) == 1.6971


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 4, 4)], "x double")
    h = [r["n"] for r in profile.histogram(df, F.col("x"), 4).orderBy("bin").collect()]
    assert h == [1, 1, 1, 3]
    flat = profile.histogram(df.select(F.lit(2.0).alias("x")), F.col("x"), 2).orderBy("bin").collect()
    assert sum(r["n"] for r in flat) == 6


def test_inverse_normal(spark):
    got = spark.createDataFrame([(p,) for p in (0.001, 0.025, 0.5, 0.8413447460685429, 0.999)], "p double").select(
        profile.inverse_normal(F.col("p")).alias("z")).collect()
    assert [r["z"] for r in got] == pytest.approx([-3.090232306, -1.959963985, 0.0, 1.0, 3.090232306], abs=1e-6)


def test_qq_points_are_order_statistics(spark):
    values = [float(v) for v in range(1, 301)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = profile.qq_points(df, "x", 11).orderBy("point").collect()
    assert [r["ordered_value"] for r in got] == [values[r["rank"] - 1] for r in got]
    assert got[0]["normal_quantile"] == pytest.approx(-got[-1]["normal_quantile"], abs=1e-6)


def test_correlations(spark):
    data = [(float(i), 2.0 * i, None if i % 2 else float(-i), 1.0) for i in range(40)]
    df = spark.createDataFrame(data, "a double, b double, c double, k double")
    m = {(r["x"], r["y"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    assert m["a", "b"] == pytest.approx(1) and m["c", "a"] == pytest.approx(-1) and m["a", "a"] == 1 and m["k", "k"] is None
    ranking = profile.correlation_ranking(df, ["b", "c", "k"], "a").collect()
    assert {(r["feature"], r["n"], r["direction"]) for r in ranking} == {("b", 40, "positive"), ("c", 20, "negative")}


def test_co_moments_equal_plain_sums_over_tasks(spark):
    """Missing values, constants among the common rows, far-off means, sorted tasks; one scan of the input."""
    random = np.random.default_rng(5)
    n = 3000
    table = {
        "a.b": random.normal(1e9, 1.0, n), "c": np.arange(n) * 1e-3, "d": random.integers(0, 3, n).astype(float),
        "k": np.full(n, 0.1), "only": np.where(np.arange(n) == 7, 2.0, np.nan), "gone": np.full(n, np.nan),
    }
    table["d"][::3] = np.nan
    table["e"] = np.where(np.isnan(table["d"]), table["c"], 0.3)  # constant wherever d is
    table["e"][5] = np.nan
    table["far"] = np.where(np.arange(n) == 0, 1e12, table["c"] + 1)
    names = list(table)
    rows_ = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(zip(*table.values()))]
    df = spark.createDataFrame(rows_, ", ".join(f"`{c}` double" for c in names)).repartitionByRange(7, "c")
    found = comoments.correlations(df, names, names)
    assert sum("Scan" in x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "ExistingRDD" in x) == 1
    got = {(r["x"], r["y"]): r for r in found.collect()}
    assert len(got) == len(names) ** 2
    for a in names:
        for b in names:
            both = ~np.isnan(table[a]) & ~np.isnan(table[b])
            x, y = table[a][both], table[b][both]
            assert got[a, b]["n"] == both.sum()
            if len(x) < 2 or np.ptp(x) == 0 or np.ptp(y) == 0:
                assert got[a, b]["r"] is None, (a, b)
            else:
                # a mean held in one double is off by up to its last digit, which counts against the spread
                limit = 1e-9 + sum(np.spacing(abs(v).max()) / v.std() for v in (x, y))
                assert got[a, b]["r"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=limit), (a, b)


def test_co_moments_of_no_rows_and_of_infinities(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in comoments.correlations(none, ["a"], ["b"]).collect()] == [("a", "b", 0, None)]
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (float("inf"), 4.0, None), (3.0, 7.0, 1.0)], "a double, b double, c double")
    got = {r["y"]: (r["n"], r["r"]) for r in comoments.correlations(df, ["a"], ["b", "c"]).collect()}
    assert got == {"b": (3, None), "c": (2, pytest.approx(-1.0))}


def test_deny_table_and_union(spark):
    df = spark.createDataFrame([("A",), ("b",), (None,)], "h string")
    deny = spark.createDataFrame([("a",)], "n string")
    assert {r["h"] for r in rows.anti_join_denied(df, "h", deny, "n").collect()} == {"b", None}
    u = rows.union_by_name(df, spark.createDataFrame([(1,)], "x int"))
    assert u.columns == ["h", "x"] and u.count() == 4


def test_random_split_takes_one_scan_of_hashes(spark, monkeypatch):
    """Both cuts come from one scan; null and repeated keys still go the longer way."""
    def brute(keys):
        def order(seed):
            return lambda k: hashlib.md5(f"{seed}|{k}".encode()).hexdigest()

        n = len(keys)
        fit = sorted(keys, key=order(42))[: n - math.ceil(0.4 * n)]
        held = sorted(set(keys) - set(fit), key=order(43))
        val = held[: len(held) - math.ceil(0.5 * len(held))]
        return {k: "train" if k in set(fit) else "val" if k in set(val) else "test" for k in keys}

    def split(df):
        return {r["key"]: r["split"] for r in splits.random_split(df, "key").collect()}

    nulls = spark.range(300).selectExpr("if(id % 3 = 0, null, string(id)) AS key")
    both = splits.random_split(nulls, "key").groupBy("key", "split").count().collect()
    monkeypatch.setattr(splits, "hash_cuts", lambda *a: None)
    assert sorted(map(str, both)) == sorted(map(str, splits.random_split(nulls, "key").groupBy("key", "split").count().collect()))
    monkeypatch.undo()
    monkeypatch.setattr(splits, "hash_cut", lambda *a: pytest.fail("a scan for each cut"))
    for n in (1, 2, 3, 9, 4000):
        df = spark.range(n).selectExpr("string(id) AS key")
        assert split(df) == brute([str(i) for i in range(n)])
    assert ranks.hash_cuts(spark.range(0).selectExpr("string(id) AS key"), F.lit("0"), F.lit("0"), 0.4, 0.5) is None
