"""Splits, encoders and models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stayglass.catalog.registry import STAYS, rd, register, tidy
from stayglass.operators import encode, ranks, rows, splits
from stayglass.plans import train as tr
from stayglass.session import work_path
from stayglass.sources import files
from stayglass.sources import tables as t

BOUNDARY = dt.date(1999, 6, 1)


@register("time_split", f"""
WITH {STAYS}, b AS (
  SELECT stay_id, row_number() OVER (ORDER BY md5('42|' || stay_id)) AS rn, count(*) OVER () AS n FROM stays WHERE checkin = DATE '{BOUNDARY}')
SELECT s.stay_id, CASE WHEN checkin < DATE '{BOUNDARY}' THEN 'train' WHEN checkin > DATE '{BOUNDARY}' THEN 'test'
  WHEN rn <= CAST(floor(0.35::DOUBLE * n) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM stays s LEFT JOIN b USING (stay_id)""")
def time_split(spark, folder):
    return splits.time_split(
        t.stays(spark, folder).select("stay_id", "checkin"), "checkin", "stay_id", BOUNDARY
    ).select("stay_id", "split")


@register("standardize", f"""
WITH x AS (SELECT l_orderkey, l_quantity, l_discount, 7.0::DOUBLE AS flat FROM lineitem),
f AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd FROM x)
SELECT l_orderkey, l_quantity, {rd('(l_quantity - mq) / sq')} AS l_quantity_std, {rd('(l_discount - md) / sd')} AS l_discount_std,
  0.0::DOUBLE AS flat_std FROM x, f""")
def standardize(spark, folder):
    lines = t.table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_discount", F.lit(7.0).alias("flat"))
    return tidy(encode.standardize(lines, ["l_quantity", "l_discount", "flat"]).drop("l_discount", "flat"))


CODES = """
c AS (SELECT kind, row_number() OVER (ORDER BY kind) - 1 AS code FROM (
  SELECT DISTINCT 'K' || (o_custkey % 37) AS kind FROM orders WHERE o_custkey % 37 < 30)),
x AS (SELECT o_orderkey AS stay_id, 'K' || (o_custkey % 37) AS kind FROM orders)"""


def _kinds(spark, folder):
    kinds = t.stays(spark, folder).select("stay_id", "hotel", F.concat(F.lit("K"), F.col("hotel") % 37).alias("kind"))
    return kinds.select("stay_id", "kind"), kinds.where("hotel % 37 < 30")


@register("one_hot", f"WITH {CODES} SELECT stay_id, x.kind, CASE WHEN code > 0 THEN code - 1 END AS hot FROM x LEFT JOIN c USING (kind)")
def one_hot(spark, folder):
    rows_, train = _kinds(spark, folder)
    return encode.one_hot_position(rows_, train, "kind", "hot").select("stay_id", "kind", "hot")


@register("label_encode", f"WITH {CODES} SELECT stay_id, x.kind, coalesce(code, 0) AS code FROM x LEFT JOIN c USING (kind)")
def label_encode(spark, folder):
    rows_, train = _kinds(spark, folder)
    return encode.label_encode(rows_, train, "kind", "code").select("stay_id", "kind", "code")


@register("global_row_number", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate,
  row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS position FROM lineitem""")
def global_row_number(spark, folder):
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = t.table(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate")).select(*order)
    return tidy(ranks.global_row_number(lines, order, "position"), keep=("l_extendedprice",))


@register("cv_folds", """
WITH r AS (SELECT o_orderkey AS stay_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT stay_id, CASE WHEN i < n // 3 + least(1, n % 3) THEN 0 WHEN i < 2 * (n // 3) + least(2, n % 3) THEN 1 ELSE 2 END::BIGINT AS fold FROM r""")
def cv_folds(spark, folder):
    return ranks.contiguous_folds(t.stays(spark, folder).select("stay_id"), "stay_id", 3)


FEATURES = ["l_quantity", "l_discount", "l_tax", "brand_size", "l_returnflag", "dear"]


def model_rows(spark, folder):
    """Priced line items with a few features of each kind, in exact parts of 60, 20 and 20 %."""
    priced = t.table(spark, folder, "lineitem").select(
        F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("string"))).alias("key"),
        "l_quantity", "l_discount", "l_tax", (F.col("l_partkey") % 50).alias("brand_size"), "l_returnflag",
        (F.col("l_tax") > 0.04).alias("dear"),
        F.col("l_extendedprice").alias("price"), F.log1p("l_extendedprice").alias("log_price"),
    )
    # training repeats scans, so the parts are written once
    parted = splits.random_split(priced, "key")
    stored = work_path(spark, "model-rows")
    parted.write.partitionBy("split").parquet(stored)
    return spark.read.parquet(stored)


def _parts(spark, folder):
    data = model_rows(spark, folder)
    return data.where("split = 'train'").drop("split"), data.where("split = 'val'").drop("split")


def _report(spark, folder, specs):
    train, val = _parts(spark, folder)
    board, _ = tr.compare(specs, train, val, FEATURES, "log_price", "price")
    return tidy(board)


@register("train_linear")
def train_linear(spark, folder):
    return _report(spark, folder, tr.BASELINES[:4])


@register("train_forest")
def train_forest(spark, folder):
    return _report(spark, folder, [tr.BASELINES[4], tr.ADVANCED[0]])


@register("train_gbt")
def train_gbt(spark, folder):
    return _report(spark, folder, [tr.ADVANCED[1]])


@register("score_predictions")
def score_predictions(spark, folder):
    train, val = _parts(spark, folder)
    model, _ = tr.fit(tr.BASELINES[0], train, FEATURES, "log_price")
    return tidy(tr.metrics(model, val, "log_price", "price"))


@register("score_new_data")
def score_new_data(spark, folder):
    train, val = _parts(spark, folder)
    model, _ = tr.fit(tr.BASELINES[0], train, FEATURES, "log_price")
    return tidy(tr.score(model, val.drop("price", "log_price")).select("key", "prediction", "prediction_price"), 2)


@register("model_roundtrip")
def model_roundtrip(spark, folder):
    train, val = _parts(spark, folder)
    model, _ = tr.fit(tr.BASELINES[0], train, FEATURES, "log_price")
    again = tr.load(tr.save(model, work_path(spark, "model")))
    return tidy(tr.metrics(again, val, "log_price", "price"))


@register("cross_validate")
def cross_validate(spark, folder):
    data = model_rows(spark, folder).where("split <> 'test'").drop("split")
    folded = ranks.contiguous_folds(ranks.global_row_number(data, ["key"], "position"), "position", 3)
    return tidy(tr.cross_validate(tr.BASELINES[0], files.stored(folded, "folds"), FEATURES, "log_price", "fold"))


@register("cross_validate_best")
def cross_validate_best(spark, folder):
    """The best three of the linear models, by the exact split's validation part."""
    data = model_rows(spark, folder)
    train, val = data.where("split = 'train'").drop("split"), data.where("split = 'val'").drop("split")
    board, _ = tr.compare(tr.BASELINES[:4], train, val, FEATURES, "log_price", "price")
    kept = data.where("split <> 'test'").drop("split")
    folded = ranks.contiguous_folds(ranks.global_row_number(kept, ["key"], "position"), "position", 3)
    return tidy(tr.cross_validate_best(board, tr.BASELINES[:4], files.stored(folded, "folds"), FEATURES, "log_price", "fold"))


@register("feature_importance")
def feature_importance(spark, folder):
    train, _ = _parts(spark, folder)
    model, names = tr.fit(tr.BASELINES[4], train, FEATURES, "log_price")
    return tidy(tr.feature_importance(model, names, train))


def _leaderboard_sql() -> str:
    def of(part: str, expr: str, digits: int = 4) -> str:
        return rd(f"any_value(CASE WHEN part = '{part}' THEN {expr} END)", digits)

    return f"""
WITH r AS (SELECT o_totalprice AS y, o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'train' ELSE 'val' END AS part FROM orders),
p AS (SELECT part, 'Half' AS model, 'Baseline' AS kind, y, y * (0.5 + (k % 5) / 10.0::DOUBLE) AS f FROM r
      UNION ALL SELECT part, 'Near', 'Advanced', y, y * (0.9 + (k % 3) / 10.0::DOUBLE) FROM r),
mu AS (SELECT part, avg(y) AS m FROM r GROUP BY part),
g AS (SELECT model, kind, part, sqrt(avg(power(y - f, 2))) AS rmse, avg(abs((y - f) / y)) * 100 AS mape,
        1 - sum(power(y - f, 2)) / sum(power(y - m, 2)) AS r2 FROM p JOIN mu USING (part) GROUP BY ALL)
SELECT model, kind, {of('train', 'rmse', 2)} AS train_rmse, {of('val', 'rmse', 2)} AS val_rmse, {of('train', 'mape')} AS train_mape,
  {of('val', 'mape')} AS val_mape, {of('train', 'r2')} AS train_r2, {of('val', 'r2')} AS val_r2,
  {rd("any_value(CASE WHEN part = 'train' THEN r2 END) - any_value(CASE WHEN part = 'val' THEN r2 END)")} AS overfit
FROM g GROUP BY model, kind ORDER BY val_r2 DESC"""


@register("model_leaderboard", _leaderboard_sql())
def model_leaderboard(spark, folder):
    stays = t.stays(spark, folder)
    guesses = {
        ("Half", "Baseline"): F.col("price") * (F.lit(0.5) + (F.col("stay_id") % 5) / 10.0),
        ("Near", "Advanced"): F.col("price") * (F.lit(0.9) + (F.col("stay_id") % 3) / 10.0),
    }
    reports = []
    for (name, kind), guess in guesses.items():
        for part, keep in (("train", "stay_id % 2 = 0"), ("val", "stay_id % 2 <> 0")):
            scored = stays.where(keep).select("price", guess.alias("guess"), F.log1p("price").alias("y"), F.log1p(guess).alias("p"))
            reports.append(tr.regression_metrics(scored, "y", "p", "price", "guess").select(
                F.lit(name).alias("model"), F.lit(kind).alias("kind"), F.lit(part).alias("part"), "*"
            ))
    board = tr.leaderboard(rows.union_by_name(*reports))
    return tidy(board.withColumns({c: F.round(c, 2) for c in ("train_rmse", "val_rmse")}))
