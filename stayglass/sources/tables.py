"""Lodging views over the generic order / line-item tables used for checks and benches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _grid(base: float, number, step: float = 0.001):
    return F.lit(base) + number.cast("double") * F.lit(step)


def stays(spark: SparkSession, folder: str, district: bool = False) -> DataFrame:
    """One stay per order; ``district`` joins the customer table in."""
    orders = table(spark, folder, "orders")
    ci = F.to_date("o_orderdate")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    extra = []
    if district:
        customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
        orders = orders.join(customers, "o_custkey")
        extra = [F.col("c_mktsegment").alias("district")]
    return orders.select(
        key.alias("stay_id"),
        ci.alias("checkin"),
        F.date_add(ci, (key % 3 + 1).cast("int")).alias("checkout"),
        F.date_sub(ci, (key % 120).cast("int")).alias("snapshot"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("room"),
        F.col("o_orderstatus").alias("status"),
        cust.alias("hotel"),
        F.when(cust % 20 != 0, _grid(43.60, cust % 100)).alias("lat"),
        _grid(-79.50, cust % 150).alias("lon"),
        *extra,
    )


def city_events(spark: SparkSession, folder: str) -> DataFrame:
    """One event per line item."""
    lines = table(spark, folder, "lineitem")
    day = F.to_date("l_shipdate")
    return lines.select(
        F.md5(F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", day.cast("string"))).alias("event_id"),
        day.alias("day"),
        (F.col("l_quantity") * F.lit(0.25)).alias("score"),
        F.col("l_returnflag").alias("segment"),
        _grid(43.60, F.col("l_partkey") % 120).alias("event_lat"),
        _grid(-79.50, F.col("l_suppkey") % 100).alias("event_lon"),
    )


def station_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Five stations, one row per station and day."""
    return table(spark, folder, "lineitem").groupBy(
        F.to_date("l_shipdate").alias("day"), (F.col("l_suppkey") % 5).alias("station")
    ).agg(
        (F.sum("l_quantity") / F.count("l_quantity") - 20.0).alias("mean_temp"),
        F.max("l_quantity").alias("max_temp"),
    )


def holidays(spark: SparkSession, folder: str) -> DataFrame:
    """First-of-month order dates as the holiday calendar."""
    day = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(day.alias("day")).where(F.dayofmonth("day") == 1).distinct()
