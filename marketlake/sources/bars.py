"""Bars from ticks: one partial/final aggregation on (symbol, period)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bars_from_ticks(ticks: DataFrame, symbol: Column, time: Column, price: Column, order: Column, grain: str) -> DataFrame:
    """Roll ticks up to OHLCV bars.

    ``order`` decides open and close and must be unique within a bar. Map-side partial aggregation
    collapses each task's share of a hot symbol to one row per period before the shuffle. A numeric order
    (a sequence number) aggregates by hash; a struct makes Spark sort the ticks first, four times slower.
    """
    return (
        ticks.select(
            symbol.alias("symbol"),
            F.date_trunc(grain, time).alias("timestamp"),
            price.cast("double").alias("price"),
            order.alias("ord"),
        )
        .groupBy("symbol", "timestamp")
        .agg(
            F.min_by("price", "ord").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "ord").alias("close"),
            F.count("*").alias("volume"),
        )
    )


def bars_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per order status."""
    orders = table(spark, folder, "orders")
    return bars_from_ticks(
        orders, F.col("o_orderstatus"), F.col("o_orderdate"), F.col("o_totalprice"), F.col("o_orderkey"), "day"
    )


def bars_events(spark: SparkSession, folder: str, grain: str = "hour") -> DataFrame:
    """Intraday (or daily) bars per event type; ticks in order of time, then id, as one number that aggregates by hash."""
    events = table(spark, folder, "events")
    order = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(38,0)") * F.expr("10000000000000000000BD") + F.col("event_id")
    return bars_from_ticks(events, F.col("event_type"), F.col("ts"), F.col("value"), order, grain)


def bars_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per customer: many short histories."""
    orders = table(spark, folder, "orders")
    return bars_from_ticks(
        orders, F.col("o_custkey").cast("string"), F.col("o_orderdate"), F.col("o_totalprice"), F.col("o_orderkey"), "day"
    )


def bars_seconds(spark: SparkSession, folder: str) -> DataFrame:
    """One-second bars: one hot history with all ticks, and one per user."""
    events = table(spark, folder, "events")
    order = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(38,0)") * F.expr("10000000000000000000BD") + F.col("event_id")
    users = F.concat(F.lit("user "), F.col("user_id"))
    ticks = events.withColumn("symbol", F.explode(F.array_compact(F.array(F.lit("all"), users))))
    return bars_from_ticks(ticks, F.col("symbol"), F.col("ts"), F.col("value"), order, "second")
