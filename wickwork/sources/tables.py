"""Scans of stored tables, with the partition filters that keep them small."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wickwork import layout
from wickwork.functions.times import utc
from wickwork.layout import read_table, time_range


def read_bronze(
    spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Bronze candles with ``start <= open_time < end``; months outside are not read."""
    return time_range(read_table(spark, path, layout.BRONZE), "open_time", start, end).drop("month")


def rollup_scan(gold: DataFrame, unit: str, interval: str, as_of: datetime, lookback: timedelta) -> DataFrame:
    """The seven serving columns of one interval's recent buckets, ordered by coin and bucket."""
    return recent_buckets(gold, unit, interval, as_of, lookback).orderBy("coin_id", unit)


def recent_buckets(gold: DataFrame, unit: str, interval: str, as_of: datetime, lookback: timedelta) -> DataFrame:
    """``rollup_scan`` without the order, for what is written to a table that sorts its files itself."""
    recent = time_range(gold, unit, utc(as_of) - lookback)
    return recent.filter(F.col("interval") == interval).select("coin_id", unit, "open", "high", "low", "close", "volume")


def registry_scan(coins: DataFrame, limit: int | None = None) -> DataFrame:
    """Coins that have an exchange symbol, ordered; ``limit`` keeps the first ones for a trial run."""
    df = coins.filter(F.col("binance_symbol").isNotNull()).select("coin_id", "binance_symbol")
    return first_coins(df, limit)


def first_coins(coins: DataFrame, limit: int | None = None) -> DataFrame:
    """Coins in id order, the first ``limit`` of them; none or 0 means all."""
    ordered = coins.orderBy("coin_id")
    return ordered.limit(limit) if limit else ordered


def watermark_scan(watermarks: DataFrame, interval: str) -> DataFrame:
    return watermarks.filter(F.col("interval") == interval).select("coin_id", "last_loaded_close_time")
