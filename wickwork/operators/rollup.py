"""Bronze to silver to gold: one row per candle, then open/high/low/close per hour and day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from wickwork.functions.times import at, bucket, trunc, utc

CANDLE_KEY = ["coin_id", "interval", "open_time"]

# How far back an incremental rebuild looks.
LOOKBACK = {"hour": timedelta(hours=6), "day": timedelta(days=3)}


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` is limited on the map side too, so a key with any number of rows
    sends one row per task through the shuffle. ``max(struct(...))`` would fall back to a sort
    aggregate over whole-row structs, which measured slower.
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).filter("__rn = 1").drop("__rn")


def version_order(published: str, first: Sequence[Column] = ()) -> list[Column]:
    """Versions of a candle, the one that counts first; ``first`` decides among those published together."""
    order = [F.desc_nulls_last(published), *first, F.desc("is_closed"), F.desc("trade_count")]
    return order + [F.desc(c) for c in ("volume", "close", "high", "low", "open", "quote_volume", "close_time")]


def silver(bronze: DataFrame) -> DataFrame:
    """One row per (coin, interval, open time): the version published last.

    Versions published at the same moment are told apart by their contents, so the result
    does not depend on input order. A version without a publish time loses to any with one.
    """
    return latest_per_key(bronze, CANDLE_KEY, version_order("publish_time")).select(
        *CANDLE_KEY,
        "close_time",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "quote_volume",
        "trade_count",
        "is_closed",
        F.col("publish_time").alias("latest_publish_time"),
    )


def merge_silver(stored: DataFrame, fresh_bronze: DataFrame) -> DataFrame:
    """Stored silver rows and new bronze versions, reduced again by the same rule.

    Merging is associative and repeatable: any split of bronze into batches, in any order
    and with repeats, ends in the same silver.
    """
    columns = [*CANDLE_KEY, "close_time", "open", "high", "low", "close", "volume", "quote_volume"]
    columns += ["trade_count", "is_closed", "publish_time"]
    versions = stored.withColumnRenamed("latest_publish_time", "publish_time")
    return silver(versions.select(*columns).unionByName(fresh_bronze.select(*columns)))


def _measures(order: str, candle_count: Column) -> list[Column]:
    # min_by and max_by over decimals keep the aggregate hash-based and partial on the map side.
    return [
        F.min_by("open", order).alias("open"),
        F.max_by("close", order).alias("close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").alias("volume"),
        F.sum("quote_volume").alias("quote_volume"),
        F.sum("trade_count").alias("trade_count"),
        candle_count.alias("candle_count"),
        F.max("latest_publish_time").alias("latest_publish_time"),
    ]


def lookback_start(as_of: datetime, unit: str, lookback: timedelta | None = None) -> datetime:
    """Start of the oldest bucket to rebuild, always a whole bucket.

    An unaligned start would rebuild the oldest bucket from part of its candles and then
    overwrite the full one.
    """
    return trunc(utc(as_of) - (LOOKBACK[unit] if lookback is None else lookback), unit)


def ohlcv(
    candles: DataFrame,
    unit: str,
    as_of: datetime | None = None,
    lookback: timedelta | None = None,
) -> DataFrame:
    """Candles rolled up to ``unit`` ("hour" or "day"), the bucket column named after it.

    Without ``as_of`` it is a full refresh; with it, only buckets from the lookback start on.
    """
    if as_of is not None:
        start = lookback_start(as_of, unit, lookback)
        candles = candles.filter(F.col("open_time") >= at(start, candles.schema["open_time"].dataType))
    return candles.groupBy("coin_id", "interval", bucket(candles, "open_time", unit).alias(unit)).agg(
        *_measures("open_time", F.count("*"))
    )


def bars_of(changed: DataFrame, candles: DataFrame, unit: str) -> DataFrame:
    """Bars of the buckets in ``changed`` (``coin_id``, ``interval``, ``unit``), with ``deleted`` for those that have no candles left."""
    keys = ["coin_id", "interval", unit]
    candles = candles.withColumn(unit, bucket(candles, "open_time", unit))
    wanted = changed.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = [F.col(f"__{k}").eqNullSafe(F.col(k)) for k in keys]
    found = wanted.join(candles.withColumn("__there", F.lit(1)), same, "left").drop(*keys).withColumnsRenamed({f"__{k}": k for k in keys})
    bars = found.groupBy(*keys).agg(*_measures("open_time", F.count("__there")))
    return bars.withColumn("deleted", F.col("candle_count") == 0)


def rebucket(gold: DataFrame, source: str, target: str) -> DataFrame:
    """Gold rows of a finer unit rolled up to a coarser one."""
    return gold.groupBy("coin_id", "interval", bucket(gold, source, target).alias(target)).agg(
        *_measures(source, F.sum("candle_count"))
    )


def partial_days(gold_daily: DataFrame, expected: int = 24) -> DataFrame:
    """Days holding fewer candles than a full day has."""
    return gold_daily.filter(F.col("candle_count") < expected)
