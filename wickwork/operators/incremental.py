"""Per-coin high watermarks: where to read from, and how far a run got."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from wickwork.functions.times import at, interval_length, millis, utc

# Candles read again before the watermark, and hours read without one.
OVERLAP_CANDLES = 2
DEFAULT_LOOKBACK_HOURS = 24


def fetch_start(
    coins: DataFrame,
    watermarks: DataFrame,
    as_of: datetime,
    interval: str = "1h",
    overlap: int = OVERLAP_CANDLES,
    default_hours: int = DEFAULT_LOOKBACK_HOURS,
) -> DataFrame:
    """Coins with the time to read from: the watermark less the overlap, or the default lookback.

    The overlap reads the last candles again because they may have been open when last
    read; for the same reason a watermark may lie in the future.
    """
    ts_type = watermarks.schema["last_loaded_close_time"].dataType
    back = F.make_interval(secs=F.lit(overlap * int(interval_length(interval).total_seconds())))
    default = at(as_of, ts_type) - F.make_interval(hours=F.lit(default_hours))
    marks = watermarks.filter(F.col("interval") == interval).select("coin_id", "last_loaded_close_time")
    start = F.coalesce(F.col("last_loaded_close_time") - back, default)
    return coins.join(marks, "coin_id", "left").withColumn("fetch_from", start.cast(ts_type))


def from_start(candles: DataFrame, starts: DataFrame) -> DataFrame:
    """Candles at or after their coin's fetch start; ``starts`` has one row per coin."""
    marks = starts.select("coin_id", "fetch_from")
    return candles.join(marks, "coin_id").filter(F.col("open_time") >= F.col("fetch_from")).drop("fetch_from")


def new_watermarks(candles: DataFrame) -> DataFrame:
    """Highest close time per coin and interval over sane candles, the still open one included."""
    return candles.groupBy("coin_id", "interval").agg(F.max("close_time").alias("last_loaded_close_time"))


def latest_closed(candles: DataFrame, as_of: datetime) -> DataFrame:
    """Each coin's last candle that closed before ``as_of``: its close price and close time.

    ``candles`` holds one row per candle, as ``rollup.silver`` leaves them.
    """
    ts_type = candles.schema["close_time"].dataType
    closed = candles.filter(F.col("close_time") < at(millis(as_of), ts_type))
    return closed.groupBy("coin_id").agg(
        F.max_by("close", "close_time").alias("price_usd"), F.max("close_time").alias("updated_at")
    )


def due(as_of: datetime, hour: int) -> bool:
    """True in the one UTC hour of the day that work is scheduled for."""
    return utc(as_of).hour == hour
