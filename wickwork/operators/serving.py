"""Serving rollups: what charts read, and the reads themselves."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from wickwork.functions.times import at, bucket, step, trunc, utc
from wickwork.layout import time_range
from wickwork.operators.rollup import LOOKBACK
from wickwork.schemas import SERVING
from wickwork.sources.tables import recent_buckets

# How far back a sync reads. Wider than the rebuild's own lookback, so a
# bucket the rebuild revised is always picked up.
SYNC_LOOKBACK = {"hour": timedelta(hours=8), "day": timedelta(days=5)}


def check_margin(unit: str, sync: timedelta, rebuild: timedelta) -> None:
    """A sync has to look back further than the rebuild it follows."""
    if sync <= rebuild:
        raise ValueError(f"{unit} sync lookback {sync} must be wider than the rebuild lookback {rebuild}")


def to_serving(
    gold: DataFrame,
    unit: str,
    as_of: datetime,
    interval: str = "1h",
    lookback: timedelta | None = None,
) -> DataFrame:
    """Recent gold buckets in serving types; a bucket is closed once it has ended by ``as_of``.

    Serving rows are keyed by coin and bucket without the interval, hence the single interval.
    """
    lookback = SYNC_LOOKBACK[unit] if lookback is None else lookback
    check_margin(unit, lookback, LOOKBACK[unit])
    return serving_rows(recent_buckets(gold, unit, interval, as_of, lookback), unit, as_of)


def serving_rows(gold: DataFrame, unit: str, as_of: datetime) -> DataFrame:
    """Gold buckets of one interval in serving types."""
    ts_type = gold.schema[unit].dataType
    ends = F.col("bucket_start") + F.make_interval(secs=F.lit(int(step(unit).total_seconds())))
    rows = gold.withColumnRenamed(unit, "bucket_start")
    amounts = {f.name: f.dataType for f in SERVING.fields if f.name in ("open", "high", "low", "close", "volume")}
    return rows.select(
        "coin_id",
        "bucket_start",
        *[F.col(c).cast(t).alias(c) for c, t in amounts.items()],
        (ends <= at(as_of, ts_type)).alias("is_closed"),
        at(as_of, ts_type).alias("updated_at"),
    )


def range_scan(rollups: DataFrame, coin_id: str, start: datetime, end: datetime | None = None) -> DataFrame:
    """One coin's buckets from ``start`` on, oldest first."""
    rows = time_range(rollups.filter(F.col("coin_id") == coin_id), "bucket_start", start, end)
    return rows.orderBy("bucket_start")


def today_bars(hourly: DataFrame, as_of: datetime) -> DataFrame:
    """Today's day bar of each coin, made from its hourly bars so far."""
    ts_type = hourly.schema["bucket_start"].dataType
    first = trunc(as_of, "day")
    today = time_range(hourly, "bucket_start", first, first + timedelta(days=1))
    bars = today.groupBy("coin_id", bucket(today, "bucket_start", "day").alias("day")).agg(
        F.min_by("open", "bucket_start").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bucket_start").alias("close"),
        F.sum("volume").alias("volume"),
        F.max("updated_at").alias("updated_at"),
    )
    ends = F.col("day") + F.make_interval(days=F.lit(1))
    bars = bars.withColumn("is_closed", ends <= at(as_of, ts_type)).withColumnRenamed("day", "bucket_start")
    return bars.select(*[F.col(f.name).cast(hourly.schema[f.name].dataType) for f in SERVING.fields])


def with_today(daily: DataFrame, hourly: DataFrame, as_of: datetime) -> DataFrame:
    """Daily bars with today's bar taken from the hourly ones where a coin has any.

    Today's stored rows and hourly bars meet in one aggregate by coin and day, in which a stored row counts only where there
    are no hourly ones. History passes through with its filter pushed to the scan. Rows of later days do not exist yet at ``as_of``.
    """
    ts_type = hourly.schema["bucket_start"].dataType
    today, end = trunc(as_of, "day"), trunc(as_of, "day") + timedelta(days=1)
    names = [f.name for f in SERVING.fields]
    amounts = [c for c in names if c not in ("coin_id", "bucket_start", "is_closed", "updated_at")]
    history = time_range(daily, "bucket_start", end=today).select(*names)
    stored = time_range(daily, "bucket_start", today, end)
    stored = stored.select("coin_id", "bucket_start", F.lit(None).cast(ts_type).alias("hour"), *amounts, "is_closed", "updated_at")
    bars = time_range(hourly, "bucket_start", today, end)
    day = bucket(bars, "bucket_start", "day").alias("bucket_start")
    bars = bars.select("coin_id", day, F.col("bucket_start").alias("hour"), *amounts, F.lit(None).cast("boolean").alias("is_closed"), "updated_at")
    fresh = F.col("hour").isNotNull()
    made = {
        "open": F.min_by("open", "hour"),
        "high": F.max(F.when(fresh, F.col("high"))),
        "low": F.min(F.when(fresh, F.col("low"))),
        "close": F.max_by("close", "hour"),
        "volume": F.sum(F.when(fresh, F.col("volume"))),
        "updated_at": F.max(F.when(fresh, F.col("updated_at"))),
        "is_closed": F.lit(end <= utc(as_of)),
    }
    rows = stored.unionByName(bars).groupBy("coin_id", "bucket_start")
    there = F.count("hour") > 0
    known = lambda c: F.max(F.when(~fresh, F.col(c)))
    merged = rows.agg(*[F.when(there, value).otherwise(known(c)).alias(c) for c, value in made.items()])
    typed = [F.col(c).cast(hourly.schema[c].dataType).alias(c) for c in names]
    return history.unionByName(merged.select(*typed))


def history(daily: DataFrame, hourly: DataFrame, coin_id: str, start: datetime, as_of: datetime) -> DataFrame:
    """One coin's daily bars from ``start`` on, today included, oldest first."""
    one = F.col("coin_id") == coin_id
    recent = time_range(daily.filter(one), "bucket_start", start)
    return range_scan(with_today(recent, hourly.filter(one), as_of), coin_id, start)


def latest_rows(df: DataFrame, n: int = 5, by: str = "updated_at", tie_break: tuple[str, ...] = ("coin_id",)) -> DataFrame:
    """The ``n`` most recently updated rows."""
    return df.orderBy(F.desc(by), *tie_break).limit(n)


def from_source(snapshots: DataFrame, price_source: str) -> DataFrame:
    """Snapshots whose price came from one writer."""
    return snapshots.filter(F.col("price_source") == price_source)
