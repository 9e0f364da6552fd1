"""Serving queries: what the sync writes and what charts read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from wickwork import layout
from wickwork.catalog import shapes
from wickwork.catalog.base import ctes, query
from wickwork.catalog.candles import ohlcv_daily, ohlcv_hourly
from wickwork.catalog.shapes import BRONZE, EVENTS_AS_OF, SILVER, SNAPSHOTS, gold_sql
from wickwork.catalog.upserts import target_snapshots, TARGET
from wickwork.layout import read_table
from wickwork.operators import serving
from wickwork.session import new_folder
from wickwork.sinks.tables import create_table, upsert_table

_HOURLY = (BRONZE, SILVER, gold_sql("gold", "silver", "hour"))
_DAILY = (BRONZE, SILVER, gold_sql("gold", "silver", "day"))


def _serving_sql(name: str, unit: str, length: str, source: str = "gold", since: str | None = None) -> str:
    where = f"WHERE \"{unit}\" >= TIMESTAMP '{since}'" if since else ""
    return f"""
{name} AS (
  SELECT coin_id, "{unit}" AS bucket_start, CAST(open AS DECIMAL(24,10)) AS open, CAST(high AS DECIMAL(24,10)) AS high,
    CAST(low AS DECIMAL(24,10)) AS low, CAST(close AS DECIMAL(24,10)) AS close, CAST(volume AS DECIMAL(28,10)) AS volume,
    "{unit}" + INTERVAL 1 {length} <= TIMESTAMP '2024-01-30 20:30:00' AS is_closed,
    TIMESTAMP '2024-01-30 20:30:00' AS updated_at
  FROM {source} {where})"""


def _timestamps(df):
    """The zoneless gold queries back in stored types."""
    return df.select(
        *[F.col(f.name).cast("timestamp") if f.dataType.simpleString() == "timestamp_ntz" else F.col(f.name) for f in df.schema]
    )


def hourly_gold(spark, sf_dir):
    return _timestamps(ohlcv_hourly(spark, sf_dir))


def daily_gold(spark, sf_dir):
    return _timestamps(ohlcv_daily(spark, sf_dir))


@query(
    "serving_hourly",
    ctes(*_HOURLY, _serving_sql("serving", "hour", "HOUR", since="2024-01-30 12:30:00")) + "SELECT * FROM serving",
)
def serving_hourly(spark, sf_dir):
    return serving.to_serving(hourly_gold(spark, sf_dir), "hour", EVENTS_AS_OF)


@query(
    "serving_daily",
    ctes(*_DAILY, _serving_sql("serving", "day", "DAY", since="2024-01-25 20:30:00")) + "SELECT * FROM serving",
)
def serving_daily(spark, sf_dir):
    return serving.to_serving(daily_gold(spark, sf_dir), "day", EVENTS_AS_OF)


@query(
    "upsert_rollups",
    ctes(*_HOURLY, _serving_sql("serving", "hour", "HOUR", since="2024-01-01")) + "SELECT * FROM serving",
)
def upsert_rollups(spark, sf_dir):
    """Two syncs into a stored rollup table, the second over buckets the first had written."""
    path = new_folder(spark, "rollups")
    create_table(spark, path, layout.ROLLUPS_HOURLY)
    gold = hourly_gold(spark, sf_dir)
    for as_of in (datetime(2024, 1, 20, 5), EVENTS_AS_OF):
        known = gold.filter(F.col("hour") <= F.lit(str(as_of)).cast("timestamp")) if as_of != EVENTS_AS_OF else gold
        rows = serving.to_serving(known, "hour", as_of, lookback=as_of - datetime(2024, 1, 1))
        upsert_table(path, rows, layout.ROLLUPS_HOURLY)
    return read_table(spark, path, layout.ROLLUPS_HOURLY).drop("date")


def _bars(spark, sf_dir, gold, unit):
    return serving.to_serving(gold(spark, sf_dir), unit, EVENTS_AS_OF, lookback=EVENTS_AS_OF - datetime(2024, 1, 1))


_BARS = (
    BRONZE,
    SILVER,
    gold_sql("gold_h", "silver", "hour"),
    gold_sql("gold_d", "silver", "day"),
    _serving_sql("hourly", "hour", "HOUR", "gold_h"),
    _serving_sql("daily", "day", "DAY", "gold_d"),
)
_TODAY = """
today AS (
  SELECT coin_id, date_trunc('day', bucket_start) AS bucket_start, arg_min(open, bucket_start) AS open,
    max(high) AS high, min(low) AS low, arg_max(close, bucket_start) AS close,
    CAST(sum(volume) AS DECIMAL(28,10)) AS volume, FALSE AS is_closed, max(updated_at) AS updated_at
  FROM hourly WHERE bucket_start >= TIMESTAMP '2024-01-30' GROUP BY 1, 2),
merged AS (
  SELECT * FROM daily d WHERE bucket_start < TIMESTAMP '2024-01-30'
    OR NOT EXISTS (SELECT 1 FROM today t WHERE t.coin_id = d.coin_id AND t.bucket_start = d.bucket_start)
  UNION ALL SELECT * FROM today)"""


@query("today_bars", ctes(*_BARS, _TODAY) + "SELECT * FROM today")
def today_bars(spark, sf_dir):
    return serving.today_bars(_bars(spark, sf_dir, hourly_gold, "hour"), EVENTS_AS_OF)


@query("today_merge", ctes(*_BARS, _TODAY) + "SELECT * FROM merged")
def today_merge(spark, sf_dir):
    daily = _bars(spark, sf_dir, daily_gold, "day")
    return serving.with_today(daily, _bars(spark, sf_dir, hourly_gold, "hour"), EVENTS_AS_OF)


@query(
    "history",
    ctes(*_BARS, _TODAY)
    + "SELECT * FROM merged WHERE coin_id = 'click' AND bucket_start >= TIMESTAMP '2024-01-10' ORDER BY bucket_start",
)
def history(spark, sf_dir):
    daily = _bars(spark, sf_dir, daily_gold, "day")
    hourly = _bars(spark, sf_dir, hourly_gold, "hour")
    return serving.history(daily, hourly, "click", datetime(2024, 1, 10), EVENTS_AS_OF)


_REPLAY = """
today AS (
  SELECT coin_id, date_trunc('day', bucket_start) AS bucket_start, arg_min(open, bucket_start) AS open,
    max(high) AS high, min(low) AS low, arg_max(close, bucket_start) AS close,
    CAST(sum(volume) AS DECIMAL(28,10)) AS volume, FALSE AS is_closed, max(updated_at) AS updated_at
  FROM hourly WHERE bucket_start >= TIMESTAMP '2024-01-16' AND bucket_start < TIMESTAMP '2024-01-17' GROUP BY 1, 2),
merged AS (
  SELECT * FROM daily WHERE bucket_start < TIMESTAMP '2024-01-16'
  UNION ALL SELECT * FROM daily d WHERE bucket_start = TIMESTAMP '2024-01-16'
    AND NOT EXISTS (SELECT 1 FROM today t WHERE t.coin_id = d.coin_id)
  UNION ALL SELECT * FROM today)"""


@query(
    "history_replay",
    ctes(*_BARS, _REPLAY)
    + "SELECT * FROM merged WHERE coin_id = 'view' AND bucket_start >= TIMESTAMP '2024-01-10' ORDER BY bucket_start",
)
def history_replay(spark, sf_dir):
    """The history as of a past day shows nothing of the days after it."""
    daily = _bars(spark, sf_dir, daily_gold, "day")
    hourly = _bars(spark, sf_dir, hourly_gold, "hour")
    return serving.history(daily, hourly, "view", datetime(2024, 1, 10), datetime(2024, 1, 16, 5))


@query(
    "range_scan",
    ctes(*_HOURLY, _serving_sql("serving", "hour", "HOUR"))
    + """SELECT * FROM serving WHERE coin_id = 'view' AND bucket_start >= TIMESTAMP '2024-01-25'
    ORDER BY bucket_start""",
)
def range_scan(spark, sf_dir):
    return serving.range_scan(_bars(spark, sf_dir, hourly_gold, "hour"), "view", datetime(2024, 1, 25))


_SNAPSHOT_COLUMNS = (
    "SELECT coin_id, price_usd, market_cap_usd, rank, change_percent_24h, updated_at, price_source FROM target "
)


@query("latest_rows", ctes(SNAPSHOTS, TARGET) + _SNAPSHOT_COLUMNS + "ORDER BY updated_at DESC, coin_id LIMIT 5")
def latest_rows(spark, sf_dir):
    return serving.latest_rows(target_snapshots(spark, sf_dir))


@query("price_source_rows", ctes(SNAPSHOTS, TARGET) + _SNAPSHOT_COLUMNS + "WHERE price_source = 'binance_rest'")
def price_source_rows(spark, sf_dir):
    return serving.from_source(target_snapshots(spark, sf_dir), "binance_rest")


@query(
    "latest_bronze",
    ctes(BRONZE) + "SELECT coin_id, open_time, publish_time FROM bronze ORDER BY publish_time DESC LIMIT 5",
)
def latest_bronze(spark, sf_dir):
    newest = serving.latest_rows(shapes.bronze(spark, sf_dir), by="publish_time")
    return newest.select("coin_id", "open_time", "publish_time")


@query(
    "coin_versions",
    ctes(BRONZE)
    + "SELECT coin_id, open_time, open, close, publish_time FROM bronze WHERE coin_id = 'signup'",
)
def coin_versions(spark, sf_dir):
    """All stored versions of one coin's candles, as the round-trip check of the stream reads them."""
    rows = shapes.bronze(spark, sf_dir).filter(F.col("coin_id") == "signup")
    return rows.select("coin_id", "open_time", "open", "close", "publish_time")
