"""Metric queries, from tables and from rollups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from wickwork.catalog.base import ctes, query
from wickwork.catalog.candles import sane_silver
from wickwork.catalog.serving import daily_gold, hourly_gold
from wickwork.catalog.shapes import BRONZE, EVENTS_AS_OF, SILVER, gold_sql
from wickwork.operators.metrics import CANDLES, DAILY, HOURLY, build_rollup, covered_now, metric_query
from wickwork.session import new_folder
from wickwork.layout import SILVER as SILVER_TABLE, read_table
from wickwork.sinks.rollups import read_rollup, refresh_rollup, write_rollup
from wickwork.sinks.tables import create_table, write_partitions
from wickwork.versions import append_versions

_DEDUPED = (BRONZE, SILVER)
_LAST_WEEK = "{t} >= TIMESTAMP '2024-01-23' AND {t} < TIMESTAMP '2024-01-30'"

BY_COIN = {
    "measures": ["candles.count", "candles.high", "candles.volume"],
    "dimensions": ["candles.coin_id"],
    "filters": [{"member": "candles.coin_id", "operator": "equals", "values": ["click", "view", "error"]}],
    "timeDimensions": [{"dimension": "candles.open_time", "dateRange": "last 7 days"}],
}
_BY_COIN_SQL = f"""SELECT coin_id, count(*) AS count, max(high) AS high, CAST(sum(volume) AS DECIMAL(38,9)) AS volume
  FROM silver WHERE coin_id IN ('click', 'view', 'error') AND {_LAST_WEEK.format(t='open_time')} GROUP BY 1"""


@query("metric_query_base", ctes(*_DEDUPED) + _BY_COIN_SQL)
def metric_query_base(spark, sf_dir):
    return metric_query(sane_silver(spark, sf_dir), CANDLES, BY_COIN, EVENTS_AS_OF)


@query("metric_query_rollup", ctes(*_DEDUPED) + _BY_COIN_SQL)
def metric_query_rollup(spark, sf_dir):
    """The same query, answered from a stored rollup."""
    name, path = "candles_by_coin_and_hour", new_folder(spark, "rollup")
    silver = sane_silver(spark, sf_dir)
    write_rollup(silver, CANDLES, name, path, EVENTS_AS_OF)
    return metric_query(silver, CANDLES, BY_COIN, EVENTS_AS_OF, {name: read_rollup(silver, CANDLES, name, path)})


@query("metric_query_stale_rollup", ctes(*_DEDUPED) + _BY_COIN_SQL)
def metric_query_stale_rollup(spark, sf_dir):
    """A rollup built before the range ends answers for what it holds, the table for the rest."""
    name, path = "candles_by_coin_and_hour", new_folder(spark, "rollup")
    silver, early = sane_silver(spark, sf_dir), datetime(2024, 1, 26)
    write_rollup(silver.filter("open_time < timestamp'2024-01-26'"), CANDLES, name, path, early)
    return metric_query(silver, CANDLES, BY_COIN, EVENTS_AS_OF, {name: read_rollup(silver, CANDLES, name, path)})


_SINCE = {
    "measures": ["count", "high", "low", "volume", "trade_count"],
    "dimensions": ["coin_id"],
    "timeDimensions": [{"dimension": "open_time", "granularity": "day", "dateRange": ["2024-01-03T05:30:00", "2024-01-29T12:15:00"]}],
}
_SINCE_SQL = """SELECT coin_id, date_trunc('day', open_time) AS open_time, count(*) AS count, max(high) AS high, min(low) AS low,
  CAST(sum(volume) AS DECIMAL(38,9)) AS volume, CAST(sum(trade_count) AS BIGINT) AS trade_count FROM silver
  WHERE open_time >= TIMESTAMP '2024-01-03 05:30:00' AND open_time < TIMESTAMP '2024-01-29 12:15:00' GROUP BY 1, 2"""


@query("metric_query_split", ctes(*_DEDUPED) + _SINCE_SQL)
def metric_query_split(spark, sf_dir):
    """A stored table with a rollup of its first part, and versions appended since into days that the rollup covers.

    Covered whole hours come from the rollup; changed days, the time after the build and the range's broken ends from the table.
    """
    name, source, path = "candles_by_coin_and_hour", new_folder(spark, "silver"), new_folder(spark, "rollup")
    create_table(spark, source, SILVER_TABLE)
    silver = sane_silver(spark, sf_dir)
    late = "day(open_time) IN (5, 6, 20) AND trade_count % 2 = 0"
    append_versions(silver.where(f"open_time < timestamp'2024-01-21' AND NOT ({late})"), source, SILVER_TABLE)
    refresh_rollup(spark, source, SILVER_TABLE, CANDLES, name, path, datetime(2024, 1, 21))
    append_versions(silver.where(f"open_time >= timestamp'2024-01-21' OR ({late})"), source, SILVER_TABLE)
    table = read_table(spark, source, SILVER_TABLE)
    stored = read_rollup(table, CANDLES, name, path, source)
    return metric_query(table, CANDLES, _SINCE, EVENTS_AS_OF, {name: stored})


@query("metric_query_refreshed", ctes(*_DEDUPED) + _SINCE_SQL)
def metric_query_refreshed(spark, sf_dir):
    """The same, after the rollup has followed the table's feed."""
    name, source, path = "candles_by_coin_and_hour", new_folder(spark, "silver"), new_folder(spark, "rollup")
    create_table(spark, source, SILVER_TABLE)
    silver = sane_silver(spark, sf_dir)
    for n, build in enumerate((datetime(2024, 1, 20), EVENTS_AS_OF)):
        append_versions(silver.where(F.pmod("trade_count", F.lit(2)) == n), source, SILVER_TABLE)
        refresh_rollup(spark, source, SILVER_TABLE, CANDLES, name, path, build)
    table = read_table(spark, source, SILVER_TABLE)
    return metric_query(table, CANDLES, _SINCE, EVENTS_AS_OF, {name: read_rollup(table, CANDLES, name, path, source)})


@query(
    "metric_query_outside_range",
    ctes(*_DEDUPED) + "SELECT coin_id, count(*) AS count, max(high) AS high FROM silver WHERE open_time < TIMESTAMP '2024-01-21' GROUP BY 1",
)
def metric_query_outside_range(spark, sf_dir):
    """Two years after the candles: their months lie before the rollup's thirteen, and the table answers for all that are asked for."""
    name, path, late = "candles_by_coin_and_hour", new_folder(spark, "rollup"), datetime(2026, 1, 21)
    silver = sane_silver(spark, sf_dir)
    write_rollup(silver, CANDLES, name, path, late)
    spec = {
        "measures": ["count", "high"],
        "dimensions": ["coin_id"],
        "timeDimensions": [{"dimension": "open_time", "dateRange": ["2023-01-01", "2024-01-20"]}],
    }
    return metric_query(silver, CANDLES, spec, late, {name: read_rollup(silver, CANDLES, name, path)})


@query(
    "metric_query_empty_count",
    ctes(*_DEDUPED)
    + """SELECT count(*) AS count, max(high) AS high FROM silver
    WHERE coin_id = 'nobody' AND open_time >= TIMESTAMP '2024-01-23' AND open_time < TIMESTAMP '2024-01-30'""",
)
def metric_query_empty_count(spark, sf_dir):
    """A count over no rows is 0 from a rollup too."""
    name = "candles_by_coin_and_hour"
    spec = {
        "measures": ["count", "high"],
        "filters": [{"member": "coin_id", "operator": "equals", "values": ["nobody"]}],
        "timeDimensions": [{"dimension": "open_time", "dateRange": "last 7 days"}],
    }
    silver = sane_silver(spark, sf_dir)
    return metric_query(silver, CANDLES, spec, EVENTS_AS_OF, {name: covered_now(silver, CANDLES, name, EVENTS_AS_OF)})


@query(
    "metric_query_close_time",
    ctes(*_DEDUPED)
    + """SELECT coin_id, count(*) AS count, max(high) AS high FROM silver
    WHERE open_time + INTERVAL 7 DAY >= TIMESTAMP '2024-01-23' AND open_time + INTERVAL 7 DAY < TIMESTAMP '2024-01-30'
    GROUP BY 1""",
)
def metric_query_close_time(spark, sf_dir):
    """A range of close times over a stored table whose partitions follow from open times, with week-long candles."""
    path = new_folder(spark, "silver")
    weekly = sane_silver(spark, sf_dir).selectExpr("* EXCEPT (close_time)", "open_time + INTERVAL 7 DAY AS close_time")
    write_partitions(weekly, path, SILVER_TABLE)
    spec = {
        "measures": ["count", "high"],
        "dimensions": ["coin_id"],
        "timeDimensions": [{"dimension": "close_time", "dateRange": "last 7 days"}],
    }
    return metric_query(read_table(spark, path, SILVER_TABLE), CANDLES, spec, EVENTS_AS_OF)


@query(
    "metric_query_candles",
    ctes(*_DEDUPED)
    + f"""SELECT coin_id, "interval", date_trunc('hour', open_time) AS open_time, max(open) AS open, max(high) AS high,
      min(low) AS low, max(close) AS close FROM silver
    WHERE {_LAST_WEEK.format(t='open_time')} GROUP BY 1, 2, 3""",
)
def metric_query_candles(spark, sf_dir):
    spec = {
        "measures": ["open", "high", "low", "close"],
        "dimensions": ["coin_id", "interval"],
        "timeDimensions": [{"dimension": "open_time", "granularity": "hour", "dateRange": "last 7 days"}],
    }
    return metric_query(sane_silver(spark, sf_dir), CANDLES, spec, EVENTS_AS_OF)


@query(
    "metric_query_closed",
    ctes(*_DEDUPED)
    + """SELECT "interval", is_closed, date_trunc('day', open_time) AS open_time, count(*) AS count,
      CAST(sum(trade_count) AS BIGINT) AS trade_count, CAST(sum(quote_volume) AS DECIMAL(38,9)) AS quote_volume
    FROM silver WHERE is_closed GROUP BY 1, 2, 3""",
)
def metric_query_closed(spark, sf_dir):
    spec = {
        "measures": ["count", "trade_count", "quote_volume"],
        "dimensions": ["interval", "is_closed"],
        "filters": [{"member": "candles.is_closed", "operator": "equals", "values": ["true"]}],
        "timeDimensions": [{"dimension": "open_time", "granularity": "day"}],
    }
    return metric_query(sane_silver(spark, sf_dir), CANDLES, spec, EVENTS_AS_OF)


@query(
    "metric_query_average",
    ctes(*_DEDUPED, gold_sql("gold", "silver", "hour"))
    + """SELECT coin_id, date_trunc('day', "hour") AS "hour", CAST(sum(open) AS DOUBLE) / count(open) AS open,
      CAST(sum(close) AS DOUBLE) / count(close) AS close, count(*) AS count FROM gold GROUP BY 1, 2""",
)
def metric_query_average(spark, sf_dir):
    spec = {
        "measures": ["open", "close", "count"],
        "dimensions": ["coin_id"],
        "timeDimensions": [{"dimension": "hourly_candle_metrics.hour", "granularity": "day"}],
    }
    return metric_query(hourly_gold(spark, sf_dir), HOURLY, spec, EVENTS_AS_OF)


@query(
    "metric_query_daily",
    ctes(*_DEDUPED, gold_sql("gold", "silver", "day"))
    + """SELECT coin_id, CAST(sum(candle_count) AS BIGINT) AS candle_count, min(low) AS low, max(high) AS high
    FROM gold WHERE "day" >= TIMESTAMP '2024-01-05' AND "day" < TIMESTAMP '2024-01-21' GROUP BY 1""",
)
def metric_query_daily(spark, sf_dir):
    name = "daily_metrics_by_coin"
    spec = {
        "measures": ["candle_count", "low", "high"],
        "dimensions": ["coin_id"],
        "timeDimensions": [{"dimension": "day", "dateRange": ["2024-01-05", "2024-01-20"]}],
    }
    gold = daily_gold(spark, sf_dir)
    return metric_query(gold, DAILY, spec, EVENTS_AS_OF, {name: covered_now(gold, DAILY, name, EVENTS_AS_OF)})


_ROLLUP = """SELECT coin_id, "interval", is_closed, date_trunc('hour', open_time) AS open_time, count(*) AS count,
  max(open) AS open, max(high) AS high, min(low) AS low, max(close) AS close,
  CAST(sum(volume) AS DECIMAL(38,9)) AS volume, CAST(sum(quote_volume) AS DECIMAL(38,9)) AS quote_volume,
  CAST(sum(trade_count) AS BIGINT) AS trade_count, CAST(date_trunc('month', open_time) AS DATE) AS part
  FROM silver WHERE open_time <= TIMESTAMP '2024-01-30 20:30:00' GROUP BY 1, 2, 3, 4, 13"""


@query("rollup_build", ctes(*_DEDUPED) + _ROLLUP)
def rollup_build(spark, sf_dir):
    return build_rollup(sane_silver(spark, sf_dir), CANDLES, "candles_by_coin_and_hour", EVENTS_AS_OF)


_HOURLY_ROLLUP = """SELECT coin_id, "interval", "hour", count(*) AS count, max(high) AS high, min(low) AS low,
  CAST(sum(volume) AS DECIMAL(38,9)) AS volume, CAST(sum(quote_volume) AS DECIMAL(38,9)) AS quote_volume,
  CAST(sum(trade_count) AS BIGINT) AS trade_count, CAST(date_trunc('month', "hour") AS DATE) AS part
  FROM gold GROUP BY 1, 2, 3, 10"""


@query("rollup_refresh", ctes(*_DEDUPED, gold_sql("gold", "silver", "hour")) + _HOURLY_ROLLUP)
def rollup_refresh(spark, sf_dir):
    """A rollup built early and refreshed later: only months with newer rows are rebuilt."""
    name, path = "hourly_metrics_by_coin", new_folder(spark, "rollup")
    gold, early = hourly_gold(spark, sf_dir), datetime(2024, 1, 16)
    write_rollup(gold.filter("hour < timestamp'2024-01-16'"), HOURLY, name, path, early)
    write_rollup(gold, HOURLY, name, path, EVENTS_AS_OF, changed_since=early)
    return read_rollup(gold, HOURLY, name, path).rows
