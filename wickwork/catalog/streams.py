"""Streaming queries: run to the end of the input, then read what they wrote."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wickwork import layout
from wickwork.catalog import shapes
from wickwork.catalog.base import ctes, query
from wickwork.catalog.shapes import BRONZE, FINE, SILVER_COLUMNS, gold_sql
from wickwork.functions.times import iso_instant
from wickwork.layout import read_table
from wickwork.operators import alerts
from wickwork.session import new_folder
from wickwork.streaming import events as stream, watch

# Events in a landed file. A file is the work of one task, so a batch has as many files as its rows need.
_ROWS_PER_FILE = 100_000

# The number in an event's properties says whether its message is spoilt, and how.
_NUMBER = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _messages(spark: SparkSession, sf_dir: str, batches: int = 1) -> DataFrame:
    """The events table as a stream of candle messages; with more ``batches``, in as many, in no order of time.

    Payloads carry two fields the schema does not name. The number ``k`` in an event's
    properties spoils some: below 10 the coin is missing, below 20 a time is an epoch
    number, below 30 the text is cut short, below 40 a price is no number.
    """
    events = shapes.table(spark, sf_dir, "events")
    reader = spark.readStream.schema(events.schema)
    if batches == 1:
        source = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    else:
        folder = new_folder(spark, "events")
        files = max(1, math.ceil(events.count() / batches / _ROWS_PER_FILE))
        events.repartition(batches * files, "event_id").write.parquet(folder)
        source = reader.option("maxFilesPerTrigger", files).parquet(folder)
    k = F.col("k")
    columns = shapes._candle_columns(F.date_trunc("hour", F.col("ts")))
    number = F.get_json_object("props", "$.k").cast("bigint")
    b = source.select("event_id", number.alias("k"), *columns)
    text = lambda c: F.col(c).cast("decimal(38,2)").cast("string")
    payload = F.to_json(
        F.struct(
            F.when(k >= 10, F.col("coin_id")).alias("coin_id"),
            F.col("interval"),
            F.when((k >= 10) & (k < 20), F.unix_millis("open_time").cast("string"))
            .otherwise(iso_instant(F.col("open_time")))
            .alias("open_time"),
            iso_instant(F.col("close_time")).alias("close_time"),
            F.when((k >= 30) & (k < 40), "n/a").otherwise(text("open")).alias("open"),
            *[text(c).alias(c) for c in ("high", "low", "close", "volume", "quote_volume")],
            F.col("trade_count"),
            F.col("is_closed"),
            F.lit("binance_ws").alias("source"),
            F.lit(1).alias("added_later"),
        )
    )
    return b.select(
        F.when((k >= 20) & (k < 30), F.substring(payload, 1, 20)).otherwise(payload).alias("value"),
        "publish_time",
        F.col("event_id").cast("string").alias("message_id"),
        F.lit(None).cast("string").alias("attributes"),
    )


def _split(spark: SparkSession, sf_dir: str, batches: int = 1) -> tuple[DataFrame, DataFrame]:
    return stream.split_invalid(stream.parse_events(_messages(spark, sf_dir, batches), "bronze"))


def _finish(run) -> None:
    run.awaitTermination()


_GOOD = "k >= 40"
_BRONZE = BRONZE.replace("event_id\n", f"event_id, {_NUMBER} AS k\n")


@query(
    "stream_bronze",
    ctes(_BRONZE)
    + f"""SELECT {SILVER_COLUMNS}, publish_time, 'bronze' AS subscription_name, CAST(event_id AS VARCHAR) AS message_id,
      CAST(NULL AS VARCHAR) AS attributes FROM bronze WHERE {_GOOD}""",
)
def stream_bronze(spark, sf_dir):
    path = new_folder(spark, "stream-bronze")
    valid, _ = _split(spark, sf_dir)
    _finish(stream.start_bronze(valid, path, new_folder(spark, "checkpoint")))
    return read_table(spark, path, layout.BRONZE).drop("month")


@query(
    "stream_dead_letter",
    f"""SELECT CAST(event_id AS VARCHAR) AS message_id, ts AS publish_time, 'bronze' AS subscription_name,
      CASE WHEN k < 10 THEN 'missing required field: coin_id' WHEN k < 20 THEN 'not an RFC 3339 time: open_time'
        WHEN k < 30 THEN 'malformed JSON' ELSE 'not an amount: open' END AS reason
    FROM (SELECT *, {_NUMBER} AS k FROM events) WHERE NOT ({_GOOD})""",
)
def stream_dead_letter(spark, sf_dir):
    path = new_folder(spark, "stream-dead")
    _, dead = _split(spark, sf_dir)
    _finish(stream.start_dead_letters(dead, path, new_folder(spark, "checkpoint")))
    letters = spark.read.schema(dead.schema).parquet(path)
    return letters.select("message_id", "publish_time", "subscription_name", "reason")


@query(
    "stream_parked",
    f"""WITH failed AS (
      SELECT CAST(event_id % 97 AS VARCHAR) AS message_id, ts AS publish_time, CASE WHEN k < 10 THEN 'missing required field: coin_id'
        WHEN k < 20 THEN 'not an RFC 3339 time: open_time' WHEN k < 30 THEN 'malformed JSON' ELSE 'not an amount: open' END AS reason,
        row_number() OVER (PARTITION BY event_id % 97 ORDER BY ts) AS attempts
      FROM (SELECT *, {_NUMBER} AS k FROM events) WHERE NOT ({_GOOD}))
    SELECT message_id, publish_time, reason, CAST(attempts AS INTEGER) AS attempts FROM failed WHERE attempts = 5""",
)
def stream_parked(spark, sf_dir):
    """Events as repeated deliveries of 97 messages: the fifth failure of a message parks it, with its reason."""
    path = new_folder(spark, "stream-parked")
    _, failed = _split(spark, sf_dir)
    failed = failed.withColumn("message_id", (F.col("message_id").cast("bigint") % 97).cast("string"))
    parked = watch.park_failures(failed, forget=timedelta(days=3650))
    _finish(stream.start_dead_letters(parked, path, new_folder(spark, "checkpoint")))
    return spark.read.schema(parked.schema).parquet(path).select("message_id", "publish_time", "reason", "attempts")


@query(
    "stream_lag_alert",
    """WITH w AS (
      SELECT event_type AS subscription_id, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, max(CAST(user_id * 10 AS DOUBLE)) AS value
      FROM events GROUP BY 1, 2 HAVING max(CAST(user_id * 10 AS DOUBLE)) > 600),
    a AS (
      SELECT w.*, EXISTS (SELECT 1 FROM w b WHERE b.subscription_id = w.subscription_id AND b.window_start = w.window_start - INTERVAL 5 MINUTE) AS held
      FROM w),
    r AS (SELECT * FROM a WHERE held)
    SELECT r.*  EXCLUDE (held), CASE WHEN EXISTS (SELECT 1 FROM r b WHERE b.subscription_id = r.subscription_id
        AND b.window_start = r.window_start - INTERVAL 5 MINUTE) THEN 'open' ELSE 'opened' END AS event
    FROM r WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
)
def stream_lag_alert(spark, sf_dir):
    """The lag rule over a stream of samples, one an event; what the watermark has passed."""
    schema = shapes.table(spark, sf_dir, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    samples = source.select(
        F.col("event_type").alias("subscription_id"),
        F.lit(alerts.LAG_RULE["metric"]).alias("metric"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("user_id") * 10).cast("double").alias("value"),
    )
    path, found = new_folder(spark, "stream-alerts"), watch.watch(samples, **alerts.LAG_RULE)
    _finish(stream.start_dead_letters(found, path, new_folder(spark, "checkpoint")))
    return spark.read.schema(found.schema).parquet(path).where("event <> 'closed'")


_STREAM_SILVER = f"""
silver AS (
  SELECT {SILVER_COLUMNS}, publish_time AS latest_publish_time
  FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, "interval", open_time ORDER BY publish_time DESC) AS rn
        FROM bronze WHERE {_GOOD})
  WHERE rn = 1)"""


@query("stream_silver", ctes(_BRONZE, _STREAM_SILVER) + "SELECT * FROM silver")
def stream_silver(spark, sf_dir):
    path = new_folder(spark, "stream-silver")
    valid, _ = _split(spark, sf_dir)
    _finish(stream.start_silver(valid, path, new_folder(spark, "checkpoint")))
    return read_table(spark, path, layout.SILVER).drop("date")


@query("stream_ohlcv", ctes(_BRONZE, _STREAM_SILVER, gold_sql("gold", "silver", "hour")) + "SELECT * FROM gold")
def stream_ohlcv(spark, sf_dir):
    silver, gold = new_folder(spark, "stream-silver"), new_folder(spark, "stream-gold")
    valid, _ = _split(spark, sf_dir)
    _finish(stream.start_ohlcv(valid, silver, gold, "hour", new_folder(spark, "checkpoint")))
    return read_table(spark, gold, layout.GOLD_HOURLY).drop("date")


@query("stream_silver_batches", ctes(_BRONZE, _STREAM_SILVER) + "SELECT * FROM silver")
def stream_silver_batches(spark, sf_dir):
    """Silver after several batches that reach into the same days, one of them replayed from a new checkpoint."""
    path = new_folder(spark, "stream-silver")
    valid, _ = _split(spark, sf_dir, 3)
    for checkpoint in ("first", "second"):
        _finish(stream.start_silver(valid, path, new_folder(spark, checkpoint)))
    return read_table(spark, path, layout.SILVER).drop("date")


@query("stream_ohlcv_batches", ctes(_BRONZE, _STREAM_SILVER, gold_sql("gold", "silver", "day")) + "SELECT * FROM gold")
def stream_ohlcv_batches(spark, sf_dir):
    """Day bars after several batches, of which each rolls up only the buckets it has candles of."""
    silver, gold = new_folder(spark, "stream-silver"), new_folder(spark, "stream-gold")
    valid, _ = _split(spark, sf_dir, 3)
    _finish(stream.start_ohlcv(valid, silver, gold, "day", new_folder(spark, "checkpoint")))
    return read_table(spark, gold, layout.GOLD_DAILY).drop("date")


@query(
    "stream_windows",
    ctes(FINE, gold_sql("gold", "fine", "hour", latest="publish_time")) + "SELECT * FROM gold",
)
def stream_windows(spark, sf_dir):
    """Hour bars kept as stream state over candles that come once each."""
    schema = shapes.table(spark, sf_dir, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    candles = source.select(*shapes._candle_columns(F.col("ts").cast("timestamp")))
    path = new_folder(spark, "stream-windows")
    bars = stream.windowed_ohlcv(candles, "hour")
    _finish(stream.start_upserts(bars, path, layout.GOLD_HOURLY, new_folder(spark, "checkpoint")))
    return read_table(spark, path, layout.GOLD_HOURLY).drop("date")


@query(
    "stream_fan_out",
    ctes(_BRONZE)
    + f"""SELECT 'bronze' AS sink, count(*) AS rows FROM bronze WHERE {_GOOD}
    UNION ALL SELECT 'dead letters', count(*) FROM bronze WHERE NOT ({_GOOD})
    UNION ALL SELECT 'silver', count(DISTINCT (coin_id, open_time)) FROM bronze WHERE {_GOOD}""",
)
def stream_fan_out(spark, sf_dir):
    """One stream into three sinks, each with its own checkpoint."""
    valid, dead = _split(spark, sf_dir)
    bronze, letters, silver = (new_folder(spark, f"fan-{n}") for n in ("bronze", "dead", "silver"))
    runs = [
        stream.start_bronze(valid, bronze, new_folder(spark, "checkpoint")),
        stream.start_dead_letters(dead, letters, new_folder(spark, "checkpoint")),
        stream.start_silver(valid, silver, new_folder(spark, "checkpoint")),
    ]
    for run in runs:
        _finish(run)
    count = lambda df, name: df.agg(F.lit(name).alias("sink"), F.count("*").alias("rows"))
    return (
        count(read_table(spark, bronze, layout.BRONZE), "bronze")
        .unionByName(count(spark.read.schema(dead.schema).parquet(letters), "dead letters"))
        .unionByName(count(read_table(spark, silver, layout.SILVER), "silver"))
    )
