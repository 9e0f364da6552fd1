"""Candle events: a JSON payload with broker metadata around it.

One event stream feeds several tables. Each is its own streaming query with its own
checkpoint, so one that falls behind does not hold up the others, and a query started on a
new checkpoint replays whatever the source still holds.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wickwork import layout, schemas as S
from wickwork.functions.values import money, present
from wickwork.layout import Layout
from wickwork.operators.rollup import LOOKBACK, silver
from wickwork.plans.follow import follow_silver
from wickwork.sinks.tables import append, create_table, upsert_table
from wickwork.versions import Delta, append_versions

_TEXT_FIELDS = ("coin_id", "interval")
_TIME_FIELDS = ("open_time", "close_time")
_AMOUNT_FIELDS = ("open", "high", "low", "close", "volume", "quote_volume")
_OTHER_FIELDS = ("trade_count", "is_closed")
# Fixed value: times are RFC 3339 text.
_RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def candle_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages landed as JSON lines of ``value, publish_time, message_id, attributes``."""
    reader = spark.readStream.schema(S.MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def broker_messages(records: DataFrame) -> DataFrame:
    """Records of Spark's Kafka source in the same shape; the publish time is the broker's."""
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("publish_time"),
        F.concat_ws("-", "partition", "offset").alias("message_id"),
        F.lit(None).cast("string").alias("attributes"),
    )


def broker_stream(spark: SparkSession, **options: str) -> DataFrame:
    """Messages straight from Kafka; needs Spark's Kafka connector on the class path."""
    return broker_messages(spark.readStream.format("kafka").options(**options).load())


def _rfc3339(text: Column) -> Column:
    return F.when(text.rlike(_RFC3339), text.try_cast("timestamp"))


def parse_events(messages: DataFrame, subscription: str) -> DataFrame:
    """Messages as bronze rows plus the raw ``value`` and a ``reason`` that is null for good ones.

    Fields the schema does not name are dropped. The publish time comes from the broker
    alone; a payload field of that name is ignored like any other unknown field.
    """
    parsed = F.from_json("value", S.EVENT, {"columnNameOfCorruptRecord": "malformed"})
    raw = lambda name: F.col("e")[name]
    typed = F.struct(
        *[_rfc3339(raw(c)).alias(c) for c in _TIME_FIELDS], *[money(raw(c)).alias(c) for c in _AMOUNT_FIELDS]
    )
    # Exploding one-element arrays parses each message and each field once. As plain columns
    # they would be copied into every check when a filter on ``reason`` is pushed below them.
    rows = messages.select("*", F.explode(F.array(parsed)).alias("e"))
    rows = rows.select("*", F.explode(F.array(typed)).alias("x"))
    return rows.select(
        *[raw(c).alias(c) for c in _TEXT_FIELDS],
        *[F.col("x")[c].alias(c) for c in (*_TIME_FIELDS, *_AMOUNT_FIELDS)],
        *[raw(c).alias(c) for c in _OTHER_FIELDS],
        "publish_time",
        F.lit(subscription).alias("subscription_name"),
        "message_id",
        "attributes",
        "value",
        _reason().alias("reason"),
    )


def _reason() -> Column:
    """Why a message cannot be stored: the first check it fails, or null."""
    raw, typed = (lambda c: F.col("e")[c]), (lambda c: F.col("x")[c])
    reason = F.when(F.col("e").isNull() | raw("malformed").isNotNull(), F.lit("malformed JSON"))
    for name in _TEXT_FIELDS:
        reason = reason.when(~present(raw(name)), F.lit(f"missing required field: {name}"))
    for name in (*_TIME_FIELDS, *_AMOUNT_FIELDS, *_OTHER_FIELDS):
        reason = reason.when(raw(name).isNull(), F.lit(f"missing required field: {name}"))
    for name in _TIME_FIELDS:
        reason = reason.when(typed(name).isNull(), F.lit(f"not an RFC 3339 time: {name}"))
    for name in _AMOUNT_FIELDS:
        reason = reason.when(typed(name).isNull(), F.lit(f"not an amount: {name}"))
    return reason


def split_invalid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Storable bronze rows, and dead letters: the raw message, its metadata and the reason."""
    valid = events.filter(F.col("reason").isNull()).select(*S.BRONZE.names)
    dead = events.filter(F.col("reason").isNotNull()).select(
        "value", "reason", "publish_time", "subscription_name", "message_id", "attributes"
    )
    return valid, dead


def _start(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], available_now: bool):
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_bronze(valid: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append good events to bronze, next to what batch loads append there.

    Delivery is at least once: a batch retried after a failure may add versions again,
    which silver reduces.
    """
    create_table(valid.sparkSession, path, layout.BRONZE)
    return _start(valid, checkpoint, lambda batch, _: append(batch, path, layout.BRONZE), available_now)


def start_dead_letters(dead: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append dead letters as parquet files, exactly once."""
    writer = dead.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def merge_into_silver(batch: DataFrame, path: str) -> Delta | None:
    """Append new bronze versions to the silver table, which is merged when it is read; None if there are none."""
    return append_versions(silver(batch), path, layout.SILVER)


def start_silver(valid: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep silver current: each batch writes its own versions and nothing else.

    Nothing is held as stream state and nothing is too late: order, repeats and delay of
    events do not change the result. ``versions.compact`` folds the versions in, as a job of its own.
    """
    create_table(valid.sparkSession, path, layout.SILVER)
    return _start(valid, checkpoint, lambda batch, _: merge_into_silver(batch, path), available_now)


def start_ohlcv(
    valid: DataFrame,
    silver_path: str,
    gold_path: str,
    unit: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep silver and one gold table current; only the buckets that a batch has candles of are rolled up again."""
    spark = valid.sparkSession
    gold = layout.GOLD[unit]
    create_table(spark, silver_path, layout.SILVER)
    create_table(spark, gold_path, gold)

    def handle(batch: DataFrame, _: int) -> None:
        merge_into_silver(batch, silver_path)
        follow_silver(spark, silver_path, gold_path, unit)

    return _start(valid, checkpoint, handle, available_now)


def windowed_ohlcv(candles: DataFrame, unit: str, watermark: timedelta | None = None) -> DataFrame:
    """Hour or day bars of a stream that holds each candle once, as stream state.

    State is kept for the lookback the batch rebuild has (6 hours, 3 days) and then let go;
    candles later than that need the batch rebuild, which remains the full path.
    """
    keep = LOOKBACK[unit] if watermark is None else watermark
    bars = (
        candles.withWatermark("open_time", f"{int(keep.total_seconds())} seconds")
        .groupBy("coin_id", "interval", F.window("open_time", f"1 {unit}").alias("w"))
        .agg(
            F.min_by("open", "open_time").alias("open"),
            F.max_by("close", "open_time").alias("close"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.sum("volume").alias("volume"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trade_count").alias("trade_count"),
            F.count("*").alias("candle_count"),
            F.max("publish_time").alias("latest_publish_time"),
        )
    )
    return bars.select("coin_id", "interval", F.col("w.start").alias(unit), *bars.columns[3:])


def start_upserts(bars: DataFrame, path: str, table: Layout, checkpoint: str, available_now: bool = True):
    """Write changed stream rows (update mode) into a keyed table; a repeated batch changes nothing."""
    create_table(bars.sparkSession, path, table)
    writer = bars.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda batch, _: upsert_table(path, batch, table))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
