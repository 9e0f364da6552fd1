"""Candle queries: dedupe, rollups, watermarks, and the incremental tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wickwork import layout, versions
from wickwork.catalog import shapes
from wickwork.catalog.base import ctes, query
from wickwork.catalog.shapes import BRONZE, EVENTS_AS_OF, FINE, SANE, SILVER, gold_sql
from wickwork.layout import read_table
from wickwork.operators import incremental, rollup
from wickwork.operators.quality import reject_counts, sane
from wickwork.plans import jobs
from wickwork.session import new_folder
from wickwork.sinks.tables import append, create_table, delete_from_table

_DEDUPED = (BRONZE, SILVER)
# The time bronze is split at where a query loads it in two parts.
_MID = datetime(2024, 1, 16)


def sane_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = sane(shapes.bronze(spark, sf_dir))
    return rollup.silver(kept)


@query("silver_dedupe", ctes(*_DEDUPED) + "SELECT * FROM silver")
def silver_dedupe(spark, sf_dir):
    return sane_silver(spark, sf_dir)


@query("ohlcv_daily", ctes(*_DEDUPED, gold_sql("gold", "silver", "day")) + "SELECT * FROM gold")
def ohlcv_daily(spark, sf_dir):
    return rollup.ohlcv(sane_silver(spark, sf_dir), "day")


@query("ohlcv_hourly", ctes(*_DEDUPED, gold_sql("gold", "silver", "hour")) + "SELECT * FROM gold")
def ohlcv_hourly(spark, sf_dir):
    return rollup.ohlcv(sane_silver(spark, sf_dir), "hour")


_TWO = BRONZE.replace("'1h' AS", "CASE WHEN event_id % 2 = 0 THEN '1h' ELSE '4h' END AS")


def _two_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of two intervals that open at the same times."""
    even = F.col("trade_count") % 2 == 0
    rows = sane(shapes.bronze(spark, sf_dir))[0].withColumn("interval", F.when(even, "1h").otherwise("4h"))
    return rollup.silver(rows)


@query("silver_two_intervals", ctes(_TWO, SILVER) + "SELECT * FROM silver")
def silver_two_intervals(spark, sf_dir):
    return _two_intervals(spark, sf_dir)


@query("ohlcv_two_intervals", ctes(_TWO, SILVER, gold_sql("gold", "silver", "day")) + "SELECT * FROM gold")
def ohlcv_two_intervals(spark, sf_dir):
    return rollup.ohlcv(_two_intervals(spark, sf_dir), "day")


@query(
    "ohlcv_fine_hourly",
    ctes(FINE, gold_sql("gold", "fine", "hour", latest="publish_time")) + "SELECT * FROM gold",
)
def ohlcv_fine_hourly(spark, sf_dir):
    return rollup.ohlcv(shapes.fine(spark, sf_dir), "hour")


@query(
    "ohlcv_fine_daily",
    ctes(FINE, gold_sql("gold", "fine", "day", latest="publish_time")) + "SELECT * FROM gold",
)
def ohlcv_fine_daily(spark, sf_dir):
    return rollup.ohlcv(shapes.fine(spark, sf_dir), "day")


@query(
    "ohlcv_incremental",
    ctes(
        FINE,
        gold_sql("gold", "fine", "hour", "open_time >= TIMESTAMP '2024-01-30 14:00:00'", "publish_time"),
    )
    + "SELECT * FROM gold",
)
def ohlcv_incremental(spark, sf_dir):
    return rollup.ohlcv(shapes.fine(spark, sf_dir), "hour", as_of=EVENTS_AS_OF)


@query(
    "ohlcv_incremental_daily",
    ctes(FINE, gold_sql("gold", "fine", "day", "open_time >= TIMESTAMP '2024-01-27'", "publish_time"))
    + "SELECT * FROM gold",
)
def ohlcv_incremental_daily(spark, sf_dir):
    return rollup.ohlcv(shapes.fine(spark, sf_dir), "day", as_of=EVENTS_AS_OF)


@query("sane_filter", ctes(BRONZE) + f"SELECT * EXCLUDE (event_id) FROM bronze WHERE {SANE}")
def sane_filter(spark, sf_dir):
    return sane(shapes.bronze(spark, sf_dir))[0]


@query(
    "sane_rejected",
    ctes(BRONZE) + f"SELECT * EXCLUDE (event_id) FROM bronze WHERE NOT ({SANE})",
)
def sane_rejected(spark, sf_dir):
    return sane(shapes.bronze(spark, sf_dir))[1]


@query(
    "reject_counts",
    ctes(BRONZE)
    + f"""SELECT coin_id, count(*) AS fetched, count(*) FILTER (WHERE {SANE}) AS kept,
      count(*) FILTER (WHERE NOT ({SANE})) AS skipped FROM bronze GROUP BY 1""",
)
def reject_counts_by_coin(spark, sf_dir):
    return reject_counts(shapes.bronze(spark, sf_dir), ["coin_id"])


_REBUCKET = """SELECT coin_id, "interval", date_trunc('day', "hour") AS day, arg_min(open, "hour") AS open,
  arg_max(close, "hour") AS close, max(high) AS high, min(low) AS low,
  CAST(sum(volume) AS DECIMAL(38,9)) AS volume, CAST(sum(quote_volume) AS DECIMAL(38,9)) AS quote_volume,
  CAST(sum(trade_count) AS BIGINT) AS trade_count, CAST(sum(candle_count) AS BIGINT) AS candle_count,
  max(latest_publish_time) AS latest_publish_time FROM gold GROUP BY 1, 2, 3"""


@query("rebucket_daily", ctes(FINE, gold_sql("gold", "fine", "hour", latest="publish_time")) + _REBUCKET)
def rebucket_daily(spark, sf_dir):
    return rollup.rebucket(rollup.ohlcv(shapes.fine(spark, sf_dir), "hour"), "hour", "day")


@query(
    "partial_days",
    ctes(*_DEDUPED, gold_sql("gold", "silver", "day")) + "SELECT * FROM gold WHERE candle_count < 24",
)
def partial_days(spark, sf_dir):
    return rollup.partial_days(ohlcv_daily(spark, sf_dir))


@query(
    "latest_closed",
    ctes(*_DEDUPED)
    + """SELECT coin_id, arg_max(close, close_time) AS price_usd, max(close_time) AS updated_at
    FROM silver WHERE close_time < TIMESTAMP '2024-01-30 20:30:00' GROUP BY 1""",
)
def latest_closed(spark, sf_dir):
    return incremental.latest_closed(sane_silver(spark, sf_dir), EVENTS_AS_OF)


@query(
    "new_watermark",
    ctes(BRONZE)
    + f"""SELECT coin_id, "interval", max(close_time) AS last_loaded_close_time
    FROM bronze WHERE {SANE} GROUP BY 1, 2""",
)
def new_watermark(spark, sf_dir):
    return incremental.new_watermarks(sane(shapes.bronze(spark, sf_dir))[0])


# Watermarks of the customers' coins: the date of their last order, none without orders.
_MARKS = """
marks AS (
  SELECT CAST(o_custkey AS VARCHAR) AS coin_id, max(o_orderdate) AS last_loaded_close_time
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)"""


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shapes.table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    return orders.groupBy(F.col("o_custkey").cast("string").alias("coin_id")).agg(
        F.lit("1h").alias("interval"), F.max(F.col("o_orderdate").cast("timestamp")).alias("last_loaded_close_time")
    )


@query(
    "fetch_start",
    ctes(_MARKS)
    + """SELECT CAST(c_custkey AS VARCHAR) AS coin_id, last_loaded_close_time,
      coalesce(last_loaded_close_time - INTERVAL 2 HOUR, TIMESTAMP '2001-07-31') AS fetch_from
    FROM customer LEFT JOIN marks ON coin_id = CAST(c_custkey AS VARCHAR)""",
)
def fetch_start(spark, sf_dir):
    coins = shapes.coins(spark, sf_dir).select("coin_id")
    return incremental.fetch_start(coins, _marks(spark, sf_dir), shapes.ORDERS_AS_OF)


@query(
    "overlap_reread",
    ctes(
        BRONZE,
        """marks AS (SELECT coin_id, max(close_time) AS m FROM bronze
      WHERE publish_time < TIMESTAMP '2024-01-16' GROUP BY 1)""",
    )
    + """SELECT b.* EXCLUDE (event_id) FROM bronze b JOIN marks USING (coin_id)
    WHERE open_time >= m - INTERVAL 2 HOUR""",
)
def overlap_reread(spark, sf_dir):
    bronze = shapes.bronze(spark, sf_dir)
    marks = incremental.new_watermarks(bronze.filter(F.col("publish_time") < F.lit(str(_MID)).cast("timestamp")))
    starts = incremental.fetch_start(bronze.select("coin_id").distinct(), marks, EVENTS_AS_OF)
    return incremental.from_start(bronze, starts)


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[jobs.Tables, datetime]:
    """Tables after two loads of the sane bronze rows: before the split time, and after it."""
    tables = jobs.Tables(new_folder(spark, "two-loads"))
    for name in ("bronze_candles", "silver_candles", "hourly_candle_metrics", "daily_candle_metrics"):
        create_table(spark, tables.path(name), tables.layouts[name])
    kept, _ = sane(shapes.bronze(spark, sf_dir))
    mid = F.lit(str(_MID)).cast("timestamp")
    append(kept.filter(F.col("publish_time") < mid), tables.path("bronze_candles"), layout.BRONZE)
    jobs.rebuild_silver(spark, tables)
    jobs.rebuild_gold(spark, tables, "hour")
    jobs.rebuild_gold(spark, tables, "day")
    append(kept.filter(F.col("publish_time") >= mid), tables.path("bronze_candles"), layout.BRONZE)
    jobs.refresh_silver(spark, tables, since=_MID - timedelta(days=1), published_after=_MID - timedelta(microseconds=1))
    return tables, _MID


@query("silver_incremental", ctes(*_DEDUPED) + "SELECT * FROM silver")
def silver_incremental(spark, sf_dir):
    tables, _ = _two_loads(spark, sf_dir)
    return read_table(spark, tables.path("silver_candles"), layout.SILVER).drop("date")


@query("gold_incremental", ctes(*_DEDUPED, gold_sql("gold", "silver", "hour")) + "SELECT * FROM gold")
def gold_incremental(spark, sf_dir):
    tables, since = _two_loads(spark, sf_dir)
    as_of = datetime(2024, 1, 31)
    jobs.rebuild_gold(spark, tables, "hour", as_of=as_of, lookback=as_of - since)
    return read_table(spark, tables.path("hourly_candle_metrics"), layout.GOLD_HOURLY).drop("date")


@query(
    "rebuild_after_delete",
    ctes(BRONZE, SILVER, "short AS (SELECT * FROM silver WHERE open_time < TIMESTAMP '2024-01-20')", gold_sql("gold", "short", "day"))
    + "SELECT * FROM gold",
)
def rebuild_after_delete(spark, sf_dir):
    """Days deleted from bronze are gone from silver and gold after a full rebuild."""
    tables, _ = _two_loads(spark, sf_dir)
    delete_from_table(spark, tables.path("bronze_candles"), layout.BRONZE, F.col("open_time") >= F.lit("2024-01-20").cast("timestamp"))
    jobs.rebuild_silver(spark, tables)
    jobs.rebuild_gold(spark, tables, "day")
    return read_table(spark, tables.path("daily_candle_metrics"), layout.GOLD_DAILY).drop("date")


_DELETED = "coin_id = 'click' AND open_time >= TIMESTAMP '2024-01-10' OR open_time >= TIMESTAMP '2024-01-20'"
_LEFT = f"kept AS (SELECT * FROM silver WHERE NOT ({_DELETED}))"


def _deleted(spark: SparkSession, sf_dir: str) -> jobs.Tables:
    """Tables after a load, a deletion in bronze and silver, and what follows from them in gold and serving."""
    tables = jobs.Tables(new_folder(spark, "deleted"))
    tables.create(spark)
    append(sane(shapes.bronze(spark, sf_dir))[0], tables.path("bronze_candles"), layout.BRONZE)
    jobs.refresh_silver(spark, tables, since=datetime(2023, 12, 1))
    jobs.propagate(spark, tables, "hour", EVENTS_AS_OF)
    jobs.delete_candles(spark, tables, F.expr(_DELETED), EVENTS_AS_OF)
    jobs.propagate(spark, tables, "hour", EVENTS_AS_OF)
    return tables


@query("delete_propagates", ctes(*_DEDUPED, _LEFT, gold_sql("gold", "kept", "hour")) + "SELECT * FROM gold")
def delete_propagates(spark, sf_dir):
    """Candles deleted once are gone from gold without a rebuild."""
    return _deleted(spark, sf_dir).read(spark, "hourly_candle_metrics").drop("date")


@query(
    "delete_reaches_serving",
    ctes(*_DEDUPED, _LEFT, gold_sql("gold", "kept", "hour"))
    + """SELECT coin_id, "hour" AS bucket_start, CAST(open AS DECIMAL(24,10)) AS open, CAST(high AS DECIMAL(24,10)) AS high,
      CAST(low AS DECIMAL(24,10)) AS low, CAST(close AS DECIMAL(24,10)) AS close, CAST(volume AS DECIMAL(28,10)) AS volume,
      "hour" + INTERVAL 1 HOUR <= TIMESTAMP '2024-01-30 20:30:00' AS is_closed, TIMESTAMP '2024-01-30 20:30:00' AS updated_at
    FROM gold""",
)
def delete_reaches_serving(spark, sf_dir):
    return _deleted(spark, sf_dir).read(spark, "candle_rollups_hourly").drop("date")


@query("silver_compacted", ctes(*_DEDUPED) + "SELECT * FROM silver")
def silver_compacted(spark, sf_dir):
    """Three appended batches with repeats, folded into the table's own files."""
    path = new_folder(spark, "appended")
    create_table(spark, path, layout.SILVER)
    kept = sane(shapes.bronze(spark, sf_dir))[0]
    for part in (1, 2, 0, 2):
        batch = kept.where(F.pmod("trade_count", F.lit(3)) == part)
        versions.append_versions(rollup.silver(batch), path, layout.SILVER)
    versions.compact(spark, path, layout.SILVER)
    return versions.read_base(spark, path, layout.SILVER).drop("date")


@query(
    "silver_null_publish_time",
    ctes(*_DEDUPED) + "SELECT * EXCLUDE (latest_publish_time), CAST(NULL AS TIMESTAMP) AS latest_publish_time FROM silver",
)
def silver_null_publish_time(spark, sf_dir):
    """Versions without a publish time are merged by a refresh that is bounded by publish time."""
    tables = jobs.Tables(new_folder(spark, "null-times"))
    for name in ("bronze_candles", "silver_candles"):
        create_table(spark, tables.path(name), tables.layouts[name])
    silver = sane_silver(spark, sf_dir).withColumnRenamed("latest_publish_time", "publish_time")
    silver = silver.withColumn("publish_time", F.lit(None).cast("timestamp"))
    append(silver, tables.path("bronze_candles"), layout.BRONZE)
    jobs.refresh_silver(spark, tables, since=datetime(2023, 12, 1), published_after=_MID)
    return read_table(spark, tables.path("silver_candles"), layout.SILVER).drop("date")
