"""The driver tables in candle shapes, in Spark and as SQL.

Each function has a SQL twin of the same columns: a CTE that the oracle queries start from.
Amounts go through decimal(18,2) first; the driver's doubles hold two decimals, and that
step is exact.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wickwork.schemas import MONEY

# Just after the last event, and the last order date: "now" for queries that need one.
EVENTS_AS_OF = datetime(2024, 1, 30, 20, 30)
ORDERS_AS_OF = datetime(2001, 8, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def amount(column: str | Column, dtype=MONEY) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("decimal(18,2)").cast(dtype)


def _candle_columns(open_time: Column) -> list[Column]:
    price = F.col("value").cast("decimal(18,2)")
    whole = lambda c: c.cast("decimal(18,2)")
    hour = F.expr("INTERVAL 1 HOUR")
    milli = F.expr("INTERVAL '0.001' SECOND")
    return [
        F.col("event_type").alias("coin_id"),
        F.lit("1h").alias("interval"),
        open_time.alias("open_time"),
        (F.date_trunc("hour", open_time) + hour - milli).alias("close_time"),
        price.cast(MONEY).alias("open"),
        (price + whole(F.col("event_id") % 7)).cast(MONEY).alias("high"),
        (price - whole(F.col("event_id") % 5)).cast(MONEY).alias("low"),
        price.cast(MONEY).alias("close"),
        F.col("user_id").cast(MONEY).alias("volume"),
        (F.col("event_id") % 1000).cast(MONEY).alias("quote_volume"),
        (F.col("event_id") % 100).alias("trade_count"),
        F.lit(True).alias("is_closed"),
        F.col("ts").cast("timestamp").alias("publish_time"),
    ]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles in several versions: one coin per event type, one version per event."""
    events = table(spark, sf_dir, "events")
    return events.select(*_candle_columns(F.date_trunc("hour", F.col("ts"))))


def fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles that open at the event's own time: many per hour, each once."""
    rows = table(spark, sf_dir, "events").select(*_candle_columns(F.col("ts").cast("timestamp")))
    return rows.withColumn("latest_publish_time", F.col("publish_time"))


def _candle_sql(name: str, open_time: str) -> str:
    return f"""
{name} AS (
  SELECT event_type AS coin_id, '1h' AS "interval", {open_time} AS open_time,
    date_trunc('hour', ts) + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS close_time,
    CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS open,
    CAST(CAST(value AS DECIMAL(18,2)) + CAST(event_id % 7 AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS high,
    CAST(CAST(value AS DECIMAL(18,2)) - CAST(event_id % 5 AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS low,
    CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS close,
    CAST(user_id AS DECIMAL(38,9)) AS volume,
    CAST(event_id % 1000 AS DECIMAL(38,9)) AS quote_volume,
    event_id % 100 AS trade_count, TRUE AS is_closed, ts AS publish_time, event_id
  FROM events)"""


BRONZE = _candle_sql("bronze", "date_trunc('hour', ts)")
FINE = _candle_sql("fine", "ts")
SANE = 'open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low AND volume >= 0'
SILVER_COLUMNS = (
    'coin_id, "interval", open_time, close_time, open, high, low, close, volume, quote_volume, trade_count, is_closed'
)
# Silver of the sane bronze rows.
SILVER = f"""
silver AS (
  SELECT {SILVER_COLUMNS}, publish_time AS latest_publish_time
  FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, "interval", open_time ORDER BY publish_time DESC) AS rn
        FROM bronze WHERE {SANE})
  WHERE rn = 1)"""


def gold_sql(name: str, source: str, unit: str, where: str = "TRUE", latest: str = "latest_publish_time") -> str:
    return f"""
{name} AS (
  SELECT coin_id, "interval", date_trunc('{unit}', open_time) AS "{unit}",
    arg_min(open, open_time) AS open, arg_max(close, open_time) AS close,
    max(high) AS high, min(low) AS low,
    CAST(sum(volume) AS DECIMAL(38,9)) AS volume, CAST(sum(quote_volume) AS DECIMAL(38,9)) AS quote_volume,
    CAST(sum(trade_count) AS BIGINT) AS trade_count, count(*) AS candle_count,
    max({latest}) AS latest_publish_time
  FROM {source} WHERE {where}
  GROUP BY 1, 2, 3)"""


def coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One coin per customer, symbols in lower case, account balance as market cap."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("coin_id"),
        F.lower("c_name").alias("symbol"),
        F.col("c_name").alias("name"),
        amount("c_acctbal", "decimal(24,2)").alias("market_cap_usd"),
        F.col("c_mktsegment").alias("segment"),
    )


COINS = """
coins AS (
  SELECT CAST(c_custkey AS VARCHAR) AS coin_id, lower(c_name) AS symbol, c_name AS name,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(24,2)) AS market_cap_usd, c_mktsegment AS segment
  FROM customer)"""


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exchange's pair list: customers of two segments trade, one of them against the dollar quote."""
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("base_asset"),
        F.when(segment == "AUTOMOBILE", "EUR").otherwise("USDT").alias("quote_asset"),
        F.when(segment.isin("BUILDING", "AUTOMOBILE", "MACHINERY"), "TRADING").otherwise("BREAK").alias("status"),
        F.concat("c_name", F.lit("USDT")).alias("symbol"),
        F.col("c_custkey").cast("int").alias("pos"),
    )


SYMBOLS = """
symbols AS (
  SELECT c_name AS base_asset, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'EUR' ELSE 'USDT' END AS quote_asset,
    CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY') THEN 'TRADING' ELSE 'BREAK' END AS status,
    c_name || 'USDT' AS symbol, CAST(c_custkey AS INTEGER) AS pos
  FROM customer)"""
# The registry: coins with the symbol of their tradeable dollar pair.
REGISTRY = """
registry AS (
  SELECT c.*, p.symbol AS binance_symbol
  FROM coins c LEFT JOIN (
    SELECT upper(base_asset) AS base, arg_max(symbol, pos) AS symbol FROM symbols
    WHERE quote_asset = 'USDT' AND status = 'TRADING' GROUP BY 1) p ON upper(c.symbol) = p.base)"""


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exchange listing per line item: part as coin, supplier as exchange, price as volume."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("coin_id"),
        F.col("l_suppkey").cast("string").alias("exchange_id"),
        F.col("l_returnflag").alias("base_symbol"),
        F.col("l_linestatus").alias("target_symbol"),
        amount("l_quantity", "decimal(24,10)").alias("price_usd"),
        amount("l_extendedprice", "decimal(28,2)").alias("volume_usd_24h"),
        F.lit(None).cast("string").alias("trust_score"),
        F.col("l_shipdate").cast("timestamp").alias("last_traded_at"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
    )


LISTINGS = """
listings AS (
  SELECT CAST(l_partkey AS VARCHAR) AS coin_id, CAST(l_suppkey AS VARCHAR) AS exchange_id,
    l_returnflag AS base_symbol, l_linestatus AS target_symbol,
    CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(24,10)) AS price_usd,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(28,2)) AS volume_usd_24h,
    CAST(NULL AS VARCHAR) AS trust_score, l_shipdate AS last_traded_at,
    l_orderkey * 10 + l_linenumber AS pos
  FROM lineitem)"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as price observations of the customer's coin; finished orders and the others apart by status."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("coin_id"),
        amount("o_totalprice", "decimal(24,10)").alias("price_usd"),
        amount("o_totalprice", "decimal(24,2)").alias("market_cap_usd"),
        (F.col("o_orderkey") % 1000).cast("int").alias("rank"),
        (F.col("o_orderkey") % 100).cast("decimal(10,4)").alias("change_percent_24h"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "binance_rest").otherwise("coingecko").alias("price_source"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("status"),
    )


SNAPSHOTS = """
snapshots AS (
  SELECT CAST(o_custkey AS VARCHAR) AS coin_id,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(24,10)) AS price_usd,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(24,2)) AS market_cap_usd,
    CAST(o_orderkey % 1000 AS INTEGER) AS rank, CAST(o_orderkey % 100 AS DECIMAL(10,4)) AS change_percent_24h,
    o_orderdate AS updated_at,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'binance_rest' ELSE 'coingecko' END AS price_source,
    o_orderkey AS seq, o_orderstatus AS status
  FROM orders)"""


def latest_sql(name: str, source: str, keys: str, order: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source} WHERE {where})
  WHERE rn = 1)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as long series rows: the status picks the series, customer and date the point."""
    status = F.col("o_orderstatus")
    kind = F.when(status == "O", "prices").when(status == "F", "market_caps").otherwise("total_volumes")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("coin_id"),
        F.lit(0).cast("bigint").alias("request"),
        kind.alias("kind"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("pos"),
    )


SERIES = """
series AS (
  SELECT CAST(o_custkey AS VARCHAR) AS coin_id,
    CASE o_orderstatus WHEN 'O' THEN 'prices' WHEN 'F' THEN 'market_caps' ELSE 'total_volumes' END AS kind,
    epoch_ms(o_orderdate) AS ts_ms, o_totalprice AS value, o_orderkey AS pos
  FROM orders)"""
