"""Explicit schemas; nothing in this package infers one."""

from __future__ import annotations

import re

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 9)

# The writers of a snapshot price, and the quote and status of a tradeable pair.
PRICE_SOURCES = ("binance_ws", "binance_rest", "coingecko")
EXCHANGE_PRICE_SOURCE = "binance_rest"
LIST_PRICE_SOURCE = "coingecko"
PAIR_QUOTE = "USDT"
PAIR_STATUS = "TRADING"


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """``"a string, b decimal(38,9)"`` as a StructType, without needing a session."""
    fields = []
    for name, kind, precision, scale in re.findall(r"(\w+) (\w+)(?:\((\d+),(\d+)\))?", spec):
        dtype = T.DecimalType(int(precision), int(scale)) if precision else _TYPES[kind]
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


# Tables.
BRONZE = _struct(
    "coin_id string, interval string, open_time timestamp, close_time timestamp, "
    "open decimal(38,9), high decimal(38,9), low decimal(38,9), close decimal(38,9), "
    "volume decimal(38,9), quote_volume decimal(38,9), trade_count bigint, is_closed boolean, "
    "publish_time timestamp, subscription_name string, message_id string, attributes string"
)
SIDECARS = ("subscription_name", "message_id", "attributes")
CANDLE = T.StructType([f for f in BRONZE.fields if f.name not in SIDECARS])
SILVER = T.StructType(
    [f for f in CANDLE.fields if f.name != "publish_time"]
    + [T.StructField("latest_publish_time", T.TimestampType())]
)


def gold_schema(unit: str) -> T.StructType:
    return _struct(
        f"coin_id string, interval string, {unit} timestamp, open decimal(38,9), close decimal(38,9), "
        "high decimal(38,9), low decimal(38,9), volume decimal(38,9), quote_volume decimal(38,9), "
        "trade_count bigint, candle_count bigint, latest_publish_time timestamp"
    )


MARKET_CAP_HISTORY = _struct(
    "coin_id string, timestamp timestamp, price_usd decimal(38,9), "
    "market_cap_usd decimal(38,9), total_volume_usd decimal(38,9)"
)
COINS = _struct("coin_id string, symbol string, name string, binance_symbol string")
SNAPSHOTS = _struct(
    "coin_id string, price_usd decimal(24,10), market_cap_usd decimal(24,2), rank int, "
    "change_percent_24h decimal(10,4), updated_at timestamp, price_source string"
)
MARKETS = _struct(
    "coin_id string, exchange_id string, base_symbol string, target_symbol string, "
    "price_usd decimal(24,10), volume_usd_24h decimal(28,2), trust_score string, "
    "last_traded_at timestamp, updated_at timestamp"
)
WATERMARKS = _struct("coin_id string, interval string, last_loaded_close_time timestamp, updated_at timestamp")
SERVING = _struct(
    "coin_id string, bucket_start timestamp, open decimal(24,10), high decimal(24,10), "
    "low decimal(24,10), close decimal(24,10), volume decimal(28,10), is_closed boolean, "
    "updated_at timestamp"
)

# Constraints of the serving tables, checked by operators.quality.
NOT_NULL = {
    "coins": ["coin_id", "symbol", "name"],
    "coin_snapshots": ["coin_id", "price_usd", "updated_at"],
    "markets": ["coin_id", "exchange_id", "base_symbol", "target_symbol", "updated_at"],
    "ingestion_watermarks": ["coin_id", "interval", "last_loaded_close_time", "updated_at"],
    "candle_rollups": SERVING.names,
}
PRIMARY_KEY = {
    "coins": ["coin_id"],
    "coin_snapshots": ["coin_id"],
    "markets": ["coin_id", "exchange_id", "base_symbol", "target_symbol"],
    "ingestion_watermarks": ["coin_id", "interval"],
    "candle_rollups": ["coin_id", "bucket_start"],
    "silver_candles": ["coin_id", "interval", "open_time"],
    "market_cap_history": ["coin_id", "timestamp"],
}

# Wire formats. Amounts go straight from text to decimal, never through a double.
KLINE_BATCH = "array<array<string>>"
MARKET_LIST = (
    "array<struct<id:string,symbol:string,name:string,market_cap:decimal(24,2),market_cap_rank:int,"
    "price_change_percentage_24h:decimal(10,4),current_price:decimal(24,10)>>"
)
TICKERS = (
    "struct<tickers:array<struct<base:string,target:string,trust_score:string,last_traded_at:string,"
    "market:struct<identifier:string>,converted_last:struct<usd:decimal(24,10)>,"
    "converted_volume:struct<usd:decimal(28,2)>>>>"
)
SYMBOLS = "struct<symbols:array<struct<symbol:string,baseAsset:string,quoteAsset:string,status:string>>>"
# The one series format whose values are doubles at the source.
SERIES = (
    "struct<prices:array<array<double>>,market_caps:array<array<double>>,total_volumes:array<array<double>>>"
)
# Times and amounts stay text here so that one bad value is a dead letter and not a failed batch.
EVENT = (
    "struct<coin_id:string,interval:string,open_time:string,close_time:string,open:string,high:string,"
    "low:string,close:string,volume:string,quote_volume:string,trade_count:bigint,is_closed:boolean,"
    "malformed:string>"
)
MESSAGE = _struct("value string, publish_time timestamp, message_id string, attributes string")
