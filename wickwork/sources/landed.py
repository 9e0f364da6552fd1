"""Landed JSON responses: one response body per row, turned into typed rows.

Every parser takes a DataFrame with a ``body`` text column (and ``coin_id`` where the
response itself does not name the coin). A body that is not valid JSON yields no rows;
``unparsed`` returns those bodies so that a job can count and keep them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wickwork import schemas as S
from wickwork.functions.times import at, epoch_to_timestamp, iso_instant, millis
from wickwork.functions.values import money, nine_places, present, whole


def read_candle_ndjson(spark: SparkSession, glob: str) -> DataFrame:
    """Candle lines under a glob, with the fixed candle schema."""
    return spark.read.schema(S.CANDLE).json(glob)


def read_bodies(spark: SparkSession, glob: str) -> DataFrame:
    """Whole response files, with the coin named by a ``coin_id=...`` folder where there is one."""
    files = spark.read.text(glob, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(
        F.nullif(F.regexp_extract(path, r"/coin_id=([^/]+)/", 1), F.lit("")).alias("coin_id"),
        F.col("value").alias("body"),
    )


def unparsed(raw: DataFrame, wire: str) -> DataFrame:
    """The rows whose body is not JSON, or not an array where the wire format is one."""
    failed = F.get_json_object("body", "$").isNull()
    if wire.startswith("array"):
        failed = failed | F.from_json("body", wire).isNull()
    return raw.filter(failed)


def parse_klines(raw: DataFrame, interval: str, as_of: datetime) -> DataFrame:
    """Positional candle arrays as bronze candles; a candle is closed once its close time has passed.

    An amount that does not parse becomes null, which ``quality.sane`` rejects and counts.
    """
    batch = F.from_json("body", S.KLINE_BATCH)
    k = F.col("k")
    cell = lambda i: F.get(k, F.lit(i))
    now = at(as_of)
    close_time = F.timestamp_millis(whole(cell(6)))
    return raw.select("coin_id", F.explode(batch).alias("k")).select(
        "coin_id",
        F.lit(interval).alias("interval"),
        F.timestamp_millis(whole(cell(0))).alias("open_time"),
        close_time.alias("close_time"),
        money(cell(1)).alias("open"),
        money(cell(2)).alias("high"),
        money(cell(3)).alias("low"),
        money(cell(4)).alias("close"),
        money(cell(5)).alias("volume"),
        money(cell(7)).alias("quote_volume"),
        whole(cell(8)).alias("trade_count"),
        (close_time < at(millis(as_of))).alias("is_closed"),
        now.alias("publish_time"),
    )


def archive_to_bronze(lines: DataFrame, interval: str, as_of: datetime) -> DataFrame:
    """Archive lines (with ``coin_id``) as bronze candles; archived candles are always closed."""
    return lines.select(
        "coin_id",
        F.lit(interval).alias("interval"),
        epoch_to_timestamp(F.col("open_time")).alias("open_time"),
        epoch_to_timestamp(F.col("close_time")).alias("close_time"),
        *[money(F.col(c)).alias(c) for c in ("open", "high", "low", "close", "volume", "quote_volume")],
        "trade_count",
        F.lit(True).alias("is_closed"),
        at(as_of).alias("publish_time"),
    )


def bronze_to_json(bronze: DataFrame) -> DataFrame:
    """Candles as JSON lines (``coin_id``, ``value``): ISO instants for times, text for amounts."""
    amounts = ("open", "high", "low", "close", "volume", "quote_volume")
    times = ("open_time", "close_time", "publish_time")
    fields: list[Column] = []
    for name in S.CANDLE.names:
        if name in times:
            fields.append(iso_instant(F.col(name)).alias(name))
        elif name in amounts:
            fields.append(F.col(name).cast("string").alias(name))
        else:
            fields.append(F.col(name))
    return bronze.select("coin_id", F.to_json(F.struct(*fields)).alias("value"))


def parse_markets(raw: DataFrame) -> DataFrame:
    """The coin list: one row per coin, in serving types."""
    m = F.col("m")
    return raw.select(F.explode(F.from_json("body", S.MARKET_LIST)).alias("m")).select(
        m["id"].alias("coin_id"),
        m["symbol"].alias("symbol"),
        m["name"].alias("name"),
        m["market_cap"].alias("market_cap_usd"),
        m["market_cap_rank"].alias("rank"),
        m["price_change_percentage_24h"].alias("change_percent_24h"),
        m["current_price"].alias("current_price"),
    )


def parse_tickers(raw: DataFrame) -> DataFrame:
    """A coin's exchange listings; ``pos`` is the listing's place in the response.

    Listings without an exchange, base or target (missing or empty) are left out.
    """
    tickers = F.from_json("body", S.TICKERS)["tickers"]
    t = F.col("t")
    return (
        raw.select("coin_id", F.posexplode(tickers).alias("pos", "t"))
        .select(
            "coin_id",
            t["market"]["identifier"].alias("exchange_id"),
            t["base"].alias("base_symbol"),
            t["target"].alias("target_symbol"),
            t["converted_last"]["usd"].alias("price_usd"),
            t["converted_volume"]["usd"].alias("volume_usd_24h"),
            t["trust_score"].alias("trust_score"),
            t["last_traded_at"].try_cast("timestamp").alias("last_traded_at"),
            "pos",
        )
        .filter(present(F.col("exchange_id")) & present(F.col("base_symbol")) & present(F.col("target_symbol")))
    )


def parse_symbols(raw: DataFrame) -> DataFrame:
    """The exchange's pair list; ``pos`` is the pair's place in the response."""
    symbols = F.from_json("body", S.SYMBOLS)["symbols"]
    return raw.select(F.posexplode(symbols).alias("pos", "p")).select(
        F.col("p.baseAsset").alias("base_asset"),
        F.col("p.quoteAsset").alias("quote_asset"),
        F.col("p.status").alias("status"),
        F.col("p.symbol").alias("symbol"),
        "pos",
    )


def parse_series(raw: DataFrame) -> DataFrame:
    """A coin's three [ms, value] series as long rows ``(coin_id, request, kind, ts_ms, value, pos)``.

    ``request`` orders the responses of one coin (0 where the input has no such column);
    ``operators.series.align_series`` puts the three kinds side by side again.
    """
    series = F.col("series")
    request = F.col("request").cast("bigint") if "request" in raw.columns else F.lit(0).cast("bigint")

    def points(kind: str) -> Column:
        return F.transform(
            F.coalesce(series[kind], F.array().cast("array<array<double>>")),
            lambda pair, i: F.struct(
                F.lit(kind).alias("kind"),
                F.get(pair, F.lit(0)).cast("bigint").alias("ts_ms"),
                F.get(pair, F.lit(1)).alias("value"),
                i.alias("pos"),
            ),
        )

    every = F.concat(*[points(kind) for kind in ("prices", "market_caps", "total_volumes")])
    # Exploding a one-element array parses each body once; as a plain column it would be copied into every use.
    parsed = raw.select("coin_id", request.alias("request"), F.explode(F.array(F.from_json("body", S.SERIES))).alias("series"))
    return parsed.select("coin_id", "request", F.explode(every).alias("e")).select("coin_id", "request", "e.*")


def series_to_history(aligned: DataFrame) -> DataFrame:
    """Aligned series in the stored types: a timestamp and nine-place amounts."""
    return aligned.select(
        "coin_id",
        F.timestamp_millis("ts_ms").alias("timestamp"),
        nine_places(F.col("price")).alias("price_usd"),
        nine_places(F.col("market_cap")).alias("market_cap_usd"),
        nine_places(F.col("total_volume")).alias("total_volume_usd"),
        "request",
    )
