"""Source queries: wire formats made from the driver tables and parsed back."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from wickwork import layout
from wickwork.catalog import shapes
from wickwork.catalog.base import ctes, query
from wickwork.catalog.shapes import BRONZE, COINS, EVENTS_AS_OF, LISTINGS, SANE, SERIES, SYMBOLS
from wickwork.functions import times
from wickwork.functions.values import nine_places
from wickwork.layout import read_table
from wickwork.operators import series as series_ops
from wickwork.operators.quality import sane
from wickwork.plans import jobs
from wickwork.schemas import CANDLE
from wickwork.session import new_folder, share_package
from wickwork.sinks.files import load_ndjson, stage_ndjson
from wickwork.sinks.tables import append, create_table
from wickwork.sources import archive, landed


def _cells():
    return F.array(
        F.unix_millis("open_time").cast("string"),
        *[F.col(c).cast("decimal(38,2)").cast("string") for c in ("open", "high", "low", "close", "volume")],
        F.unix_millis("close_time").cast("string"),
        F.col("quote_volume").cast("decimal(38,2)").cast("string"),
        F.col("trade_count").cast("string"),
        F.lit("ignored"),
    )


def raw_klines(spark, sf_dir):
    """One response per event with one positional candle, times in epoch milliseconds."""
    return shapes.bronze(spark, sf_dir).select("coin_id", F.to_json(F.array(_cells())).alias("body"))


_KLINES_SQL = (
    ctes(BRONZE)
    + """SELECT coin_id, "interval", open_time, close_time, open, high, low, close, volume, quote_volume, trade_count,
      close_time < TIMESTAMP '2024-01-30 20:30:00' AS is_closed, TIMESTAMP '2024-01-30 20:30:00' AS publish_time
    FROM bronze"""
)


@query("klines_parse", _KLINES_SQL)
def klines_parse(spark, sf_dir):
    return landed.parse_klines(raw_klines(spark, sf_dir), "1h", EVENTS_AS_OF)


@query("klines_parse_pages", _KLINES_SQL)
def klines_parse_pages(spark, sf_dir):
    """Responses as an exchange gives them: a page of candles, here a coin's day."""
    pages = shapes.bronze(spark, sf_dir).groupBy("coin_id", F.to_date("open_time").alias("day"))
    pages = pages.agg(F.to_json(F.collect_list(_cells())).alias("body"))
    return landed.parse_klines(pages.select("coin_id", "body"), "1h", EVENTS_AS_OF)


def raw_markets(spark, sf_dir):
    c = shapes.table(spark, sf_dir, "customer")
    row = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.lower("c_name").alias("symbol"),
        F.col("c_name").alias("name"),
        shapes.amount("c_acctbal", "decimal(24,2)").alias("market_cap"),
        F.col("c_nationkey").alias("market_cap_rank"),
        (F.col("c_custkey") % 10).cast("decimal(10,4)").alias("price_change_percentage_24h"),
        F.when(F.col("c_mktsegment") != "FURNITURE", shapes.amount("c_acctbal", "decimal(24,10)")).alias(
            "current_price"
        ),
    )
    return c.select(F.to_json(F.array(row)).alias("body"))


@query(
    "markets_parse",
    ctes(COINS)
    + """SELECT c.coin_id, c.symbol, c.name, c.market_cap_usd, CAST(x.c_nationkey AS INTEGER) AS rank,
      CAST(x.c_custkey % 10 AS DECIMAL(10,4)) AS change_percent_24h,
      CASE WHEN c.segment <> 'FURNITURE'
        THEN CAST(CAST(x.c_acctbal AS DECIMAL(18,2)) AS DECIMAL(24,10)) END AS current_price
    FROM coins c JOIN customer x ON CAST(x.c_custkey AS VARCHAR) = c.coin_id""",
)
def markets_parse(spark, sf_dir):
    return landed.parse_markets(raw_markets(spark, sf_dir))


def _ticker():
    returned = F.col("base_symbol") == "R"
    open_accepted = (F.col("base_symbol") == "A") & (F.col("target_symbol") == "O")
    return F.struct(
        F.col("base_symbol").alias("base"),
        F.when(open_accepted, "").otherwise(F.col("target_symbol")).alias("target"),
        F.lit("green").alias("trust_score"),
        F.date_format("last_traded_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_traded_at"),
        F.when(~returned, F.struct(F.col("exchange_id").alias("identifier"))).alias("market"),
        F.struct(F.col("price_usd").alias("usd")).alias("converted_last"),
        F.struct(F.col("volume_usd_24h").alias("usd")).alias("converted_volume"),
    )


def raw_tickers(spark, sf_dir):
    """One response per line item; returned items lack their exchange, open accepted ones have an empty target."""
    rows = shapes.listings(spark, sf_dir)
    return rows.select("coin_id", F.to_json(F.struct(F.array(_ticker()).alias("tickers"))).alias("body"))


@query(
    "tickers_parse_pages",
    ctes(LISTINGS)
    + """SELECT coin_id, exchange_id, base_symbol, target_symbol, price_usd, volume_usd_24h, 'green' AS trust_score, last_traded_at,
      CAST(n AS INTEGER) AS pos FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY pos, exchange_id, price_usd, volume_usd_24h,
        base_symbol, target_symbol, last_traded_at) - 1 AS n FROM listings)
    WHERE base_symbol <> 'R' AND NOT (base_symbol = 'A' AND target_symbol = 'O')""",
)
def tickers_parse_pages(spark, sf_dir):
    """One response a coin with all its listings, some of which are left out."""
    # Some positions are not unique.
    order = ["pos", "exchange_id", "price_usd", "volume_usd_24h", "base_symbol", "target_symbol", "last_traded_at"]
    listed = F.sort_array(F.collect_list(F.struct(*order, _ticker().alias("t"))))["t"]
    rows = shapes.listings(spark, sf_dir).groupBy("coin_id").agg(listed.alias("tickers"))
    return landed.parse_tickers(rows.select("coin_id", F.to_json(F.struct("tickers")).alias("body")))


@query(
    "tickers_parse",
    ctes(LISTINGS)
    + """SELECT coin_id, exchange_id, base_symbol, target_symbol, price_usd, volume_usd_24h,
      'green' AS trust_score, last_traded_at, 0 AS pos FROM listings
    WHERE base_symbol <> 'R' AND NOT (base_symbol = 'A' AND target_symbol = 'O')""",
)
def tickers_parse(spark, sf_dir):
    return landed.parse_tickers(raw_tickers(spark, sf_dir))


@query("symbols_parse", ctes(SYMBOLS) + "SELECT base_asset, quote_asset, status, symbol, 0 AS pos FROM symbols")
def symbols_parse(spark, sf_dir):
    pair = F.struct(
        F.col("symbol"),
        F.col("base_asset").alias("baseAsset"),
        F.col("quote_asset").alias("quoteAsset"),
        F.col("status"),
    )
    raw = shapes.symbols(spark, sf_dir).select(F.to_json(F.struct(F.array(pair).alias("symbols"))).alias("body"))
    return landed.parse_symbols(raw)


_ALIGN = """SELECT coin_id, ts_ms,
    arg_max(value, pos) FILTER (WHERE kind = 'prices') AS price,
    arg_max(value, pos) FILTER (WHERE kind = 'market_caps') AS market_cap,
    arg_max(value, pos) FILTER (WHERE kind = 'total_volumes') AS total_volume
  FROM series GROUP BY 1, 2 HAVING count(*) FILTER (WHERE kind = 'prices') > 0"""


@query("series_align", ctes(SERIES) + _ALIGN)
def series_align(spark, sf_dir):
    return series_ops.align_series(shapes.series(spark, sf_dir)).drop("request")


@query(
    "series_parse",
    """SELECT CAST(o_custkey AS VARCHAR) AS coin_id, o_orderdate AS timestamp,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS DECIMAL(38,9)) AS price_usd,
      CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) END AS market_cap_usd,
      CAST(NULL AS DECIMAL(38,9)) AS total_volume_usd, o_orderkey AS request FROM orders""",
)
def series_parse(spark, sf_dir):
    """One response per order: the price point twice, a cap at that time or a day later, no volumes."""
    o = shapes.table(spark, sf_dir, "orders")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("double")
    price = shapes.amount("o_totalprice", "decimal(18,2)").cast("double")
    plus_one = (shapes.amount("o_totalprice", "decimal(18,2)") + 1).cast("double")
    cap_ms = F.when(F.col("o_orderstatus") == "F", ms).otherwise(ms + 86_400_000.0)
    body = F.to_json(
        F.struct(
            F.array(F.array(ms, price), F.array(ms, plus_one)).alias("prices"),
            F.array(F.array(cap_ms, price)).alias("market_caps"),
        )
    )
    raw = o.select(F.col("o_custkey").cast("string").alias("coin_id"), F.col("o_orderkey").alias("request"), body.alias("body"))
    return landed.series_to_history(series_ops.align_series(landed.parse_series(raw)))


def _keys(spark, sf_dir):
    """Archive keys from orders: monthly files of open ones, daily files of the others, checksums beside them."""
    o = shapes.table(spark, sf_dir, "orders")
    symbol = F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit("USDT"))
    monthly = F.col("o_orderstatus") == "O"
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    stem = F.concat(symbol, F.lit("-1h-"), F.when(monthly, F.substring(day, 1, 7)).otherwise(day))
    folder = F.concat(
        F.lit("klines/"), F.when(monthly, "monthly/").otherwise("daily/"), symbol, F.lit("/1h/")
    )
    zips = o.select(F.concat(folder, stem, F.lit(".zip")).alias("key")).distinct()
    return zips.unionByName(zips.select(F.concat("key", F.lit(".CHECKSUM")).alias("key")))


@query(
    "archive_select",
    """WITH files AS (
      SELECT DISTINCT 'C' || o_custkey || 'USDT' AS symbol, strftime(o_orderdate, '%Y-%m') AS year_month,
        o_orderstatus <> 'O' AS is_daily,
        CASE WHEN o_orderstatus = 'O' THEN 'monthly/' ELSE 'daily/' END AS sort,
        CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d
      FROM orders),
    newest AS (SELECT symbol, max(year_month) AS m FROM files WHERE NOT is_daily GROUP BY 1)
    SELECT 'klines/' || sort || f.symbol || '/1h/' || f.symbol || '-1h-' || d || '.zip' AS key, f.symbol,
      '1h' AS "interval", year_month, is_daily
    FROM files f LEFT JOIN newest n ON f.symbol = n.symbol WHERE NOT is_daily OR m IS NULL OR year_month > m""",
)
def archive_select(spark, sf_dir):
    return archive.select_archive_files(_keys(spark, sf_dir))


def _write_zip(name: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One group's CSV lines as a zip, packed a batch at a time; the folder is part of the group's name."""
    folder, stem = (part.as_py() for part in name)
    fs, inside = archive.open_uri(folder)
    fs.create_dir(inside, recursive=True)
    with fs.open_output_stream(f"{inside}/{stem}.zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as packed:
        # The length is not known beforehand and may pass what a header without zip64 holds.
        with packed.open(f"{stem}.csv", "w", force_zip64=True) as entry:
            between = ""
            for batch in batches:
                entry.write((between + "\n".join(batch.column("line").to_pylist())).encode())
                between = "\n"
    yield pa.RecordBatch.from_pydict({"key": [f"{folder}/{stem}.zip"]})


def _write_archive(candles, folder: str) -> int:
    """Candles as monthly zips of headerless CSV, one a coin and month, epochs in both units; returns the number of files."""
    unit = lambda c: F.when(F.col("trade_count") % 2 == 0, F.unix_millis(c)).otherwise(F.unix_micros(c))
    names = ["open", "high", "low", "close", "volume"]
    cells = [unit("open_time"), *[F.col(c) for c in names], unit("close_time"), F.col("quote_volume"), F.col("trade_count"), F.lit("0")]
    stem = F.concat(F.upper("coin_id"), F.lit("USDT-1h-"), F.date_format("open_time", "yyyy-MM"))
    lines = candles.select(F.lit(folder).alias("folder"), stem.alias("stem"), F.concat_ws(",", *[c.cast("string") for c in cells]).alias("line"))
    return lines.groupBy("folder", "stem").applyInArrow(_write_zip, "key string").count()


@query(
    "archive_backfill",
    ctes(BRONZE)
    + "SELECT * EXCLUDE (event_id) REPLACE (TIMESTAMP '2024-01-30 20:30:00' AS publish_time) FROM bronze",
)
def archive_backfill(spark, sf_dir):
    """Candles written as zips, found by listing, and loaded into bronze by the backfill job."""
    tables = jobs.Tables(new_folder(spark, "backfill"))
    tables.create(spark)
    candles, folder = shapes.bronze(spark, sf_dir), new_folder(spark, "klines")
    coins = candles.select("coin_id", F.concat(F.upper("coin_id"), F.lit("USDT")).alias("binance_symbol")).distinct()
    append(coins, tables.path("coins"), layout.COINS)
    share_package(spark)
    _write_archive(candles, folder)
    jobs.backfill_candles(spark, tables, folder, new_folder(spark, "ndjson"), shapes.EVENTS_AS_OF)
    return tables.read(spark, "bronze_candles").select(*CANDLE.names)


@query(
    "epoch_units",
    """SELECT event_id, date_trunc('milliseconds', ts) AS from_millis, date_trunc('milliseconds', ts) AS from_micros
    FROM events""",
)
def epoch_units(spark, sf_dir):
    e = shapes.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id",
        times.epoch_to_timestamp(F.unix_millis(ts)).alias("from_millis"),
        times.epoch_to_timestamp(F.unix_micros(ts)).alias("from_micros"),
    )


@query(
    "time_texts",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
        WHEN epoch_us(ts) % 1000 = 0 THEN strftime(ts, '.%g') ELSE strftime(ts, '.%f') END || 'Z' AS instant,
      CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day_epoch, CAST(ts AS DATE) AS day,
      CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS amount FROM events""",
)
def time_texts(spark, sf_dir):
    e = shapes.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id",
        times.iso_instant(ts).alias("instant"),
        times.day_start_epoch(ts).alias("day_epoch"),
        F.to_date("ts").alias("day"),
        nine_places(F.col("value")).alias("amount"),
    )


@query("ndjson_load", ctes(BRONZE) + f"SELECT * EXCLUDE (event_id) FROM bronze WHERE {SANE}")
def ndjson_load(spark, sf_dir):
    """Candles staged as JSON lines per coin, loaded into bronze, read back."""
    staging, target = new_folder(spark, "ndjson"), new_folder(spark, "bronze")
    stage_ndjson(sane(shapes.bronze(spark, sf_dir))[0], staging)
    create_table(spark, target, layout.BRONZE)
    load_ndjson(spark, f"{staging}/*/*", target)
    return read_table(spark, target, layout.BRONZE).select(*CANDLE.names)
