"""Registry queries: symbols, routing, top lists and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickwork.catalog import shapes
from wickwork.catalog.base import ctes, query
from wickwork.catalog.shapes import COINS, LISTINGS, REGISTRY, SYMBOLS, latest_sql
from wickwork.operators import backfill, registry
from wickwork.sources import tables as scans

_LISTING_KEY = ["coin_id", "exchange_id", "base_symbol", "target_symbol"]


def matched_coins(spark, sf_dir):
    pairs = registry.trading_pairs(shapes.symbols(spark, sf_dir))
    return registry.match_symbols(shapes.coins(spark, sf_dir), pairs)


@query("symbol_match", ctes(COINS, SYMBOLS, REGISTRY) + "SELECT * FROM registry")
def symbol_match(spark, sf_dir):
    return matched_coins(spark, sf_dir)


@query(
    "trading_pairs",
    ctes(SYMBOLS)
    + """SELECT upper(base_asset) AS base, arg_max(symbol, pos) AS symbol FROM symbols
    WHERE quote_asset = 'USDT' AND status = 'TRADING' GROUP BY 1""",
)
def trading_pairs(spark, sf_dir):
    return registry.trading_pairs(shapes.symbols(spark, sf_dir))


@query(
    "registry_scan",
    ctes(COINS, SYMBOLS, REGISTRY) + "SELECT coin_id, binance_symbol FROM registry WHERE binance_symbol IS NOT NULL",
)
def registry_scan(spark, sf_dir):
    return scans.registry_scan(matched_coins(spark, sf_dir))


@query(
    "trial_coins",
    ctes(COINS) + "SELECT coin_id, name FROM coins ORDER BY coin_id LIMIT 20",
)
def trial_coins(spark, sf_dir):
    return scans.first_coins(shapes.coins(spark, sf_dir).select("coin_id", "name"), 20)


@query(
    "tradeable_split",
    ctes(COINS, SYMBOLS, REGISTRY)
    + """SELECT coin_id, market_cap_usd,
      CASE WHEN binance_symbol IS NULL THEN 'list' ELSE 'exchange' END AS price_from FROM registry""",
)
def tradeable_split(spark, sf_dir):
    rows = shapes.coins(spark, sf_dir).select("coin_id", "market_cap_usd")
    tradeable, other = registry.split_tradeable(rows, matched_coins(spark, sf_dir))
    return tradeable.withColumn("price_from", F.lit("exchange")).unionByName(
        other.withColumn("price_from", F.lit("list"))
    )


@query(
    "top_coins",
    ctes(COINS) + "SELECT coin_id, symbol, market_cap_usd FROM coins ORDER BY market_cap_usd DESC, coin_id LIMIT 150",
)
def top_coins(spark, sf_dir):
    return registry.top_coins(shapes.coins(spark, sf_dir)).select("coin_id", "symbol", "market_cap_usd")


_RANK = """SELECT *, CAST(row_number() OVER (PARTITION BY coin_id
    ORDER BY coalesce(volume_usd_24h, 0) DESC, exchange_id, pos) AS INTEGER) AS rank FROM listings"""


@query("listing_rank", ctes(LISTINGS) + _RANK)
def listing_rank(spark, sf_dir):
    return registry.rank_listings(shapes.listings(spark, sf_dir), ["exchange_id", "pos"])


_NO_VOLUME = """SELECT * REPLACE (CASE WHEN pos % 3 = 0 THEN NULL ELSE volume_usd_24h END AS volume_usd_24h) FROM listings"""


@query("listing_rank_by_ranges", ctes(LISTINGS, f"thinned AS ({_NO_VOLUME})") + _RANK.replace("FROM listings", "FROM thinned"))
def listing_rank_by_ranges(spark, sf_dir):
    """Ranks where a third of the listings has no volume, so that the tie-break orders them."""
    listings = shapes.listings(spark, sf_dir)
    thinned = listings.withColumn("volume_usd_24h", F.when(F.col("pos") % 3 != 0, F.col("volume_usd_24h")))
    return registry.rank_listings(thinned, ["exchange_id", "pos"])


@query("listings_sorted", ctes(LISTINGS) + "SELECT * FROM listings ORDER BY coin_id, volume_usd_24h DESC, pos")
def listings_sorted(spark, sf_dir):
    return registry.sort_listings(shapes.listings(spark, sf_dir), ["pos"])


@query(
    "latest_listings",
    ctes(LISTINGS, latest_sql("latest", "listings", ", ".join(_LISTING_KEY), "coalesce(volume_usd_24h, 0), pos DESC"))
    + "SELECT * FROM latest",
)
def latest_listings(spark, sf_dir):
    return registry.latest_listings(shapes.listings(spark, sf_dir), _LISTING_KEY)


@query(
    "last_wins",
    """SELECT CAST(o_custkey AS VARCHAR) AS coin_id, epoch_ms(o_orderdate) AS ts_ms,
      arg_max(o_totalprice, o_orderkey) AS value FROM orders GROUP BY 1, 2""",
)
def last_wins(spark, sf_dir):
    return registry.last_wins(shapes.series(spark, sf_dir), ["coin_id", "ts_ms"], "value", "pos")


@query(
    "work_grid",
    ctes(
        COINS,
        """windows AS (
      SELECT CAST(i AS INTEGER) AS window_no,
        CAST(DATE '2001-08-01' - CAST(least((i + 1) * 90, 365) AS INTEGER) AS DATE) AS window_start,
        CAST(DATE '2001-08-01' - CAST(i * 90 AS INTEGER) AS DATE) AS window_end
      FROM range(0, 5) t(i))""",
    )
    + """SELECT coin_id, window_no, window_start, window_end,
      CAST(epoch(window_start) AS BIGINT) AS from_epoch, CAST(epoch(window_end) AS BIGINT) AS to_epoch
    FROM coins, windows""",
)
def work_grid(spark, sf_dir):
    return backfill.work_grid(shapes.coins(spark, sf_dir).select("coin_id"), shapes.ORDERS_AS_OF.date())
