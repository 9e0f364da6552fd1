"""The coin registry: top coins, exchange symbols, and listing ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wickwork.operators.rollup import latest_per_key
from wickwork.schemas import PAIR_QUOTE, PAIR_STATUS
from wickwork.session import staged

TOP_N = 150


def top_coins(coins: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` coins of highest market cap, fewer if there are fewer; ties go to the lower id."""
    return coins.orderBy(F.desc_nulls_last("market_cap_usd"), "coin_id").limit(n)


def trading_pairs(symbols: DataFrame, quote: str = PAIR_QUOTE, status: str = PAIR_STATUS) -> DataFrame:
    """Upper-cased base asset to exchange symbol for tradeable pairs; the last pair of a base counts."""
    tradeable = symbols.filter((F.col("quote_asset") == quote) & (F.col("status") == status))
    return last_wins(tradeable.withColumn("base", F.upper("base_asset")), ["base"], "symbol", "pos")


def last_wins(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """The value at the highest position of each key, as assigning into a map in order would leave it."""
    return df.groupBy(*keys).agg(F.max_by(value, position).alias(value))


def match_symbols(coins: DataFrame, pairs: DataFrame) -> DataFrame:
    """Coins with the exchange symbol of their own symbol, whatever its case; none is null.

    ``pairs`` holds each base once, so the join cannot multiply coins. No broadcast is
    forced: the adaptive plan broadcasts the pairs only if their real size is small, and
    splits a symbol that very many coins share.
    """
    lookup = pairs.select(F.col("base").alias("__base"), F.col("symbol").alias("binance_symbol"))
    return (
        coins.drop("binance_symbol")
        .join(lookup, F.upper("symbol") == F.col("__base"), "left")
        .drop("__base")
    )


def tradeable_coins(coins: DataFrame) -> DataFrame:
    return coins.filter(F.col("binance_symbol").isNotNull()).select("coin_id")


def split_tradeable(df: DataFrame, coins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of coins with an exchange symbol, and the others."""
    tradeable = tradeable_coins(coins)
    return df.join(tradeable, "coin_id", "left_semi"), df.join(tradeable, "coin_id", "left_anti")


def flag_tradeable(df: DataFrame, coins: DataFrame) -> DataFrame:
    """Both halves of ``split_tradeable`` in one pass, told apart by a ``tradeable`` column."""
    known = tradeable_coins(coins).withColumn("tradeable", F.lit(True))
    return df.join(known, "coin_id", "left").withColumn("tradeable", F.coalesce("tradeable", F.lit(False)))


def _listing_order(tie_break: list[str]) -> list:
    return [F.coalesce("volume_usd_24h", F.lit(0)).desc(), *[F.col(c).asc() for c in tie_break]]


def sort_listings(listings: DataFrame, tie_break: list[str]) -> DataFrame:
    """Listings of each coin by USD volume, largest first, no volume counting as zero."""
    return listings.orderBy("coin_id", *_listing_order(tie_break))


def latest_listings(listings: DataFrame, keys: list[str]) -> DataFrame:
    """One listing per key: the one written last when written in rank order, largest volume first."""
    return latest_per_key(listings, keys, [F.coalesce("volume_usd_24h", F.lit(0)).asc(), F.desc("pos")])


def rank_listings(listings: DataFrame, tie_break: list[str]) -> DataFrame:
    """Rank of each listing within its coin by USD volume, as a ``rank`` column.

    Rows are parted by ranges of coin, volume and tie-break, whose bounds Spark samples, and sorted inside: a
    coin of any size, and any number of listings of one volume, is as many ranges as it needs. Numbered in that
    order, a listing's place in its range is known; its rank is that place, less that of its coin's
    first listing there, plus the coin's listings in the ranges before. These are counted per range and coin, so what is
    windowed by coin is one row a range. ``tie_break`` has to make the order unique. The
    placed rows are written once to the shared folder, as all counts have to see the same ranges.
    """
    order = [F.col("coin_id").asc_nulls_first(), *_listing_order(tie_break)]
    placed = listings.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits are the partition, the lower 33 the place in it.
    placed = staged(placed.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", 33).alias("__part")
    pieces = placed.groupBy("coin_id", part).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("coin_id").orderBy("__part")) - F.col("__n")
    pieces = pieces.select(F.col("coin_id").alias("__coin"), "__part", (before - F.col("__first") + 1).alias("__add"))
    same = placed["coin_id"].eqNullSafe(pieces["__coin"]) & (F.shiftright("__at", 33) == pieces["__part"])
    ranked = placed.join(pieces, same)
    return ranked.select(*listings.columns, (F.col("__at") + F.col("__add")).cast("int").alias("rank"))
