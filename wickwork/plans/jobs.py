"""The jobs that keep the tables current.

All of them may be run again with the same input, or overlap a slow earlier run: bronze
takes further versions, everything else is written by key.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wickwork import layout, schemas as S
from wickwork.functions.times import at, trunc
from wickwork.layout import Layout, read_table, time_range
from wickwork.operators import incremental, registry, retention, rollup, serving
from wickwork.operators.backfill import work_grid
from wickwork.operators.quality import is_sane, job_counters
from wickwork.operators.series import align_series
from wickwork.session import staged, staging
from wickwork.sinks.files import load_ndjson, stage_ndjson
from wickwork.sinks.tables import (
    append,
    create_table,
    delete_from_table,
    drop_partitions_except,
    partition_values,
    prune_table,
    touched_partitions,
    upsert_table,
    write_partitions,
)
from wickwork.sources import archive, landed
from wickwork.sources.tables import first_coins
from wickwork.plans.follow import follow_gold, follow_silver
from wickwork.streaming.events import merge_into_silver
from wickwork.versions import NO_VALUE, append_versions, compact, drop_deltas, note_change, read_deltas, stored_numbers


@dataclass(frozen=True)
class Tables:
    """Paths of the tables under one root."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def layouts(self) -> dict[str, Layout]:
        return {
            "bronze_candles": layout.BRONZE,
            "silver_candles": layout.SILVER,
            "hourly_candle_metrics": layout.GOLD_HOURLY,
            "daily_candle_metrics": layout.GOLD_DAILY,
            "market_cap_history": layout.MARKET_CAP_HISTORY,
            "coins": layout.COINS,
            "coin_snapshots": layout.SNAPSHOTS,
            "markets": layout.MARKETS,
            "ingestion_watermarks": layout.WATERMARKS,
            "candle_rollups_hourly": layout.ROLLUPS_HOURLY,
            "candle_rollups_daily": layout.ROLLUPS_DAILY,
        }

    def create(self, spark: SparkSession) -> None:
        for name, table in self.layouts.items():
            create_table(spark, self.path(name), table)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self.path(name), self.layouts[name])


GOLD_NAME = {"hour": "hourly_candle_metrics", "day": "daily_candle_metrics"}
ROLLUP_NAME = {"hour": "candle_rollups_hourly", "day": "candle_rollups_daily"}


def _last_in_list() -> list:
    """Of a coin listed twice, the later entry of the list, which is sorted by cap, stays."""
    return [F.asc_nulls_first("market_cap_usd")]


def candle_work_list(spark: SparkSession, tables: Tables, as_of: datetime, interval: str = "1h") -> DataFrame:
    """Coins with an exchange symbol and the time to read each from."""
    coins = tables.read(spark, "coins").filter(F.col("binance_symbol").isNotNull()).select("coin_id", "binance_symbol")
    return incremental.fetch_start(coins, tables.read(spark, "ingestion_watermarks"), as_of, interval)


def ingest_candles(
    spark: SparkSession, tables: Tables, raw: DataFrame, as_of: datetime, interval: str = "1h"
) -> dict[str, int]:
    """Landed candle responses (``coin_id, body``) into bronze, watermarks and snapshot prices.

    The order matters: bronze first, then the watermarks, so that a failed load never moves
    a watermark past rows that were not stored. Returns counters, the responses that were
    not JSON among them.
    """
    parsed = landed.parse_klines(raw, interval, as_of)
    with staging(parsed.withColumn("sane", is_sane(parsed)), "candles") as rows:
        kept = rows.filter("sane")
        append(kept, tables.path("bronze_candles"), layout.BRONZE)

        marks = incremental.new_watermarks(kept).withColumn("updated_at", at(as_of))
        upsert_table(tables.path("ingestion_watermarks"), marks, layout.WATERMARKS)

        prices = incremental.latest_closed(rollup.silver(kept), as_of)
        prices = prices.withColumn("price_source", F.lit(S.EXCHANGE_PRICE_SOURCE))
        newer = F.col("t.updated_at") < F.col("s.updated_at")
        upsert_table(tables.path("coin_snapshots"), prices, layout.SNAPSHOTS, when=newer)

        counts = job_counters(rows, {"kept": F.col("sane"), "skipped": ~F.col("sane")}).first().asDict()
    counts["failed"] = landed.unparsed(raw, S.KLINE_BATCH).count()
    return counts


def rebuild_silver(spark: SparkSession, tables: Tables) -> None:
    """Silver from all of bronze, in one pass. Days that bronze no longer has go, and so do all versions beside silver."""
    bronze = tables.read(spark, "bronze_candles").drop("month")
    path = tables.path("silver_candles")
    beside, before = stored_numbers(spark, path), partition_values(spark, path, layout.SILVER)
    write_partitions(rollup.silver(bronze), path, layout.SILVER, clustered=True)
    days = touched_partitions(bronze.select(layout.SILVER.partition_value().alias("date")), layout.SILVER)
    drop_partitions_except(spark, path, layout.SILVER, days)
    drop_deltas(spark, path, beside)
    note_change(spark, path, list({*before, *[NO_VALUE if d is None else str(d) for d in days]}))


def refresh_silver(
    spark: SparkSession, tables: Tables, since: datetime, published_after: datetime | None = None
) -> list[date]:
    """Append bronze versions of candles from ``since`` on to silver; returns the days that changed.

    ``since`` bounds candles by open time, which bronze partitions prune by, and
    ``published_after`` versions by publish time; versions without one are always merged, as
    merging again changes nothing. With nothing new in bronze nothing is written.
    """
    bronze = time_range(tables.read(spark, "bronze_candles"), "open_time", since)
    if published_after is not None:
        bronze = bronze.filter(F.col("publish_time").isNull() | (F.col("publish_time") > at(published_after)))
    written = merge_into_silver(bronze.drop("month"), tables.path("silver_candles"))
    return [None if v == NO_VALUE else date.fromisoformat(v) for v in written.partitions] if written else []


def compact_tables(spark: SparkSession, tables: Tables) -> dict[str, int]:
    """Fold appended versions into silver and gold; returns the number of partitions rewritten of each."""
    names = [name for name, table in tables.layouts.items() if table.versions]
    return {name: len(compact(spark, tables.path(name), tables.layouts[name])) for name in names}


def delete_candles(spark: SparkSession, tables: Tables, condition: Column, as_of: datetime) -> dict[str, int]:
    """Delete candles from bronze, and from silver by tombstones published at ``as_of``; returns rows deleted of each.

    A tombstone outranks the version that it deletes and all others published up to ``as_of``, those that come later
    included. Gold and serving take the change over by ``propagate``.
    """
    deleted = delete_from_table(spark, tables.path("bronze_candles"), layout.BRONZE, condition)
    path = tables.path("silver_candles")
    gone = tables.read(spark, "silver_candles").where(F.coalesce(condition, F.lit(False)))
    published = F.greatest(at(as_of), F.col("latest_publish_time")).alias("latest_publish_time")
    gone = gone.select(*layout.SILVER.keys, published, F.lit(True).alias("deleted"))
    written = append_versions(gone, path, layout.SILVER)
    return {"bronze": deleted, "silver": read_deltas(spark, path, layout.SILVER, [written.number]).count() if written else 0}


def propagate(spark: SparkSession, tables: Tables, unit: str, as_of: datetime, interval: str = "1h") -> dict[str, int]:
    """Take what changed in silver over into gold and serving, deletions included; returns serving rows upserted and deleted."""
    gold = tables.path(GOLD_NAME[unit])
    follow_silver(spark, tables.path("silver_candles"), gold, unit)
    return follow_gold(spark, gold, tables.path(ROLLUP_NAME[unit]), unit, as_of, interval)


def rebuild_gold(
    spark: SparkSession,
    tables: Tables,
    unit: str,
    as_of: datetime | None = None,
    lookback: timedelta | None = None,
) -> None:
    """Rebuild a gold table: all of it, or the days the lookback reaches into when ``as_of`` is given.

    Whole days are rebuilt because a day is the unit that is replaced; rebuilt days that silver
    no longer has go.
    """
    silver = tables.read(spark, "silver_candles")
    since = ""
    if as_of is not None:
        first = trunc(rollup.lookback_start(as_of, unit, lookback), "day")
        silver = time_range(silver, "open_time", first)
        since = first.strftime("%Y-%m-%d")
    path, gold = tables.path(GOLD_NAME[unit]), layout.GOLD[unit]
    compact(spark, path, gold)
    before = [v for v in partition_values(spark, path, gold) if v >= since]
    write_partitions(rollup.ohlcv(silver, unit), path, gold)
    days = touched_partitions(silver, layout.SILVER)
    drop_partitions_except(spark, path, gold, days, since)
    note_change(spark, path, list({*before, *[NO_VALUE if d is None else str(d) for d in days]}))


def sync_serving(
    spark: SparkSession,
    tables: Tables,
    unit: str,
    as_of: datetime,
    interval: str = "1h",
    lookback: timedelta | None = None,
) -> dict[str, int]:
    """Recent gold buckets into the serving table, then the retention limit; returns rows upserted and pruned."""
    gold = tables.read(spark, GOLD_NAME[unit])
    target = layout.ROLLUPS[unit]
    path = tables.path(ROLLUP_NAME[unit])
    upserted = upsert_table(path, serving.to_serving(gold, unit, as_of, interval, lookback), target)
    limit = {"days": retention.HOURLY_DAYS} if unit == "hour" else {"months": retention.DAILY_MONTHS}
    return {"upserted": upserted, "pruned": prune_table(spark, path, target, as_of, **limit)}


def seed_coins(
    spark: SparkSession, tables: Tables, raw_list: DataFrame, raw_symbols: DataFrame, n: int = registry.TOP_N
) -> dict[str, int]:
    """Top coins with their exchange symbols into ``coins``; returns how many matched."""
    coins = registry.top_coins(landed.parse_markets(raw_list), n)
    pairs = registry.trading_pairs(landed.parse_symbols(raw_symbols))
    found = F.col("binance_symbol").isNotNull()
    with staging(registry.match_symbols(coins, pairs), "seed") as matched:
        upsert_table(
            tables.path("coins"),
            matched.select(*S.COINS.names, "market_cap_usd"),
            layout.COINS,
            order_by=_last_in_list(),
        )
        return job_counters(matched, {"matched": found, "unmatched": ~found}).first().asDict()


def snapshot_changes() -> dict:
    """What a coin-list refresh changes in a known snapshot.

    A tradeable coin keeps its price, the price's time and its writer: those belong to the
    exchange feed. Any other coin has no second writer, so everything is taken over.
    """

    def unless_tradeable(name: str):
        return F.when(F.col("s.tradeable"), F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))

    return {
        "market_cap_usd": F.col("s.market_cap_usd"),
        "rank": F.col("s.rank"),
        "change_percent_24h": F.col("s.change_percent_24h"),
        "price_usd": unless_tradeable("price_usd"),
        "updated_at": unless_tradeable("updated_at"),
        "price_source": unless_tradeable("price_source"),
    }


def snapshot_rows(markets: DataFrame, coins: DataFrame, as_of: datetime) -> DataFrame:
    """Coin-list rows as snapshot rows with a ``tradeable`` flag; a missing price is zero."""
    return registry.flag_tradeable(markets, coins).select(
        "coin_id",
        F.coalesce("current_price", F.lit(0)).cast("decimal(24,10)").alias("price_usd"),
        "market_cap_usd",
        "rank",
        "change_percent_24h",
        at(as_of).alias("updated_at"),
        F.lit(S.LIST_PRICE_SOURCE).alias("price_source"),
        "tradeable",
    )


def refresh_coins(
    spark: SparkSession,
    tables: Tables,
    raw_list: DataFrame,
    as_of: datetime,
    n: int = registry.TOP_N,
    raw_tickers: DataFrame | None = None,
    listings_hour: int = 0,
) -> dict[str, int]:
    """The coin list into ``coins`` and ``coin_snapshots``, and once a day the listings into ``markets``.

    Exchange symbols already known are kept. Returns how many coins and listings were
    upserted, and how many listing responses were not JSON.
    """
    with staging(registry.top_coins(landed.parse_markets(raw_list), n), "coin-list") as markets:
        coins = upsert_table(
            tables.path("coins"),
            markets.select("coin_id", "symbol", "name", "market_cap_usd"),
            layout.COINS,
            update=["symbol", "name"],
            order_by=_last_in_list(),
        )
        rows = snapshot_rows(markets, tables.read(spark, "coins"), as_of)
        upsert_table(
            tables.path("coin_snapshots"), rows, layout.SNAPSHOTS, update=snapshot_changes(), order_by=_last_in_list()
        )
    counts = {"coins": coins, "listings": 0, "failed": 0}
    if raw_tickers is not None and incremental.due(as_of, listings_hour):
        listings = landed.parse_tickers(raw_tickers).withColumn("updated_at", at(as_of))
        counts["listings"] = store_listings(spark, tables.path("markets"), listings)
        counts["failed"] = landed.unparsed(raw_tickers, S.TICKERS).count()
    return counts


def store_listings(spark: SparkSession, path: str, listings: DataFrame) -> int:
    """The latest of each listing, whole rows, into the listings table; returns their number.

    A load is appended and rewrites no group of the table; reading keeps the newest load's row of a listing.
    """
    keys = list(layout.MARKETS.keys)
    latest = registry.latest_listings(listings.dropna(subset=keys), keys).drop("pos")
    written = append_versions(latest, path, layout.MARKETS)
    return read_deltas(spark, path, layout.MARKETS, [written.number]).count() if written else 0


def backfill_candles(
    spark: SparkSession,
    tables: Tables,
    archive_path: str,
    staging_path: str,
    as_of: datetime,
    interval: str = "1h",
    limit_coins: int | None = None,
) -> DataFrame:
    """Archived candles of every registered coin, through JSON lines, into bronze.

    Returns files and rows loaded per coin. Running it twice adds versions to bronze that
    silver reduces.
    """
    coins = tables.read(spark, "coins").filter(F.col("binance_symbol").isNotNull()).select("coin_id", "binance_symbol")
    coins = first_coins(coins, limit_coins)
    named = F.col("symbol") == F.col("binance_symbol")
    keys = archive.select_archive_files(archive.archive_keys(spark, archive_path))
    keys = keys.filter(F.col("interval") == interval).join(coins, named)
    with staging(keys.select("key", "coin_id"), "archive-keys") as wanted:
        lines = archive.read_kline_archive(spark, archive_path, wanted).withColumnRenamed("path", "key")
        lines = archive.key_parts(lines).join(coins, named)
        stage_ndjson(landed.archive_to_bronze(lines, interval, as_of), staging_path)
        load_ndjson(spark, f"{staging_path}/*/*", tables.path("bronze_candles"))
        files = staged(wanted.groupBy("coin_id").agg(F.count("*").alias("files")), "backfill-files")
    rows = spark.read.text(staging_path).groupBy(F.col("coin_id").cast("string")).agg(F.count("*").alias("rows"))
    return files.join(rows, "coin_id", "left").na.fill(0, ["rows"])


def backfill_market_caps(spark: SparkSession, tables: Tables, raw: DataFrame) -> None:
    """Landed series responses (``coin_id, body`` and optionally ``request``) into the history table.

    Where two responses of a coin share a timestamp, the later request's values stay.
    """
    aligned = align_series(landed.parse_series(raw))
    rows = landed.series_to_history(aligned)
    upsert_table(
        tables.path("market_cap_history"), rows, layout.MARKET_CAP_HISTORY, order_by=[F.desc("request")]
    )


def backfill_requests(spark: SparkSession, tables: Tables, end: date, total_days: int, limit_coins: int | None = None):
    """The requests a market-cap backfill makes: each coin with each window."""
    coins = first_coins(tables.read(spark, "coins").select("coin_id"), limit_coins)
    return work_grid(coins, end, total_days)
