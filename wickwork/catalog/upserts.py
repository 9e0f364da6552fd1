"""Upsert, retention and delete queries.

The orders give both sides of an upsert: finished ones (status F) are what a table holds,
the others what a run brings.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from wickwork import layout, schemas as S
from wickwork.catalog import shapes
from wickwork.catalog.base import ctes, query
from wickwork.catalog.registry import matched_coins
from wickwork.catalog.shapes import COINS, LISTINGS, REGISTRY, SNAPSHOTS, SYMBOLS, latest_sql
from wickwork.layout import read_table
from wickwork.operators import registry, retention
from wickwork.operators.rollup import latest_per_key
from wickwork.operators.upsert import delete_where, upsert
from wickwork.plans.jobs import snapshot_changes, snapshot_rows, store_listings
from wickwork.session import new_folder
from wickwork.sinks.tables import append, create_table, delete_from_table, prune_table, upsert_table

_COLUMNS = S.SNAPSHOTS.names
_SELECT = ", ".join(_COLUMNS)
TARGET = latest_sql("target", "snapshots", "coin_id", "updated_at DESC, seq DESC", "status = 'F'")
SOURCE = latest_sql("source", "snapshots", "coin_id", "updated_at DESC, seq DESC", "status <> 'F'")


def newest():
    return [F.desc("updated_at"), F.desc("seq")]


def target_snapshots(spark, sf_dir):
    rows = shapes.snapshots(spark, sf_dir).filter("status = 'F'")
    return latest_per_key(rows, ["coin_id"], newest()).select(*_COLUMNS)


def source_snapshots(spark, sf_dir):
    return shapes.snapshots(spark, sf_dir).filter("status <> 'F'").drop("status")


def _merged_sql(changed: str, guard: str = "TRUE") -> str:
    """The result of an upsert as SQL: ``changed`` columns from the source where the guard holds."""
    changes = [c.strip() for c in changed.split(",")]
    out = ["coalesce(t.coin_id, s.coin_id) AS coin_id"]
    for c in _COLUMNS[1:]:
        matched = f"WHEN s.coin_id IS NOT NULL AND ({guard}) THEN s.{c} " if c in changes else ""
        out.append(f"CASE WHEN t.coin_id IS NULL THEN s.{c} {matched}ELSE t.{c} END AS {c}")
    return f"SELECT {', '.join(out)} FROM target t FULL OUTER JOIN source s ON t.coin_id = s.coin_id"


_ALL = ", ".join(_COLUMNS[1:])


@query("upsert_plain", ctes(SNAPSHOTS, TARGET, SOURCE) + _merged_sql(_ALL))
def upsert_plain(spark, sf_dir):
    return upsert(
        target_snapshots(spark, sf_dir), source_snapshots(spark, sf_dir), ["coin_id"], order_by=newest()
    )


_GUARD = "t.updated_at < s.updated_at"


@query(
    "upsert_guarded", ctes(SNAPSHOTS, TARGET, SOURCE) + _merged_sql("price_usd, updated_at, price_source", _GUARD)
)
def upsert_guarded(spark, sf_dir):
    return upsert(
        target_snapshots(spark, sf_dir),
        source_snapshots(spark, sf_dir),
        ["coin_id"],
        update=["price_usd", "updated_at", "price_source"],
        when=F.col("t.updated_at") < F.col("s.updated_at"),
        order_by=newest(),
    )


@query(
    "upsert_partial", ctes(SNAPSHOTS, TARGET, SOURCE) + _merged_sql("market_cap_usd, rank, change_percent_24h")
)
def upsert_partial(spark, sf_dir):
    return upsert(
        target_snapshots(spark, sf_dir),
        source_snapshots(spark, sf_dir),
        ["coin_id"],
        update=["market_cap_usd", "rank", "change_percent_24h"],
        order_by=newest(),
    )


@query(
    "upsert_guarded_table", ctes(SNAPSHOTS, TARGET, SOURCE) + _merged_sql("price_usd, updated_at, price_source", _GUARD)
)
def upsert_guarded_table(spark, sf_dir):
    """The guarded upsert against a stored table."""
    path = new_folder(spark, "snapshots")
    create_table(spark, path, layout.SNAPSHOTS)
    append(target_snapshots(spark, sf_dir), path, layout.SNAPSHOTS)
    upsert_table(
        path,
        source_snapshots(spark, sf_dir),
        layout.SNAPSHOTS,
        update=["price_usd", "updated_at", "price_source"],
        when=F.col("t.updated_at") < F.col("s.updated_at"),
        order_by=newest(),
    )
    return read_table(spark, path, layout.SNAPSHOTS).drop("part")


def _list_rows(spark, sf_dir):
    """The coin list: every customer's coin, its balance as cap and price."""
    coins = shapes.coins(spark, sf_dir)
    return coins.select(
        "coin_id",
        F.when(F.col("market_cap_usd") > 0, F.col("market_cap_usd").cast("decimal(24,10)")).alias("current_price"),
        "market_cap_usd",
        F.length("name").alias("rank"),
        F.lit(1).cast("decimal(10,4)").alias("change_percent_24h"),
    )


@query(
    "upsert_snapshots",
    ctes(
        COINS,
        SYMBOLS,
        REGISTRY,
        SNAPSHOTS,
        TARGET,
        """source AS (
      SELECT coin_id, CASE WHEN market_cap_usd > 0 THEN CAST(market_cap_usd AS DECIMAL(24,10)) ELSE 0 END AS price_usd,
        market_cap_usd, CAST(length(name) AS INTEGER) AS rank, CAST(1 AS DECIMAL(10,4)) AS change_percent_24h,
        TIMESTAMP '2001-08-01' AS updated_at, 'coingecko' AS price_source,
        binance_symbol IS NOT NULL AS tradeable FROM registry)""",
    )
    + """SELECT coalesce(t.coin_id, s.coin_id) AS coin_id,
      CAST(CASE WHEN t.coin_id IS NOT NULL AND (s.coin_id IS NULL OR s.tradeable) THEN t.price_usd ELSE s.price_usd END AS DECIMAL(24,10)) AS price_usd,
      CASE WHEN s.coin_id IS NOT NULL THEN s.market_cap_usd ELSE t.market_cap_usd END AS market_cap_usd,
      CASE WHEN s.coin_id IS NOT NULL THEN s.rank ELSE t.rank END AS rank,
      CASE WHEN s.coin_id IS NOT NULL THEN s.change_percent_24h ELSE t.change_percent_24h END AS change_percent_24h,
      CASE WHEN t.coin_id IS NOT NULL AND (s.coin_id IS NULL OR s.tradeable) THEN t.updated_at ELSE s.updated_at END AS updated_at,
      CASE WHEN t.coin_id IS NOT NULL AND (s.coin_id IS NULL OR s.tradeable) THEN t.price_source ELSE s.price_source END AS price_source
    FROM target t FULL OUTER JOIN source s ON t.coin_id = s.coin_id""",
)
def upsert_snapshots(spark, sf_dir):
    """Coin-list refresh of snapshots: tradeable coins keep price, time and source."""
    rows = snapshot_rows(_list_rows(spark, sf_dir), matched_coins(spark, sf_dir), shapes.ORDERS_AS_OF)
    return upsert(
        target_snapshots(spark, sf_dir), rows, ["coin_id"], update=snapshot_changes(), order_by=[F.lit(1)]
    )


# A stored registry: the coins of two segments, with their symbols, under older names.
_STORED = """
stored AS (
  SELECT coin_id, symbol, 'old ' || name AS name, binance_symbol FROM registry
  WHERE segment IN ('BUILDING', 'FURNITURE'))"""


def _stored_coins(spark, sf_dir):
    known = matched_coins(spark, sf_dir).filter(F.col("segment").isin("BUILDING", "FURNITURE"))
    return known.select("coin_id", "symbol", F.concat(F.lit("old "), "name").alias("name"), "binance_symbol")


@query(
    "upsert_coins_seed",
    ctes(COINS, SYMBOLS, REGISTRY, _STORED)
    + """SELECT coalesce(t.coin_id, s.coin_id) AS coin_id, s.symbol, s.name, s.binance_symbol
    FROM stored t FULL OUTER JOIN registry s ON t.coin_id = s.coin_id""",
)
def upsert_coins_seed(spark, sf_dir):
    source = matched_coins(spark, sf_dir).select(*S.COINS.names)
    return upsert(_stored_coins(spark, sf_dir), source, ["coin_id"], ["symbol", "name", "binance_symbol"])


@query(
    "upsert_coins_names",
    ctes(COINS, SYMBOLS, REGISTRY, _STORED)
    + """SELECT coalesce(t.coin_id, s.coin_id) AS coin_id, s.symbol, s.name, t.binance_symbol
    FROM stored t FULL OUTER JOIN registry s ON t.coin_id = s.coin_id""",
)
def upsert_coins_names(spark, sf_dir):
    """The recurring upsert: names change, exchange symbols stay as they were."""
    source = shapes.coins(spark, sf_dir).select("coin_id", "symbol", "name")
    return upsert(_stored_coins(spark, sf_dir), source, ["coin_id"], ["symbol", "name"])


_KEY = ", ".join(layout.MARKETS.keys)
_AFTER = "last_traded_at >= TIMESTAMP '1998-01-01'"


_MARKETS_SQL = (
    ctes(
        LISTINGS,
        latest_sql("target", "listings", _KEY, "coalesce(volume_usd_24h, 0), pos DESC", f"NOT ({_AFTER})"),
        latest_sql("source", "listings", _KEY, "coalesce(volume_usd_24h, 0), pos DESC", _AFTER),
        f"""merged AS (
      SELECT *, TIMESTAMP '2001-08-01' AS updated_at FROM source
      UNION ALL
      SELECT *, TIMESTAMP '1998-01-01' AS updated_at FROM target t
      WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.coin_id = t.coin_id AND s.exchange_id = t.exchange_id
        AND s.base_symbol = t.base_symbol AND s.target_symbol = t.target_symbol))""",
    )
    + f"SELECT {', '.join(S.MARKETS.names)} FROM merged"
)


@query("upsert_markets", _MARKETS_SQL)
def upsert_markets(spark, sf_dir):
    rows = shapes.listings(spark, sf_dir)
    late = F.col("last_traded_at") >= F.lit("1998-01-01").cast("timestamp")
    stored = registry.latest_listings(rows.filter(~late), list(layout.MARKETS.keys))
    stored = stored.withColumn("updated_at", F.lit("1998-01-01").cast("timestamp")).select(*S.MARKETS.names)
    fresh = registry.latest_listings(rows.filter(late), list(layout.MARKETS.keys))
    fresh = fresh.withColumn("updated_at", F.lit("2001-08-01").cast("timestamp"))
    return upsert(stored, fresh.drop("pos"), layout.MARKETS.keys)


@query("upsert_markets_table", _MARKETS_SQL)
def upsert_markets_table(spark, sf_dir):
    """The same against a stored table: two loads, of which the second rewrites nothing of the first."""
    path = new_folder(spark, "markets")
    create_table(spark, path, layout.MARKETS)
    late = F.col("last_traded_at") >= F.lit("1998-01-01").cast("timestamp")
    for which, at in ((~late, "1998-01-01"), (late, "2001-08-01")):
        rows = shapes.listings(spark, sf_dir).filter(which)
        store_listings(spark, path, rows.withColumn("updated_at", F.lit(at).cast("timestamp")))
    return read_table(spark, path, layout.MARKETS).drop("part")


_MARKET_CAP_SQL = """WITH points AS (
      SELECT CAST(o_custkey AS VARCHAR) AS coin_id, o_orderdate AS timestamp, o_orderstatus = 'F' AS stored,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS price_usd, o_orderkey AS seq FROM orders),
    best AS (SELECT *, row_number() OVER (PARTITION BY coin_id, timestamp ORDER BY stored, seq DESC) AS rn FROM points)
    SELECT coin_id, timestamp, price_usd, CAST(price_usd * 2 AS DECIMAL(38,9)) AS market_cap_usd,
      CAST(NULL AS DECIMAL(38,9)) AS total_volume_usd FROM best WHERE rn = 1"""


def _points(spark, sf_dir):
    o = shapes.table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("coin_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        shapes.amount("o_totalprice").alias("price_usd"),
        (F.col("o_totalprice").cast("decimal(18,2)") * 2).cast(S.MONEY).alias("market_cap_usd"),
        F.lit(None).cast(S.MONEY).alias("total_volume_usd"),
        F.col("o_orderkey").alias("seq"),
        "o_orderstatus",
    )


@query("upsert_market_cap", _MARKET_CAP_SQL)
def upsert_market_cap(spark, sf_dir):
    """Market-cap points merged by coin and time; of repeated points the later request's stays."""
    points = _points(spark, sf_dir)
    stored = latest_per_key(points.filter("o_orderstatus = 'F'"), ["coin_id", "timestamp"], [F.desc("seq")])
    return upsert(
        stored.select(*S.MARKET_CAP_HISTORY.names),
        points.filter("o_orderstatus <> 'F'"),
        ["coin_id", "timestamp"],
        order_by=[F.desc("seq")],
    )


@query("upsert_market_cap_table", _MARKET_CAP_SQL)
def upsert_market_cap_table(spark, sf_dir):
    """The same against a stored table, in two loads."""
    path, table = new_folder(spark, "market-caps"), layout.MARKET_CAP_HISTORY
    create_table(spark, path, table)
    for which in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        upsert_table(path, _points(spark, sf_dir).filter(which).drop("o_orderstatus"), table, order_by=[F.desc("seq")])
    return read_table(spark, path, table).drop(table.partition)


@query(
    "upsert_watermarks",
    """WITH t AS (SELECT CAST(o_custkey AS VARCHAR) AS coin_id, max(o_orderdate) AS m FROM orders
      WHERE o_orderstatus = 'F' GROUP BY 1),
    s AS (SELECT CAST(o_custkey AS VARCHAR) AS coin_id, max(o_orderdate) AS m FROM orders
      WHERE o_orderstatus <> 'F' GROUP BY 1)
    SELECT coalesce(t.coin_id, s.coin_id) AS coin_id, '1h' AS "interval",
      coalesce(s.m, t.m) AS last_loaded_close_time,
      CASE WHEN s.m IS NULL THEN TIMESTAMP '2001-01-01' ELSE TIMESTAMP '2001-08-01' END AS updated_at
    FROM t FULL OUTER JOIN s ON t.coin_id = s.coin_id""",
)
def upsert_watermarks(spark, sf_dir):
    def marks(condition: str, stamp: str):
        rows = shapes.snapshots(spark, sf_dir).filter(condition)
        return rows.groupBy("coin_id", F.lit("1h").alias("interval")).agg(
            F.max("updated_at").alias("last_loaded_close_time"), F.lit(stamp).cast("timestamp").alias("updated_at")
        )

    return upsert(
        marks("status = 'F'", "2001-01-01"), marks("status <> 'F'", "2001-08-01"), layout.WATERMARKS.keys
    )


_AS_OF = datetime(2000, 3, 31, 12)


@query(
    "prune_days",
    ctes(SNAPSHOTS) + "SELECT coin_id, updated_at, seq FROM snapshots WHERE updated_at >= TIMESTAMP '2000-03-21 12:00:00'",
)
def prune_days(spark, sf_dir):
    rows = shapes.snapshots(spark, sf_dir).select("coin_id", "updated_at", "seq")
    return retention.prune(rows, "updated_at", _AS_OF, days=retention.HOURLY_DAYS)


@query(
    "prune_months",
    ctes(SNAPSHOTS) + "SELECT coin_id, updated_at, seq FROM snapshots WHERE updated_at >= TIMESTAMP '1999-02-28 12:00:00'",
)
def prune_months(spark, sf_dir):
    rows = shapes.snapshots(spark, sf_dir).select("coin_id", "updated_at", "seq")
    return retention.prune(rows, "updated_at", _AS_OF, months=retention.DAILY_MONTHS)


_POINTS = """
points AS (
  SELECT CAST(o_custkey AS VARCHAR) AS coin_id, o_orderdate AS timestamp,
    max(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,9))) AS price_usd
  FROM orders GROUP BY 1, 2)"""


def _stored_points(spark, sf_dir) -> str:
    path = new_folder(spark, "points")
    create_table(spark, path, layout.MARKET_CAP_HISTORY)
    points = shapes.table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("coin_id"), F.col("o_orderdate").cast("timestamp").alias("timestamp")
    )
    append(points.agg(F.max(shapes.amount("o_totalprice")).alias("price_usd")), path, layout.MARKET_CAP_HISTORY)
    return path


@query(
    "prune_table",
    ctes(_POINTS) + "SELECT * FROM points WHERE timestamp >= TIMESTAMP '1999-02-28 12:00:00'",
)
def prune_stored(spark, sf_dir):
    """Retention on a stored table: old month partitions dropped, the edge month rewritten."""
    path = _stored_points(spark, sf_dir)
    prune_table(spark, path, layout.MARKET_CAP_HISTORY, _AS_OF, months=retention.DAILY_MONTHS)
    return read_table(spark, path, layout.MARKET_CAP_HISTORY).select("coin_id", "timestamp", "price_usd")


@query("delete_where", ctes(SNAPSHOTS) + f"SELECT {_SELECT} FROM snapshots WHERE price_source <> 'binance_rest'")
def delete_rows(spark, sf_dir):
    rows = shapes.snapshots(spark, sf_dir).select(*_COLUMNS)
    return delete_where(rows, F.col("price_source") == "binance_rest")


@query("delete_coin", ctes(_POINTS) + "SELECT * FROM points WHERE coin_id <> '1'")
def delete_coin(spark, sf_dir):
    """One coin's rows deleted from a stored table; only months that hold it are rewritten."""
    path = _stored_points(spark, sf_dir)
    delete_from_table(spark, path, layout.MARKET_CAP_HISTORY, F.col("coin_id") == "1")
    return read_table(spark, path, layout.MARKET_CAP_HISTORY).select("coin_id", "timestamp", "price_usd")
