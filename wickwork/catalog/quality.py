"""Checks, counters and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickwork.catalog import shapes
from wickwork.catalog.base import ctes, query
from wickwork.catalog.shapes import BRONZE, COINS, SANE, SNAPSHOTS
from wickwork.operators import alerts, quality
from wickwork.schemas import NOT_NULL, PRIMARY_KEY


@query(
    "not_null_check",
    ctes(
        SNAPSHOTS,
        """seen AS (
      SELECT coin_id, CASE WHEN status <> 'P' THEN price_usd END AS price_usd, updated_at FROM snapshots)""",
    )
    + """SELECT 'coin_id' AS column_name, count(*) FILTER (WHERE coin_id IS NULL) AS violations FROM seen
    UNION ALL SELECT 'price_usd', count(*) FILTER (WHERE price_usd IS NULL) FROM seen
    UNION ALL SELECT 'updated_at', count(*) FILTER (WHERE updated_at IS NULL) FROM seen""",
)
def not_null_check(spark, sf_dir):
    rows = shapes.snapshots(spark, sf_dir)
    rows = rows.withColumn("price_usd", F.when(F.col("status") != "P", F.col("price_usd")))
    return quality.check_not_null(rows, NOT_NULL["coin_snapshots"])


@query(
    "pk_dupes",
    ctes(BRONZE)
    + 'SELECT coin_id, "interval", open_time, count(*) AS row_count FROM bronze GROUP BY 1, 2, 3 HAVING count(*) > 1',
)
def pk_dupes(spark, sf_dir):
    return quality.check_unique(shapes.bronze(spark, sf_dir), PRIMARY_KEY["silver_candles"])


@query("domain_check", ctes(COINS) + "SELECT coin_id, segment FROM coins WHERE segment NOT IN ('BUILDING', 'MACHINERY')")
def domain_check(spark, sf_dir):
    coins = shapes.coins(spark, sf_dir).select("coin_id", "segment")
    return quality.check_domain(coins, "segment", ["BUILDING", "MACHINERY"])


@query(
    "fk_orphans",
    ctes(SNAPSHOTS, COINS)
    + """SELECT s.coin_id, seq FROM snapshots s
    WHERE s.coin_id NOT IN (SELECT coin_id FROM coins WHERE segment <> 'FURNITURE')""",
)
def fk_orphans(spark, sf_dir):
    parents = shapes.coins(spark, sf_dir).filter("segment <> 'FURNITURE'")
    return quality.orphans(shapes.snapshots(spark, sf_dir).select("coin_id", "seq"), parents, "coin_id")


@query(
    "job_counters",
    ctes(BRONZE)
    + f"""SELECT count(*) AS rows, count(*) FILTER (WHERE {SANE}) AS kept,
      count(*) FILTER (WHERE NOT ({SANE})) AS skipped FROM bronze""",
)
def job_counters(spark, sf_dir):
    rows = shapes.bronze(spark, sf_dir)
    ok = quality.is_sane(rows)
    return quality.job_counters(rows, {"kept": ok, "skipped": ~ok})


def _samples(spark, sf_dir):
    """Events as monitoring samples: the type names the subscription, value and metric from the event."""
    return shapes.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("subscription_id"),
        F.lit("oldest_unacked_message_age").alias("metric"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("user_id") * 10).cast("double").alias("value"),
    )


def _alert_sql(aggregate: str, threshold: int, hold: int) -> str:
    windows = f"""WITH w AS (
      SELECT event_type AS subscription_id, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, {aggregate} AS value
      FROM events GROUP BY 1, 2 HAVING {aggregate} > {threshold})"""
    if hold == 1:
        return windows + " SELECT * FROM w"
    return (
        windows
        + """ SELECT a.* FROM w a JOIN w b ON a.subscription_id = b.subscription_id
      AND b.window_start = a.window_start - INTERVAL 5 MINUTE"""
    )


@query("lag_alert", _alert_sql("max(CAST(user_id * 10 AS DOUBLE))", 600, 2))
def lag_alert(spark, sf_dir):
    return alerts.threshold_alert(_samples(spark, sf_dir), **alerts.LAG_RULE)


@query("dlq_alert", _alert_sql("sum(CAST(event_id % 3 AS DOUBLE))", 0, 1))
def dlq_alert(spark, sf_dir):
    e = shapes.table(spark, sf_dir, "events")
    samples = e.select(
        F.col("event_type").alias("subscription_id"),
        F.lit("dead_letter_message_count").alias("metric"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_id") % 3).cast("double").alias("value"),
    )
    return alerts.threshold_alert(samples, **alerts.DEAD_LETTER_RULE)
