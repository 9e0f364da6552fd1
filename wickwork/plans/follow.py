"""Tables that follow another by its change feed: gold follows silver, serving follows gold.

A follower keeps the number of the last change it has taken over, beside its own table. A run reads
the records after it, recomputes what they name and appends it. The number moves last, so a run that is
lost is done again, with the same result.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wickwork import layout
from wickwork.functions.times import bucket
from wickwork.layout import Layout, read_table
from wickwork.operators import rollup, serving
from wickwork.session import staging
from wickwork.sinks.tables import delete_keys, upsert_table
from wickwork.versions import Delta, append_versions, feed, in_values, position, read_deltas, set_position


def _changed(spark: SparkSession, path: str, table: Layout, deltas: list[Delta], follower: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Versions of the deltas that are stored; and where some are folded in, all rows of their partitions, here and in the follower."""
    versions = read_deltas(spark, path, table, [d.number for d in deltas if d.stored])
    folded = {v for d in deltas if not d.stored for v in d.partitions}
    if not folded:
        return versions, None
    whole = read_table(spark, path, table).where(in_values(table, folded))
    return versions, whole.unionByName(follower.where(in_values(table, folded)), allowMissingColumns=True)


def follow_silver(spark: SparkSession, silver_path: str, gold_path: str, unit: str) -> Delta | None:
    """Roll up again the buckets of candles that changed since the last run; those without candles are deleted.

    A change whose versions have been folded into silver names whole days, and all their buckets are done.
    """
    gold = layout.GOLD[unit]
    deltas = feed(spark, silver_path, position(spark, gold_path, silver_path))
    if not deltas:
        return None
    keys = ["coin_id", "interval", unit]
    versions, folded = _changed(spark, silver_path, layout.SILVER, deltas, read_table(spark, gold_path, gold))
    changed = versions.select("coin_id", "interval", bucket(versions, "open_time", unit).alias(unit))
    if folded is not None:
        changed = changed.unionByName(folded.select("coin_id", "interval", F.coalesce(unit, bucket(folded, "open_time", unit)).alias(unit)))
    days = {v for d in deltas for v in d.partitions}
    candles = read_table(spark, silver_path, layout.SILVER).where(in_values(layout.SILVER, days))
    bars = rollup.bars_of(changed.select(*keys).distinct(), candles, unit)
    written = append_versions(bars, gold_path, gold)
    set_position(spark, gold_path, silver_path, deltas[-1].number)
    return written


def follow_gold(spark: SparkSession, gold_path: str, serving_path: str, unit: str, as_of: datetime, interval: str = "1h") -> dict[str, int]:
    """Take over into serving the bars that changed since the last run; returns rows upserted and deleted."""
    gold, target = layout.GOLD[unit], layout.ROLLUPS[unit]
    deltas = feed(spark, gold_path, position(spark, serving_path, gold_path))
    if not deltas:
        return {"upserted": 0, "deleted": 0}
    stored = read_table(spark, serving_path, target).select("coin_id", F.lit(interval).alias("interval"), F.col("bucket_start").alias(unit))
    stored = stored.withColumn(gold.partition, F.to_date(unit))
    versions, folded = _changed(spark, gold_path, gold, deltas, stored)
    keys = ["coin_id", "interval", unit]
    changed = versions.select(*keys) if folded is None else versions.select(*keys).unionByName(folded.select(*keys))
    changed = changed.where(F.col("interval") == interval).distinct()
    days = {v for d in deltas for v in d.partitions}
    current = read_table(spark, gold_path, gold).where(in_values(gold, days))
    with staging(changed.join(current.withColumn("there", F.lit(True)), keys, "left"), "changed-bars") as bars:
        there = bars.where("there")
        gone = bars.where("there is null").select("coin_id", F.col(unit).alias("bucket_start"))
        upserted = upsert_table(serving_path, serving.serving_rows(there, unit, as_of), target)
        deleted = delete_keys(spark, serving_path, target, gone)
    set_position(spark, serving_path, gold_path, deltas[-1].number)
    return {"upserted": upserted, "deleted": deleted}
