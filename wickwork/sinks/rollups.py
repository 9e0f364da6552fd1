"""Stored metric rollups, each with a manifest of what it covers."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wickwork.functions.times import at, utc
from wickwork.layout import Layout, read_table, time_range
from wickwork.operators.metrics import Covered, Model, Range, Rollup, build_range, build_rollup, covered_range
from wickwork.session import file_system, remove
from wickwork.versions import NO_VALUE, feed, newest, read_lines, write_lines


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}-manifest/covers"


def _read_manifest(spark: SparkSession, path: str) -> dict | None:
    fs, p = file_system(spark, _manifest(path))
    return json.loads(read_lines(spark, _manifest(path))[0]) if fs.exists(p) else None


def _withdraw(spark: SparkSession, path: str) -> dict:
    """Take the manifest away, so that the rollup answers nothing while it is rewritten; returns what it said."""
    said = _read_manifest(spark, path) or {}
    remove(spark, _manifest(path))
    return said


def _note(spark: SparkSession, path: str, rollup: Rollup, as_of: datetime, parts: dict[str, dict], followed: int) -> None:
    first, last = covered_range(rollup, as_of)
    said = {
        "built_at": utc(as_of).isoformat(),
        "from": first and first.isoformat(),
        "to": last.isoformat(),
        "followed": followed,
        "parts": parts,
    }
    write_lines(spark, _manifest(path), [json.dumps(said)])


def write_rollup(
    table: DataFrame,
    model: Model,
    name: str,
    path: str,
    as_of: datetime,
    changed_since: datetime | None = None,
) -> list | None:
    """Build a rollup into ``path``, partitioned by time and sorted by coin inside each file.

    With ``changed_since`` only the partitions that hold a row published after it are
    rebuilt; with no such row no rows are written. Returns the rebuilt partitions, or None
    for a full build. ``refresh_rollup`` finds the changed partitions without a scan.
    """
    rollup = model.rollups[name]
    part = _part(rollup)
    if changed_since is None:
        _rebuild(table, model, name, path, as_of, None, 0)
        return None
    newer = table.filter(F.col("latest_publish_time") > at(changed_since))
    # One value per month or year of the table.
    changed = sorted(r[0] for r in newer.select(part.alias("part")).distinct().collect())
    _rebuild(table, model, name, path, as_of, changed, 0)
    return changed


def refresh_rollup(
    spark: SparkSession, source: str, layout: Layout, model: Model, name: str, path: str, as_of: datetime
) -> list | None:
    """Bring a stored rollup up to ``as_of`` from the change feed of its table; returns the rebuilt partitions, None for all.

    The manifest holds the number in the feed up to which the rollup has followed the table. Only the partitions that later
    records reach into are read and rebuilt. Without a manifest everything is built.
    """
    said, now = _read_manifest(spark, path), newest(spark, source)
    table = read_table(spark, source, layout)
    if said is None:
        _rebuild(table, model, name, path, as_of, None, now)
        return None
    days = {v for d in feed(spark, source, said["followed"]) if d.number <= now for v in d.partitions} - {NO_VALUE}
    unit = model.rollups[name].partition_granularity
    starts = {date.fromisoformat(v).replace(day=1) for v in days}
    changed = sorted({d.replace(month=1) if unit == "year" else d for d in starts})
    _rebuild(table, model, name, path, as_of, changed, now)
    return changed


def _part(rollup: Rollup) -> Column:
    return F.to_date(F.date_trunc(rollup.partition_granularity, F.col(rollup.time_dimension)))


def _rebuild(table: DataFrame, model: Model, name: str, path: str, as_of: datetime, changed: list | None, followed: int) -> None:
    """Replace the partitions ``changed`` (None: all), drop those that are no longer covered or have no rows, state what is covered."""
    spark, rollup = table.sparkSession, model.rollups[name]
    ts = rollup.time_dimension
    said = _withdraw(spark, path)
    parts = said.get("parts", {}) if changed is not None else {}
    built: set[str] = set()
    if changed is None or changed:
        if changed is not None:
            inside = time_range(table, ts, datetime(changed[0].year, changed[0].month, 1), _after(changed[-1], rollup))
            if "date" in table.columns:
                # Scans only the days of the changed partitions, also between the first and the last.
                inside = inside.filter(F.to_date(F.date_trunc(rollup.partition_granularity, F.col("date"))).isin(changed))
            table = inside.filter(_part(rollup).isin(changed))
        rows = build_rollup(table, model, name, as_of)
        (
            rows.hint("rebalance", F.col("part"))
            .sortWithinPartitions("part", "coin_id", ts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("part")
            .parquet(path)
        )
        published = F.max("latest_publish_time").cast("string") if "latest_publish_time" in table.columns else F.lit(None).cast("string")
        for value, seen in table.groupBy(_part(rollup).cast("string").alias("part")).agg(published).collect():
            built.add(str(value))
            parts[str(value)] = {"built_at": utc(as_of).isoformat(), "newest": seen}
    oldest = None
    if rollup.build_months is not None:
        first = build_range(rollup, as_of)[0].date()
        oldest = first.replace(day=1) if rollup.partition_granularity == "month" else first.replace(month=1, day=1)
    rewritten = None if changed is None else {str(c) for c in changed}
    for value in _stored_parts(spark, path):
        empty = value not in built and (rewritten is None or value in rewritten)
        if empty or (oldest is not None and value != NO_VALUE and date.fromisoformat(value) < oldest):
            remove(spark, f"{path}/part={value}")
            parts.pop(value, None)
    _note(spark, path, rollup, as_of, parts, followed)


def _after(part: date, rollup: Rollup) -> datetime:
    """The end of a partition."""
    start = datetime(part.year, part.month, 1)
    return start.replace(year=start.year + 1) if rollup.partition_granularity == "year" else (start + timedelta(days=31)).replace(day=1)


def _stored_parts(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [n[5:] for n in names if n.startswith("part=")]


def rollup_built_at(spark: SparkSession, path: str) -> datetime:
    """When a stored rollup was last built or refreshed, in UTC."""
    said = _read_manifest(spark, path)
    if said is None:
        raise FileNotFoundError(f"no manifest of {path}")
    return datetime.fromisoformat(said["built_at"])


def read_rollup(table: DataFrame, model: Model, name: str, path: str, source: str | None = None) -> Covered:
    """A stored rollup of ``table`` under the schema its model gives it, with what its manifest says it covers.

    With ``source``, the path of the table, days that its feed says have changed since are not covered. Without a manifest
    nothing is.
    """
    spark = table.sparkSession
    rows = spark.read.schema(build_rollup(table, model, name, datetime(2000, 1, 1)).schema).parquet(path)
    said = _read_manifest(spark, path)
    if said is None:
        return Covered(rows, ())
    ranges: list[Range] = [(said["from"] and datetime.fromisoformat(said["from"]), datetime.fromisoformat(said["to"]))]
    if source is not None:
        changed = {v for d in feed(spark, source, said["followed"]) for v in d.partitions} - {NO_VALUE}
        for day in sorted(changed):
            start = datetime.fromisoformat(day)
            ranges = [p for r in ranges for p in _without(r, start, start + timedelta(days=1))]
    return Covered(rows, tuple(ranges))


def _without(whole: Range, start: datetime, end: datetime) -> list[Range]:
    first, last = whole
    if (first is not None and end <= first) or (last is not None and start >= last):
        return [whole]
    left = [(first, start)] if first is None or first < start else []
    return left + ([(end, last)] if last is None or end < last else [])
