"""Writes to partitioned parquet tables.

Plain parquet has no MERGE or DELETE. Every change here recomputes the partitions it
touches and replaces them with a dynamic partition overwrite, whose new files only take the
place of the old ones when the whole job has succeeded; a lost executor re-runs its tasks
from files that are still there. All changes are keyed, so a rerun ends in the same table.
A table takes one writer at a time. Deltas beside a table (``wickwork.versions``) are folded in before a
change in place.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wickwork.layout import Layout, read_table
from wickwork.operators.retention import cutoff
from wickwork.operators.upsert import delete_where, upsert
from wickwork.session import file_system, remove, staging
from wickwork.versions import NO_VALUE, compact

_log = logging.getLogger(__name__)


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def create_table(spark: SparkSession, path: str, layout: Layout) -> None:
    """An empty table, unless there is one already: a folder, as the schema is the layout's."""
    fs, p = file_system(spark, path)
    if not fs.mkdirs(p):
        raise OSError(f"cannot create {path} for {layout.partition} partitions")


def partition_values(spark: SparkSession, path: str, layout: Layout) -> list[str]:
    """Partition values of a table, from its directory names."""
    fs, p = file_system(spark, path)
    prefix = layout.partition + "="
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(n[len(prefix) :] for n in names if n.startswith(prefix))


def write_partitions(df: DataFrame, path: str, layout: Layout, clustered: bool = False) -> None:
    """Replace exactly the partitions ``df`` has rows for, in the table's own files; ``clustered`` for large rewrites."""
    shaped = df if layout.partition in df.columns else layout.shaped(df)
    (
        layout.sorted_for_write(shaped, clustered)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(layout.partition)
        .parquet(path)
    )


def append(df: DataFrame, path: str, layout: Layout) -> None:
    """Append rows to a table that has to exist: a misspelt path is an error, not a new table.

    One write for the whole run, whatever number of coins it covers.
    """
    if not table_exists(df.sparkSession, path):
        raise FileNotFoundError(f"no table at {path}")
    shaped = layout.shaped(df)
    layout.sorted_for_write(shaped).write.mode("append").partitionBy(layout.partition).parquet(path)


def drop_partitions_except(spark: SparkSession, path: str, layout: Layout, kept: list, since: str = "") -> None:
    """Remove the partitions from ``since`` on (a directory value) that ``kept`` does not name."""
    names = {NO_VALUE if v is None else str(v) for v in kept}
    for value in partition_values(spark, path, layout):
        reached = not since if value == NO_VALUE else value >= since
        if reached and value not in names:
            remove(spark, f"{path}/{layout.partition}={value}")


def touched_partitions(df: DataFrame, layout: Layout) -> list:
    """Distinct partition values of ``df``: one per directory of the table, never one per row."""
    return [r[0] for r in df.select(layout.partition).distinct().collect()]


def upsert_table(
    path: str,
    source: DataFrame,
    layout: Layout,
    update: Sequence[str] | Mapping[str, Column] | None = None,
    when: Column | None = None,
    order_by: Sequence[Column] | None = None,
) -> int:
    """Merge ``source`` into the table by the layout's key, rewriting only the partitions it touches.

    Columns of the table that the source lacks are null in inserted rows and unchanged in
    updated ones. Source rows without a whole key have no place in the table: they are rejected
    before the write and their number is logged. Returns the number of source rows merged.
    """
    spark = source.sparkSession
    present = [c for c in layout.schema.names if c in source.columns]
    if update is None:
        update = [c for c in present if c not in layout.keys]
    keyed = source.withColumn(layout.partition, layout.partition_value())
    compact(spark, path, layout)
    with staging(keyed, "upsert") as staged:
        rows = staged.dropna(subset=list(layout.keys))
        merged_rows = rows.count()
        rejected = staged.count() - merged_rows
        if rejected:
            _log.warning("%s: %d rows without a whole key rejected", path, rejected)
        values = touched_partitions(rows, layout)
        if not values:
            return 0
        target = read_table(spark, path, layout).filter(layout.in_partitions(values))
        merged = upsert(
            target.drop(layout.partition),
            rows.drop(layout.partition),
            layout.keys,
            update=update,
            when=when,
            order_by=order_by,
        )
        write_partitions(layout.shaped(merged), path, layout)
        return merged_rows


def prune_table(
    spark: SparkSession,
    path: str,
    layout: Layout,
    as_of: datetime,
    days: int | None = None,
    months: int | None = None,
) -> int:
    """Drop rows older than the limit and return their number.

    Partitions before the limit's own are dropped as directories, their rows counted from
    file footers; only the partition the limit falls in is rewritten.
    """
    compact(spark, path, layout)
    limit = cutoff(as_of, days, months)
    edge = spark.range(1).select(layout.partition_literal(limit).cast("string")).first()[0]
    stored = partition_values(spark, path, layout)
    gone = [v for v in stored if v < edge]
    pruned = 0
    if gone:
        before = F.col(layout.partition) < F.lit(edge).cast(layout.partition_type)
        pruned = read_table(spark, path, layout).filter(before).count()
        for value in gone:
            remove(spark, f"{path}/{layout.partition}={value}")
    if edge in stored:
        pruned += _delete_in(spark, path, layout, [edge], F.col(layout.source) < limit)
    return pruned


def delete_from_table(spark: SparkSession, path: str, layout: Layout, condition: Column) -> int:
    """Delete rows by predicate and return their number; only partitions that hold such rows are rewritten."""
    compact(spark, path, layout)
    hit = read_table(spark, path, layout).filter(F.coalesce(condition, F.lit(False)))
    values = [r[0] for r in hit.select(F.col(layout.partition).cast("string")).distinct().collect()]
    return _delete_in(spark, path, layout, values, condition) if values else 0


def delete_keys(spark: SparkSession, path: str, layout: Layout, keys: DataFrame) -> int:
    """Delete the rows whose key is in ``keys`` and return their number; only partitions that hold such rows are rewritten."""
    compact(spark, path, layout)
    with staging(keys.select(*layout.keys).distinct(), "keys") as gone:
        values = touched_partitions(gone.withColumn(layout.partition, layout.partition_value()), layout)
        if not values:
            return 0
        inside = read_table(spark, path, layout).filter(layout.in_partitions(values))
        marked = inside.join(gone.withColumn("__gone", F.lit(True)), list(layout.keys), "left")
        text = F.coalesce(F.col(layout.partition).cast("string"), F.lit(NO_VALUE))
        counts = marked.groupBy(text.alias("value")).agg(F.count("__gone").alias("gone"), F.count_if(F.col("__gone").isNull()).alias("kept"))
        hit = {r["value"]: r for r in counts.where("gone > 0").collect()}
        if hit:
            chosen = layout.in_partitions([None if v == NO_VALUE else v for v in hit])
            write_partitions(marked.where("__gone is null").where(chosen).drop("__gone"), path, layout)
        for value, row in hit.items():
            if row["kept"] == 0:
                remove(spark, f"{path}/{layout.partition}={value}")
        return sum(r["gone"] for r in hit.values())


def _delete_in(spark: SparkSession, path: str, layout: Layout, values: list[str], condition: Column) -> int:
    inside = read_table(spark, path, layout).filter(layout.in_partitions(values))
    deletes = F.coalesce(condition, F.lit(False))
    counts = {
        r["value"]: (r["deleted"], r["kept"])
        for r in inside.groupBy(F.col(layout.partition).cast("string").alias("value"))
        .agg(F.count_if(deletes).alias("deleted"), F.count_if(~deletes).alias("kept"))
        .collect()
    }
    deleted = sum(d for d, _ in counts.values())
    if deleted:
        write_partitions(delete_where(inside, condition), path, layout)
        # A dynamic overwrite leaves a partition alone when no rows remain for it.
        for value, (_, kept) in counts.items():
            if kept == 0:
                remove(spark, f"{path}/{layout.partition}={NO_VALUE if value is None else value}")
    return deleted
