"""Row versions appended beside a table, merged when it is read.

A keyed table that takes many small batches is a *base*, ordinary partitions, and numbered
*deltas* in a folder beside it. A delta holds the versions of one batch: rows of the table, and
tombstones, which only say that a key is deleted. A batch writes its own rows and nothing else,
however large the partitions are into which they fall. Reading keeps the newest version of each
key and leaves tombstones out. Only partitions that deltas reach into are reduced; all others are
read as they stand. Compaction folds deltas into the base.

The *feed* has one small record a delta: its number and the partitions that it changes. A delta
without a record has not been finished and is not read. Records outlive compaction, so whoever
follows a table reads on from the number that it has come to.

Merging is associative and repeatable: deltas in any order and repeated, and a compaction that
is lost half-way, end in the same rows. A table takes one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wickwork.layout import Layout
from wickwork.operators.rollup import latest_per_key, version_order
from wickwork.session import file_system, remove, staging

# Fixed value: the directory of rows whose partition value is null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Tombstones that compaction has to keep, so that older versions that come later stay deleted.
_KEPT = 0
_EXTRA = [T.StructField("deleted", T.BooleanType()), T.StructField("seq", T.LongType())]


@dataclass(frozen=True)
class Delta:
    """One record of the feed. ``stored`` tells whether its rows still stand beside the base."""

    number: int
    partitions: tuple[str, ...]
    stored: bool


def _deltas(path: str) -> str:
    return f"{path.rstrip('/')}-deltas"


def _feed(path: str) -> str:
    return f"{path.rstrip('/')}-feed"


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _numbers(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the folders with deltas, finished or not."""
    return {int(n[4:]) for n in _names(spark, _deltas(path)) if n.startswith("seq=")}


def _recorded(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in _names(spark, _feed(path)) if n.isdigit())


def _records(spark: SparkSession, path: str, numbers: list[int], stored: set[int]) -> list[Delta]:
    return [Delta(n, tuple(read_lines(spark, f"{_feed(path)}/{n:012d}")), n in stored) for n in numbers]


def feed(spark: SparkSession, path: str, after: int = 0) -> list[Delta]:
    """The deltas with a number above ``after``, in order. Earlier records are not read."""
    found = [n for n in _recorded(spark, path) if n > after]
    return _records(spark, path, found, _numbers(spark, path)) if found else []


def newest(spark: SparkSession, path: str) -> int:
    """The number of the last finished delta, compacted or not; 0 before the first."""
    return max(_recorded(spark, path), default=0)


def forget_changes(spark: SparkSession, path: str, upto: int) -> int:
    """Drop the records up to a number that all followers have passed, whose deltas are folded in; returns how many.

    The last record stays, for the numbers to go on from.
    """
    stored, known = _numbers(spark, path), _recorded(spark, path)
    gone = [n for n in known[:-1] if n <= upto and n not in stored]
    for n in gone:
        remove(spark, f"{_feed(path)}/{n:012d}")
    return len(gone)


def read_lines(spark: SparkSession, file: str) -> list[str]:
    """The lines of a small file."""
    fs, p = file_system(spark, file)
    stream = fs.open(p)
    try:
        text = spark._jvm.java.lang.String(stream.readAllBytes(), "UTF-8")
    finally:
        stream.close()
    return [line for line in str(text).split("\n") if line]


def write_lines(spark: SparkSession, file: str, lines: list[str]) -> None:
    """A small file that is there whole or not at all; replaces one of that name."""
    fs, p = file_system(spark, file)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{file}.part")
    stream = fs.create(part, True)
    stream.write(bytearray("\n".join(lines).encode()))
    stream.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"cannot write {file}")


def append_versions(rows: DataFrame, path: str, layout: Layout) -> Delta | None:
    """Store a batch of versions; ``deleted`` marks tombstones where ``rows`` has that column.

    ``rows`` holds a key once. Nothing that is stored is read or rewritten. None if there are no rows.
    """
    spark = rows.sparkSession
    number = max([*_numbers(spark, path), newest(spark, path)], default=0) + 1
    folder = f"{_deltas(path)}/seq={number}"
    deleted = F.coalesce("deleted", F.lit(False)) if "deleted" in rows.columns else F.lit(False)
    shaped = layout.shaped(rows.withColumn("deleted", deleted), "deleted")
    _write(shaped, folder, layout)
    prefix = layout.partition + "="
    values = sorted(n[len(prefix) :] for n in _names(spark, folder) if n.startswith(prefix))
    if not values:
        remove(spark, folder)
        return None
    write_lines(spark, f"{_feed(path)}/{number:012d}", values)
    return Delta(number, tuple(values), True)


def note_change(spark: SparkSession, path: str, values: list) -> None:
    """A record in the feed for partitions that were rewritten in the base."""
    names = sorted(NO_VALUE if v is None else str(v) for v in values)
    if names:
        number = max([*_numbers(spark, path), newest(spark, path)], default=0) + 1
        write_lines(spark, f"{_feed(path)}/{number:012d}", names)


def _write(shaped: DataFrame, folder: str, layout: Layout, clustered: bool = False) -> None:
    writer = layout.sorted_for_write(shaped, clustered).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(layout.partition).parquet(folder)


def _stored(spark: SparkSession, path: str) -> list[Delta]:
    """The finished deltas beside the base."""
    folders = _numbers(spark, path) - {_KEPT}
    return _records(spark, path, sorted(folders.intersection(_recorded(spark, path))), folders) if folders else []


def read_deltas(spark: SparkSession, path: str, layout: Layout, numbers: list[int]) -> DataFrame:
    """The versions of the deltas named, tombstones included, with ``deleted`` and ``seq``."""
    schema = T.StructType([*layout.schema.fields, *_EXTRA, layout.stored_schema().fields[-1]])
    if not numbers:
        return spark.createDataFrame([], schema)
    folders = [f"{_deltas(path)}/seq={n}" for n in numbers]
    found = spark.read.schema(schema).option("basePath", _deltas(path)).parquet(*folders)
    return found.select(*schema.names)


def _order(layout: Layout) -> list[Column]:
    if layout.versions == "published":
        return version_order("latest_publish_time", [F.desc("deleted")])
    return [F.desc("seq"), F.desc("deleted")]


def in_values(layout: Layout, values: set[str]) -> Column:
    """Whether a row lies in one of the partitions that feed records name."""
    return layout.in_partitions([None if v == NO_VALUE else v for v in sorted(values)])


def _winners(spark: SparkSession, path: str, layout: Layout, deltas: list[Delta]) -> tuple[Column, DataFrame]:
    """The condition for partitions that deltas reach into, and the newest version of each of their keys."""
    values = {v for d in deltas for v in d.partitions}
    reached = in_values(layout, values)
    base = read_base(spark, path, layout).where(reached)
    base = base.withColumn("deleted", F.lit(False)).withColumn("seq", F.lit(-1).cast("long"))
    kept = [_KEPT] if _KEPT in _numbers(spark, path) else []
    versions = read_deltas(spark, path, layout, [*kept, *[d.number for d in deltas]]).where(reached)
    # A key has one partition; with it in the window a filter on the partition reaches the files.
    keys = [layout.partition, *layout.keys]
    return reached, latest_per_key(base.unionByName(versions), keys, _order(layout))


def read_base(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """The table's own partitions, under the fixed schema (no inference, no footer reads)."""
    return spark.read.schema(layout.stored_schema()).parquet(path)


def read_current(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """The table as base and deltas have it, with its partition column."""
    base = read_base(spark, path, layout)
    deltas = _stored(spark, path) if layout.versions else []
    if not deltas:
        return base
    reached, winners = _winners(spark, path, layout, deltas)
    current = winners.where(~F.col("deleted")).select(*base.columns)
    return base.where(~F.coalesce(reached, F.lit(False))).unionByName(current)


def compact(spark: SparkSession, path: str, layout: Layout) -> list[str]:
    """Fold the deltas into the base, a job of its own beside the batches; returns the partitions rewritten.

    Where versions are told by publish time, tombstones are kept: an older version may still come. The deltas go last, so
    a job that is lost leaves them to be folded again.
    """
    deltas = _stored(spark, path) if layout.versions else []
    if not deltas:
        return []
    _, newest_rows = _winners(spark, path, layout, deltas)
    values = sorted({v for d in deltas for v in d.partitions})
    with staging(newest_rows, "compact") as winners:
        if layout.versions == "published":
            tombstones = winners.where("deleted").select(*layout.schema.names, "deleted", layout.partition)
            _write(tombstones, f"{_deltas(path)}/seq={_KEPT}", layout)
        alive = winners.where(~F.col("deleted")).select(*layout.stored_schema().names)
        _write(alive, path, layout, clustered=True)
        # A dynamic overwrite leaves a partition alone when no rows remain for it.
        text = F.coalesce(F.col(layout.partition).cast("string"), F.lit(NO_VALUE))
        with_rows = {r[0] for r in alive.select(text).distinct().collect()}
        for value in values:
            if value not in with_rows:
                remove(spark, f"{path}/{layout.partition}={value}")
    drop_deltas(spark, path, [d.number for d in deltas])
    return values


def drop_deltas(spark: SparkSession, path: str, numbers: list[int]) -> None:
    for n in numbers:
        remove(spark, f"{_deltas(path)}/seq={n}")


def stored_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all deltas beside the base, kept tombstones and unfinished ones included."""
    return sorted(_numbers(spark, path))


def position(spark: SparkSession, path: str, source: str) -> int:
    """The number of the source's feed up to which the table at ``path`` has followed it."""
    file = _position(path, source)
    fs, p = file_system(spark, file)
    return int(read_lines(spark, file)[0]) if fs.exists(p) else 0


def set_position(spark: SparkSession, path: str, source: str, number: int) -> None:
    """To be called when all changes up to ``number`` have been stored."""
    write_lines(spark, _position(path, source), [str(number)])


def _position(path: str, source: str) -> str:
    name = source.rstrip("/").rpartition("/")[2]
    return f"{path.rstrip('/')}-followed/{name}"
