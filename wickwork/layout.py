"""How each stored table is laid out: schema, key, partition column and sort order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wickwork import schemas as S
from wickwork.functions.times import at, utc


@dataclass(frozen=True)
class Layout:
    """A parquet table partitioned by one derived column.

    ``kind`` says how the partition value follows from ``source``: ``month`` and ``day`` of
    a timestamp, or ``hash`` of the key columns into ``buckets`` even groups.
    """

    schema: T.StructType
    keys: tuple[str, ...]
    kind: str
    source: str | None = None
    buckets: int = 32
    sort: tuple[str, ...] = ()
    # How the newest of a key's appended versions is told: by its publish time ("published") or by
    # the batch that wrote it ("appended"). None: the table takes no deltas (wickwork.versions).
    versions: str | None = None

    @property
    def partition(self) -> str:
        return {"month": "month", "day": "date", "hash": "part"}[self.kind]

    @property
    def partition_type(self) -> T.DataType:
        return {"month": T.StringType(), "day": T.DateType(), "hash": T.IntegerType()}[self.kind]

    def partition_value(self) -> Column:
        if self.kind == "month":
            return F.date_format(self.source, "yyyy-MM")
        if self.kind == "day":
            return F.to_date(self.source)
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def partition_literal(self, value: Column) -> Column:
        """The partition a timestamp of the source column belongs to; not for hashed tables."""
        return F.date_format(value, "yyyy-MM") if self.kind == "month" else F.to_date(value)

    def in_partitions(self, values: list) -> Column:
        """Whether a row lies in one of the given partitions; None stands for rows without a partition value."""
        known = [F.lit(v).cast(self.partition_type) for v in values if v is not None]
        inside = F.col(self.partition).isin(known) if known else F.lit(False)
        return inside | F.col(self.partition).isNull() if len(known) < len(values) else inside

    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(self.partition, self.partition_type)])

    def shaped(self, df: DataFrame, *extra: str) -> DataFrame:
        """``df`` in the table's column order and types, with the partition column; absent columns are null."""
        columns = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema.fields
        ]
        return df.select(*columns, *extra).withColumn(self.partition, self.partition_value())

    def sorted_for_write(self, df: DataFrame, clustered: bool = False) -> DataFrame:
        """Rows gathered by partition and sorted inside it.

        REBALANCE sizes the write tasks at run time: small partitions share a task's output
        sensibly and one partition holding much of the data is split over many tasks. ``clustered`` splits it by ranges
        of the sort order instead, whose bounds Spark samples: each file of a big partition then holds a few neighbouring
        coins, and a read of one coin skips the other files by their statistics. It costs a pass for the sample, so
        it is for rewrites, not for small appends.
        """
        order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.sort]
        if clustered:
            # Keys beyond the sort order let a single coin that is most of a partition be split too.
            named = {c.lstrip("-") for c in self.sort}
            rest = [F.col(k) for k in self.keys if k not in named]
            gathered = df.repartitionByRange(F.col(self.partition), *order, *rest)
        else:
            gathered = df.hint("rebalance", F.col(self.partition))
        return gathered.sortWithinPartitions(self.partition, *order)


def read_table(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """The table with its partition column: its own files, merged with the deltas beside it where it takes such."""
    from wickwork.versions import read_current

    return read_current(spark, path, layout)


def time_range(
    df: DataFrame, ts_col: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Rows with ``start <= ts_col < end``, and the same bounds on the table's partition column.

    Spark cannot tell that ``date`` or ``month`` follow from a timestamp; without their own
    filter every partition would be listed and opened. They follow from the column the layouts
    name as their source: of any other timestamp they say nothing.
    """
    dtype = df.schema[ts_col].dataType
    partitioned = set(df.columns) & {"date", "month"} if ts_col in _SOURCES else set()
    as_date = "date" in partitioned and isinstance(df.schema["date"].dataType, T.DateType)
    if start is not None:
        first = utc(start)
        df = df.filter(F.col(ts_col) >= at(first, dtype))
        if as_date:
            df = df.filter(F.col("date") >= F.lit(first.date()))
        if "month" in partitioned:
            df = df.filter(F.col("month") >= first.strftime("%Y-%m"))
    if end is not None:
        last = utc(end) - timedelta(microseconds=1)
        df = df.filter(F.col(ts_col) < at(end, dtype))
        if as_date:
            df = df.filter(F.col("date") <= F.lit(last.date()))
        if "month" in partitioned:
            df = df.filter(F.col("month") <= last.strftime("%Y-%m"))
    return df


BRONZE = Layout(S.BRONZE, (), "month", "open_time", sort=("coin_id", "interval", "open_time"))
SILVER = Layout(S.SILVER, ("coin_id", "interval", "open_time"), "day", "open_time", sort=("coin_id", "interval"), versions="published")
GOLD_HOURLY = Layout(S.gold_schema("hour"), ("coin_id", "interval", "hour"), "day", "hour", sort=("coin_id", "interval"), versions="appended")
GOLD_DAILY = Layout(S.gold_schema("day"), ("coin_id", "interval", "day"), "day", "day", sort=("coin_id", "interval"), versions="appended")
GOLD = {"hour": GOLD_HOURLY, "day": GOLD_DAILY}
MARKET_CAP_HISTORY = Layout(
    S.MARKET_CAP_HISTORY, ("coin_id", "timestamp"), "month", "timestamp", sort=("coin_id", "timestamp")
)
COINS = Layout(S.COINS, ("coin_id",), "hash", buckets=4, sort=("coin_id",))
SNAPSHOTS = Layout(S.SNAPSHOTS, ("coin_id",), "hash", buckets=4, sort=("coin_id",))
MARKETS = Layout(
    S.MARKETS, ("coin_id", "exchange_id", "base_symbol", "target_symbol"), "hash", buckets=32, sort=("coin_id",), versions="appended"
)
WATERMARKS = Layout(S.WATERMARKS, ("coin_id", "interval"), "hash", buckets=4, sort=("coin_id",))
# Newest bucket first within a coin: the order in which charts read.
ROLLUPS_HOURLY = Layout(
    S.SERVING, ("coin_id", "bucket_start"), "day", "bucket_start", sort=("coin_id", "-bucket_start")
)
ROLLUPS_DAILY = Layout(
    S.SERVING, ("coin_id", "bucket_start"), "month", "bucket_start", sort=("coin_id", "-bucket_start")
)
ROLLUPS = {"hour": ROLLUPS_HOURLY, "day": ROLLUPS_DAILY}
# The timestamps that partitions are made from.
_SOURCES = {t.source for t in (BRONZE, SILVER, *GOLD.values(), MARKET_CAP_HISTORY, *ROLLUPS.values())}
