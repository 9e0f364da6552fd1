"""Sharding: range partitions cut at splitters that are quantiles of a size-weighted sample.

1. A sample of keys is drawn, each record's chance growing with its size, and its quantiles
   are the splitters of many more ranges than shards.
2. Records and bytes of every range are counted exactly. Ranges that hold too much get more
   splitters, from a second sample drawn in them alone.
3. Each range is sorted by itself. Its first record's place in the whole order is known from
   the counts of the ranges before it, so every record's byte offset and place are exact. The
   share of the total that lies before a record's middle names its shard, so shards are as
   equal as the records at their ends allow.

The order is by key and then by a hash of the record, so a hot key is cut like any other part
of the order. What reaches the driver, and stands in the plan as splitters, is one row a range
and ``SAMPLES_PER_RANGE`` keys for each: eight ranges a shard, or one for ``ROWS_PER_RANGE`` rows where that is more.
No task holds more than a range.

Defined cases: a null key comes first. Records that are equal in all columns are ordered among
themselves at will, which cannot be seen in the result. A null size counts as 0. An empty table gives no rows. A table
smaller than the number of shards leaves shards empty. Own columns carry names that begin with
two underscores until the end, so other columns cannot clash.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wickwork.llm.common import cut

RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 4_000_000
SAMPLES_PER_RANGE = 32
OVERFULL = 1.5  # fair shares from which a range is subdivided


def _sample(records: DataFrame, most: int) -> list:
    """At most ``most`` order values, drawn without replacement with chances that grow with size; sorted."""
    uniform = (F.pmod(F.xxhash64("__order", F.lit("sample")), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    drawn = records.select("__order", "__range", (-F.log(uniform) / F.greatest("__size", F.lit(1))).alias("__turn"))
    drawn = drawn.orderBy("__turn").limit(most).select("__order", "__range")
    return [(r["__range"], r["__order"]) for r in drawn.distinct().orderBy("__order").collect()]


def _quantiles(sorted_values: list, parts: int) -> list:
    """The values that cut a sorted sample into equal parts."""
    n = len(sorted_values)
    return list(dict.fromkeys(sorted_values[k * n // parts] for k in range(1, parts))) if n else []


def _range_of(splitters: list, kind: T.StructType) -> Column:
    """How many splitters are at most the order value: a binary search in a constant array."""
    if not splitters:
        return F.lit(0)
    types = [f.dataType for f in kind.fields]
    values = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"_{i}") for i, (v, t) in enumerate(zip(s, types))]) for s in splitters])

    def step(low: Column, width: Column) -> Column:
        up = low + width
        return F.when((up <= len(splitters)) & (F.get(values, up - 1) <= F.col("__order")), up).otherwise(low)

    widths = [1 << k for k in reversed(range(len(splitters).bit_length()))]
    return F.aggregate(F.array(*[F.lit(w) for w in widths]), F.lit(0), step)


def _totals(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and records of each range."""
    sums = records.groupBy("__range").agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n"))
    return {r["__range"]: (r["size"], r["n"]) for r in sums.collect()}


def _at(values: list[int], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), index)


def shard(records: DataFrame, shards: int, *, key: str, size: str) -> DataFrame:
    """``records`` with ``shard`` (from 0) and ``slot`` (the place in the shard, gapless from 0).

    All columns of ``records`` are carried, sorted and written to the checkpoint folder once,
    so leave out texts; ``write_shards`` moves those.
    """
    columns = records.columns
    whole = F.xxhash64(*[F.col(c) for c in columns])
    order = F.struct(F.col(key).alias("_0"), whole.alias("_1"))
    records = cut(records.select("*", order.alias("__order"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("__size")))
    kind = records.schema["__order"].dataType
    total, rows = records.agg(F.coalesce(F.sum("__size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(shards * RANGES_PER_SHARD, rows // ROWS_PER_RANGE)

    sample = [order for _, order in _sample(records.withColumn("__range", F.lit(0)), ranges * SAMPLES_PER_RANGE)]
    splitters = _quantiles(sample, ranges)
    totals = _totals(records.withColumn("__range", _range_of(splitters, kind)))
    fair = max(1, total // ranges)
    overfull = {k: -(-held // fair) for k, (held, n) in totals.items() if held > OVERFULL * fair and n > 1}
    if overfull:
        inside = records.withColumn("__range", _range_of(splitters, kind)).where(F.col("__range").isin(*overfull))
        again = defaultdict(list)
        for k, order in _sample(inside, sum(overfull.values()) * SAMPLES_PER_RANGE):
            again[k].append(order)
        splitters = _in_order(splitters, again, overfull)
        totals = _totals(records.withColumn("__range", _range_of(splitters, kind)))

    bytes_before, rows_before = [0], [0]
    for k in range(len(splitters)):
        held, n = totals.get(k, (0, 0))
        bytes_before.append(bytes_before[-1] + held)
        rows_before.append(rows_before[-1] + n)
    before = Window.partitionBy("__range").orderBy("__order").rowsBetween(Window.unboundedPreceding, -1)
    number = F.row_number().over(Window.partitionBy("__range").orderBy("__order")) - 1
    placed = records.withColumn("__range", _range_of(splitters, kind)).select(
        *columns,
        "__size",
        (F.coalesce(F.sum("__size").over(before), F.lit(0)) + _at(bytes_before, F.col("__range"))).alias("__offset"),
        (number + _at(rows_before, F.col("__range"))).alias("__place"),
    )
    share = F.expr(f"least((2 * __offset + __size) * {shards} div {max(1, 2 * total)}, {shards - 1})").cast("int")
    placed = cut(placed.select(*columns, share.alias("__shard"), "__place"))
    first = {r[0]: r[1] for r in placed.groupBy("__shard").agg(F.min("__place")).collect()}
    slot = F.col("__place") - _at([first.get(k, 0) for k in range(shards)], F.col("__shard"))
    return placed.select(*columns, F.col("__shard").alias("shard"), slot.alias("slot"))


def _in_order(splitters: list, again: dict[int, list], overfull: dict[int, int]) -> list:
    """The splitters with those of subdivided ranges put where they belong; the driver compares no keys."""
    out = []
    for k in range(len(splitters) + 1):
        out += [x for x in _quantiles(again.get(k, []), overfull.get(k, 1)) if not out or x != out[-1]]
        if k < len(splitters):
            out.append(splitters[k])
    return out


def write_shards(docs: DataFrame, placed: DataFrame, path: str, *, key: str = "doc_id") -> None:
    """Write the documents as Parquet, one folder a shard; ``key`` names each document once."""
    placed = placed.select(F.col(key), "shard", "slot")
    docs.join(placed, key).repartition("shard", F.expr("slot div 1000000")).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
