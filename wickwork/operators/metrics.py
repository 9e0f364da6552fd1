"""Metric queries over a small declarative model, with optional pre-aggregated rollups.

A model names a table's dimensions and measures. A query names some of them; it becomes
one ``groupBy().agg()`` on the table or, when that gives the same answer, on a rollup. A stored
rollup comes with the ranges of time that it covers; what a query asks for beyond them is taken from the
table and added to what the rollup has.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wickwork.functions.times import at, months_before, step, trunc, utc
from wickwork.layout import time_range

_ADDITIVE = {"count", "sum", "max", "min"}


@dataclass(frozen=True)
class Rollup:
    """A pre-aggregation: measures by dimensions and a truncated time, partitioned for rebuilds."""

    measures: tuple[str, ...]
    dimensions: tuple[str, ...]
    time_dimension: str
    granularity: str
    partition_granularity: str
    build_months: int | None = None


@dataclass(frozen=True)
class Model:
    """Dimensions by type (string, boolean, time) and measures by (type, column)."""

    name: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, tuple[str, str | None]]
    primary_key: tuple[str, ...]
    rollups: Mapping[str, Rollup] = field(default_factory=dict)
    # Measures that equal one row's value and so make sense only at one row per bucket.
    single_row: tuple[str, ...] = ()
    finest: str | None = None


def _measures(average_prices: bool, candle_count: bool) -> dict[str, tuple[str, str | None]]:
    price = "avg" if average_prices else "max"
    measures: dict[str, tuple[str, str | None]] = {
        "count": ("count", None),
        "open": (price, "open"),
        "high": ("max", "high"),
        "low": ("min", "low"),
        "close": (price, "close"),
        "volume": ("sum", "volume"),
        "quote_volume": ("sum", "quote_volume"),
        "trade_count": ("sum", "trade_count"),
    }
    if candle_count:
        measures["candle_count"] = ("sum", "candle_count")
    return measures


_GOLD_ROLLUP = ("count", "high", "low", "volume", "quote_volume", "trade_count")

# The names, types and rollups of the three models.
CANDLES = Model(
    name="candles",
    dimensions={
        "coin_id": "string",
        "interval": "string",
        "is_closed": "boolean",
        "open_time": "time",
        "close_time": "time",
    },
    measures=_measures(average_prices=False, candle_count=False),
    primary_key=("coin_id", "open_time"),
    rollups={
        "candles_by_coin_and_hour": Rollup(
            measures=("count", "open", "high", "low", "close", "volume", "quote_volume", "trade_count"),
            dimensions=("coin_id", "interval", "is_closed"),
            time_dimension="open_time",
            granularity="hour",
            partition_granularity="month",
            build_months=13,
        )
    },
    single_row=("open", "close"),
    finest="hour",
)
HOURLY = Model(
    name="hourly_candle_metrics",
    dimensions={"coin_id": "string", "interval": "string", "hour": "time"},
    measures=_measures(average_prices=True, candle_count=False),
    primary_key=("coin_id", "hour"),
    rollups={
        "hourly_metrics_by_coin": Rollup(_GOLD_ROLLUP, ("coin_id", "interval"), "hour", "hour", "month")
    },
)
DAILY = Model(
    name="daily_candle_metrics",
    dimensions={"coin_id": "string", "interval": "string", "day": "time"},
    measures=_measures(average_prices=True, candle_count=True),
    primary_key=("coin_id", "day"),
    rollups={
        "daily_metrics_by_coin": Rollup(
            (*_GOLD_ROLLUP, "candle_count"), ("coin_id", "interval"), "day", "day", "year"
        )
    },
)
MODELS = {m.name: m for m in (CANDLES, HOURLY, DAILY)}


Range = tuple[datetime | None, datetime | None]


@dataclass(frozen=True)
class Covered:
    """A rollup's rows and the half-open ranges of UTC times for which they are what the table gives.

    None as an end stands for no limit. Rows without a time are never covered.
    """

    rows: DataFrame
    ranges: tuple[Range, ...]


@dataclass(frozen=True)
class _Request:
    measures: list[str]
    dimensions: list[str]
    filters: list[tuple[str, list]]
    time_dimension: str | None
    granularity: str | None
    start: datetime | None
    end: datetime | None


def date_range(value: str | list, as_of: datetime) -> tuple[datetime, datetime]:
    """A date range as a half-open interval of UTC times.

    ``"last 7 days"`` is the seven whole days before today (likewise hours, weeks, months);
    ``"today"`` and ``"yesterday"`` are those days. A pair of ISO dates covers both days
    whole; a pair of ISO times ends just before the second.
    """
    now = utc(as_of)
    today = trunc(now, "day")
    if isinstance(value, (list, tuple)):
        first, last = (str(v) for v in value)
        end = datetime.fromisoformat(last)
        return datetime.fromisoformat(first), end + timedelta(days=1) if len(last) == 10 else end
    text = value.strip().lower()
    if text == "today":
        return today, today + timedelta(days=1)
    if text == "yesterday":
        return today - timedelta(days=1), today
    words = text.split()
    if len(words) == 3 and words[0] == "last" and words[1].isdigit():
        n, unit = int(words[1]), words[2].rstrip("s")
        if unit == "hour":
            end = trunc(now, "hour")
            return end - timedelta(hours=n), end
        if unit == "day":
            return today - timedelta(days=n), today
        if unit == "week":
            monday = today - timedelta(days=today.weekday())
            return monday - timedelta(weeks=n), monday
        if unit == "month":
            first = today.replace(day=1)
            index = first.year * 12 + first.month - 1 - n
            return first.replace(year=index // 12, month=index % 12 + 1), first
    raise ValueError(f"unknown date range: {value!r}")


def _request(model: Model, spec: Mapping, as_of: datetime) -> _Request:
    def member(name: str, known: Mapping) -> str:
        prefix, _, short = name.rpartition(".")
        if prefix not in ("", model.name) or short not in known:
            raise ValueError(f"{name!r} is not in model {model.name}")
        return short

    filters = []
    for f in spec.get("filters", []):
        if f["operator"] != "equals":
            raise ValueError(f"unsupported filter operator: {f['operator']!r}")
        filters.append((member(f["member"], model.dimensions), list(f["values"])))
    times = spec.get("timeDimensions", [])
    if len(times) > 1:
        raise ValueError("one time dimension per query")
    time_dimension = granularity = start = end = None
    if times:
        time_dimension = member(times[0]["dimension"], model.dimensions)
        granularity = times[0].get("granularity")
        if granularity not in (None, "hour", "day"):
            raise ValueError(f"unsupported granularity: {granularity!r}")
        if times[0].get("dateRange") is not None:
            start, end = date_range(times[0]["dateRange"], as_of)
    return _Request(
        measures=[member(m, model.measures) for m in spec.get("measures", [])],
        dimensions=[member(d, model.dimensions) for d in spec.get("dimensions", [])],
        filters=filters,
        time_dimension=time_dimension,
        granularity=granularity,
        start=start,
        end=end,
    )


def _check_single_row(model: Model, request: _Request) -> None:
    """Open and close of a candle are one row's value: reject queries that mix several rows into one."""
    wanted = [m for m in request.measures if m in model.single_row]
    if not wanted:
        return
    per_time = request.granularity == model.finest or any(
        model.dimensions[d] == "time" and d in model.primary_key for d in request.dimensions
    )
    if not per_time:
        raise ValueError(
            f"{', '.join(wanted)}: only at {model.finest} granularity; use the rollup operators for coarser bars"
        )
    # A candle is one coin's and one interval's: both have to be told apart, or be one value.
    single = {m for m, values in request.filters if len(set(values)) == 1}
    loose = [k for k in _SERIES_KEY if k in model.dimensions and k not in single and k not in request.dimensions]
    if loose:
        raise ValueError(f"{', '.join(wanted)}: needs {', '.join(loose)} as a dimension or with one value")


_SERIES_KEY = ("coin_id", "interval")


def choose_source(
    model: Model,
    spec: Mapping,
    as_of: datetime,
    available: Collection[str] | None = None,
    built_at: Mapping[str, datetime] | None = None,
) -> str | None:
    """Name of the rollup that answers the query exactly, or None for the table itself.

    The rollup has to be ``available`` (None: all are) and to hold every measure, all additive,
    every dimension and filter member, buckets no coarser than asked for, a range that starts
    and ends on bucket edges, and all of that range. What it holds follows from the time it was
    built: a stored rollup's is in ``built_at``; one that is not named there was built at ``as_of``.
    """
    request = _request(model, spec, as_of)
    for name, rollup in model.rollups.items():
        if available is not None and name not in available:
            continue
        built = utc((built_at or {}).get(name, as_of))
        if built < utc(as_of) and (request.end is None or request.end > built):
            continue
        kinds = {model.measures[m][0] for m in request.measures}
        if not kinds <= _ADDITIVE or not set(request.measures) <= set(rollup.measures):
            continue
        plain = set(request.dimensions) | {m for m, _ in request.filters}
        if not plain <= set(rollup.dimensions):
            continue
        if request.time_dimension not in (None, rollup.time_dimension):
            continue
        if request.granularity is not None and step(request.granularity) < step(rollup.granularity):
            continue
        edges = [e for e in (request.start, request.end) if e is not None]
        if any(trunc(e, rollup.granularity) != e for e in edges):
            continue
        if rollup.build_months is not None:
            covered_from, covered_to = build_range(rollup, built)
            if request.start is None or request.start < covered_from or request.end > covered_to:
                continue
        return name
    return None


def _fits(model: Model, rollup: Rollup, request: _Request) -> bool:
    """Whether the rollup has all that the query needs, wherever it has rows."""
    kinds = {model.measures[m][0] for m in request.measures}
    plain = set(request.dimensions) | {m for m, _ in request.filters}
    return (
        kinds <= _ADDITIVE
        and set(request.measures) <= set(rollup.measures)
        and plain <= set(rollup.dimensions)
        and request.time_dimension in (None, rollup.time_dimension)
        and (request.granularity is None or step(request.granularity) >= step(rollup.granularity))
    )


def _on_edges(first: datetime | None, last: datetime | None, unit: str) -> Range | None:
    """The whole buckets within a range; None if there is none."""
    if first is not None and trunc(first, unit) != first:
        first = trunc(first, unit) + step(unit)
    if last is not None:
        last = trunc(last, unit)
    return (first, last) if first is None or last is None or first < last else None


def split_ranges(ranges: tuple[Range, ...], request: Range, unit: str) -> tuple[list[Range], list[Range]]:
    """A requested range as whole buckets that ``ranges`` cover, and the gaps that they leave, both in order."""
    lo, hi = request
    covered: list[Range] = []
    for first, last in sorted(ranges, key=lambda r: (r[0] is not None, r[0])):
        first = lo if first is None else first if lo is None else max(first, lo)
        last = hi if last is None else last if hi is None else min(last, hi)
        if covered and covered[-1][1] is None:
            break
        if covered and first is not None:
            first = max(first, covered[-1][1])
        whole = _on_edges(first, last, unit)
        if whole is not None and (whole[0] is None or whole[1] is None or whole[0] < whole[1]):
            if covered and covered[-1][1] == whole[0]:
                whole = (covered.pop()[0], whole[1])
            covered.append(whole)
    gaps: list[Range] = []
    at = lo
    for first, last in covered:
        if first is not None and (at is None or at < first):
            gaps.append((at, first))
        at = last
        if last is None:
            return covered, gaps
    if hi is None or at is None or at < hi:
        gaps.append((at, hi))
    return covered, gaps


def build_range(rollup: Rollup, as_of: datetime) -> tuple[datetime, datetime]:
    """What a capped rollup covers: from whole days ``build_months`` calendar months back up to now."""
    day = trunc(as_of, "day")
    index = day.year * 12 + day.month - 1 - rollup.build_months
    first = day.replace(year=index // 12, month=index % 12 + 1, day=1)
    next_month = (first.replace(day=28) + timedelta(days=4)).replace(day=1)
    last_day = (next_month - timedelta(days=1)).day
    return first.replace(day=min(day.day, last_day)), utc(as_of)


def _aggregate(kind: str, column: str | None) -> Column:
    if kind == "count":
        return F.count("*") if column is None else F.sum(column)
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](column)


def _average(df: DataFrame, column: str) -> Column:
    # Sum and count, not avg(): decimals stay exact until the one division.
    total = F.sum(column).cast("double")
    return total / F.count(column)


def _filtered(df: DataFrame, request: _Request) -> DataFrame:
    df = _wanted(df, request)
    return time_range(df, request.time_dimension, request.start, request.end) if request.time_dimension else df


def _wanted(df: DataFrame, request: _Request) -> DataFrame:
    for name, values in request.filters:
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.BooleanType):
            values = [str(v).lower() == "true" for v in values]
        df = df.filter(F.col(name).isin(*values))
    return df


def _between(df: DataFrame, rollup: Rollup, first: datetime | None, last: datetime | None) -> DataFrame:
    """A stored rollup's rows of a range, and the partitions that the range reaches into."""
    df = time_range(df, rollup.time_dimension, first, last)
    if first is not None:
        start = first.replace(day=1) if rollup.partition_granularity == "month" else first.replace(month=1, day=1)
        df = df.filter(F.col("part") >= F.lit(start.date()))
    if last is not None:
        df = df.filter(F.col("part") <= F.lit(last.date()))
    return df


def _grouped(df: DataFrame, request: _Request, aggregates: list[Column]) -> DataFrame:
    groups = [F.col(d) for d in request.dimensions]
    if request.granularity:
        ts = request.time_dimension
        groups.append(F.date_trunc(request.granularity, F.col(ts)).cast(df.schema[ts].dataType).alias(ts))
    if not aggregates:
        return df.select(*groups).distinct()
    return df.groupBy(*groups).agg(*aggregates)


def metric_query(
    table: DataFrame,
    model: Model,
    spec: Mapping,
    as_of: datetime,
    rollups: Mapping[str, Covered] | None = None,
) -> DataFrame:
    """Answer ``{measures, dimensions, filters, timeDimensions}`` from the table, with the help of a rollup where one fits.

    Column names are the member names without the model prefix. ``sinks.rollups.read_rollup`` reads a stored
    rollup with what it covers; rows without a statement of that are refused. The first rollup that has all members
    and covers some whole bucket of the range answers for the buckets that it covers, the table for the rest.
    """
    request = _request(model, spec, as_of)
    _check_single_row(model, request)
    for name, stored in (rollups or {}).items():
        rollup = model.rollups[name]
        if not isinstance(stored, Covered) or not _fits(model, rollup, request):
            continue
        covered, gaps = split_ranges(stored.ranges, (request.start, request.end), rollup.granularity)
        if covered:
            return _split(table, model, rollup, request, stored.rows, covered, gaps)
    aggregates = []
    for m in request.measures:
        kind, column = model.measures[m]
        made = _average(table, column) if kind == "avg" else _aggregate(kind, column)
        aggregates.append(made.alias(m))
    return _grouped(_filtered(table, request), request, aggregates)


def _split(
    table: DataFrame, model: Model, rollup: Rollup, request: _Request, rows: DataFrame, covered: list[Range], gaps: list[Range]
) -> DataFrame:
    """The answer from rollup rows of covered buckets and table rows of the gaps.

    Both give partial measures, which combine alike. Each range is a scan with its own bounds on time and partitions.
    """
    ts = rollup.time_dimension
    names = [*rollup.dimensions, ts, *request.measures]
    parts = [_between(_wanted(rows, request), rollup, *r).select(*names) for r in covered]
    wanted = _wanted(table, request)
    made = [_aggregate(*model.measures[m]).alias(m) for m in request.measures]
    rest = [time_range(wanted, ts, *gap) for gap in gaps]
    if request.start is None and request.end is None:
        rest.append(wanted.where(F.col(ts).isNull()))
    for gap in rest:
        time = F.date_trunc(rollup.granularity, F.col(ts)).cast(table.schema[ts].dataType).alias(ts)
        grouped = gap.groupBy(*rollup.dimensions, time)
        parts.append((grouped.agg(*made) if made else gap.select(*rollup.dimensions, time)).select(*names))
    every = reduce(DataFrame.unionByName, parts)
    aggregates = []
    for m in request.measures:
        # A count is summed, and is 0 over no rows; every other additive measure combines as itself.
        kind, column = model.measures[m]
        combined = _aggregate("sum" if kind == "count" else kind, m)
        counts_rows = kind == "count" and column is None
        if kind == "sum":
            combined = combined.cast(_sum_type(table, column))
        aggregates.append((F.coalesce(combined, F.lit(0)) if counts_rows else combined).alias(m))
    return _grouped(every, request, aggregates)


def _sum_type(table: DataFrame, column: str) -> T.DataType:
    """The type of a sum over the table, which a sum of sums keeps."""
    return table.select(F.sum(column).alias("x")).schema["x"].dataType


def covered_now(table: DataFrame, model: Model, name: str, as_of: datetime) -> Covered:
    """A rollup built from the table at ``as_of``, with what it covers."""
    return Covered(build_rollup(table, model, name, as_of), (covered_range(model.rollups[name], as_of),))


def covered_range(rollup: Rollup, as_of: datetime) -> Range:
    """What a rollup built at ``as_of`` holds whole: up to then, from the first whole bucket of its range on."""
    first = build_range(rollup, as_of)[0] if rollup.build_months is not None else None
    return first, trunc(as_of, rollup.granularity)


def build_rollup(table: DataFrame, model: Model, name: str, as_of: datetime) -> DataFrame:
    """The rollup's rows, with a ``part`` column holding the start of its partition as a date."""
    rollup = model.rollups[name]
    ts = rollup.time_dimension
    dtype = table.schema[ts].dataType
    if rollup.build_months is not None:
        first = F.to_date(months_before(trunc(as_of, "day"), rollup.build_months)).cast(dtype)
        table = table.filter((F.col(ts) >= first) & (F.col(ts) <= at(as_of, dtype)))
    time = F.date_trunc(rollup.granularity, F.col(ts)).cast(dtype).alias(ts)
    aggregates = [_aggregate(*model.measures[m]).alias(m) for m in rollup.measures]
    built = table.groupBy(*rollup.dimensions, time).agg(*aggregates)
    return built.withColumn("part", F.to_date(F.date_trunc(rollup.partition_granularity, F.col(ts))))
