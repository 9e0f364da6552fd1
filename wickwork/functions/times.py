"""Time expressions. Every function that depends on "now" takes it as ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: epochs above this are microseconds, up to and including it milliseconds.
MICROS_ABOVE = 100_000_000_000_000

_STEP = {"hour": timedelta(hours=1), "day": timedelta(days=1)}
_INTERVAL_UNIT = {"m": "minutes", "h": "hours", "d": "days", "w": "weeks"}


def utc(as_of: datetime) -> datetime:
    """Naive UTC; a naive input is taken as UTC already."""
    return as_of if as_of.tzinfo is None else as_of.astimezone(timezone.utc).replace(tzinfo=None)


def at(as_of: datetime, dtype: T.DataType | str = "timestamp") -> Column:
    """``as_of`` as a literal of a timestamp type, whatever the session or machine zone."""
    name = dtype if isinstance(dtype, str) else dtype.simpleString()
    text = utc(as_of).isoformat(sep=" ")
    return F.lit(text).cast(name) if name == "timestamp_ntz" else F.lit(text + "Z").cast("timestamp")


def millis(as_of: datetime) -> datetime:
    """``as_of`` cut to milliseconds, the precision candle times have."""
    as_of = utc(as_of)
    return as_of.replace(microsecond=as_of.microsecond // 1000 * 1000)


def trunc(as_of: datetime, unit: str) -> datetime:
    as_of = utc(as_of)
    day = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return day if unit == "day" else day.replace(hour=as_of.hour)


def step(unit: str) -> timedelta:
    return _STEP[unit]


def interval_length(interval: str) -> timedelta:
    """``"1h"`` as a timedelta: a count and one of m, h, d, w."""
    return timedelta(**{_INTERVAL_UNIT[interval[-1]]: int(interval[:-1])})


def months_before(as_of: datetime, months: int) -> Column:
    """Calendar months back; a day the month lacks is clamped to its last one."""
    return at(as_of) - F.make_interval(months=F.lit(months))


def bucket(df: DataFrame, name: str, unit: str) -> Column:
    """Start of the hour or day a column falls in, in the column's own timestamp type."""
    return F.date_trunc(unit, F.col(name)).cast(df.schema[name].dataType)


def epoch_to_timestamp(value: Column) -> Column:
    """Epoch milliseconds or microseconds, told apart by size; microseconds are cut to milliseconds."""
    return F.when(value > MICROS_ABOVE, F.timestamp_micros(value - value % 1000)).otherwise(F.timestamp_millis(value))


def iso_instant(ts: Column) -> Column:
    """ISO-8601 UTC text with as many fraction digits (0, 3 or 6) as the value needs."""
    micros = F.unix_micros(ts)
    body = "yyyy-MM-dd'T'HH:mm:ss"
    return (
        F.when(micros % 1_000_000 == 0, F.date_format(ts, f"{body}'Z'"))
        .when(micros % 1_000 == 0, F.date_format(ts, f"{body}.SSS'Z'"))
        .otherwise(F.date_format(ts, f"{body}.SSSSSS'Z'"))
    )


def day_start_epoch(day: Column) -> Column:
    """Epoch seconds of a date's start in UTC."""
    return F.unix_date(day.cast("date")).cast("bigint") * 86400
