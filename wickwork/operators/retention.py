"""Retention limits."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from wickwork.functions.times import at, months_before, utc

# How long serving rollups are kept.
HOURLY_DAYS = 10
DAILY_MONTHS = 13


def cutoff(as_of: datetime, days: int | None = None, months: int | None = None) -> Column:
    """Oldest timestamp to keep, a constant; a row exactly at it stays."""
    if (days is None) == (months is None):
        raise ValueError("give either days or months")
    return at(utc(as_of) - timedelta(days=days)) if days is not None else months_before(as_of, months)


def prune(df: DataFrame, ts_col: str, as_of: datetime, days: int | None = None, months: int | None = None) -> DataFrame:
    """Rows not older than the limit."""
    return df.filter(F.col(ts_col) >= cutoff(as_of, days, months).cast(df.schema[ts_col].dataType))
