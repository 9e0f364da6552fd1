"""The grid of requests a historical backfill makes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wickwork.functions.times import day_start_epoch

# Days per request and days of history.
CHUNK_DAYS = 90
TOTAL_DAYS = 365


def _windows(end: date, total_days: int, chunk_days: int) -> Column:
    """All windows as one constant array, newest first."""
    last = F.lit(end.isoformat()).cast("date")
    if total_days <= 0:
        offsets = F.array().cast("array<int>")
    else:
        offsets = F.sequence(F.lit(0), F.lit(total_days - 1), F.lit(chunk_days))
    return F.transform(
        offsets,
        lambda back, i: F.struct(
            i.alias("window_no"),
            F.date_sub(last, F.least(back + chunk_days, F.lit(total_days))).alias("window_start"),
            F.date_sub(last, back).alias("window_end"),
        ),
    )


def backfill_windows(
    spark: SparkSession, end: date, total_days: int = TOTAL_DAYS, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Windows of ``chunk_days`` going back from ``end``, newest first; the oldest one may be shorter."""
    return spark.range(1).select(F.inline(_windows(end, total_days, chunk_days)))


def work_grid(
    coins: DataFrame, end: date, total_days: int = TOTAL_DAYS, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Every coin with every window, and the window's bounds as epoch seconds.

    The few windows are exploded from a constant on each coin row: no cross join, no shuffle.
    """
    return coins.select("*", F.inline(_windows(end, total_days, chunk_days))).withColumns(
        {
            "from_epoch": day_start_epoch(F.col("window_start")),
            "to_epoch": day_start_epoch(F.col("window_end")),
        }
    )
