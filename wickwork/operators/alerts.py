"""Threshold alerts over fixed windows of monitoring samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The two rules on event subscriptions. Lag has to stay above its threshold
# from one window to the next; a single dead letter is enough.
LAG_RULE = {"metric": "oldest_unacked_message_age", "agg": "max", "threshold": 600, "hold_periods": 2}
DEAD_LETTER_RULE = {"metric": "dead_letter_message_count", "agg": "sum", "threshold": 0, "hold_periods": 1}
PERIOD_SECONDS = 300


def threshold_alert(
    samples: DataFrame,
    agg: str = "max",
    threshold: float = 0,
    period_seconds: int = PERIOD_SECONDS,
    hold_periods: int = 1,
    metric: str | None = None,
) -> DataFrame:
    """Windows per subscription whose max or sum is above ``threshold``, ``hold_periods`` in a row.

    The row returned is the last window of the run, with its value. Each window in breach
    votes for itself and the windows that follow, and a window with enough votes is in
    alert: aggregates only, so no subscription is gathered in one task.
    """
    if metric is not None:
        samples = samples.filter(F.col("metric") == metric)
    aggregate = {"max": F.max, "sum": F.sum}[agg]("value")
    ts_type = samples.schema["ts"].dataType
    windows = (
        samples.groupBy("subscription_id", F.window("ts", f"{period_seconds} seconds").alias("w"))
        .agg(aggregate.alias("value"))
        .filter(F.col("value") > threshold)
        .select("subscription_id", F.col("w.start").cast(ts_type).alias("window_start"), "value")
    )
    if hold_periods == 1:
        return windows
    votes = windows.select(
        "subscription_id",
        "window_start",
        "value",
        F.explode(F.sequence(F.lit(0), F.lit(hold_periods - 1))).alias("later"),
    ).select(
        "subscription_id",
        (F.col("window_start") + F.make_interval(secs=F.col("later") * period_seconds)).alias("window_start"),
        F.when(F.col("later") == 0, F.col("value")).alias("value"),
    )
    return (
        votes.groupBy("subscription_id", "window_start")
        .agg(F.count("*").alias("__votes"), F.max("value").alias("value"))
        .filter(F.col("__votes") == hold_periods)
        .drop("__votes")
    )
