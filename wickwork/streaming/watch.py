"""Stateful streams: delivery attempts that are counted, and alerts that open and close.

State is keyed by message or subscription, holds a few numbers, and is let go by event-time timers.
Only failed deliveries and the samples of alert rules reach Python.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wickwork.operators.alerts import PERIOD_SECONDS
from wickwork.session import share_package

# Fixed value: failed deliveries after which a message is parked.
ATTEMPTS = 5
FORGET = timedelta(days=7)


def park_failures(
    failed: DataFrame, attempts: int = ATTEMPTS, forget: timedelta = FORGET, delivered: str = "publish_time", late: timedelta = timedelta(0)
) -> DataFrame:
    """Of a stream of failed deliveries (``events.split_invalid``), each message's ``attempts``-th, once.

    ``failed`` has ``message_id`` and ``delivered``, the time of the delivery; a message without an id is told by its text.
    Fewer failures park nothing: whatever good delivery there was in between or comes later has been stored by the
    other branch of the split. What is known of a message is forgotten when no delivery of it has failed for ``forget``.
    Deliveries may come late by ``late`` and in any order within a batch.
    """
    share_package(failed.sparkSession)
    names = failed.columns
    key = F.coalesce(F.col("message_id"), F.sha2(F.coalesce("value", F.lit("")).cast("binary"), 256)).alias("__message")
    keyed = failed.withWatermark(delivered, f"{int(late.total_seconds())} seconds").select(key, *names)
    out = T.StructType([*failed.schema.fields, T.StructField("attempts", T.IntegerType())])
    keep_ms = int(forget.total_seconds() * 1000)

    def count(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        failures, last = state.get if state.exists else (0, 0)
        found = pd.concat(list(frames)).sort_values([delivered, "value"], kind="stable", na_position="first")
        before, failures = failures, failures + len(found)
        times = found[delivered].dropna()
        if len(times):
            last = max(last, int(times.max().timestamp() * 1000))
        state.update((failures, last))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + max(keep_ms, 1))
        if before < attempts <= failures:
            parked = found.iloc[attempts - before - 1 : attempts - before]
            yield parked[names].assign(attempts=attempts)

    return keyed.groupBy("__message").applyInPandasWithState(
        count, out, "failures int, last bigint", "append", GroupStateTimeout.EventTimeTimeout
    )


def watch(
    samples: DataFrame,
    agg: str = "max",
    threshold: float = 0,
    period_seconds: int = PERIOD_SECONDS,
    hold_periods: int = 1,
    metric: str | None = None,
    late: timedelta = timedelta(minutes=10),
) -> DataFrame:
    """``alerts.threshold_alert`` of a stream: ``subscription_id``, ``window_start``, ``value`` and ``event``.

    A window in alert is ``opened`` if the one before it was not, else ``open``; the first window after a run
    that is not in breach is ``closed``. A subscription that sends nothing more is closed by a timer, when the watermark has
    passed the next window, with no value. Each is given once, when no sample of its window can come any more: samples may be
    late by ``late`` and in any order within that. State holds the windows that the watermark has not passed.
    """
    share_package(samples.sparkSession)
    if metric is not None:
        samples = samples.filter(F.col("metric") == metric)
    together = {"max": max, "sum": operator.add}[agg]
    period_ms = period_seconds * 1000
    values = samples.withWatermark("ts", f"{int(late.total_seconds())} seconds").select("subscription_id", "ts", "value")
    values = values.withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, last, starts, totals = state.get if state.exists else (0, 0, [], [])
        waiting = dict(zip(starts, totals))
        passed = state.getCurrentWatermarkMs()
        for found in [] if state.hasTimedOut else frames:
            for ms, value in zip(found["ms"].tolist(), found["value"].tolist()):
                start = ms // period_ms * period_ms
                if start + period_ms > passed and value is not None and value == value:
                    waiting[start] = together(waiting[start], value) if start in waiting else value
        rows = []

        def silence(until: int) -> int:
            """Close the run if the window after its last one is known to be empty."""
            if run >= hold_periods and last + 2 * period_ms <= until:
                rows.append((key[0], last + period_ms, None, "closed"))
                return 0
            return run

        for start in sorted(k for k in waiting if k + period_ms <= passed):
            value = waiting.pop(start)
            run = silence(start)
            before = run if start == last + period_ms else 0
            run, last = before + 1 if value > threshold else 0, start
            if run >= hold_periods:
                rows.append((key[0], start, value, "opened" if run == hold_periods else "open"))
            elif before >= hold_periods:
                rows.append((key[0], start, value, "closed"))
        run = silence(passed)
        timers = [k + period_ms for k in waiting] + ([last + 2 * period_ms] if run else [])
        if timers:
            state.update((run, last, list(waiting), list(waiting.values())))
            state.setTimeoutTimestamp(max(min(timers), passed + 1))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=["subscription_id", "ms", "value", "event"])

    events = values.groupBy("subscription_id").applyInPandasWithState(
        step,
        "subscription_id string, ms bigint, value double, event string",
        "run int, last bigint, starts array<bigint>, totals array<double>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return events.select("subscription_id", F.timestamp_millis("ms").alias("window_start"), "value", "event")
