"""Counted delivery attempts, and alerts on streams against the batch rule."""

import json
import os
import random
from datetime import timedelta

import pytest

from helpers import utc
from wickwork import layout
from wickwork.operators.alerts import LAG_RULE, threshold_alert
from wickwork.streaming import events as E, watch as W

GOOD = {
    "coin_id": "bit", "interval": "1h", "open_time": "2024-01-01T22:00:00Z", "close_time": "2024-01-01T22:59:59Z",
    "open": "64", "high": "66", "low": "63", "close": "65", "volume": "3", "quote_volume": "2", "trade_count": 8, "is_closed": True,
}
BAD = {k: v for k, v in GOOD.items() if k != "open"}


def land(folder, batches):
    folder.mkdir()
    for n, rows in enumerate(batches):
        file = folder / f"{n:03d}.json"
        file.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(file, (10**9 + n, 10**9 + n))  # files come in order of their time


def delivery(message, minute, body, day=2):
    at = utc(2024, 1, day) + timedelta(minutes=minute)
    return {"value": json.dumps(body), "publish_time": at.strftime("%Y-%m-%dT%H:%M:%S.000Z"), "message_id": message}


def run(spark, folder, tmp_path, **options):
    valid, dead = E.split_invalid(E.parse_events(E.candle_stream(spark, str(folder), max_files=1), "bronze"))
    p = lambda name: str(tmp_path / name)
    E.start_bronze(valid, p("bronze"), p("c1")).awaitTermination()
    E.start_dead_letters(W.park_failures(dead, **options), p("parked"), p("c2")).awaitTermination()
    stored = layout.read_table(spark, p("bronze"), layout.BRONZE).select("message_id").distinct()
    parked = spark.read.schema(W.park_failures(dead).schema).parquet(p("parked"))
    return [r[0] for r in stored.orderBy("message_id").collect()], [tuple(r) for r in parked.select("message_id", "reason", "attempts").collect()]


def test_five_failures_park_a_message_and_four_do_not(spark, tmp_path):
    batches = [[delivery("late", n, BAD), delivery("never", n, BAD), delivery("once", n, GOOD)] for n in range(4)]
    batches.append([delivery("late", 4, GOOD), delivery("never", 4, {**GOOD, "high": "x"})])
    batches.append([delivery("never", 5, BAD), delivery("never", 6, BAD)])  # parked already
    land(tmp_path / "in", batches)
    stored, parked = run(spark, tmp_path / "in", tmp_path)
    assert stored == ["late", "once"]
    assert parked == [("never", "not an amount: high", 5)]


def test_many_failures_in_one_batch_and_messages_without_an_id(spark, tmp_path):
    land(tmp_path / "in", [[delivery("m", n, BAD) for n in range(9)] + [delivery(None, n, BAD) for n in range(5)]])
    _, parked = run(spark, tmp_path / "in", tmp_path, attempts=5)
    assert sorted(map(str, parked)) == sorted(map(str, [("m", "missing required field: open", 5), (None, "missing required field: open", 5)]))


def test_failures_are_forgotten(spark, tmp_path):
    batches = [[delivery("m", n, BAD) for n in range(4)]]
    batches += [[delivery("other", 0, BAD, day=9)], [delivery("other", 5, BAD, day=9)], [delivery("m", 10, BAD, day=9)]]
    land(tmp_path / "in", batches)
    _, parked = run(spark, tmp_path / "in", tmp_path, forget=timedelta(hours=1))
    assert parked == []


SCHEMA = "subscription_id string, metric string, ts timestamp, value double"


def watched(spark, rows, tmp_path, files, **rule):
    folder = tmp_path / "samples"
    for n in range(files):
        part = rows[n * len(rows) // files : (n + 1) * len(rows) // files]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    out = W.watch(stream, **rule, late=timedelta(minutes=30))
    writer = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("hold", [1, 2, 3])
def test_alerts_equal_the_batch_rule(spark, tmp_path, hold):
    rng = random.Random(hold)
    metric = "oldest_unacked_message_age"
    rows = [(s, metric, utc(2024, 1, 1) + timedelta(minutes=m), rng.choice([10.0, 700.0, 900.0])) for s in "abc" for m in range(0, 300, 2) if rng.random() < 0.6]
    rows.sort(key=lambda r: (r[2] + timedelta(minutes=rng.randrange(20))).timestamp())  # out of order, within the watermark
    rows += [("end", metric, utc(2024, 1, 2), 0.0), ("end", metric, utc(2024, 1, 2, 2), 0.0), ("end", metric, utc(2024, 1, 2, 4), 0.0)]
    rule = {**LAG_RULE, "hold_periods": hold}
    got = watched(spark, rows, tmp_path, 5, **rule).collect()
    batch = threshold_alert(spark.createDataFrame(rows, SCHEMA), **rule)
    open_rows = sorted((r["subscription_id"], r["window_start"], r["value"]) for r in got if r["event"] != "closed")
    assert open_rows == sorted(tuple(r) for r in batch.select("subscription_id", "window_start", "value").collect()) and open_rows
    opened = {(r["subscription_id"], r["window_start"]) for r in got if r["event"] == "opened"}
    in_alert = {(s, t) for s, t, _ in open_rows}
    assert opened == {(s, t) for s, t in in_alert if (s, t - timedelta(minutes=5)) not in in_alert}
    closed = [(r["subscription_id"], r["window_start"]) for r in got if r["event"] == "closed"]
    assert sorted(closed) == sorted((s, t + timedelta(minutes=5)) for s, t in in_alert if (s, t + timedelta(minutes=5)) not in in_alert)
