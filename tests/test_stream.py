import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import bronze, candle, frame, rows_of, utc
from wickwork import layout, schemas as S
from wickwork.catalog import streams
from wickwork.layout import read_table
from wickwork.operators import rollup
from wickwork.streaming import events as E

GOOD = {
    "coin_id": "bit", "interval": "1h", "open_time": "2024-01-01T22:00:00Z", "close_time": "2024-01-01T22:59:59Z",
    "open": "64.25", "high": "66.00", "low": "63.50", "close": "65.75", "volume": "310.12500001",
    "quote_volume": "20165.30", "trade_count": 87, "is_closed": True, "source": "binance_ws",
}


def messages(spark, *payloads):
    rows = [
        (p if isinstance(p, str) else json.dumps(p), utc(2024, 1, 2), str(i), None) for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, S.MESSAGE)


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


@pytest.mark.parametrize(
    "payload,reason",
    [
        (GOOD, None),
        ({**GOOD, "new_field": {"deep": [1]}, "publish_time": "1999-01-01T00:00:00Z"}, None),
        ({**GOOD, "open_time": "2024-01-01T22:00:00.123+02:00"}, None),
        (without("coin_id"), "missing required field: coin_id"),
        ({**GOOD, "coin_id": ""}, "missing required field: coin_id"),
        (without("volume"), "missing required field: volume"),
        (without("trade_count"), "missing required field: trade_count"),
        ({**GOOD, "open_time": 1704146400000}, "not an RFC 3339 time: open_time"),
        ({**GOOD, "open_time": "2024"}, "not an RFC 3339 time: open_time"),
        ({**GOOD, "close_time": "2024-13-45T00:00:00Z"}, "not an RFC 3339 time: close_time"),
        ({**GOOD, "high": "NaN"}, "not an amount: high"),
        ("{\"coin_id\": \"bit\", ", "malformed JSON"),
        ("not json", "malformed JSON"),
        ("", "malformed JSON"),
    ],
)
def test_one_message(spark, payload, reason):
    valid, dead = E.split_invalid(E.parse_events(messages(spark, payload), "bronze"))
    if reason is None:
        row = valid.first()
        assert valid.columns == S.BRONZE.names
        assert row["publish_time"] is not None and row["subscription_name"] == "bronze" and row["message_id"] == "0"
        assert valid.select(F.year("publish_time")).first()[0] == 2024
        assert dead.count() == 0
    else:
        assert valid.count() == 0
        letter = dead.first()
        assert letter["reason"] == reason
        assert letter["value"] == (payload if isinstance(payload, str) else json.dumps(payload))


def test_messages_are_parsed_once(spark):
    valid, _ = E.split_invalid(E.parse_events(messages(spark, GOOD), "bronze"))
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_broker_records(spark):
    df = spark.createDataFrame([(bytearray(b"{}"), utc(2024, 1, 1), 3, 17)], "value binary, timestamp timestamp, partition int, offset bigint")
    row = E.broker_messages(df).first()
    assert (row["value"], row["message_id"]) == ("{}", "3-17")


def payload_rows(n=60):
    out = []
    for i in range(n):
        opened = utc(2024, 1, 1) + timedelta(hours=i % 20)
        payload = {
            **GOOD,
            "coin_id": f"c{i % 3}",
            "open_time": opened.strftime("%Y-%m-%dT%H:%M:%SZ"),
            "close_time": (opened + timedelta(minutes=59)).strftime("%Y-%m-%dT%H:%M:%SZ"),
            "close": str(100 + i),
            "high": "500",
        }
        if i % 15 == 7:
            payload.pop("open")
        out.append({"value": json.dumps(payload), "publish_time": f"2024-01-03T00:{i:02d}:00.000Z", "message_id": str(i)})
    return out


@pytest.fixture(params=["in order", "newest first", "repeated"])
def landed(request, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = payload_rows()
    if request.param == "newest first":
        rows = rows[::-1]
    if request.param == "repeated":
        rows = rows + rows[10:40]
    for i in range(0, len(rows), 20):
        (folder / f"{i:04d}.json").write_text("\n".join(json.dumps(r) for r in rows[i : i + 20]))
    return folder


def expected(spark, tmp_path):
    """The batch answer over the same messages, each once."""
    (tmp_path / "all.json").write_text("\n".join(json.dumps(r) for r in payload_rows()))
    batch = spark.read.schema(S.MESSAGE).json(str(tmp_path / "all.json"))
    valid, dead = E.split_invalid(E.parse_events(batch, "bronze"))
    return rollup.silver(valid), dead


def test_streams_equal_the_batch(spark, landed, tmp_path):
    source = E.candle_stream(spark, str(landed), max_files=1)
    valid, dead = E.split_invalid(E.parse_events(source, "bronze"))
    p = lambda name: str(tmp_path / name)
    runs = [
        E.start_bronze(valid, p("bronze"), p("c1")),
        E.start_dead_letters(dead, p("dead"), p("c2")),
        E.start_ohlcv(valid, p("silver"), p("gold"), "hour", p("c3")),
    ]
    for run in runs:
        run.awaitTermination()
        assert run.exception() is None
    silver, letters = expected(spark, tmp_path)
    columns = ["coin_id", "open_time", "close", "latest_publish_time"]
    assert rows_of(read_table(spark, p("silver"), layout.SILVER), *columns) == rows_of(silver, *columns)
    gold = read_table(spark, p("gold"), layout.GOLD_HOURLY)
    assert rows_of(gold, "coin_id", "hour", "close", "candle_count") == rows_of(
        rollup.ohlcv(silver, "hour"), "coin_id", "hour", "close", "candle_count"
    )
    from_bronze = rollup.silver(read_table(spark, p("bronze"), layout.BRONZE))
    assert rows_of(from_bronze, *columns) == rows_of(silver, *columns)
    stored = spark.read.parquet(p("dead"))
    assert set(rows_of(stored, "message_id", "reason")) == set(rows_of(letters, "message_id", "reason"))


def test_replay_on_a_new_checkpoint_changes_nothing(spark, landed, tmp_path):
    valid, _ = E.split_invalid(E.parse_events(E.candle_stream(spark, str(landed)), "bronze"))
    path = str(tmp_path / "silver")
    seen = []
    for checkpoint in ("one", "one", "two"):
        E.start_silver(valid, path, str(tmp_path / checkpoint)).awaitTermination()
        seen.append(sorted(map(str, read_table(spark, path, layout.SILVER).collect())))
    assert seen[0] == seen[1] == seen[2] and seen[0]


def test_late_version_with_an_older_publish_time(spark, tmp_path):
    path = str(tmp_path / "silver")
    from wickwork.sinks.tables import create_table

    create_table(spark, path, layout.SILVER)
    for close, published in ((11, utc(2024, 1, 6)), (10, utc(2024, 1, 5)), (11, utc(2024, 1, 6))):
        E.merge_into_silver(bronze(spark, [candle(close=close, published=published)]), path)
    assert [int(r[0]) for r in rows_of(read_table(spark, path, layout.SILVER), "close")] == [11]


def test_stream_windows_equal_the_batch(spark, tmp_path):
    folder = tmp_path / "candles"
    rows = [candle(open_time=utc(2024, 1, 1) + timedelta(minutes=20 * i), open=i + 1, close=i + 2, published=utc(2024, 1, 9)) for i in range(90)]
    for i in range(0, 90, 30):  # files land in time order
        frame(spark, rows[i : i + 30], S.CANDLE).coalesce(1).write.mode("append").parquet(str(folder))
    source = spark.readStream.schema(S.CANDLE).option("maxFilesPerTrigger", 1).parquet(str(folder))
    path = str(tmp_path / "gold")
    E.start_upserts(E.windowed_ohlcv(source, "hour"), path, layout.GOLD_HOURLY, str(tmp_path / "c")).awaitTermination()
    got = read_table(spark, path, layout.GOLD_HOURLY).drop("date")
    want = rollup.ohlcv(rollup.silver(bronze(spark, rows)), "hour")
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


def test_streamed_batches_have_files_for_several_tasks(spark, tmp_path, monkeypatch):
    """The number of batches is fixed; what grows with the table is the number of files in each."""
    monkeypatch.setattr(streams, "_ROWS_PER_FILE", 50, raising=False)
    rows = [(i, datetime(2024, 1, 1 + i % 5, i % 24), i, "click", 1.0, json.dumps({"k": 40 + i})) for i in range(600)]
    events = spark.createDataFrame(
        rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    batches = []

    def note(batch, _):
        batches.append(([r["message_id"] for r in batch.select("message_id").collect()], batch.rdd.getNumPartitions()))

    valid, _ = streams._split(spark, str(tmp_path), 3)
    run = valid.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).foreachBatch(note)
    run.trigger(availableNow=True).start().awaitTermination()
    assert sorted(int(i) for ids, _ in batches for i in ids) == list(range(600))
    assert len(batches) == 3 and all(tasks > 1 for _, tasks in batches)
