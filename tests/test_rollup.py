import random
from datetime import datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import bronze, candle, rows_of, utc
from wickwork.operators import incremental, quality, rollup

V1, V2, V3 = utc(2024, 1, 5), utc(2024, 1, 6), utc(2024, 1, 7)


def test_latest_version_wins_whatever_the_row_order(spark):
    rows = [
        candle(close=11, published=V3),
        candle(close=99, published=None),
        candle(close=10, published=V1),
        candle(close=12, published=V2),
        candle("b", close=5, published=None),
    ]
    for _ in range(3):
        random.shuffle(rows)
        got = rollup.silver(bronze(spark, rows))
        assert rows_of(got, "coin_id", "close") == [("a", Decimal(11)), ("b", Decimal(5))]
        assert got.filter("coin_id = 'a'").first()["latest_publish_time"] is not None


def test_versions_published_together_keep_one_whole_row(spark):
    rows = [candle(close=11, high=20, published=V1), candle(close=12, high=13, published=V1)]
    got = {tuple(map(str, r)) for _ in range(2) for r in rows_of(rollup.silver(bronze(spark, rows[::-1])), "close", "high")}
    got |= {tuple(map(str, r)) for r in rows_of(rollup.silver(bronze(spark, rows)), "close", "high")}
    assert got == {("12.000000000", "13.000000000")}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(1, 9), st.integers(1, 50)), min_size=1, max_size=25
    ),
    st.integers(1, 24),
)
def test_merging_batches_equals_one_dedupe(spark, versions, cut):
    rows = [
        candle(f"c{coin}", hour=hour, close=close, published=utc(2024, 1, 5, 0, minute))
        for coin, hour, close, minute in versions
    ]
    columns = ["coin_id", "open_time", "close", "latest_publish_time"]
    whole = rows_of(rollup.silver(bronze(spark, rows)), *columns)
    first, second = rows[:cut], rows[cut:]
    stored = rollup.silver(bronze(spark, first))
    assert rows_of(rollup.merge_silver(stored, bronze(spark, second + first)), *columns) == whole


def test_a_candle_without_a_time_is_one_row_when_sent_again(spark):
    rows = [candle(open_time=None, published=V1), candle(interval=None, published=V1)]
    stored = rollup.silver(bronze(spark, rows))
    assert rollup.merge_silver(stored, bronze(spark, rows)).count() == 2


def silver_of(spark, rows):
    return rollup.silver(bronze(spark, rows))


def test_day_edges_and_measures(spark):
    rows = [
        candle(hour=23, day=1, open=1, high=9, low=1, close=2, published=V1),
        candle(hour=0, day=2, open=3, high=4, low=2, close=4, published=V2),
        candle(hour=5, day=2, open=5, high=8, low=1, close=6, published=V1),
    ]
    got = rows_of(
        rollup.ohlcv(silver_of(spark, rows), "day"), "day", "open", "high", "low", "close", "volume", "candle_count"
    )
    assert [tuple(int(v) if isinstance(v, Decimal) else v for v in r[1:]) for r in got] == [
        (1, 9, 1, 2, 5, 1),
        (3, 8, 1, 6, 10, 2),
    ]


def test_partial_days(spark):
    full = [candle(hour=h, day=1) for h in range(24)]
    short = [candle(hour=h, day=2) for h in range(23)]
    gold = rollup.ohlcv(silver_of(spark, full + short), "day")
    assert rows_of(rollup.partial_days(gold), "candle_count") == [(23,)]
    hourly = rollup.ohlcv(silver_of(spark, full + short), "hour")
    assert rows_of(rollup.rebucket(hourly, "hour", "day"), *gold.columns) == rows_of(gold, *gold.columns)


def test_lookback_takes_whole_buckets():
    assert rollup.lookback_start(datetime(2024, 1, 2, 13, 40), "hour") == datetime(2024, 1, 2, 7)
    assert rollup.lookback_start(datetime(2024, 1, 5, 13, 40), "day") == datetime(2024, 1, 2)


def test_incremental_buckets_equal_full_ones(spark):
    start = utc(2024, 1, 1)
    rows = []
    for i in range(200):  # quarter-hour candles
        opened = start + timedelta(minutes=15 * i)
        rows.append(candle(open_time=opened, close_time=opened + timedelta(minutes=14), open=i + 1, close=i + 2, published=V1))
    silver = silver_of(spark, rows)
    full = rollup.ohlcv(silver, "hour")
    part = rollup.ohlcv(silver, "hour", as_of=datetime(2024, 1, 2, 20, 10))
    since = F.col("hour") >= F.lit("2024-01-02 14:00:00").cast("timestamp")
    assert rows_of(part, *full.columns) == rows_of(full.filter(since), *full.columns)
    assert part.agg(F.min("candle_count")).first()[0] == 4


def test_doubles_are_checked_for_nan(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0, 1.0, 0.0), (float("nan"), 2.0, 1.0, 1.0, 0.0), (1.0, float("inf"), 1.0, 1.0, 0.0)],
        "open double, high double, low double, close double, volume double",
    )
    kept, rejected = quality.sane(df)
    assert (kept.count(), rejected.count()) == (1, 2)


def test_watermarks_and_latest_closed(spark):
    rows = [candle(hour=0, close=1), candle(hour=1, close=2), candle(hour=2, close=3), candle("b", hour=2, close=9)]
    silver = silver_of(spark, rows)
    now = utc(2024, 1, 1, 2, 30)
    assert rows_of(incremental.latest_closed(silver, now), "coin_id", "price_usd") == [("a", Decimal(2))]
    marks = rows_of(incremental.new_watermarks(silver), "coin_id", "last_loaded_close_time")
    assert [m[1].minute for m in marks] == [59, 59] and [m[1].hour for m in marks] == [2, 2]  # the open candle counts


def test_fetch_start(spark):
    coins = spark.createDataFrame([("a",), ("b",)], "coin_id string")
    marks = spark.createDataFrame(
        [("a", "1h", utc(2024, 1, 1, 10)), ("b", "4h", utc(2024, 1, 1, 10))],
        "coin_id string, interval string, last_loaded_close_time timestamp",
    )
    starts = lambda **kw: {
        r["coin_id"]: r["fetch_from"].timestamp()
        for r in incremental.fetch_start(coins, marks, utc(2024, 1, 2), **kw).collect()
    }
    assert starts() == {"a": utc(2024, 1, 1, 8).timestamp(), "b": utc(2024, 1, 1).timestamp()}
    assert starts(interval="4h")["b"] == utc(2024, 1, 1, 2).timestamp()


def test_due():
    assert incremental.due(utc(2024, 1, 1, 0, 59), 0)
    assert not incremental.due(utc(2024, 1, 1, 1), 0)


def test_checks(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "q")], "k string, v int, d string")
    nulls = {r["column_name"]: r["violations"] for r in quality.check_not_null(df, ["k", "v", "d"]).collect()}
    assert nulls == {"k": 1, "v": 0, "d": 1}
    assert rows_of(quality.check_unique(df.filter("k is not null"), ["k"]), "k", "row_count") == [("a", 2)]
    assert quality.check_domain(df, "d", ["x", "y"]).collect()[0]["d"] == "q"
    parents = spark.createDataFrame([("b",)], "k string")
    assert quality.orphans(df.filter("k is not null"), parents, "k").count() == 2
