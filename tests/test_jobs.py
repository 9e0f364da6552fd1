"""The jobs against each other, on small landed responses."""

import json
import zipfile
from datetime import date, timedelta
from decimal import Decimal

import pytest

from helpers import rows_of, utc
from wickwork.operators import serving
from wickwork.plans import jobs

START = utc(2024, 1, 10)


def kline(hour, close, day=10, volume="5"):
    opened = int(utc(2024, 1, day, hour).timestamp() * 1000)
    high, low = str(float(close) + 1), str(float(close) - 1)
    return [opened, close, high, low, close, volume, opened + 3_599_999, "50", 4, "x", "y", "z"]


def landed(spark, **bodies):
    rows = [(coin, json.dumps(b) if not isinstance(b, str) else b) for coin, b in bodies.items()]
    return spark.createDataFrame(rows, "coin_id string, body string")


def coin_list(spark, *coins):
    rows = [
        {"id": c, "symbol": s, "name": c.title(), "market_cap": cap, "market_cap_rank": i + 1,
         "price_change_percentage_24h": 1.23456, "current_price": price}
        for i, (c, s, cap, price) in enumerate(coins)
    ]
    return spark.createDataFrame([(json.dumps(rows),)], "body string")


def symbols(spark, *bases):
    rows = [{"symbol": f"{b}USDT", "baseAsset": b, "quoteAsset": "USDT", "status": "TRADING"} for b in bases]
    return spark.createDataFrame([(json.dumps({"symbols": rows}),)], "body string")


@pytest.fixture()
def tables(spark, tmp_path):
    t = jobs.Tables(str(tmp_path / "tables"))
    t.create(spark)
    return t


COINS = [("bit", "btc", 100, 40.0), ("eth", "eth", 50, 20.0), ("dollar", "usdx", 25, None)]


def test_candles_from_response_to_chart(spark, tables):
    seeded = jobs.seed_coins(spark, tables, coin_list(spark, *COINS), symbols(spark, "BTC", "ETH"))
    assert seeded == {"rows": 3, "matched": 2, "unmatched": 1}
    work = jobs.candle_work_list(spark, tables, START + timedelta(hours=3))
    assert rows_of(work, "coin_id", "binance_symbol") == [("bit", "BTCUSDT"), ("eth", "ETHUSDT")]

    first = landed(spark, bit=[kline(0, "10"), kline(1, "11"), kline(2, "12"), kline(1, "0")], eth=[kline(1, "5")], gone="oops")
    as_of = utc(2024, 1, 10, 2, 30)
    assert jobs.ingest_candles(spark, tables, first, as_of) == {"rows": 5, "kept": 4, "skipped": 1, "failed": 1}
    prices = tables.read(spark, "coin_snapshots")
    # The candle of hour 2 was still open.
    assert [(c, int(p), s) for c, p, s in rows_of(prices, "coin_id", "price_usd", "price_source")] == [
        ("bit", 11, "binance_rest"), ("eth", 5, "binance_rest"),
    ]
    marks = {r["coin_id"]: r["last_loaded_close_time"].hour for r in tables.read(spark, "ingestion_watermarks").collect()}
    assert marks == {"bit": 2, "eth": 1}  # the open candle counts for the watermark

    # Two hours on: the overlap brings hour 2 again, closed and revised.
    second = landed(spark, bit=[kline(1, "11"), kline(2, "15", volume="8"), kline(3, "16")])
    later = utc(2024, 1, 10, 4, 5)
    assert jobs.ingest_candles(spark, tables, second, later)["kept"] == 3
    assert tables.read(spark, "bronze_candles").count() == 7
    assert tables.read(spark, "coin_snapshots").filter("coin_id = 'bit'").first()["price_usd"] == 16

    jobs.rebuild_silver(spark, tables)
    silver = tables.read(spark, "silver_candles")
    assert silver.count() == 5
    assert silver.filter("coin_id = 'bit' and hour(open_time) = 2").first()["close"] == 15
    for unit in ("hour", "day"):
        jobs.rebuild_gold(spark, tables, unit)
        assert jobs.sync_serving(spark, tables, unit, later) == {"upserted": 5 if unit == "hour" else 2, "pruned": 0}
    day = tables.read(spark, "daily_candle_metrics").filter("coin_id = 'bit'").first()
    assert (int(day["open"]), int(day["close"]), int(day["volume"]), day["candle_count"]) == (10, 16, 23, 4)
    hourly, daily = (tables.read(spark, n) for n in ("candle_rollups_hourly", "candle_rollups_daily"))
    assert hourly.count() == 5 and daily.filter("is_closed").count() == 0
    bars = serving.history(daily.drop("month"), hourly.drop("date"), "bit", utc(2024, 1, 1), later).collect()
    assert [(int(b["open"]), int(b["close"]), int(b["volume"])) for b in bars] == [(10, 16, 23)]


def test_every_job_may_run_again(spark, tables):
    jobs.seed_coins(spark, tables, coin_list(spark, *COINS), symbols(spark, "BTC"))
    raw = landed(spark, bit=[kline(h, str(10 + h)) for h in range(5)])
    as_of = utc(2024, 1, 10, 5)
    names = ["coins", "coin_snapshots", "ingestion_watermarks", "silver_candles", "hourly_candle_metrics", "candle_rollups_hourly"]
    seen = []
    for _ in range(2):
        jobs.ingest_candles(spark, tables, raw, as_of)
        jobs.refresh_silver(spark, tables, START)
        jobs.rebuild_gold(spark, tables, "hour", as_of=as_of)
        jobs.sync_serving(spark, tables, "hour", as_of)
        seen.append([sorted(map(str, tables.read(spark, n).collect())) for n in names])
    assert seen[0] == seen[1]
    assert tables.read(spark, "bronze_candles").count() == 10


def test_incremental_rebuild_keeps_older_hours_of_the_day(spark, tables):
    raw = landed(spark, bit=[kline(h, str(10 + h)) for h in range(20)])
    as_of = utc(2024, 1, 10, 20)
    jobs.ingest_candles(spark, tables, raw, as_of)
    jobs.rebuild_silver(spark, tables)
    jobs.rebuild_gold(spark, tables, "hour")
    full = sorted(map(str, tables.read(spark, "hourly_candle_metrics").collect()))
    jobs.rebuild_gold(spark, tables, "hour", as_of=as_of)
    assert sorted(map(str, tables.read(spark, "hourly_candle_metrics").collect())) == full


def test_silver_refresh_without_news_writes_nothing(spark, tables):
    jobs.ingest_candles(spark, tables, landed(spark, bit=[kline(0, "10")]), utc(2024, 1, 10, 5))
    assert jobs.refresh_silver(spark, tables, START) == [date(2024, 1, 10)]
    assert jobs.refresh_silver(spark, tables, START, published_after=utc(2024, 1, 10, 5)) == []


def test_coin_refresh_leaves_exchange_prices_alone(spark, tables):
    jobs.seed_coins(spark, tables, coin_list(spark, *COINS), symbols(spark, "BTC"))
    first, second = utc(2024, 1, 10, 1), utc(2024, 1, 10, 2)
    assert jobs.refresh_coins(spark, tables, coin_list(spark, *COINS), first) == {"coins": 3, "listings": 0, "failed": 0}
    jobs.ingest_candles(spark, tables, landed(spark, bit=[kline(0, "77", day=11)]), utc(2024, 1, 12))
    renamed = [("bit", "btc", 200, 41.0), ("eth", "ETH", 60, 21.0), ("dollar", "usdx", 25, 1.0)]
    jobs.refresh_coins(spark, tables, coin_list(spark, *renamed), second)
    got = {r["coin_id"]: r for r in tables.read(spark, "coin_snapshots").collect()}
    assert (got["bit"]["price_usd"], got["bit"]["price_source"]) == (77, "binance_rest")
    assert got["bit"]["market_cap_usd"] == 200 and got["bit"]["change_percent_24h"] == Decimal("1.2346")
    assert (got["eth"]["price_usd"], got["eth"]["price_source"], got["eth"]["updated_at"].hour) == (21, "coingecko", 2)
    assert got["dollar"]["price_usd"] == 1
    coins = {r["coin_id"]: r for r in tables.read(spark, "coins").collect()}
    assert coins["bit"]["binance_symbol"] == "BTCUSDT" and coins["eth"]["symbol"] == "ETH"


def test_first_price_of_an_unlisted_coin_is_zero(spark, tables):
    jobs.refresh_coins(spark, tables, coin_list(spark, *COINS), utc(2024, 1, 10, 1))
    assert tables.read(spark, "coin_snapshots").filter("coin_id = 'dollar'").first()["price_usd"] == 0


def test_listings_once_a_day(spark, tables):
    ticker = {"market": {"identifier": "x"}, "base": "A", "target": "B", "converted_last": {"usd": 1},
              "converted_volume": {"usd": 2}}
    raw = landed(spark, bit={"tickers": [ticker, {**ticker, "target": ""}]}, eth="<html>")
    listing = coin_list(spark, *COINS)
    assert jobs.refresh_coins(spark, tables, listing, utc(2024, 1, 10, 1), raw_tickers=raw)["listings"] == 0
    assert tables.read(spark, "markets").count() == 0
    assert jobs.refresh_coins(spark, tables, listing, utc(2024, 1, 11, 0), raw_tickers=raw) == {"coins": 3, "listings": 1, "failed": 1}
    assert jobs.refresh_coins(spark, tables, listing, utc(2024, 1, 12, 0), raw_tickers=raw)["listings"] == 1
    assert rows_of(tables.read(spark, "markets"), "coin_id", "exchange_id", "target_symbol") == [("bit", "x", "B")]


def test_archive_backfill(spark, tables, tmp_path):
    jobs.seed_coins(spark, tables, coin_list(spark, *COINS), symbols(spark, "BTC", "ETH"))
    for kind, name in (("monthly", "BTCUSDT-1h-2023-12"), ("daily", "BTCUSDT-1h-2023-12-31"), ("daily", "BTCUSDT-1h-2024-01-01"), ("monthly", "OTHER-1h-2023-12")):
        symbol = name.split("-")[0]
        folder = tmp_path / "archive" / kind / symbol / "1h"
        folder.mkdir(parents=True, exist_ok=True)
        day = name[-2:] if kind == "daily" else "01"
        month = name.split("1h-")[1][:7]
        opened = int(utc(*map(int, month.split("-")), int(day)).timestamp() * 1000)
        with zipfile.ZipFile(folder / f"{name}.zip", "w") as z:
            z.writestr(f"{name}.csv", f"{opened},1,2,1,1.5,3,{opened + 3599999},4,5,0,0,0\n")
    report = jobs.backfill_candles(
        spark, tables, str(tmp_path / "archive"), str(tmp_path / "staging"), utc(2024, 1, 2)
    )
    assert rows_of(report, "coin_id", "files", "rows") == [("bit", 2, 2)]
    bronze = tables.read(spark, "bronze_candles")
    assert rows_of(bronze, "coin_id", "month") == [("bit", "2023-12"), ("bit", "2024-01")]
    assert (tmp_path / "staging" / "coin_id=bit").is_dir()


def test_market_cap_backfill(spark, tables):
    def body(*points):
        return json.dumps({"prices": [[ms, v] for ms, v in points], "market_caps": [], "total_volumes": []})

    raw = spark.createDataFrame(
        [("bit", 0, body((1000, 1.0), (2000, 2.0))), ("bit", 1, body((2000, 3.0)))], "coin_id string, request int, body string"
    )
    for _ in range(2):
        jobs.backfill_market_caps(spark, tables, raw)
        got = tables.read(spark, "market_cap_history")
        assert [int(r[0]) for r in rows_of(got, "price_usd")] == [1, 3]
    jobs.seed_coins(spark, tables, coin_list(spark, *COINS), symbols(spark))
    assert jobs.backfill_requests(spark, tables, date(2024, 12, 31), 180, limit_coins=2).count() == 4


def test_sync_must_look_back_further_than_the_rebuild():
    with pytest.raises(ValueError):
        serving.check_margin("hour", timedelta(hours=6), timedelta(hours=6))
