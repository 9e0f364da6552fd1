import json
import os
import tracemalloc
import zipfile
from datetime import date
from decimal import Decimal

import pyarrow as pa
import pytest

from helpers import rows_of, utc
from wickwork import schemas as S
from wickwork.catalog import sources
from wickwork.functions.times import epoch_to_timestamp, iso_instant
from wickwork.operators import registry, series
from wickwork.operators.backfill import backfill_windows, work_grid
from wickwork.operators.quality import sane
from wickwork.sources import archive, landed
from pyspark.sql import functions as F

LINE = "1704067200000,1.5,2,1,1.75,10,1704070799999,15,3,0,0,0"


def make_zip(path, entries):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, text in entries.items():
            z.writestr(name, text)


def test_zip_with_two_csvs_blank_lines_and_other_files(spark, tmp_path):
    target = tmp_path / "AUSDT-1h-2024-01.zip"
    micros = LINE.replace("1704067200000", "1704067200000999").replace("1704070799999", "1704070799999999")
    make_zip(target, {"a.csv": f"{LINE}\n\n   \n", "b.csv": micros + "\r\n" + LINE, "readme.txt": "no"})
    lines = archive.read_kline_archive(spark, str(tmp_path))
    assert lines.count() == 3
    rows = landed.archive_to_bronze(lines.withColumn("coin_id", F.lit("a")), "1h", utc(2024, 2, 1))
    got = rows_of(rows, "open_time", "close_time", "close", "trade_count", "is_closed")
    one = (utc(2024, 1, 1), utc(2024, 1, 1, 0, 59, 59, 999000), Decimal("1.75"), 3, True)
    assert [tuple(v if not hasattr(v, "year") else v.replace(tzinfo=one[0].tzinfo) for v in r) for r in got] == [one] * 3


def test_long_archives_come_in_batches(spark, tmp_path, monkeypatch):
    n = 120_001
    make_zip(tmp_path / "AUSDT-1h-2024-01.zip", {"a.csv": "\n".join([LINE] * n)})
    assert archive.read_kline_archive(spark, str(tmp_path)).count() == n


def test_plain_and_gzipped_csv(spark, tmp_path):
    import gzip

    (tmp_path / "AUSDT-1h-2024-01.csv").write_text(LINE + "\n\n" + LINE)
    with gzip.open(tmp_path / "BUSDT-1h-2024-01.csv.gz", "wt") as f:
        f.write(LINE)
    paths = [str(tmp_path / "AUSDT-1h-2024-01.csv"), str(tmp_path / "BUSDT-1h-2024-01.csv.gz")]
    assert archive.read_kline_archive(spark, paths).count() == 3


def test_short_and_unparsable_lines_are_rejected_not_failed(spark, tmp_path):
    make_zip(tmp_path / "AUSDT-1h-2024-01.zip", {"a.csv": f"{LINE}\n1704067200000,1\nx,1,2,1,1,1,y,1,z\n"})
    lines = archive.read_kline_archive(spark, str(tmp_path)).withColumn("coin_id", F.lit("a"))
    rows = landed.archive_to_bronze(lines, "1h", utc(2024, 2, 1))
    kept, rejected = sane(rows)
    assert (kept.count(), rejected.count()) == (1, 2)


KEYS = [
    "d/monthly/A/1h/A-1h-2024-01.zip",
    "d/monthly/A/1h/A-1h-2024-02.zip",
    "d/monthly/A/1h/A-1h-2024-02.zip.CHECKSUM",
    "d/daily/A/1h/A-1h-2024-02-29.zip",
    "d/daily/A/1h/A-1h-2024-03-01.zip",
    "d/daily/A/1h/A-1h-2024-03-01.zip.CHECKSUM",
    "d/daily/B/1h/B-1h-2023-12-31.zip",
]


def test_daily_files_only_after_newest_month(spark):
    keys = spark.createDataFrame([(k,) for k in KEYS], "key string")
    got = [r[0] for r in rows_of(archive.select_archive_files(keys), "key")]
    assert got == sorted([KEYS[0], KEYS[1], KEYS[4], KEYS[6]])


def test_listing_and_reading_selected_files_only(spark, tmp_path):
    for key in KEYS:
        if key.endswith(".zip"):
            make_zip(tmp_path / key, {"x.csv": LINE})
        else:
            (tmp_path / key).write_text("sum")
    keys = archive.select_archive_files(archive.archive_keys(spark, str(tmp_path)))
    assert keys.count() == 4
    assert archive.read_kline_archive(spark, str(tmp_path), keys).select("path").distinct().count() == 4


def test_wanted_files_are_found_however_their_keys_are_written(spark, tmp_path):
    for key in KEYS:
        if key.endswith(".zip"):
            make_zip(tmp_path / key, {"x.csv": LINE})
    keys = archive.select_archive_files(archive.archive_keys(spark, str(tmp_path)))
    names = [r["key"] for r in keys.collect()]
    bare = [n.split(":", 1)[1] for n in names]
    for written in (names, bare, ["file://" + n for n in bare], [names[0], *bare[1:]]):
        wanted = spark.createDataFrame([(n,) for n in written], "key string")
        assert archive.read_kline_archive(spark, str(tmp_path), wanted).select("path").distinct().count() == 4
    none = spark.createDataFrame([], "key string")
    assert archive.read_kline_archive(spark, str(tmp_path), none).count() == 0


def test_relative_keys_and_keys_without_a_file(spark, tmp_path):
    make_zip(tmp_path / "d/A-1h-2024-01.zip", {"x.csv": LINE})
    folder = os.path.relpath(tmp_path)
    for key in (f"{folder}/d/A-1h-2024-01.zip", f"./{folder}/d//A-1h-2024-01.zip"):
        wanted = spark.createDataFrame([(key,)], "key string")
        assert archive.read_kline_archive(spark, str(tmp_path), wanted).count() == 1
    working = spark._jvm.org.apache.hadoop.fs.Path(".").getFileSystem(spark._jsc.hadoopConfiguration())
    before = working.getWorkingDirectory()
    working.setWorkingDirectory(spark._jvm.org.apache.hadoop.fs.Path(str(tmp_path / "d")))
    try:
        bare = spark.createDataFrame([("A-1h-2024-01.zip",)], "key string")
        assert archive.read_kline_archive(spark, str(tmp_path), bare).count() == 1
    finally:
        working.setWorkingDirectory(before)
    missing = spark.createDataFrame([(str(tmp_path / "d/A-1h-2024-01.zip"),), (str(tmp_path / "d/A-1h-2024-02.zip"),)], "key string")
    with pytest.raises(FileNotFoundError, match="A-1h-2024-02.zip"):
        archive.read_kline_archive(spark, str(tmp_path), missing)


def test_only_wanted_zips_are_opened_and_nothing_is_shuffled(spark, tmp_path):
    wanted = []
    for key in KEYS:
        if key.endswith(".zip"):
            make_zip(tmp_path / key, {"x.csv": LINE})
            wanted.append(str(tmp_path / key))
    (tmp_path / KEYS[0]).write_bytes(b"not a zip, and not wanted")
    keys = spark.createDataFrame([(k,) for k in wanted[1:]], "key string")
    lines = archive.read_kline_archive(spark, str(tmp_path), keys)
    text = lines._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "content" not in text and "Join" not in text
    assert lines.count() == len(wanted) - 1
    broken = spark.createDataFrame([(wanted[0],)], "key string")
    with pytest.raises(Exception, match="not a zip"):
        archive.read_kline_archive(spark, str(tmp_path), broken).count()


def test_files_share_tasks_by_size(monkeypatch):
    monkeypatch.setattr(archive, "TASK_BYTES", 100)
    files = [("d", 60), ("a", 50), ("b", 50), ("c", 10), ("e", 500)]
    assert [p.paths for p in archive._ArchiveReader(files).partitions()] == [["a", "b"], ["c", "d"], ["e"]]
    assert archive._ArchiveReader([]).partitions() == []


def test_names_with_spaces_and_signs(spark, tmp_path):
    make_zip(tmp_path / "a folder #1 %20" / "AUSDT-1h-2024-01.zip", {"x.csv": LINE})
    assert archive.read_kline_archive(spark, str(tmp_path)).count() == 1


def test_epoch_threshold(spark):
    df = spark.createDataFrame([(100_000_000_000_000,), (100_000_000_000_001,), (1735689600123456,)], "v bigint")
    got = [r[0] for r in df.select(F.unix_micros(epoch_to_timestamp(F.col("v"))).alias("m")).collect()]
    assert got == [100_000_000_000_000_000, 100_000_000_000_000, 1735689600123000]


@pytest.mark.parametrize(
    "micros,text",
    [
        (1704067200000000, "2024-01-01T00:00:00Z"),
        (1704067200120000, "2024-01-01T00:00:00.120Z"),
        (1704067200120001, "2024-01-01T00:00:00.120001Z"),
    ],
)
def test_iso_instants(spark, micros, text):
    df = spark.range(1).select(iso_instant(F.timestamp_micros(F.lit(micros))).alias("t"))
    assert df.first()[0] == text


def klines(spark, batches):
    return spark.createDataFrame([("a", json.dumps(b)) for b in batches], "coin_id string, body string")


def row(**changes):
    cells = {0: 1704067200000, 1: "10", 2: "12", 3: "9", 4: "11", 5: "5", 6: 1704070799999, 7: "50", 8: 4}
    cells.update({int(k[1:]): v for k, v in changes.items()})
    return [cells[i] for i in range(9)]


def test_kline_sanity_edges(spark):
    batch = [
        row(),
        row(_5="0"),  # zero volume is kept
        row(_1="0"),
        row(_4="-1"),
        row(_2="8"),  # high below low
        row(_5="-0.1"),
        row(_3="abc"),
        row(_1="NaN"),
        row(_1="Infinity"),
        row(_2=None),
    ]
    parsed = landed.parse_klines(klines(spark, [batch, []]), "1h", utc(2024, 1, 1, 0, 30))
    kept, rejected = sane(parsed)
    assert (kept.count(), rejected.count()) == (2, 8)
    first = kept.first()
    assert first["is_closed"] is False  # still open at 00:30
    assert first["quote_volume"] == Decimal(50) and first["trade_count"] == 4


def test_is_closed_is_strict(spark):
    raw = klines(spark, [[row(_6=1704070800000)]])
    closed = lambda *t: landed.parse_klines(raw, "1h", utc(*t)).first()["is_closed"]
    assert closed(2024, 1, 1, 1) is False
    assert closed(2024, 1, 1, 1, 0, 0, 1000) is True


def test_bodies_that_are_not_json(spark):
    bodies = [("a", "[["), ("b", "[]"), ("c", json.dumps([row()])), ("d", '{"code": 1}'), ("e", ""), ("f", None)]
    raw = spark.createDataFrame(bodies, "coin_id string, body string")
    assert [r["coin_id"] for r in landed.unparsed(raw, S.KLINE_BATCH).collect()] == ["a", "d", "e", "f"]
    lists = spark.createDataFrame([("a", "{}"), ("b", '{"tickers": []}'), ("c", "<html>")], "coin_id string, body string")
    assert [r["coin_id"] for r in landed.unparsed(lists, S.TICKERS).collect()] == ["c"]
    assert landed.parse_klines(raw, "1h", utc(2024, 1, 2)).count() == 1


def test_tickers(spark):
    def ticker(exchange, base, target, volume, last=1.5):
        return {
            "market": {"identifier": exchange} if exchange is not None else None,
            "base": base,
            "target": target,
            "converted_last": {"usd": last},
            "converted_volume": {"usd": volume},
            "trust_score": "green",
            "last_traded_at": "2024-01-01T00:00:00+00:00",
        }

    tickers = [
        ticker("x", "A", "USD", 5),
        ticker(None, "A", "USD", 9),
        ticker("x", "", "USD", 9),
        ticker("y", "A", None, 9),
        ticker("z", "A", "USD", None),
        ticker("w", "A", "USD", 7, 0.12345678901),
        ticker("x", "A", "USD", 3),  # the same listing again: written last, so it stays
    ]
    raw = spark.createDataFrame([("a", json.dumps({"tickers": tickers})), ("b", "{}")], "coin_id string, body string")
    parsed = landed.parse_tickers(raw)
    assert parsed.count() == 4
    latest = registry.latest_listings(parsed, ["coin_id", "exchange_id", "base_symbol", "target_symbol"])
    ranked = registry.rank_listings(latest, ["exchange_id"])
    got = rows_of(ranked, "rank", "exchange_id", "volume_usd_24h", "price_usd")
    assert got == [
        (1, "w", Decimal("7.00"), Decimal("0.1234567890")),
        (2, "x", Decimal("3.00"), Decimal("1.5000000000")),
        (3, "z", None, Decimal("1.5000000000")),
    ]


def test_pairs_and_symbol_match(spark):
    pairs = [
        {"symbol": "AUSDT", "baseAsset": "a", "quoteAsset": "USDT", "status": "TRADING"},
        {"symbol": "BEUR", "baseAsset": "B", "quoteAsset": "EUR", "status": "TRADING"},
        {"symbol": "CUSDT", "baseAsset": "C", "quoteAsset": "USDT", "status": "BREAK"},
        {"symbol": "A2USDT", "baseAsset": "A", "quoteAsset": "USDT", "status": "TRADING"},
    ]
    raw = spark.createDataFrame([(json.dumps({"symbols": pairs}),)], "body string")
    known = registry.trading_pairs(landed.parse_symbols(raw))
    coins = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", "A")], "coin_id string, symbol string")
    got = rows_of(registry.match_symbols(coins, known).na.fill("none"), "coin_id", "binance_symbol")
    assert got == [("1", "A2USDT"), ("2", "none"), ("3", "none"), ("4", "A2USDT")]


def test_series(spark):
    body = {
        "prices": [[1000, 1.0], [2000, 2.5], [2000, 3.0000000005], [3000, 4]],
        "market_caps": [[1000, 10], [9000, 99]],
        # "total_volumes" is absent
    }
    raw = spark.createDataFrame(
        [("a", json.dumps(body)), ("b", json.dumps({"prices": [], "market_caps": [[1, 2]]}))], "coin_id string, body string"
    )
    history = landed.series_to_history(series.align_series(landed.parse_series(raw)))
    got = [(r["timestamp"].timestamp(), r["price_usd"], r["market_cap_usd"], r["total_volume_usd"]) for r in history.orderBy("timestamp").collect()]
    assert got == [
        (1.0, Decimal("1.000000000"), Decimal("10.000000000"), None),
        (2.0, Decimal("3.000000001"), None, None),
        (3.0, Decimal("4.000000000"), None, None),
    ]


def test_coin_list(spark):
    coins = [
        {"id": "a", "symbol": "A", "name": "A", "market_cap": 5, "market_cap_rank": 2, "current_price": None},
        {"id": "b", "symbol": "B", "name": "B", "market_cap": None, "market_cap_rank": None, "current_price": 1e-9},
        {"id": "c", "symbol": "C", "name": "C", "market_cap": 5, "market_cap_rank": 3, "current_price": 2},
        {"id": "d", "symbol": "D", "name": "D", "market_cap": 9, "market_cap_rank": 1, "current_price": 3},
    ]
    raw = spark.createDataFrame([(json.dumps(coins),)], "body string")
    parsed = landed.parse_markets(raw)
    assert [r["coin_id"] for r in registry.top_coins(parsed, 3).collect()] == ["d", "a", "c"]
    assert registry.top_coins(parsed, 10).count() == 4
    assert parsed.filter("coin_id = 'b'").first()["current_price"] == Decimal("0.0000000010")


def test_backfill_windows(spark):
    got = rows_of(backfill_windows(spark, date(2024, 12, 31), 200, 90), "window_no", "window_start", "window_end")
    assert got == [
        (0, date(2024, 10, 2), date(2024, 12, 31)),
        (1, date(2024, 7, 4), date(2024, 10, 2)),
        (2, date(2024, 6, 14), date(2024, 7, 4)),
    ]
    assert backfill_windows(spark, date(2024, 12, 31), 0).count() == 0
    assert backfill_windows(spark, date(2024, 12, 31), 90).count() == 1
    grid = work_grid(spark.createDataFrame([("a",), ("b",)], "coin_id string"), date(2024, 12, 31), 200)
    assert grid.count() == 6
    assert grid.filter("window_no = 0").first()["to_epoch"] == 1735603200


def test_series_bodies_are_parsed_once(spark):
    raw = spark.createDataFrame([("a", '{"prices": [[1, 2.0]], "market_caps": [], "total_volumes": [[1, 3.0]]}')], "coin_id string, body string")
    series = landed.parse_series(raw)
    assert series._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    assert rows_of(series, "kind", "ts_ms", "value") == [("prices", 1, 2.0), ("total_volumes", 1, 3.0)]


def test_an_archive_zip_is_written_in_the_memory_of_a_batch(tmp_path):
    line = lambda i: f"{i},{LINE}"
    batches = (pa.RecordBatch.from_pydict({"line": [line(i) for i in range(b, b + 1000)]}) for b in range(0, 200_000, 1000))
    tracemalloc.start()
    try:
        made = list(sources._write_zip((pa.scalar(str(tmp_path)), pa.scalar("AUSDT-1h-2024-01")), batches))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2_000_000
    assert [b.to_pydict() for b in made] == [{"key": [f"{tmp_path}/AUSDT-1h-2024-01.zip"]}]
    with zipfile.ZipFile(tmp_path / "AUSDT-1h-2024-01.zip") as z:
        assert z.namelist() == ["AUSDT-1h-2024-01.csv"]
        assert z.read("AUSDT-1h-2024-01.csv").decode().split("\n") == [line(i) for i in range(200_000)]
