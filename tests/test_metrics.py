from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import bronze, candle, rows_of, utc
from wickwork.operators import metrics as M, rollup
from wickwork.sinks.rollups import read_rollup, write_rollup

NOW = utc(2024, 3, 10, 15, 30)
NAME = "candles_by_coin_and_hour"


def spec(measures, dimensions=(), filters=(), dateRange="last 7 days", granularity=None, time="open_time"):
    out = {"measures": list(measures), "dimensions": list(dimensions), "filters": list(filters)}
    if time:
        out["timeDimensions"] = [{"dimension": time, "granularity": granularity, "dateRange": dateRange}]
    return out


@pytest.mark.parametrize(
    "text,start,end",
    [
        ("last 7 days", (2024, 3, 3), (2024, 3, 10)),
        ("Last 1 day", (2024, 3, 9), (2024, 3, 10)),
        ("last 24 hours", (2024, 3, 9, 15), (2024, 3, 10, 15)),
        ("last 2 weeks", (2024, 2, 19), (2024, 3, 4)),
        ("last 3 months", (2023, 12, 1), (2024, 3, 1)),
        ("today", (2024, 3, 10), (2024, 3, 11)),
        ("yesterday", (2024, 3, 9), (2024, 3, 10)),
        (["2024-03-01", "2024-03-02"], (2024, 3, 1), (2024, 3, 3)),
        (["2024-03-01T05:00:00", "2024-03-01T06:00:00"], (2024, 3, 1, 5), (2024, 3, 1, 6)),
    ],
)
def test_date_ranges(text, start, end):
    assert M.date_range(text, NOW) == (datetime(*start), datetime(*end))


def test_unknown_members_and_operators():
    for bad in (
        spec(["candles.nothing"]),
        spec(["other.high"]),
        spec(["high"], filters=[{"member": "coin_id", "operator": "contains", "values": ["a"]}]),
        spec(["high"], dateRange="some day"),
        spec(["high"], granularity="minute"),
    ):
        with pytest.raises(ValueError):
            M.choose_source(M.CANDLES, bad, NOW)


@pytest.mark.parametrize(
    "query,expected",
    [
        (spec(["count", "high"], ["coin_id"]), NAME),
        (spec(["volume"], ["coin_id", "interval", "is_closed"], granularity="day"), NAME),
        (spec(["high"], ["close_time"]), None),  # not a dimension of the rollup
        (spec(["high"], time=None), None),  # reaches back before the rollup's range
        (spec(["high"], dateRange=["2022-01-01", "2022-02-01"]), None),
        (spec(["high"], dateRange=["2024-03-01T05:30:00", "2024-03-02T00:00:00"]), None),  # not on an hour
        (spec(["high"], dateRange="today"), None),  # ends after what was built
        (spec(["high"], dateRange="last 3 hours"), NAME),
    ],
)
def test_choice_of_source(query, expected):
    assert M.choose_source(M.CANDLES, query, NOW) == expected


def test_averages_never_come_from_a_rollup():
    assert M.choose_source(M.HOURLY, spec(["open"], time="hour"), NOW) is None
    assert M.choose_source(M.HOURLY, spec(["high"], time="hour"), NOW) == "hourly_metrics_by_coin"
    assert M.choose_source(M.DAILY, spec(["candle_count"], time=None), NOW) == "daily_metrics_by_coin"


def test_open_and_close_need_one_row_per_bucket(spark):
    silver = rollup.silver(bronze(spark, [candle()]))
    for bad in (spec(["open"], ["coin_id"]), spec(["close"], ["coin_id"], granularity="day")):
        with pytest.raises(ValueError):
            M.metric_query(silver, M.CANDLES, bad, NOW)
    hours = {"granularity": "hour", "dateRange": ["2024-01-01", "2024-01-02"]}
    one = {"member": "interval", "operator": "equals", "values": ["1h"]}
    two = {"member": "interval", "operator": "equals", "values": ["1h", "4h"]}
    for bad in (spec(["open"], **hours), spec(["open"], ["coin_id"], **hours), spec(["open"], ["coin_id"], [two], **hours)):
        with pytest.raises(ValueError):
            M.metric_query(silver, M.CANDLES, bad, NOW)
    for fine in (spec(["open", "close"], ["coin_id", "interval"], **hours), spec(["open", "close"], ["coin_id"], [one], **hours)):
        assert M.metric_query(silver, M.CANDLES, fine, NOW).count() == 1


def test_a_rollup_answers_only_for_what_it_was_built_over():
    query = spec(["count"], dateRange=["2024-01-01", "2024-01-02"])
    as_of = utc(2024, 1, 4)
    built = lambda *t: {NAME: utc(*t)}
    assert M.choose_source(M.CANDLES, query, as_of, [NAME], built(2024, 1, 3)) == NAME
    assert M.choose_source(M.CANDLES, query, as_of, [NAME], built(2024, 1, 1, 12)) is None
    assert M.choose_source(M.CANDLES, query, as_of, [], None) is None
    old = spec(["count"], dateRange=["2022-12-01", "2022-12-02"])
    assert M.choose_source(M.CANDLES, old, as_of, [NAME], built(2024, 1, 3)) is None
    hourly = spec(["count"], time="hour", dateRange=["2024-01-01", "2024-01-02"])
    name = "hourly_metrics_by_coin"
    assert M.choose_source(M.HOURLY, hourly, as_of, [name], {name: utc(2024, 1, 2)}) is None
    assert M.choose_source(M.HOURLY, hourly, as_of, [name], {name: utc(2024, 1, 3)}) == name


def test_the_time_of_a_build_is_stored(spark, silver, tmp_path):
    from wickwork.sinks.rollups import rollup_built_at

    path = str(tmp_path / "r")
    write_rollup(silver, M.CANDLES, NAME, path, utc(2024, 3, 2, 1))
    assert rollup_built_at(spark, path) == datetime(2024, 3, 2, 1)
    write_rollup(silver, M.CANDLES, NAME, path, utc(2024, 3, 3), changed_since=utc(2024, 3, 2))
    assert rollup_built_at(spark, path) == datetime(2024, 3, 3)


def test_thirteen_months_back_from_month_ends():
    capped = M.CANDLES.rollups[NAME]
    assert M.build_range(capped, utc(2024, 3, 31, 5))[0] == datetime(2023, 2, 28)
    assert M.build_range(capped, utc(2024, 1, 15))[0] == datetime(2022, 12, 15)


@pytest.fixture()
def silver(spark):
    rows = [
        candle(c, open_time=utc(2024, 1, 1) + timedelta(hours=7 * i), high=20 + i % 5, volume=i, published=utc(2024, 2, 1))
        for i in range(240)
        for c in ("a", "b")
    ]
    return rollup.silver(bronze(spark, rows))


@pytest.mark.parametrize("granularity", [None, "hour", "day"])
def test_rollup_and_table_agree(spark, silver, granularity, tmp_path):
    write_rollup(silver, M.CANDLES, NAME, str(tmp_path / "r"), NOW)
    stored = read_rollup(silver, M.CANDLES, NAME, str(tmp_path / "r"))
    query = spec(
        ["count", "high", "low", "volume", "trade_count"],
        ["coin_id"],
        [{"member": "candles.coin_id", "operator": "equals", "values": ["a"]}],
        dateRange=["2024-01-05", "2024-03-01"],
        granularity=granularity,
    )
    assert M.choose_source(M.CANDLES, query, NOW) == NAME
    base = M.metric_query(silver, M.CANDLES, query, NOW)
    routed = M.metric_query(silver, M.CANDLES, query, NOW, {NAME: stored})
    text = routed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in text and "Scan ExistingRDD" not in text
    assert rows_of(base, *base.columns) == rows_of(routed, *base.columns)


def test_refresh_rebuilds_only_changed_partitions(spark, silver, tmp_path):
    import os

    path = str(tmp_path / "r")
    write_rollup(silver, M.CANDLES, NAME, path, NOW)
    before = {d: os.listdir(f"{path}/{d}") for d in os.listdir(path) if d.startswith("part=")}
    assert sorted(before) == ["part=2024-01-01", "part=2024-02-01", "part=2024-03-01"]
    assert write_rollup(silver, M.CANDLES, NAME, path, NOW, changed_since=utc(2024, 2, 1)) == []
    fresh = silver.withColumn(
        "latest_publish_time",
        F.when(F.month("open_time") == 2, F.lit("2024-03-05").cast("timestamp")).otherwise(F.col("latest_publish_time")),
    ).withColumn("high", F.col("high") + 1)
    changed = write_rollup(fresh, M.CANDLES, NAME, path, NOW, changed_since=utc(2024, 2, 1))
    assert [str(c) for c in changed] == ["2024-02-01"]
    after = {d: os.listdir(f"{path}/{d}") for d in os.listdir(path) if d.startswith("part=")}
    assert {d for d in after if after[d] != before[d]} == {"part=2024-02-01"}


def test_dimensions_alone_are_distinct(spark, silver):
    got = M.metric_query(silver, M.CANDLES, spec([], ["coin_id"], time=None), NOW)
    assert rows_of(got, "coin_id") == [("a",), ("b",)]


H = timedelta(hours=1)


@pytest.mark.parametrize("seed", range(40))
def test_split_ranges_cover_each_hour_once(seed):
    """Every half hour of the requested range lies in just one covered range or gap; covered ones are whole covered buckets."""
    import random

    rng = random.Random(seed)
    zero = datetime(2024, 1, 1)
    some = lambda: zero + timedelta(minutes=30 * rng.randrange(200))
    ranges = []
    for _ in range(rng.randrange(4)):
        first, last = sorted((some(), some()))
        ranges.append((first, last))
    if rng.random() < 0.3:
        ranges.append((None, some()))
    first, last = sorted((some(), some()))
    request = (rng.choice([None, first]), rng.choice([None, last]))
    covered, gaps = M.split_ranges(tuple(ranges), request, "hour")
    inside = lambda t, r: (r[0] is None or r[0] <= t) and (r[1] is None or t < r[1])
    for k in range(-4, 210):
        t = zero + timedelta(minutes=30 * k)
        found = sum(inside(t, r) for r in covered), sum(inside(t, r) for r in gaps)
        assert sum(found) == (1 if inside(t, request) else 0)
        if found[0]:
            assert any(inside(t, r) for r in ranges)
    for a, b in covered:
        assert all(e is None or e.minute == 0 or e in request for e in (a, b))
        assert a is None or a.minute == 0


def test_rows_without_a_manifest_are_refused(spark, silver, tmp_path):
    from wickwork.operators.metrics import build_rollup

    query = spec(["count"], dateRange=["2024-01-05", "2024-01-20"])
    wrong = build_rollup(silver.limit(0), M.CANDLES, NAME, NOW)
    expected = rows_of(M.metric_query(silver, M.CANDLES, query, NOW), "count")
    assert rows_of(M.metric_query(silver, M.CANDLES, query, NOW, {NAME: wrong}), "count") == expected
    path = str(tmp_path / "r")
    write_rollup(silver, M.CANDLES, NAME, path, NOW)
    import shutil

    shutil.rmtree(path + "-manifest")
    stored = read_rollup(silver, M.CANDLES, NAME, path)
    assert stored.ranges == ()
    assert rows_of(M.metric_query(silver, M.CANDLES, query, NOW, {NAME: stored}), "count") == expected


def test_an_old_rollup_does_not_hide_new_rows(spark, silver, tmp_path):
    path, query = str(tmp_path / "r"), spec(["count"], dateRange=["2024-01-01", "2024-01-01"])
    early = silver.where(F.col("open_time") < F.lit("2024-01-01 12:00:00").cast("timestamp"))
    write_rollup(early, M.CANDLES, NAME, path, utc(2024, 1, 1, 12))
    got = M.metric_query(silver, M.CANDLES, query, utc(2024, 1, 4), {NAME: read_rollup(silver, M.CANDLES, NAME, path)})
    assert got.first()["count"] == 8


@pytest.fixture()
def followed(spark, tmp_path):
    """A stored silver table in appended batches, with a rollup that has followed the first."""
    from wickwork import layout
    from wickwork.sinks.tables import create_table
    from wickwork.versions import append_versions

    source = str(tmp_path / "silver")
    create_table(spark, source, layout.SILVER)

    def append(*candles):
        return append_versions(rollup.silver(bronze(spark, list(candles))), source, layout.SILVER)

    append(*[candle(c, open_time=utc(2024, m, d, 5), published=utc(2024, 4, 1)) for c in "ab" for m in (1, 2, 3) for d in range(1, 28)])
    return source, str(tmp_path / "rollup"), append


def test_refresh_follows_the_feed(spark, followed, monkeypatch):
    import re

    from wickwork import layout
    from wickwork.sinks import rollups as R
    from wickwork.versions import compact

    source, path, append = followed
    refresh = lambda at: R.refresh_rollup(spark, source, layout.SILVER, M.CANDLES, NAME, path, at)
    assert refresh(utc(2024, 4, 1)) is None
    assert refresh(utc(2024, 4, 2)) == []
    compact(spark, source, layout.SILVER)
    append(candle("a", open_time=utc(2024, 2, 9, 5), high=77, published=utc(2024, 4, 3)))
    scans = []
    build = R.build_rollup
    monkeypatch.setattr(R, "build_rollup", lambda table, *a: scans.append(table) or build(table, *a))
    assert [str(c) for c in refresh(utc(2024, 4, 3))] == ["2024-02-01"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = scans[0].select("*")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", "100")
    filters = re.findall(r"PartitionFilters: \[(.*?)\], Pushed", plan)
    assert len(filters) == 3 and all("date#" in f and "2024-02" in f for f in filters)
    days = {r[0].month for r in scans[0].select("date").distinct().collect()}
    assert days == {2}
    table = layout.read_table(spark, source, layout.SILVER)
    query = spec(["count", "high"], ["coin_id"], dateRange=["2024-01-01", "2024-03-31"], granularity="day")
    stored = read_rollup(table, M.CANDLES, NAME, path, source)
    assert len(stored.ranges) == 1
    columns = ["coin_id", "open_time", "count", "high"]
    assert rows_of(M.metric_query(table, M.CANDLES, query, utc(2024, 4, 3), {NAME: stored}), *columns) == rows_of(
        M.metric_query(table, M.CANDLES, query, utc(2024, 4, 3)), *columns
    )


def test_changed_days_are_not_covered_until_refreshed(spark, followed):
    from wickwork import layout
    from wickwork.sinks import rollups as R

    source, path, append = followed
    R.refresh_rollup(spark, source, layout.SILVER, M.CANDLES, NAME, path, utc(2024, 4, 1))
    append(candle("a", open_time=utc(2024, 2, 9, 5), high=77, published=utc(2024, 4, 3)))
    table = layout.read_table(spark, source, layout.SILVER)
    stored = read_rollup(table, M.CANDLES, NAME, path, source)
    assert [r[1:] or r for r in stored.ranges][0][0] == datetime(2024, 2, 9) and stored.ranges[1][0] == datetime(2024, 2, 10)
    query = spec(["high"], dateRange=["2024-02-01", "2024-02-29"])
    assert M.metric_query(table, M.CANDLES, query, utc(2024, 4, 3), {NAME: stored}).first()["high"] == 77


def test_months_out_of_range_go(spark, followed):
    from wickwork import layout
    from wickwork.sinks import rollups as R

    source, path, append = followed
    refresh = lambda at: R.refresh_rollup(spark, source, layout.SILVER, M.CANDLES, NAME, path, at)
    refresh(utc(2024, 4, 1))
    assert sorted(R._stored_parts(spark, path)) == ["2024-01-01", "2024-02-01", "2024-03-01"]
    append(candle("a", open_time=utc(2025, 3, 9, 5), published=utc(2025, 3, 10)))
    refresh(utc(2025, 3, 10))
    assert sorted(R._stored_parts(spark, path)) == ["2024-02-01", "2024-03-01", "2025-03-01"]
    assert read_rollup(layout.read_table(spark, source, layout.SILVER), M.CANDLES, NAME, path).ranges[0][0] == datetime(2024, 2, 10)
