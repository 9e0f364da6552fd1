import os
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows_of, utc
from wickwork import layout, schemas as S
from wickwork.functions.times import months_before
from wickwork.operators.retention import prune
from wickwork.operators.upsert import delete_where, upsert
from wickwork.sinks import tables as T

OLD, NOW, NEW = utc(2024, 1, 1), utc(2024, 1, 2), utc(2024, 1, 3)


def snaps(spark, *rows):
    rows = [
        dict(zip(["coin_id", "price_usd", "updated_at", "price_source", "rank"], r)) for r in rows
    ]
    return frame(spark, rows, S.SNAPSHOTS)


def guarded(target, source, **how):
    return upsert(target, source, ["coin_id"], when=F.col("t.updated_at") < F.col("s.updated_at"), **how)


def test_guard_refuses_equal_and_older(spark):
    target = snaps(spark, ("eq", 1, NOW, "coingecko", 1), ("old", 1, NOW, "coingecko", 1), ("new", 1, NOW, "coingecko", 1))
    source = snaps(
        spark, ("eq", 2, NOW, "binance_rest"), ("old", 2, OLD, "binance_rest"), ("new", 2, NEW, "binance_rest"),
        ("first", 2, OLD, "binance_rest"),
    )
    source = source.select("coin_id", "price_usd", "updated_at", "price_source")
    got = guarded(target, source)
    assert [(c, int(p), r) for c, p, r in rows_of(got.na.fill(0, ["rank"]), "coin_id", "price_usd", "rank")] == [
        ("eq", 1, 1), ("first", 2, 0), ("new", 2, 1), ("old", 1, 1),
    ]
    again = guarded(got, source)
    assert rows_of(again.na.fill(0), *again.columns[:2]) == rows_of(got.na.fill(0), *got.columns[:2])


def test_seeded_price_waits_for_a_later_close(spark):
    """A list refresh stamps its own time; an exchange close from before that does not replace it."""
    seeded = snaps(spark, ("a", 5, utc(2024, 1, 2, 10, 30), "coingecko", 1))
    before = snaps(spark, ("a", 6, utc(2024, 1, 2, 9, 59, 59), "binance_rest"))
    after = snaps(spark, ("a", 7, utc(2024, 1, 2, 10, 59, 59), "binance_rest"))
    assert guarded(seeded, before).first()["price_usd"] == 5
    assert guarded(seeded, after).first()["price_usd"] == 7


def test_repeated_source_keys_do_not_multiply_rows(spark):
    target = snaps(spark, ("a", 1, OLD, "coingecko", 1))
    source = snaps(spark, ("a", 2, OLD, "coingecko", 1), ("a", 3, NEW, "coingecko", 1), ("b", 4, NOW, "coingecko", 1), ("b", 5, OLD, "coingecko", 2))
    got = upsert(target, source, ["coin_id"], order_by=[F.desc("updated_at")])
    assert [(c, int(p)) for c, p in rows_of(got, "coin_id", "price_usd")] == [("a", 3), ("b", 4)]


def test_types_are_the_targets(spark):
    target = snaps(spark)
    source = spark.createDataFrame([("a", "1.5")], "coin_id string, price_usd string")
    got = upsert(target, source, ["coin_id"])
    assert got.schema.simpleString() == target.schema.simpleString()
    assert got.first()["price_usd"] == Decimal("1.5")


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert delete_where(df, F.col("v") == 1).count() == 2


def test_prune_keeps_the_limit_itself(spark):
    as_of = utc(2024, 3, 31, 12)
    rows = [(utc(2024, 3, 21, 12),), (utc(2024, 3, 21, 11, 59, 59),), (utc(2023, 2, 28, 12),), (utc(2023, 2, 28, 11),)]
    df = spark.createDataFrame(rows, "bucket_start timestamp")
    assert prune(df, "bucket_start", as_of, days=10).count() == 1
    assert prune(df, "bucket_start", as_of, months=13).count() == 3
    with pytest.raises(ValueError):
        prune(df, "bucket_start", as_of)
    clamped = spark.range(1).select(months_before(utc(2023, 3, 31), 1).cast("string")).first()[0]
    assert clamped == "2023-02-28 00:00:00"


def bars(spark, *rows):
    rows = [dict(coin_id=c, bucket_start=t, open=v, high=v, low=v, close=v, volume=v, is_closed=True, updated_at=NOW) for c, t, v in rows]
    return frame(spark, rows, S.SERVING)


def files_under(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.fixture(params=["broadcast", "shuffle"])
def either_size(request, spark):
    """Both ways in which Spark can run an upsert's plan."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if request.param == "broadcast" else "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_table_upsert_touches_only_its_partitions(spark, tmp_path, either_size):
    path = str(tmp_path / "t")
    T.create_table(spark, path, layout.ROLLUPS_HOURLY)
    days = [utc(2024, 1, d, 5) for d in range(1, 6)]
    T.upsert_table(path, bars(spark, *[("a", t, 1) for t in days], *[("b", t, 1) for t in days]), layout.ROLLUPS_HOURLY)
    before = files_under(path)
    change = bars(spark, ("a", days[2], 9), ("c", days[2], 3))
    T.upsert_table(path, change, layout.ROLLUPS_HOURLY)
    after = files_under(path)
    kept = {f for f in before if f in after}
    assert {f.split("date=")[1][:10] for f in before if f not in kept} == {"2024-01-03"}
    table = layout.read_table(spark, path, layout.ROLLUPS_HOURLY)
    assert table.count() == 11
    assert table.filter("coin_id = 'a' and date = date'2024-01-03'").first()["close"] == 9
    snapshot = rows_of(table, "coin_id", "bucket_start", "close")
    T.upsert_table(path, change, layout.ROLLUPS_HOURLY)
    assert rows_of(layout.read_table(spark, path, layout.ROLLUPS_HOURLY), "coin_id", "bucket_start", "close") == snapshot


def test_table_upsert_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    T.create_table(spark, path, layout.COINS)
    T.upsert_table(path, frame(spark, [], S.COINS), layout.COINS)
    assert layout.read_table(spark, path, layout.COINS).count() == 0


def test_append_never_creates(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        T.append(frame(spark, [], S.BRONZE), str(tmp_path / "missing"), layout.BRONZE)
    assert not os.path.exists(tmp_path / "missing")


@pytest.mark.parametrize("table,unit", [(layout.ROLLUPS_HOURLY, "date"), (layout.ROLLUPS_DAILY, "month")])
def test_pruning_drops_old_partitions_unread(spark, tmp_path, table, unit):
    path = str(tmp_path / "t")
    T.create_table(spark, path, table)
    start = utc(2024, 1, 1)
    times = [start + timedelta(hours=12 * i) for i in range(120)]
    T.upsert_table(path, bars(spark, *[("a", t, 1) for t in times]), table)
    as_of = utc(2024, 2, 20, 6)
    limit = as_of - timedelta(days=10)
    assert T.prune_table(spark, path, table, as_of, days=10) == sum(t < limit for t in times)
    left = [r[0] for r in layout.read_table(spark, path, table).select(F.unix_timestamp("bucket_start")).collect()]
    assert sorted(left) == [t.timestamp() for t in times if t >= limit]
    edge = "2024-02-10" if unit == "date" else "2024-02"
    assert min(T.partition_values(spark, path, table)) == edge
    assert T.prune_table(spark, path, table, as_of, days=10) == 0


def test_delete_drops_partitions_it_empties(spark, tmp_path):
    path = str(tmp_path / "t")
    table = layout.ROLLUPS_HOURLY
    T.create_table(spark, path, table)
    T.upsert_table(path, bars(spark, ("a", utc(2024, 1, 1), 1), ("a", utc(2024, 1, 2), 1), ("b", utc(2024, 1, 2), 1)), table)
    assert T.delete_from_table(spark, path, table, F.col("coin_id") == "a") == 2
    assert T.partition_values(spark, path, table) == ["2024-01-02"]
    assert rows_of(layout.read_table(spark, path, table), "coin_id") == [("b",)]
    assert T.delete_from_table(spark, path, table, F.col("coin_id") == "zz") == 0


def test_newest_bucket_first_in_files(spark, tmp_path):
    path = str(tmp_path / "t")
    T.create_table(spark, path, layout.ROLLUPS_HOURLY)
    rows = [(c, utc(2024, 1, 1, h), 1) for h in range(24) for c in "ba"]
    T.upsert_table(path, bars(spark, *rows), layout.ROLLUPS_HOURLY)
    (file,) = files_under(path)
    import pyarrow.parquet as pq

    got = pq.ParquetFile(file).read(columns=["coin_id", "bucket_start"]).to_pylist()
    assert got == sorted(got, key=lambda r: (r["coin_id"], -r["bucket_start"].timestamp()))


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    target_path, source_path = str(tmp_path / "t"), str(tmp_path / "s")
    snaps(spark, *[(f"c{i}", 1, OLD, "coingecko", 1) for i in range(50)]).write.parquet(target_path)
    snaps(spark, ("c1", 2, NEW, "coingecko", 1), ("x", 2, NEW, "coingecko", 1)).write.parquet(source_path)
    target, source = spark.read.parquet(target_path), spark.read.parquet(source_path)
    merged = guarded(target, source)
    rows_of(merged, "coin_id")
    text = merged._jdf.queryExecution().executedPlan().toString()
    final = text.split("Initial Plan")[0]
    lookup = final.split("Union")[1].split("LeftAnti")[0]
    assert "BroadcastHashJoin" in lookup and "SortMergeJoin" not in lookup
    assert merged.count() == 51


def test_rows_without_a_time_do_not_replace_each_other(spark, tmp_path):
    """A table partitioned by time keeps its stored rows whatever the source lacks."""
    path, table = str(tmp_path / "h"), layout.MARKET_CAP_HISTORY
    T.create_table(spark, path, table)
    stored = frame(spark, [{"coin_id": "a", "timestamp": None}, {"coin_id": "b", "timestamp": NOW}], S.MARKET_CAP_HISTORY)
    T.append(stored, path, table)
    source = frame(spark, [{"coin_id": "c", "timestamp": None}, {"coin_id": "c", "timestamp": NOW}], S.MARKET_CAP_HISTORY)
    assert T.upsert_table(path, source, table) == 1
    rows = layout.read_table(spark, path, table).select("coin_id", "timestamp").collect()
    assert sorted((r["coin_id"], r["timestamp"] is None) for r in rows) == [("a", True), ("b", False), ("c", False)]


def test_rows_without_a_whole_key_are_counted(spark, tmp_path, caplog):
    path = str(tmp_path / "h")
    T.create_table(spark, path, layout.MARKET_CAP_HISTORY)
    rows = [{"coin_id": "a", "timestamp": NOW}, {"coin_id": None, "timestamp": NOW}, {"coin_id": "c", "timestamp": None}]
    assert T.upsert_table(path, frame(spark, rows, S.MARKET_CAP_HISTORY), layout.MARKET_CAP_HISTORY) == 1
    assert [r.getMessage() for r in caplog.records if r.name == T.__name__] == [f"{path}: 2 rows without a whole key rejected"]
    caplog.clear()
    assert T.upsert_table(path, frame(spark, rows[1:], S.MARKET_CAP_HISTORY), layout.MARKET_CAP_HISTORY) == 0
    assert T.upsert_table(path, frame(spark, rows[:1], S.MARKET_CAP_HISTORY), layout.MARKET_CAP_HISTORY) == 1
    assert len([r for r in caplog.records if r.name == T.__name__]) == 1


def test_partitions_a_rebuild_no_longer_has_go(spark, tmp_path):
    path, table = str(tmp_path / "h"), layout.MARKET_CAP_HISTORY
    T.create_table(spark, path, table)
    rows = [{"coin_id": "a", "timestamp": utc(2024, m, 1)} for m in (1, 2, 3)] + [{"coin_id": "n", "timestamp": None}]
    T.append(frame(spark, rows, S.MARKET_CAP_HISTORY), path, table)
    T.drop_partitions_except(spark, path, table, ["2024-03"], since="2024-02")
    assert T.partition_values(spark, path, table) == ["2024-01", "2024-03", "__HIVE_DEFAULT_PARTITION__"]
    T.drop_partitions_except(spark, path, table, ["2024-01", None])
    assert T.partition_values(spark, path, table) == ["2024-01", "__HIVE_DEFAULT_PARTITION__"]
