"""One key with a third and more of all rows, and the plans that have to bear it."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from wickwork.catalog import QUERIES
from wickwork.operators import quality, registry, rollup
from wickwork import schemas as S

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_listings(spark, n=9000):
    """Half of the listings belong to one coin, and most of those have the same volume."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), (i % 50).cast("string"))).alias("coin_id"),
        F.concat(F.lit("x"), i.cast("string")).alias("exchange_id"),
        F.when(i % 3 == 0, None).when(i % 3 == 1, F.lit(7)).otherwise(i % 101).cast("decimal(28,2)").alias("volume_usd_24h"),
    )


def test_ranks_equal_the_window(spark):
    df = hot_listings(spark)
    order = registry._listing_order(["exchange_id"])
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("coin_id").orderBy(*order)))
    columns = ["coin_id", "exchange_id", "rank"]
    ranked = registry.rank_listings(df, ["exchange_id"])
    assert ranked.columns == [*df.columns, "rank"]
    assert sorted(map(tuple, plain.select(*columns).collect())) == sorted(map(tuple, ranked.select(*columns).collect()))


def test_ranks_of_odd_volumes_and_other_tie_breaks(spark):
    volumes = [None, "0", "-3.50", "0.40", "0.99", "1", "9.99", "10", "99999999999999999999.25", "100", "19", "2", "-7", None]
    rows = [("a", f"e{k % 3}", Decimal(v) if v else None, k) for k, v in enumerate(volumes)] + [(None, None, None, 1), (None, None, None, 2)]
    df = spark.createDataFrame(rows, "coin_id string, exchange_id string, volume_usd_24h decimal(28,2), pos int")
    for tie_break in (["exchange_id", "pos"], ["pos"]):
        order = registry._listing_order(tie_break)
        plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("coin_id").orderBy(*order)))
        ranked = registry.rank_listings(df, tie_break)
        assert {(r["coin_id"], r["pos"], r["rank"]) for r in plain.collect()} == {(r["coin_id"], r["pos"], r["rank"]) for r in ranked.collect()}


def test_no_task_sorts_a_whole_coin(spark, monkeypatch):
    """One coin whose listings have no volume is parted into ranges of like size, and no window is keyed by rows."""
    kept = []
    stage = registry.staged
    monkeypatch.setattr(registry, "staged", lambda df, label: kept.append(stage(df, label)) or kept[0])
    hot = hot_listings(spark).filter("coin_id = 'hot'").withColumn("volume_usd_24h", F.lit(None).cast("decimal(28,2)"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = registry.rank_listings(hot, ["exchange_id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in kept[0].groupBy(F.shiftright("__at", 33).alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * sum(sizes) / len(sizes)
    assert "row_number" not in plan(ranked)
    assert [r[0] for r in ranked.orderBy("exchange_id").select("rank").collect()] == list(range(1, ranked.count() + 1))


def test_versions_of_one_candle_shrink_before_the_shuffle(spark):
    """All rows are versions of one candle: one row per map task crosses the network."""
    i = F.col("id")
    df = spark.range(0, 40_000, 1, 8).select(
        F.concat(F.lit("hot"), (i % 1).cast("string")).alias("coin_id"),
        F.lit("1h").alias("interval"),
        F.timestamp_seconds(i % 1).alias("open_time"),
        F.timestamp_seconds(F.lit(3599)).alias("close_time"),
        *[i.cast(S.MONEY).alias(c) for c in ("open", "high", "low", "close", "volume", "quote_volume")],
        i.alias("trade_count"),
        F.lit(True).alias("is_closed"),
        F.timestamp_seconds(i).alias("publish_time"),
    )
    got = rollup.silver(df)
    assert plan(got).count("WindowGroupLimit") == 2
    assert [int(r["close"]) for r in got.collect()] == [39_999]
    assert 0 < shuffled_rows(got) <= 8


def shuffled_rows(df):
    """Rows that the plan's exchanges wrote when it ran."""
    df.collect()
    total = 0
    for text in re.findall(r"shuffle records written[^\d]*([\d,]+)", metrics_text(df)):
        total += int(text.replace(",", ""))
    return total


def metrics_text(df):
    def walk(node, out):
        found = node.metrics()
        it = found.iterator()
        while it.hasNext():
            pair = it.next()
            metric = pair._2()
            name = metric.name().get() if metric.name().isDefined() else ""
            out.append(f"{name}: {metric.value()}")
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), out)
        if "QueryStage" in node.getClass().getSimpleName():
            walk(node.plan(), out)
        return out

    node = df._jdf.queryExecution().executedPlan()
    if node.getClass().getSimpleName().startswith("AdaptiveSparkPlan"):
        node = node.executedPlan()
    return "\n".join(walk(node, []))


@pytest.mark.parametrize("name", ["ohlcv_fine_daily", "reject_counts", "new_watermark", "series_align", "dlq_alert", "pk_dupes"])
def test_aggregates_reduce_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "partial_" in text
    assert "SortAggregate" not in text


def test_join_on_a_hot_symbol_is_split(spark):
    """Two thirds of the coins share a symbol; the adaptive join splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        i = F.col("id")
        coins = spark.range(0, 60_000, 1, 8).select(
            i.cast("string").alias("coin_id"),
            F.when(i % 3 != 0, "hot").otherwise(F.concat(F.lit("s"), i.cast("string"))).alias("symbol"),
        )
        pairs = spark.createDataFrame([("HOT", "HOTUSDT"), ("S3", "S3USDT")], "base string, symbol string")
        got = registry.match_symbols(coins, pairs)
        rows = got.collect()
        assert len(rows) == 60_000
        assert sum(r["binance_symbol"] == "HOTUSDT" for r in rows) == 40_000
        assert "skew=true" in plan(got)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from wickwork import layout
    from wickwork.sinks.tables import append, create_table
    from wickwork.sources.tables import read_bronze
    from helpers import bronze, candle, utc

    path = str(tmp_path / "bronze")
    create_table(spark, path, layout.BRONZE)
    append(bronze(spark, [candle(), candle(open_time=utc(2024, 5, 1))]), path, layout.BRONZE)
    df = read_bronze(spark, path, utc(2024, 1, 1), utc(2024, 1, 2)).select("coin_id", "close")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(open_time", text)
    assert "ReadSchema: struct<coin_id:string,open_time:timestamp,close:decimal(38,9)>" in text
    assert df.count() == 1


def test_orphans_of_a_hot_key(spark):
    child = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise("ok").alias("coin_id"))
    parent = spark.createDataFrame([("ok",)], "coin_id string")
    assert quality.orphans(child, parent, "coin_id").count() == 5000
