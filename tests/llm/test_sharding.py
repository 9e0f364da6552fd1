import random

import pytest
from pyspark.sql import functions as F

from wickwork.llm import sharding


def placed(spark, rows, shards, schema="k string, size bigint, n bigint"):
    df = sharding.shard(spark.createDataFrame(rows, schema), shards, key="k", size="size")
    return [r.asDict() for r in df.collect()]


def check_slots(out, shards):
    for s in range(shards):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_shards_are_cut_in_key_order_with_near_equal_sizes(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(10**6):06d}", rng.randrange(1, 400), k) for k in range(3000)]
    out = placed(spark, rows, 16)
    assert sorted((r["k"], r["size"], r["n"]) for r in out) == sorted(rows)
    check_slots(out, 16)
    sums = [sum(r["size"] for r in out if r["shard"] == s) for s in range(16)]
    assert max(sums) - min(sums) <= 2 * 400
    ordered = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    assert [r["k"] for r in ordered] == sorted(r["k"] for r in out)


def test_a_hot_key_is_cut(spark, monkeypatch):
    rows = [("hot", 10, k) for k in range(600)] + [(f"c{k}", 10, k) for k in range(300)]
    subdivided = []
    real = sharding._in_order
    monkeypatch.setattr(sharding, "_in_order", lambda *a: subdivided.append(1) or real(*a))
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 2)
    out = placed(spark, rows, 8)
    check_slots(out, 8)
    sums = [sum(r["size"] for r in out if r["shard"] == s) for s in range(8)]
    assert max(sums) - min(sums) <= 10
    assert subdivided


def test_nulls_repeats_clashing_names_and_empty(spark, clashing):
    rows = [(None, 5, 1), (None, None, 2), ("a", 5, 3), ("a", 5, 3), ("a", 5, 3)]
    df = clashing(spark.createDataFrame(rows, "k string, size bigint, n bigint"), "shard_", "range", "place")
    out = sharding.shard(df, 4, key="k", size="size").collect()
    assert len(out) == 5 and {r["range"] for r in out} == {"extra1"}
    check_slots([r.asDict() for r in out], 4)
    assert placed(spark, [], 4) == []
    one = placed(spark, [("x", 0, 1)], 4)
    assert one[0]["slot"] == 0


@pytest.mark.parametrize("splitters", [0, 1, 2, 7, 20])
def test_range_search(spark, splitters):
    df = spark.range(40).select(F.struct(F.col("id").cast("bigint").alias("_0"), F.lit(0).cast("bigint").alias("_1")).alias("__order"))
    cuts = [(2 * k, 0) for k in range(splitters)]
    found = df.select("__order._0", sharding._range_of(cuts, df.schema["__order"].dataType).alias("r")).collect()
    assert all(r["r"] == sum(c[0] <= r["_0"] for c in cuts) for r in found)


def test_write_shards(spark, docs, tmp_path):
    texts = docs(["a", "bb", None, "cccc"])
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    out = sharding.shard(texts.select("doc_id", size.alias("size")), 2, key="doc_id", size="size")
    sharding.write_shards(texts, out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s")).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in back) == [(0, "a"), (1, "bb"), (2, ""), (3, "cccc")]
