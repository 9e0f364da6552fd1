
import numpy as np
import pytest
from pyspark.sql import functions as F

from parity import connect, differences
from wickwork.llm import hard_negatives
from wickwork.llm.queries import QUERIES, SQL

SCHEMA = "vec_id bigint, embedding array<double>, label int"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, anchors, low=80, high=100, positives=5, negatives=5):
    dims = max((len(x) for _, x, _ in rows), default=0)
    rows = [(i, np.array([*x, *[0.0] * (dims - len(x))]), label) for i, x, label in rows]
    out = set()
    for a in rows:
        if a[0] not in anchors:
            continue
        scored = sorted(((float(a[1] @ r[1]), r) for r in rows if r[0] != a[0]), key=lambda s: (-s[0], s[1][0]))
        near = [(s, r) for s, r in scored if r[2] == a[2]][:positives]
        for s, p in near:
            window = [(t, r) for t, r in scored if r[2] != a[2] and low * s <= 100 * t <= high * s][:negatives]
            out |= {(a[0], p[0], k + 1, r[0], s, t) for k, (t, r) in enumerate(window)}
    return out


def mined(spark, rows, anchors, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives.mine(df, F.col("vec_id").isin(list(anchors)) if anchors else F.lit(False), **options)
    rows = [tuple(r[c] for c in NAMES) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("kind", ["clusters", "ties", "spread"])
def test_against_all_pairs(spark, kind, monkeypatch):
    rng = np.random.default_rng(7)
    n, dims = 400, 6
    if kind == "clusters":
        x = rng.integers(-60, 60, (8, dims))[rng.integers(0, 8, n)] + rng.integers(-4, 5, (n, dims))
    elif kind == "ties":
        x = rng.integers(-1, 2, (n, dims))
        x[: n // 3] = x[0]  # one vector with a third of the rows
    else:
        x = rng.integers(-100, 100, (n, dims))
    rows = [(int(k), [float(v) for v in x[k]], int(rng.integers(0, 3))) for k in range(n)]
    anchors = set(range(0, n, 20))
    # Several rounds, several blocks of a cell and several crowds of askers.
    for name, value in (("ROUND_ROWS", 40), ("BLOCK_ROWS", 16), ("BLOCK_ANCHORS", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(spark, rows, anchors) == plain(rows, anchors)


def test_heap_gives_all_cells_by_bound_and_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 8))
    books = hard_negatives.Codebooks(x[:200], 6)
    near = [hard_negatives._nearest(h, w) for h, w in zip(books.halves(x), books.words)]
    np.add.at(books.rows, tuple(near), 1)
    for half, words, code, radius in zip(books.halves(x), books.words, near, books.radius):
        np.maximum.at(radius, code, np.linalg.norm(half - words[code], axis=1))
    anchor = rng.normal(size=8)
    seen = list(books.visit(anchor))
    assert [b for b, _, _ in seen] == sorted((b for b, _, _ in seen), reverse=True)
    assert sorted(c for _, c, _ in seen) == sorted(set((near[0] * 6 + near[1]).tolist()))
    bound = {c: b for b, c, _ in seen}
    assert all(x[k] @ anchor <= bound[near[0][k] * 6 + near[1][k]] for k in range(len(x)))


def test_clustered_data_is_not_scanned_whole(spark, monkeypatch):
    rng = np.random.default_rng(11)
    centre = rng.normal(size=(16, 8)) * 100
    x = np.round(centre[rng.integers(0, 16, 3000)] + rng.normal(size=(3000, 8)))
    rows = [(k, x[k].tolist(), k % 2) for k in range(3000)]
    monkeypatch.setattr(hard_negatives, "ROUND_ROWS", 64)
    monkeypatch.setattr(hard_negatives, "LEAST_CODES", 16)
    asked = []
    ask = hard_negatives._asked

    def watch(*args):
        found = ask(*args)
        asked.append(found.where("cell is not null").count())
        return found

    monkeypatch.setattr(hard_negatives, "_asked", watch)
    anchors = set(range(0, 3000, 500))
    assert mined(spark, rows, anchors) == plain(rows, anchors)
    assert len(asked) >= 2 and sum(asked) < 0.5 * 2 * 6 * 16 * 16


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    sound = [(0, [3.0, 4.0, 0.0], 1), (1, [3.0, 4.0, 0.0], 1), (2, [3.0, 4.0], 2), (3, [2.5, 4.0, 1.0], 2), (7, [-9.0, 0.0, 0.0], 1), (8, [], 3)]
    unsound = [(None, [3.0, 4.0, 0.0], 2), (4, None, 2), (5, [nan, 1.0, 1.0], 2), (6, [inf, 1.0, 1.0], 2), (9, [None, 1.0, 1.0], 2), (10, [3.0, 4.0, 0.0], None)]
    expected = plain(sound, {0, 2, 7, 8})
    assert expected and mined(spark, sound + unsound, {0, 2, 7, 8, 4, 5}) == expected
    assert mined(spark, sound + sound, {0, 2, 7, 8}) == expected  # rows equal in all are one
    assert mined(spark, unsound, {4}) == mined(spark, [], {0}) == mined(spark, sound, set()) == set()


def test_clashing_columns_and_text_ids(spark, clashing):
    rows = [(f"v{k}", [float(k % 5), 1.0], "even" if k % 2 else "odd") for k in range(40)]
    df = clashing(spark.createDataFrame(rows, "name string, x array<double>, kind string"), "id", "key", "cell", "rank", "label", "anchor")
    found = hard_negatives.mine(df, F.col("name") == "v4", vec_id="name", vector="x", label="kind")
    expected = plain([(i, x, k) for i, x, k in rows], {"v4"})
    assert {tuple(r[c] for c in NAMES) for r in found.collect()} == expected


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    message, n = differences(spark, connect(folder), folder, QUERIES["op11_hard_negatives"], SQL["op11_hard_negatives"])
    assert message is None and n > 50


def test_sample_of_many_dimensions_is_bounded():
    assert hard_negatives.SAMPLE_VALUES * 8 <= 64 << 20
