import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from wickwork.llm import periodic_runs
from wickwork.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"


def plain_words(text):
    for c in WHITE:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_runs(x):
    """Every lag, every stretch; of equal stretches the least lag."""
    found = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = plain_words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=8))
def test_runs_equal_those_of_all_lags(parts):
    x = [w for part, times in parts for w in part * times]
    assert periodic_runs.runs_of(np.array(x, np.int64)) == plain_runs(x)


def test_splitting_recurses_to_stability():
    # "r" is frequent in the text, but rare in both parts that "x" leaves.
    x = [0] * 3 + [9] + [0] * 3 + [1] * 7
    assert periodic_runs.segments(np.array(x)) == [(7, 14)]
    assert periodic_runs.segments(np.array([0, 1] * 2)) == []


def test_a_run_inside_a_run_has_its_own_period():
    x = ([1] * 8 + [2]) * 5
    runs = periodic_runs.runs_of(np.array(x))
    assert (0, 45, 9) in runs and (0, 8, 1) in runs and runs == plain_runs(x)


@pytest.mark.parametrize("make", [lambda n: np.zeros(n, np.int64), lambda n: np.tile(np.arange(n // 20), 20), lambda n: np.random.default_rng(1).integers(0, 3, n)])
def test_very_long_texts(make):
    runs = periodic_runs.runs_of(make(200_000))
    assert all(length >= max(6, 4 * q) for _, length, q in runs)


def test_defined_cases(docs, clashing):
    texts = [None, "", " \n\t", "a a a a a", "a a a a a a", "a a a a a a", "x a b a b a b a b y", "a b a b a b a"]
    found = periodic_runs.find_runs(clashing(docs(texts), "runs", "greatest", "collapsed", "n_words"))
    rows = {r["doc_id"]: r for r in found.collect()}
    assert [rows[k]["n_words"] for k in range(8)] == [0, 0, 0, 5, 6, 6, 10, 7]
    assert [len(rows[k]["runs"]) for k in range(8)] == [0, 0, 0, 0, 1, 1, 1, 0]
    assert rows[4]["collapsed"] == rows[5]["collapsed"] == "a"
    assert tuple(rows[6]["greatest"]) == (1, 8, 2) and rows[6]["collapsed"] == "x a b y"
    assert rows[0]["greatest"] is None and rows[0]["collapsed"] == ""
    assert periodic_runs.find_runs(docs([])).count() == 0


def test_null_id_and_equal_ratios(spark):
    df = spark.createDataFrame([(None, "a b a b a b a b c d e e e e c d e e e e c d e e e e c d e e e e")], "doc_id bigint, text string")
    row = periodic_runs.find_runs(df).first()
    assert row["doc_id"] is None and row["greatest"]["start"] == 0


def test_query_against_all_lags(spark, tmp_path):
    rng = random.Random(3)
    rows = [(None, "w " * 9), (0, None), (1, "")]
    for k in range(2, 300):
        rows.append((k, " ".join(f"w{rng.randrange(rng.choice((2, 30, 300)))}" for _ in range(rng.randrange(150)))))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r["doc_id"]: tuple(r) for r in found.collect()}
    assert len(got) == 301 and got[None][1:5] == (1, 0, 9, 1)
    planted = 0
    for doc_id, text in rows[1:]:
        assert got[doc_id] == plain_digest(doc_id, text)
        planted += zlib.crc32(str(doc_id).encode()) % 10 == 0 and got[doc_id][1] > 0
    assert planted > 5
