from collections import Counter

import pytest
from pyspark.sql import functions as F

from wickwork.llm import quality


def brute(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    triples = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(triples)
    repeated = {k + j for k, t in enumerate(triples) if times[t] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures_match_brute_force(docs, prose):
    texts = [prose(k, 60, 12) for k in range(30)] + [prose(k, 300, 3000) for k in range(10)]
    texts += ["", None, " \n\t", "a", "a b", "a b c a b c", "x x x x x", "é ß 漢 #$%\n\n|\n|\n a\n a", "\x0b\x0c\r", prose(3, 30000, 50)]
    out = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in quality.measure(docs(texts)).collect()}
    assert out == {k: brute(t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("value", [0, 1, 31, 32, 33, 47, 63, 64, 1000, 123456, 10**12])
def test_bins(spark, value):
    row = spark.range(1).select(quality.bin_of(F.lit(value).cast("long")).alias("b")).select("b", quality.least_of(F.col("b")).alias("low")).first()
    assert row["low"] <= value <= row["low"] * 17 / 16
    after = spark.range(1).select(quality.least_of(F.lit(row["b"] + 1)).alias("low")).first()["low"]
    assert value < after


def test_thresholds_follow_the_source_and_fall_back(spark, docs, prose):
    clean = [(k, prose(k, 80, 2000), "en", "big", 1) for k in range(60)]
    # A source whose texts all hold symbols keeps them; one like it in another source goes.
    table = [(100 + k, " | ".join(prose(k, 80, 2000).split()), "en", "tables", 1) for k in range(60)]
    odd = [(200, " | ".join(prose(9, 80, 2000).split()), "en", "big", 1), (201, " | ".join(prose(8, 80, 2000).split()), None, None, 1)]
    rows = clean + table + odd + [(300, "short", "en", "big", 1), (301, None, "en", None, 1), (302, prose(7, 80, 2000), None, "tiny", 1)]
    out = {r["doc_id"]: r["kept"] for r in quality.judge(quality.measure(docs(rows))).collect()}
    assert all(out[k] for k in range(60)) and all(out[100 + k] for k in range(60))
    assert not out[200] and not out[300] and not out[301] and out[302]


def test_sketches_merge_in_any_order(docs, prose):
    measured = quality.measure(docs([prose(k, 60 + k, 40) for k in range(40)]))
    whole = quality.merge_sketches(quality.sketches(measured, ("lang", "source")), "lang")
    parts = [quality.sketches(measured.where(F.col("doc_id") % 3 == k), ("lang", "source")) for k in range(3)]
    merged = quality.merge_sketches(parts[2].union(parts[0]).union(parts[1]), "lang")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))


def test_keep_good_keeps_columns_and_rows(docs, prose, clashing):
    good = [prose(k, 70, 2000) for k in range(4)]
    rows = [(1, good[0], "en", "a", 1), (1, good[0], "en", "a", 1), (1, "junk", "en", "a", 1), (None, good[1], None, None, 2), (None, None, "en", "a", 0)]
    df = clashing(docs(rows), "kept", "n_words", "words", "row", "id", "hash")
    out = quality.keep_good(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == sorted([(1, good[0]), (1, good[0]), (0, good[1])])
    assert quality.keep_good(df.limit(0)).count() == 0
