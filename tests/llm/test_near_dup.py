import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wickwork.llm import near_dup
from wickwork.llm.graph import components
from wickwork.llm.near_dup import drop_near_duplicates, near_duplicates, shingles


def groups(sets, ids, percent):
    """The least id reachable of each set, by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [i if not sets[k] else least.get(find(k)) for k, i in enumerate(ids)]


def word_sets(texts, size):
    out = []
    for t in texts:
        words = (t or "").encode().lower().split()
        n = min(size, len(words))
        out.append({(n, *words[k : k + n]) for k in range(len(words) - n + 1)} if words else set())
    return out


def edited(text, rng, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


@pytest.fixture
def corpus(prose):
    rng = random.Random(3)
    texts = [prose(k, rng.randrange(30, 120), 500) for k in range(25)]
    texts += [edited(texts[k], rng, share) for k in range(25) for share in (0.01, 0.03, 0.05, 0.08)]
    texts += [edited(texts[1], rng, 0.03) for _ in range(40)]
    chain = prose(99, 100, 10**6).split()
    texts += [" ".join(chain[4 * k : 4 * k + 60]) for k in range(10)]
    texts += [None, "", " \n", "one", "ONE", "one two", "One Two", "two one", texts[0].upper(), texts[0]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("size", [2, 5])
def test_components_match_brute_force(docs, corpus, size):
    sets = word_sets(corpus, size)
    out = {r["doc_id"]: r for r in near_duplicates(docs(corpus), shingle=size).collect()}
    assert [out[k]["n_shingles"] for k in range(len(corpus))] == [len(s) for s in sets]
    assert [out[k]["component_id"] for k in range(len(corpus))] == groups(sets, range(len(corpus)), 80)


def test_nodes_branch_and_what_does_not_part_is_joined(docs, corpus, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 2)
    monkeypatch.setattr(near_dup, "MIDDLE", 3)
    monkeypatch.setattr(near_dup, "LEVELS", 1)
    out = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs(corpus), shingle=2).collect()}
    assert [out[k] for k in range(len(corpus))] == groups(word_sets(corpus, 2), range(len(corpus)), 80)


def test_pairs_at_the_threshold_keep_meeting_in_deep_levels(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 30, (2000, near_dup.COORDINATES))
    b = np.where(rng.random(a.shape) < 0.8, a, a + 1)
    rows = spark.createDataFrame([(k, a[k].tolist(), b[k].tolist()) for k in range(len(a))], "pair int, a array<int>, b array<int>")
    nodes, left = near_dup._roots, []
    for level in range(5):
        both = rows.withColumn("mins", F.col("a")).withColumn("x", nodes()).withColumn("mins", F.col("b")).withColumn("y", nodes())
        met = both.select("pair", "a", "b", F.explode(F.arrays_zip("x", "y")).alias("n")).where("n.x = n.y")
        rows = met.select("pair", "a", "b", F.col("n.x").alias("node")).localCheckpoint()
        left.append(rows.select("pair").distinct().count())
        nodes = near_dup._children
    assert min(left) >= 1997


def test_blocks_are_bounded_and_bring_all_pairs_together(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "MIDDLE", 40)
    rows = [(node, k, 9, k, k, k, size, 9 * size) for node, size in ((1, 300), (2, 50)) for k in range(size)]
    nodes = spark.createDataFrame(rows, "node bigint, id bigint, n bigint, s1 bigint, s2 bigint, comp bigint, size bigint, weight bigint")
    members = [set(r["m"]) for r in near_dup._blocks(nodes).groupBy("node").agg(F.collect_list("id").alias("m")).collect()]
    assert max(map(len, members)) <= 80
    together = {(a, b) for m in members for a in m for b in m if a < b}
    assert together == {(a, b) for b in range(300) for a in range(b)}


def test_nodes_of_too_many_shingles_go_in_blocks(docs, corpus, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 2)
    monkeypatch.setattr(near_dup, "WEIGHT", 300)
    monkeypatch.setattr(near_dup, "GROUP", 5)
    out = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs(corpus), shingle=2).collect()}
    assert [out[k] for k in range(len(corpus))] == groups(word_sets(corpus, 2), range(len(corpus)), 80)


def test_a_group_gives_a_spanning_forest():
    rng = random.Random(9)
    base = [rng.randrange(1 << 62) for _ in range(100)]
    sets = []
    for k in range(60):  # near copies of two originals, some just under the threshold
        kept = [x + (k % 2) for x in base]
        for at in rng.sample(range(100), rng.randrange(22)):
            kept[at] = rng.randrange(1 << 62)
        sets.append(np.unique(np.array(kept, np.uint64)))
    group = near_dup._Group()
    group.sets = sets
    group.rows = [(k, 0, 0, k, False) for k in range(60)]
    found = group.links(80)
    assert len(found) == len({*groups([set(x.tolist()) for x in sets], range(60), 80)} ^ set(range(60)))
    assert all(100 * len(set(sets[a].tolist()) & set(sets[b].tolist())) >= 80 * len(set(sets[a].tolist()) | set(sets[b].tolist())) for a, b in found)
    group.rows = [(k, 0, 0, k, k == 7) for k in range(60)]
    assert all(a == 7 for a, _ in group.links(80))


def test_texts_joined_by_a_shuffle(docs, corpus, monkeypatch):
    monkeypatch.setattr("wickwork.llm.common.BROADCAST_BYTES", 0)
    out = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs(corpus[:80]), shingle=2).collect()}
    assert [out[k] for k in range(80)] == groups(word_sets(corpus[:80], 2), range(80), 80)


def test_ids_missing_repeated_and_clashing_names(docs, prose, clashing):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(7, a, "en", "s", 1), (7, a, "en", "s", 1), (None, a + " x", "en", "s", 1), (7, b, "en", "s", 1), (None, b, None, None, 1), (None, None, "en", "s", 1), (None, "", "en", "s", 1)]
    df = clashing(docs(rows), "id", "component_id", "text_key", "n", "kept")
    out = near_duplicates(df).collect()
    assert len(out) == 7
    assert sorted((r["n_shingles"], r["component_id"] or 0) for r in out) == [(0, 0), (0, 0), (46, 7), (46, 7), (46, 7), (46, 7), (47, 7)]
    left = drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == sorted([(7, a), (7, b), (0, ""), (0, "")])
    assert near_duplicates(docs([])).count() == 0 and drop_near_duplicates(docs([])).count() == 0


def test_repeated_rows_without_words_stay(docs, prose):
    empty = [(1, "", "en", "s", 1)] * 3 + [(2, None, "en", "s", 1)] * 2 + [(None, " ", "en", "s", 1)] * 2
    repeated = [(5, prose(1, 50), "en", "s", 1)] * 2

    def ids(rows):
        return sorted(r["doc_id"] or 0 for r in drop_near_duplicates(docs(rows)).collect())

    assert ids(empty) == [0, 0, 1, 1, 1, 2, 2]
    assert ids(empty + repeated) == [0, 0, 1, 1, 1, 2, 2, 5]


def test_one_of_each_group_stays(docs, corpus):
    corpus = corpus[:90]
    left = drop_near_duplicates(docs(corpus), shingle=2)
    expected = [k for k, c in enumerate(groups(word_sets(corpus, 2), range(len(corpus)), 80)) if c == k]
    assert sorted(r["doc_id"] for r in left.collect()) == expected


def test_very_long_text_and_words():
    text = " ".join(f"w{k}" for k in range(200_000)) + " " + "x" * 100_000
    assert len(shingles(text, 2)) == 200_000
    assert near_dup.minwise(shingles(text, 2)).shape == (near_dup.COORDINATES,)
    assert len(np.unique(near_dup.minwise(shingles(text, 2)))) > 1


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 25)] + [(100, k) for k in range(101, 180)] + [(200, 200), (300, 301), (301, 300)]
    out = {r["a"]: r["b"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert out == {k: 0 for k in range(1, 26)} | {k: 100 for k in range(101, 180)} | {301: 300}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
