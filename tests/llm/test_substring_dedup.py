import random
from collections import Counter

import pytest

from wickwork.llm import substring_dedup
from wickwork.llm.substring_dedup import remove_repeats, shared_windows


def brute(texts, window):
    documents = [(t or "").encode().split() for t in texts]
    times = Counter(tuple(d[k : k + window]) for d in documents for k in range(len(d) - window + 1))
    out = []
    for d in documents:
        keep = [True] * len(d)
        for k in range(len(d) - window + 1):
            if times[tuple(d[k : k + window])] > 1:
                keep[k : k + window] = [False] * window
        out.append((len(d), len(d) - sum(keep), b" ".join(w for w, ok in zip(d, keep) if ok).decode()))
    return out


@pytest.fixture
def corpus(prose):
    rng = random.Random(11)
    texts = [prose(k, rng.randrange(10, 260), 10**6) for k in range(60)]
    passage = prose(500, 70, 10**6)
    for k in range(0, 60, 2):
        words = texts[k].split()
        at = rng.randrange(len(words) + 1)
        texts[k] = " ".join(words[:at] + passage.split()[: rng.randrange(20, 71)] + words[at:])
    texts += [texts[3], texts[3], "a " * 200, "b " * 36, "a b " * 90, texts[5] + "\n" + texts[5]]
    texts += [" ".join([*texts[7].split()[:80], "changed", *texts[7].split()[81:]]), None, "", "c " * 34, "d " * 35, "d " * 35]
    return texts


def got(df, n):
    rows = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()}
    return [rows[k] for k in range(n)]


@pytest.mark.parametrize(("window", "shard", "broadcast"), [(35, 64, 1 << 23), (20, 2, 0)])
def test_matches_brute_force(docs, corpus, monkeypatch, window, shard, broadcast):
    monkeypatch.setattr(substring_dedup, "SHARD_REGIONS", shard)
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", broadcast)
    assert got(remove_repeats(docs(corpus), window=window), len(corpus)) == brute(corpus, window)


def test_passage_in_very_many_documents(docs, prose):
    passage = prose(1, 60, 10**6)
    texts = [f"{prose(2 * k + 10, 15, 10**6)} {passage} {prose(2 * k + 11, 15, 10**6)}" for k in range(100)]
    assert got(remove_repeats(docs(texts), window=35), 100) == brute(texts, 35)


def test_shared_windows_of_a_shard():
    a = [b"%d" % k for k in range(12)]
    b = [b"x", *a[2:9], b"y"]
    assert shared_windows([a, b, [b"%d" % k for k in range(50, 58)]], 5) == [0b11100, 0b1110, 0]


def test_rows_that_repeat_clashing_names_and_empty(docs, prose, clashing):
    text = prose(1, 50)
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (None, prose(2, 50), "en", "s", 1), (None, None, None, None, None)]
    out = remove_repeats(clashing(docs(rows), "key", "ranges", "kept", "n_words"), window=35).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in out) == [(0, 0, 0), (0, 50, 0), (1, 50, 50), (1, 50, 50)]
    assert remove_repeats(docs([]), window=35).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(docs([]), window=5)


def test_very_long_text(docs, prose):
    text = prose(1, 60_000, 10**6)
    words = text.split()
    texts = [text, " ".join(words[1000:1040]), " ".join(words[50_000:50_034])]
    assert got(remove_repeats(docs(texts), window=35), 3) == brute(texts, 35)
