import random
import time

from wickwork.llm.common import lower_words
from wickwork.llm.licenses import PHRASES, TEMPLATES, Scanner, Template, find_licenses
from wickwork.llm.suffix import SuffixAutomaton


def test_automaton_has_just_the_runs_of_its_sequences():
    rng = random.Random(2)
    sequences = [[rng.choice("abc") for _ in range(rng.randrange(0, 14))] for _ in range(6)]
    automaton = SuffixAutomaton()
    ends = [automaton.add(s) for s in sequences]
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}

    def walk(word):
        v = 0
        for w in word:
            v = automaton.next[v].get(w)
            if v is None:
                return None
        return v

    for n in range(1, 6):
        for k in range(3**n):
            word = tuple("abc"[k // 3**i % 3] for i in range(n))
            assert (walk(word) is not None) == (word in runs)
    for s, states in zip(sequences, ends):
        assert [walk(s[: i + 1]) for i in range(len(s))] == states


def phrase_places(document, phrases):
    found = []
    for p in phrases:
        words = lower_words(p.text)
        found += [(i, i + len(words), p.label) for i in range(len(document) - len(words) + 1) if document[i : i + len(words)] == words]
    return sorted(found)


def test_phrases_match_brute_force():
    rng = random.Random(4)
    pool = "gnu general public license apache cc by mit nc the software version 2 0 x".split()
    scanner = Scanner(PHRASES, TEMPLATES, 4, 0.7)
    for _ in range(3000):
        document = [rng.choice(pool).encode() for _ in range(rng.randrange(0, 25))]
        assert sorted(scanner.scan(document)[0]) == phrase_places(document, PHRASES)


def test_matching_statistics_chain_across_gaps():
    template = Template("t", " ".join(f"w{k}" for k in range(30)))
    scanner = Scanner((), (template,), 4, 0.7)
    document = [f"w{k}".encode() for k in range(30)]
    assert scanner.scan(document)[1] == [(0, 30, "t", 1.0)]
    changed = [b"x", *document[:10], b"changed", *document[11:], b"y"]
    assert scanner.scan(changed)[1] == [(1, 31, "t", 29 / 30)]
    assert scanner.scan(document[:20])[1] == []
    assert scanner.scan(document[15:] + document[:15])[1] == []
    assert [s[:2] for s in scanner.scan(document + [b"z"] * 50 + document)[1]] == [(0, 30), (80, 110)]


def test_query_cases(docs, clashing):
    texts = ["Licensed under the APACHE-License, Version 2.0.", None, "", "cc by, CC BY: ccby", "licensed under cc by-nc 4.0 é"]
    out = {r["doc_id"]: r for r in find_licenses(clashing(docs(texts), "phrases", "spans", "n_words")).collect()}
    assert [(p["first"], p["last"], p["label"]) for p in out[0]["phrases"]] == [(3, 5, "apache")]
    assert [(s["first"], s["last"], s["label"]) for s in out[0]["spans"]] == [(0, 8, "apache-2.0")]
    assert out[1]["n_words"] == out[2]["n_words"] == 0 and not out[1]["phrases"] and not out[2]["spans"]
    assert [p["first"] for p in out[3]["phrases"]] == [0, 2]
    assert "cc-by-nc-4.0" in {s["label"] for s in out[4]["spans"]} and out[4]["n_words"] == 8
    assert find_licenses(docs([])).count() == 0


def test_very_many_notices():
    scanner = Scanner(PHRASES, TEMPLATES, 4, 0.7)
    notice = lower_words("Released under the MIT License")
    started = time.perf_counter()
    spans = scanner.scan(notice * 30_000)[1]
    assert time.perf_counter() - started < 30
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]) if a[2] == b[2])


def test_very_long_text():
    scanner = Scanner(PHRASES, TEMPLATES, 4, 0.7)
    document = [b"the", b"software"] * 200_000 + lower_words("MIT License")
    assert scanner.scan(document)[0] == [(400_000, 400_002, "mit")]
