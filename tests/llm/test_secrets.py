import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from wickwork.llm.automaton import Syntax, any_case, compile_patterns
from wickwork.llm.secrets import BASE, RULES, Scanner, find_secrets, longest, mask, redact

SCANNER = Scanner()
PATTERNS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]
PIECES = ["token", "secret", "api_key", "APIKEY", "password", "passwd", "=", ":", " ", '"', "'", "é", "a", "deadbeef", "0123456789abcdef"]
PIECES += ["AKIA", "ABCDEFGHIJ123456", "-", ".", "/", "x", "ß漢", "\n"]


def brute(text):
    found = [(m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(PATTERNS) for m in p.finditer(text) if len(m[g]) >= n]
    return [(PATTERNS[k][0], a, b) for a, k, b in sorted(found)]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_spans_match_the_expressions(text):
    assert [s for s in SCANNER.scan(text) if s[0] in BASE] == brute(text)


@pytest.mark.parametrize("pattern", ["ab|a", "a?b*c+", "(ab|cd){2,3}x", "[a-c]{2}", "[ba]?", "a{2,}", "(a|ab)(c|bcd)?", "\\x41\\."])
def test_compiled_patterns_match_longest(pattern):
    machine = compile_patterns([Syntax(pattern).read()], search=False, backwards=False)
    rng = random.Random(6)
    for _ in range(400):
        text = "".join(rng.choice("abcdxA.") for _ in range(rng.randrange(0, 9)))
        ends = [n for n in range(len(text) + 1) if re.fullmatch(pattern, text[:n])]
        assert longest(machine, text.encode(), 0) == (max(ends) if ends else 0)


def test_machine_is_minimal_and_folds_case():
    machine = compile_patterns([Syntax("abc|abd|aec|aed").read()], search=False, backwards=False)
    assert machine.states == 5  # dead, start, a, ab or ae, end
    both = compile_patterns([any_case(Syntax("k[a-b]").read())], search=False, backwards=False)
    assert longest(both, b"KB", 0) == longest(both, b"ka", 0) == 2


def test_own_rules():
    text = "x -----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36 + " xoxb-1234567890-abc AIza" + "B" * 35
    kinds = {k: text[a:b] for k, a, b in SCANNER.scan(text)}
    assert kinds["private_key"] == "-----BEGIN RSA PRIVATE KEY-----" and kinds["github"] == "ghp_" + "a" * 36
    assert kinds["slack"] == "xoxb-1234567890-abc" and kinds["google"] == "AIza" + "B" * 35
    assert SCANNER.scan("ghp_short xoxb-1 AIza") == []


def test_masking():
    assert mask("a token=abcdefgh b", [("assign", 2, 16)]) == "a [REDACTED] b"
    assert mask("0123456789", [("x", 1, 4), ("y", 2, 6), ("z", 6, 8)]) == "0[REDACTED][REDACTED]89"


def test_query_cases(docs, clashing):
    long = "y" * 300_000 + " é token = 'abcdef123' " + "z" * 300_000
    texts = ["é token: abcdef", None, "", long, "secret=abc", "clean text"]
    df = clashing(docs(texts), "spans", "kind")
    out = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in find_secrets(df).collect()}
    assert out == {0: [("assign", 2, 15)], 1: [], 2: [], 3: [("assign", 300_003, 300_003 + 18)], 4: [], 5: []}
    done = redact(df)
    assert done.columns == df.columns
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in done.collect()}
    assert rows[0] == ("é [REDACTED]", 12) and rows[1][0] is None and rows[5] == ("clean text", 10)
    assert all(not r["spans"] for r in find_secrets(done).collect())
    assert find_secrets(docs([])).count() == 0 and redact(docs([])).count() == 0
    assert [r.name for r in RULES[:3]] == list(BASE)
