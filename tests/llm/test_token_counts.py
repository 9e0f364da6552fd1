import public_tokenizers
import pytest
import tiktoken  # noqa: F401

from wickwork.llm import token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def limits(df):
    lengths = token_counts.encoded_lengths(df, RANKS)
    return lengths, {r["n_tokens"]: r.asDict() for r in token_counts.context_limits(token_counts.length_histogram(lengths)).collect()}


def test_suffix_sums_match_a_direct_count(docs, prose, monkeypatch):
    monkeypatch.setattr(token_counts, "_BLOCK", 16)
    df = docs([prose(k, 3 * (k % 30) + 1) for k in range(80)] + ["", None, "x" * 5000])
    lengths, found = limits(df)
    n = [r["n_tokens"] for r in lengths.collect()]
    assert sorted(found) == sorted(set(n))
    for limit, r in found.items():
        assert r["n_docs"] == n.count(limit)
        assert r["docs_over"] == sum(x > limit for x in n)
        assert r["tokens_over"] == sum(x for x in n if x > limit)
        assert r["tokens_kept"] == sum(min(x, limit) for x in n)
        assert (r["docs_total"], r["tokens_total"]) == (len(n), sum(n))
        assert r["quantile"] == pytest.approx(sum(x <= limit for x in n) / len(n))


def test_lengths_are_the_encoders(docs):
    from tokenizers import Tokenizer

    texts = ["It's 3 o'clock.\n\n  Äpfel 漢字", "", None, "<|endoftext|> \t a", "plain"]
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.encoded_lengths(docs(texts), RANKS).collect()}
    assert got == {k: len(whole.encode(t, add_special_tokens=False).ids) if t else 0 for k, t in enumerate(texts)}


def test_empty_table_and_clashing_names(docs, clashing):
    assert limits(docs([]))[1] == {}
    df = clashing(docs(["a b", "a b"]), "n_tokens", "n_docs", "block")
    assert limits(df)[1][2]["n_docs"] == 2
