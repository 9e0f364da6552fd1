import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from wickwork.llm.packing import Packer, Piece, pack
from wickwork.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
CACHED = WordEncoder(PATH, 50)


def ids_of(text):
    return np.array(WHOLE.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAzZéÉßŸÿ×µªº01'stdrevlm.,!<|>́İΣς漢\x1c\x85\t\n  _-\"😀"), max_size=40))
def test_cached_ids_are_the_tokenizers(text):
    assert CACHED.encode(text) == ids_of(text)


def test_special_tokens_and_long_words():
    for text in ("<|endoftext|>", "a<|startoftext|>b", "it's we'll I'VE", "x" * 3000, "é" * 500 + "!" * 500):
        assert CACHED.encode(text) == ids_of(text)


def sizes(windows):
    return [sum(map(len, w)) for w in windows]


def run_packer(lengths, size):
    packer, windows = Packer(size), []
    for k, n in enumerate(lengths):
        windows += packer.add(Piece(k, 0, bytes(4 * n), n))
    return windows + list(packer.finish())


@pytest.mark.parametrize("seed", range(40))
def test_every_token_is_in_one_piece_and_one_window_at_most_is_not_full(seed):
    rng = random.Random(seed)
    size = rng.choice([2, 5, 16, 64])
    lengths = [rng.randrange(0, 3 * size) for _ in range(rng.randrange(0, 60))]
    windows = run_packer(lengths, size)
    assert all(0 < n <= size for n in sizes(windows)) and sum(n < size for n in sizes(windows)) <= 1
    cover = defaultdict(list)
    for w in windows:
        for p in w:
            cover[p.doc].append((p.start, len(p)))
    for k, n in enumerate(lengths):
        at = 0
        for start, length in sorted(cover[k]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_level_has_the_least_sum_of_squares():
    rng = random.Random(1)
    packer = Packer(20)
    for k in range(400):
        n = rng.randrange(1, 20)
        before = packer.numbers.copy()

        def cost(level):
            after = before.copy()
            after[level] -= level > 0
            after[level + n] += 1
            return int((after[1:20] ** 2).sum())

        options = [h for h in range(21 - n) if h == 0 or before[h]]
        level = packer._level(n)
        assert level in options and cost(level) == min(map(cost, options))
        list(packer.add(Piece(k, 0, bytes(4 * n), n)))


def test_documents_round_trip(docs, prose, clashing):
    texts = [prose(k, 37 * k % 900) for k in range(60)] + [None, "", prose(5, 9000), "Ünïcode, it's", "Ünïcode, it's"]
    df = clashing(docs(texts).repartition(3), "start", "ids", "offset")
    rows = pack(df, PATH, length=256).collect()
    pieces, sequences = defaultdict(dict), defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["start"] not in pieces[r["doc_id"]]
        pieces[r["doc_id"]][r["start"]] = (bytes(r["ids"]), r["doc_tokens"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, text in enumerate(texts):
        whole = b"".join(pieces[k][s][0] for s in sorted(pieces[k]))
        assert whole == ids_of(text or "") + np.array([1], "<u4").tobytes()
        assert {n for _, n in pieces[k].values()} == {len(whole) // 4}
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256


def test_empty_table(docs):
    assert pack(docs([]), PATH).count() == 0


def test_signs_and_case_make_no_words_of_their_own():
    encoder, texts = WordEncoder(PATH), ["House, house. (house)\thouse!\n", "HOUSE&&& 'house' it's"]
    for text in texts:
        ids = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode(text) == ids
    assert not encoder.chunks
    assert sorted(encoder.pieces) == sorted([",", "house", ".", "(", ")", "!", "&&&", "'", "it", "'s"])


@pytest.mark.parametrize("text", ["a\x0bb,\x0cc\r\nd", "don't I'LL ÀÉß÷×", "x <|endoftext|> y", "a\x1cb\x85c\xa0d", "naïve – ’tis 日本"])
def test_plain_and_other_texts_have_the_ids_of_the_tokenizer(text):
    encoder = WordEncoder(PATH)
    assert encoder.encode(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
