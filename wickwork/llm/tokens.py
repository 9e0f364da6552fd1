"""Byte-pair ids of whole texts by a public tokenizer file, with a bounded cache of words.

``word_bpe`` files drop white space and never join letters across it, so a text's ids are
those of its white-space separated chunks in a row. Texts and chunks of plain Latin letters,
digits and ASCII signs are split here as the file's own pattern splits them and their pieces go
to its merges directly; all other chunks go through the whole tokenizer. A worker keeps the ids
of pieces it has seen, and of chunks where a text is not plain as a whole: pieces recur more
often than chunks, to which signs stick.
"""

from __future__ import annotations

import re
import struct

from tokenizers import Tokenizer

from wickwork.llm.common import register_cache

_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_TEXT = re.compile("[\\t-\\r -~À-ÖØ-öø-ÿ]*")
# The file's split pattern, for what _PLAIN or _PLAIN_TEXT matches, in lower case.
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = _byte_letters()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Cache(dict):
    """Values made on first use. When ``most`` are held they become the old generation; those still used come back from it."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most
        self.old: dict = {}

    def empty(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """``encode(text)``: the ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, cached: int = 150_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = _Cache(self._piece, cached)
        self.chunks = _Cache(self._chunk, cached)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(map(_SHOWN.__getitem__, piece.encode()))
        return _packed([t.id for t in self.model.tokenize(shown)])

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if chunk.isalpha():
            return self.pieces[text.lower()]
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        if text and _PLAIN_TEXT.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))
        return b"".join(map(self.chunks.__getitem__, text.encode().split())) if text else b""


_encoders: dict[str, WordEncoder] = {}


def _clear() -> None:
    for encoder in _encoders.values():
        encoder.pieces.empty()
        encoder.chunks.empty()


register_cache(__name__, _clear, lasting=True)


def word_encoder(path: str) -> WordEncoder:
    """This worker's encoder."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
