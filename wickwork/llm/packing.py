"""Packing: documents put into windows of ``length`` tokens by the sum-of-squares rule.

A document is its token ids and the end id. Of a longer document every full window is cut
off first; the rest is one piece. Each piece goes, online, to the fill level (or a new window)
after which the sum of squares of the numbers of partially filled windows per level is least.
The numbers stand in one array over levels, so a piece costs one vector operation however many
windows are open. A full window is written and forgotten.

Each input partition packs its own documents, so nothing is shuffled and a lost task is simply
run again. When a partition ends, pieces of its emptiest windows are cut to fill the others:
at most one window of a partition is not full.

Defined cases: a null or empty text is the end id alone. Equal and repeated documents are
packed one by one. An empty table gives no rows. Ties go to the fuller level. Only ``doc_id``
and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wickwork.llm import tokens
from wickwork.llm.common import map_in_arrow, release_caches, slices
from wickwork.llm.tokens import word_encoder

_ROWS = 2048  # pieces in a batch of the result


@dataclass
class Piece:
    doc: object
    start: int
    ids: bytes
    total: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[: 4 * n], self.total), Piece(self.doc, self.start + n, self.ids[4 * n :], self.total)


class Packer:
    """Open windows by fill level."""

    def __init__(self, length: int):
        self.length = length
        self.numbers = np.zeros(length + 1, np.int64)  # of open windows at each level
        self.open: list[list[list[Piece]]] = [[] for _ in range(length + 1)]

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a piece; yields the windows it fills."""
        while len(piece) >= self.length:
            full, piece = piece.cut(self.length)
            yield [full]
        size = len(piece)
        if not size:
            return
        level = self._level(size)
        window = self.open[level].pop() if level else []
        self.numbers[level] -= bool(level)
        window.append(piece)
        if level + size == self.length:
            yield window
        else:
            self.open[level + size].append(window)
            self.numbers[level + size] += 1

    def _level(self, size: int) -> int:
        """The level whose use leaves the least sum of squares; 0 is a new window."""
        numbers, length = self.numbers, self.length
        top = length - size
        # Half the change of the sum for levels 1 to top; filling a window adds to no level.
        change = 1.0 - numbers[1 : top + 1]
        change[:-1] += numbers[size + 1 : length]
        change[-1] -= 0.5
        change[numbers[1 : top + 1] == 0] = np.inf
        best = top - int(np.argmin(change[::-1]))
        return best if change[best - 1] <= numbers[size] + 0.5 else 0

    def finish(self) -> Iterator[list[Piece]]:
        """The windows still open, filled from the emptiest ones."""
        left = [window for level in reversed(self.open) for window in level]
        head = 0
        while head < len(left):
            window = left[head]
            room = self.length - sum(map(len, window))
            while room and head < len(left) - 1:
                giver = left[-1]
                piece = giver.pop()
                if len(piece) > room:
                    piece, rest = piece.cut(room)
                    giver.append(rest)
                elif not giver:
                    left.pop()
                window.append(piece)
                room -= len(piece)
            yield window
            head += 1


def pack(
    docs: DataFrame, tokenizer: str, *, length: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row a piece: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence.

    ``tokenizer`` is the path of a ``word_bpe`` file, the same on every executor.
    """
    end = np.array([end_id], "<u4").tobytes()
    names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch], packer: Packer) -> Iterator[list[Piece]]:
        encode = word_encoder(tokenizer).encode
        for batch in slices(batches):
            for doc, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(t) + end
                yield from packer.add(Piece(doc, 0, ids, len(ids) // 4))
        yield from packer.finish()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches(but=tokens.__name__)
        first = TaskContext.get().partitionId() << 33
        types = None
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = dict(zip(names, zip(*rows)))
            rows.clear()
            ids = pa.array(columns.pop("doc_id"), types)
            data = pa.array(columns.pop("ids"), pa.binary())
            numbers = {k: pa.array(v, pa.int64()) for k, v in columns.items()}
            arrays = {"doc_id": ids, "ids": data} | numbers
            return pa.RecordBatch.from_pydict({k: arrays[k] for k in names})

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal types
            for batch in batches:
                types = batch.schema.field("doc_id").type
                yield batch

        for number, window in enumerate(windows(watched(), Packer(length))):
            offset = 0
            for p in window:
                rows.append((p.doc, p.start, len(p), p.ids, p.total, first + number, offset))
                offset += len(p)
            if len(rows) >= _ROWS:
                yield out()
        if rows:
            yield out()

    schema = f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return map_in_arrow(docs, run, schema)
