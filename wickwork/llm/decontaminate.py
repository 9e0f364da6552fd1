"""Benchmark decontamination: one Aho-Corasick automaton over the words of all test items.

Items and documents are normalised alike: A-Z lower-cased, words are runs of ASCII letters,
digits and non-ASCII characters. Every run of ``window`` words of an item is a key of the
automaton; an item with fewer words, but not none, is one key. Each document's words go
through the automaton once, and the word positions found are mapped back to the original
text. Documents are neither shuffled nor cut.

Items are read to the driver in groups of at most ``group_bytes`` of text, and one group's
automaton is in memory at a time: the number of passes grows with the benchmark, the memory
does not. A usual benchmark is one group, so the documents are scanned once.

Defined cases: a null or empty text has no words and no hits. A null or empty item matches
nothing. An item without an id marks words but is not listed. Items that share an id count
once. Repeated documents are judged each by itself. Of the documents only ``doc_id`` and
``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
import uuid
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wickwork.llm.common import cut, lower_words, map_batches

# A word of the original text; lower-casing A-Z does not move it.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

_HITS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_IDS = pa.list_(pa.string())


class Matcher:
    """The automaton of one group of items. Built once in each Python worker."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.keys: list[tuple[int, set[str]]] = []  # length in words, ids of the items that hold the key
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for item_id, text in items:
            item = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in lower_words(text)]
            length = min(window, len(item))
            for start in range(len(item) - length + 1 if item else 0):
                key = tuple(item[start : start + length])
                if not self.automaton.exists(key):
                    self.automaton.add_word(key, len(self.keys))
                    self.keys.append((length, set()))
                if item_id is not None:
                    self.keys[self.automaton.get(key)][1].add(item_id)
        if self.keys:
            self.automaton.make_automaton()

    def find(self, document: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges (end exclusive, merged where they touch) and the ids of the items found."""
        ranges: list[tuple[int, int]] = []
        ids: set[str] = set()
        if self.keys and document:
            for end, k in self.automaton.iter(tuple(map(self.numbers.get, document, repeat(0)))):
                length, items = self.keys[k]
                ranges.append((end + 1 - length, end + 1))
                ids |= items
        return merge(ranges), ids


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


_built: dict[str, Matcher] = {}


def _matcher(token: str, items: list[tuple[str | None, str]], window: int) -> Matcher:
    """The matcher this worker has built for a group of items; only the latest is kept."""
    if token not in _built:
        _built.clear()
        _built[token] = Matcher(items, window)
    return _built[token]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    group_bytes: int = 2 * 1024 * 1024,
    keep_text: bool = False,
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``hits`` (word ranges), ``spans`` (code points), ``item_ids``.

    Ranges are sorted, disjoint and end-exclusive; ``item_ids`` are sorted strings. With
    ``keep_text`` the text stays as a column.
    """
    sc = docs.sparkSession.sparkContext
    items = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = -(-total // group_bytes) or 1
    found = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.lit(None).cast("array<struct<first:int,last:int>>").alias("hits"),
        F.lit(None).cast("array<string>").alias("item_ids"),
    )
    id_type = found.schema["doc_id"].dataType.simpleString()
    for k in range(groups):
        group = [tuple(r) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(groups)) == k).collect()]
        last = k == groups - 1
        found = _one_pass(found, sc.broadcast(group), window, id_type, last, keep_text)
        if not last:
            found = cut(found)
    return found


def _one_pass(found: DataFrame, shared, window: int, id_type: str, last: bool, keep_text: bool) -> DataFrame:
    token = uuid.uuid4().hex

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        matcher = _matcher(token, shared.value, window)
        columns = {name: batch.column(name) for name in ("doc_id", "text")}
        n_words, hits, spans, ids = [], [], [], []
        for text, old_hits, old_ids in zip(*(batch.column(c).to_pylist() for c in ("text", "hits", "item_ids"))):
            document = lower_words(text)
            ranges, found_ids = matcher.find(document)
            if old_hits:
                ranges = merge([*ranges, *((h["first"], h["last"]) for h in old_hits)])
            hits.append([{"first": a, "last": b} for a, b in ranges])
            ids.append(sorted(found_ids.union(old_ids or ())))
            if last:
                n_words.append(len(document))
                places = [m.span() for m in _WORD.finditer(text)] if ranges else []
                spans.append([{"start": places[a][0], "end": places[b - 1][1]} for a, b in ranges])
        columns |= {"hits": pa.array(hits, _HITS), "item_ids": pa.array(ids, _IDS)}
        if last:
            columns["n_words"] = pa.array(n_words, pa.int64())
            columns["spans"] = pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            if not keep_text:
                del columns["text"]
        return pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {id_type}, " + ("" if last and not keep_text else "text string, ")
    schema += "hits array<struct<first:int,last:int>>, item_ids array<string>"
    if last:
        schema += ", n_words bigint, spans array<struct<start:int,end:int>>"
    return map_batches(found, scan, schema)


def n_hit(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"])


def drop_contaminated(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without a hit, with all their columns in one pass.

    The columns travel beside the text as one struct, so their names cannot clash.
    """
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    found = find_items(packed, items, doc_id="row", text="text", **options)
    return found.where(F.size("hits") == 0).select("doc_id.*")
