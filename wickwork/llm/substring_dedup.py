"""Substring dedup: words covered by a run of ``window`` words that stands elsewhere too.

The reference against which documents are matched is the corpus itself, so its suffix automata
are as large as the corpus and every document would have to be streamed through all of them.
Two things make that linear. Documents and reference meet by *anchors* only: of each window the
least hash of its runs of ``ANCHOR`` words, so equal windows have equal anchors. And equal
*regions*, the words of all neighbouring windows with one anchor, are reduced to one with a count.

1. Each document's regions are made from its whole text: anchor, hash of the words, place.
2. Anchors found once are dropped. Regions found more than once are repeated as a whole.
3. The others may share some windows with another region of their anchor. The distinct regions
   of an anchor are a reference shard: a suffix automaton is built of them, each is streamed
   through it, and where the matching statistic reaches ``window`` in a state that more than one
   region has, the window is repeated. A shard has at most ``SHARD_REGIONS`` regions. Anchors
   with more, at the edges of passages in very many documents, are parted further by the whole
   window's hash, and counted.
4. A document's repeated windows are merged into maximal spans and removed.

Windows are judged on the input, and all their places are removed, the first one included.
Regions are a bounded number of words; nothing is collected per document but its own places.
What is broadcast is checked to be at most ``BROADCAST_BYTES``; beyond that Spark joins by a
shuffle. Regions and documents are told apart by 64-bit hashes.

Defined cases: a null or empty text has no words. A text of fewer words than the window keeps
them all. Rows that repeat a document are places like any other, so its windows are repeated.
Of the documents only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wickwork.llm.common import BROADCAST_BYTES, cut, map_batches, register_cache, words
from wickwork.llm.suffix import SuffixAutomaton

ANCHOR = 16
SHARD_REGIONS = 64

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    """64-bit hashes of words seen; emptied when it has grown to its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _clear() -> None:
    _hashes.clear()
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


register_cache(__name__, _clear)


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, from 0 to n at least."""
    if len(_powers[0]) <= n:
        size = 1 << n.bit_length()
        for k, b in enumerate((_BASE, _INVERSE)):
            factors = np.full(size + 1, b, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


class Regions:
    """Of a text's windows: runs of neighbours with one anchor, as arrays over runs."""

    def __init__(self, document: list[bytes], window: int):
        n = len(document)
        h = np.fromiter(map(_hashes.__getitem__, document), np.uint64, n)
        up, down = _power(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(h * up[:n], out=sums[1:])
        self.sums, self.down = sums, down
        grams = self.hash_of(np.arange(n - ANCHOR + 1), ANCHOR)
        count = n - window + 1
        least, place = grams[:count].copy(), np.zeros(count, np.int64)
        for k in range(1, window - ANCHOR + 1):
            here = grams[k : k + count]
            smaller = here < least
            least[smaller] = here[smaller]
            place[smaller] = k
        place += np.arange(count)
        self.first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        self.size = np.diff(self.first, append=count)
        self.anchor = least[self.first]
        self.content = _mixed(self.hash_of(self.first, self.size + (window - 1)) + self.anchor)

    def hash_of(self, start: np.ndarray, length) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * self.down[start])


def _occurrences(docs: DataFrame, window: int) -> DataFrame:
    """``anchor``, ``region``, ``key`` and ``at`` (first window * 64 + number of windows) of every region."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            document = words(text)
            if len(document) >= window:
                r = Regions(document, window)
                at = r.first * 64 + r.size
                for column, part in zip(columns, (r.anchor.view(np.int64), r.content.view(np.int64), np.full(len(at), key), at)):
                    column.append(part)
        arrays = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "region", "key", "at"])

    return map_batches(docs.select("key", "text"), run, "anchor bigint, region bigint, key bigint, at bigint")


def _with_words(regions: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """The regions with their ``words``, taken from the document of each one's first place."""
    places = regions.groupBy("key").agg(F.collect_list(F.struct("anchor", "region", "n", "at")).alias("regions"))
    places = cut(places)
    keys = places.select("key")
    if keys.count() * 16 <= BROADCAST_BYTES:
        docs = docs.join(F.broadcast(keys), "key", "left_semi")
    both = docs.select("key", "text").join(places, "key").select("text", "regions")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        for text, found in zip(batch.column("text").to_pylist(), batch.column("regions").to_pylist()):
            document = words(text)
            for r in found:
                first, size = divmod(r["at"], 64)
                values = (r["anchor"], r["region"], r["n"], b" ".join(document[first : first + size + window - 1]).decode())
                for column, value in zip(out, values):
                    column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["anchor", "region", "n", "words"])

    return map_batches(both, run, "anchor bigint, region bigint, n bigint, words string").dropDuplicates(["region"])


def shared_windows(regions: list[list[bytes]], window: int) -> list[int]:
    """For each region, a bit for each of its windows that another region has too."""
    automaton = SuffixAutomaton()
    ends = [automaton.add(r) for r in regions]
    link, length = automaton.link, automaton.length
    owner, shared = [-1] * len(link), [False] * len(link)
    at = []
    for k, states in enumerate(ends):
        mine = []
        for v in states[window - 1 :]:
            while length[link[v]] >= window:
                v = link[v]
            mine.append(v)
            shared[v] = shared[v] or owner[v] not in (-1, k)
            owner[v] = k
        at.append(mine)
    return [sum(1 << j for j, v in enumerate(mine) if shared[v]) for mine in at]


def _matched(regions: DataFrame, window: int) -> DataFrame:
    """``region`` and ``mask`` by the automaton of each anchor's regions."""
    shards = regions.groupBy("anchor").agg(F.collect_list(F.struct("region", "n", "words")).alias("regions"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, masks = [], []
        for shard in batch.column("regions").to_pylist():
            for r, mask in zip(shard, shared_windows([words(r["words"]) for r in shard], window)):
                if r["n"] == 1 and mask:
                    ids.append(r["region"])
                    masks.append(mask)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(masks, pa.int64())], ["region", "mask"])

    return map_batches(shards.select("regions"), run, "region bigint, mask bigint")


def _counted(regions: DataFrame, window: int) -> DataFrame:
    """``region`` and ``mask`` by counting whole windows, for anchors with very many regions."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, ids, n, bits = [], [], [], []
        for region, count, text in zip(*(batch.column(c).to_pylist() for c in ("region", "n", "words"))):
            document = words(text)
            for j in range(len(document) - window + 1):
                hashes.append(xxhash.xxh3_64_intdigest(b" ".join(document[j : j + window])) - (1 << 63))
                ids.append(region)
                n.append(count)
                bits.append(1 << j)
        arrays = [pa.array(c, pa.int64()) for c in (hashes, ids, n, bits)]
        return pa.RecordBatch.from_arrays(arrays, ["window", "region", "n", "bit"])

    windows = cut(map_batches(regions, run, "window bigint, region bigint, n bigint, bit bigint"))
    repeated = windows.groupBy("window").agg(F.sum("n").alias("total")).where("total > 1").select("window")
    found = windows.where("n = 1").join(repeated, "window", "left_semi")
    return found.groupBy("region").agg(F.bit_or("bit").alias("mask"))


def _ranges(places: list[dict], window: int) -> list[tuple[int, int]]:
    """Word ranges (end exclusive) covered by the windows of masks."""
    out: list[tuple[int, int]] = []
    for first, mask in sorted((p["at"] // 64, p["mask"]) for p in places):
        while mask:
            low = (mask & -mask).bit_length() - 1
            start, end = first + low, first + low + window
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], max(end, out[-1][1]))
            else:
                out.append((start, end))
            mask &= mask - 1
    return out


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """``key`` and ``ranges`` (words, end exclusive) of the documents that have repeated windows. ``docs``: ``key``, ``text``."""
    found = _occurrences(docs, window)
    twice = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    hits = cut(found.join(twice, "anchor", "left_semi"))
    regions = hits.groupBy("anchor", "region").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at")).alias("place"))
    regions = cut(regions.select("anchor", "region", "n", "place.*"))
    anchors = regions.groupBy("anchor").agg(F.count(F.lit(1)).alias("distinct"), F.min("n").alias("least"))
    # Only regions found once are open, and only if their anchor has another region.
    open_anchors = cut(anchors.where("distinct > 1 and least = 1").select("anchor", "distinct"))
    open_regions = regions.join(open_anchors, "anchor")
    windows = F.col("at") % 64
    masks = regions.where("n > 1").select("region", (F.call_function("shiftleft", F.lit(1).cast("long"), windows.cast("int")) - 1).alias("mask"))
    for solve, some in ((_matched, F.col("distinct") <= SHARD_REGIONS), (_counted, F.col("distinct") > SHARD_REGIONS)):
        if open_anchors.where(some).take(1):
            masks = masks.union(solve(_with_words(open_regions.where(some).drop("distinct"), docs, window), window))
    covered = hits.join(cut(masks), "region").groupBy("key").agg(F.collect_set(F.struct("at", "mask")).alias("places"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ranges = [[{"first": a, "last": b} for a, b in _ranges(p, window)] for p in batch.column("places").to_pylist()]
        return pa.RecordBatch.from_pydict({"key": batch.column("key"), "ranges": pa.array(ranges, _RANGES)})

    return map_batches(covered, run, "key bigint, ranges array<struct<first:int,last:int>>")


_RANGES = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def remove_repeats(docs: DataFrame, *, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words left joined by one space.

    ``window`` is from 17 to 78 words.
    """
    if not ANCHOR < window < ANCHOR + 63:
        raise ValueError("window has to be from 17 to 78 words")
    docs = docs.select(F.xxhash64(doc_id, text).alias("key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    spans = cut(repeated_spans(docs, window))
    size = spans.agg(F.count(F.lit(1)) * 32 + F.coalesce(F.sum(F.size("ranges")), F.lit(0)) * 24).first()[0]
    if size <= BROADCAST_BYTES:
        spans = F.broadcast(spans)
    both = docs.join(spans, "key", "left").select("doc_id", "text", "ranges")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, kept = [], [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            document = words(text)
            left = []
            at = 0
            for r in ranges or ():
                left += document[at : r["first"]]
                at = r["last"]
            left += document[at:]
            n_words.append(len(document))
            n_removed.append(len(document) - len(left))
            kept.append(b" ".join(left).decode())
        arrays = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(both, run, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string")
