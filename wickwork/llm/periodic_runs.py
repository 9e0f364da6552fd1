"""Periodic runs of words, by recursive frequency splitting and a scan of lags.

A run is a stretch of words of which those ``q`` apart are identical, for a least period ``q``,
that is as long as it can be and at least ``max(LEAST_LENGTH, LEAST_REPEATS * q)`` words. So
each of its words stands ``LEAST_REPEATS`` times or more inside it.

1. Splitting. Words found fewer times than that within the current segment cannot join a run
   there. They split it, and the parts are split again by their own counts until none changes.
   The longest part keeps its parent's counts less those of the rest, and only its words whose
   count fell are looked at again, so a word is counted anew only when its segment has halved.
2. Lag scan of what survives, an octave of lags at a time. For lags from ``b`` to ``2 * b - 1``
   every b-th word is an anchor: any run with such a period holds an anchor, and the ``b`` words
   from it stand again a period later. Runs of ``b`` words are numbered by doubling, so one
   comparison of numbers tests a lag, and an octave compares each word of a segment once. A lag
   that matches is followed to both ends of its run. Matches inside a run that is known, at a
   multiple of its period, are that run again and are passed over.

Each document is scanned by itself, within its own task; nothing is shuffled. Memory and time
follow the words of the longest text: n log n.

Defined cases: a null or empty text, and one of white space, has no words and no runs. A null id
is kept. Repeated documents each have a row. An empty table gives no rows. Only the named columns
are read, so other columns cannot clash. Of runs with the same exact ratio of length to period the
first by start, then by period, is the greatest.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wickwork.llm.common import map_batches, words

LEAST_LENGTH = 6
LEAST_REPEATS = 4


def _numbered(document: list[bytes]) -> np.ndarray:
    """Words as numbers from 0 in order of first appearance."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in document), np.int64, len(document))


def segments(ids: np.ndarray, least: int = LEAST_REPEATS, shortest: int = LEAST_LENGTH) -> list[tuple[int, int]]:
    """The stretches (end exclusive) left by splitting at rare words until nothing changes, in order."""
    if len(ids) < shortest:
        return []
    # Most texts end here: hardly a word is frequent enough.
    often = np.bincount(ids)[ids] >= least
    edges = np.flatnonzero(np.diff(np.concatenate(([0], often.view(np.int8), [0]))))
    todo = [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= shortest]
    if not todo:
        return []
    if todo == [(0, len(ids))]:
        return todo
    places: dict[int, list[int]] = {}
    listed = ids.tolist()
    for a, b in todo:
        for at in range(a, b):
            places.setdefault(listed[at], []).append(at)
    found = []
    # A segment, the counts of its words, and the words that may have become rare.
    open_segments = [(a, b, counts, list(counts)) for a, b in todo for counts in (Counter(listed[a:b]),)]
    while open_segments:
        a, b, counts, suspects = open_segments.pop()
        cuts = sorted(at for w in suspects if 0 < counts[w] < least for at in _between(places[w], a, b))
        if not cuts:
            found.append((a, b))
            continue
        parts = [(x + 1, y) for x, y in zip([a - 1, *cuts], [*cuts, b])]
        longest = max(parts, key=lambda p: p[1] - p[0])
        for x, y in parts:
            if (x, y) != longest and y - x >= shortest:
                own = Counter(listed[x:y])
                open_segments.append((x, y, own, list(own)))
        if longest[1] - longest[0] >= shortest:
            fell = Counter(listed[a : longest[0]])
            fell.update(listed[longest[1] : b])
            counts.subtract(fell)
            open_segments.append((*longest, counts, list(fell)))
    return sorted(found)


def _between(sorted_places: list[int], a: int, b: int) -> list[int]:
    return sorted_places[bisect_left(sorted_places, a) : bisect_left(sorted_places, b)]


def _reach(x: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``at`` whose words are those ``lag`` later; its end includes the later words."""
    n, step = len(x), 64
    end = at
    while end + lag < n:
        size = min(step, n - lag - end)
        same = x[end : end + size] == x[end + lag : end + lag + size]
        if not same.all():
            end += int(np.argmin(same))
            break
        end, step = end + size, 2 * step
    start, step = at, 64
    while start > 0:
        size = min(step, start)
        same = x[start - size : start] == x[start - size + lag : start + lag]
        if not same.all():
            start -= int(np.argmin(same[::-1]))
            break
        start, step = start - size, 2 * step
    return start, end + lag


class _Known:
    """Runs found in a segment, to pass over their matches at multiples of the period."""

    def __init__(self):
        self.period: dict[tuple[int, int], int] = {}
        self.starts = np.empty(0, np.int64)
        self.ends = np.empty(0, np.int64)
        self.periods = np.empty(0, np.int64)

    def freeze(self) -> None:
        """The runs of shorter octaves as arrays."""
        spans = sorted(self.period)
        self.starts = np.array([s for s, _ in spans], np.int64)
        self.ends = np.array([e for _, e in spans], np.int64)
        self.periods = np.array([self.period[s] for s in spans], np.int64)

    def cover(self, at: np.ndarray, lag: np.ndarray, size: int) -> np.ndarray:
        """Which matches of ``size`` words lie whole in a run of shorter octaves, at a multiple of its period.

        Of two runs that both hold a stretch of ``size`` words the periods are below ``size``, so only a few
        runs that start last before it can hold it.
        """
        held = np.zeros(len(at), bool)
        if len(self.starts):
            last = np.searchsorted(self.starts, at, "right") - 1
            for back in range(4):
                k = np.maximum(last - back, 0)
                held |= (last >= back) & (self.ends[k] >= at + lag + size) & (lag % self.periods[k] == 0)
        return held


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """``start``, ``length`` and least ``period`` of every run, by start and period."""
    found = []
    for a, b in segments(ids):
        found += [(a + s, e - s, q) for (s, e), q in _scan(ids[a:b]).items()]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _scan(x: np.ndarray) -> dict[tuple[int, int], int]:
    n = len(x)
    known = _Known()
    b, names = 1, x
    while LEAST_REPEATS * b <= n:
        known.freeze()
        anchors = np.arange(0, len(names) - b, b)
        # A batch of anchors with all the octave's lags at a time.
        step = max(1, (1 << 20) // b)
        for k in range(0, len(anchors), step):
            at = anchors[k : k + step, None]
            later = at + np.arange(b, 2 * b)
            same = names[np.minimum(later, len(names) - 1)] == names[at]
            same &= later < len(names)
            which, lag = np.nonzero(same)
            at, lag = at[which, 0], lag + b
            open_ones = ~known.cover(at, lag, b)
            _follow(x, at[open_ones].tolist(), lag[open_ones].tolist(), known)
        # Numbers of runs of 2 * b words, from those of b words.
        if len(names) > b:
            both = names[:-b] * (int(names.max()) + 1) + names[b:]
            names = np.unique(both, return_inverse=True)[1]
        b *= 2
    return known.period


def _follow(x: np.ndarray, at: list[int], lag: list[int], known: _Known) -> None:
    ends: dict[int, int] = {}  # lag -> end of the stretch last followed, without the later words
    for k, q in zip(at, lag):
        if k < ends.get(q, 0):
            continue
        start, end = _reach(x, k, q)
        ends[q] = end - q
        if end - start >= max(LEAST_LENGTH, LEAST_REPEATS * q):
            # Of lags with one and the same stretch the least is its period.
            known.period[start, end] = min(q, known.period.get((start, end), q))


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact ratio of length to period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(document: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left when each run keeps its first period only, joined by one space."""
    if not runs:
        return b" ".join(document)
    gone = np.zeros(len(document) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return b" ".join([document[k] for k in np.flatnonzero(keep).tolist()])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``runs`` (array of ``start``, ``length``, ``period``), ``greatest`` (a struct
    of the same, null without runs) and ``collapsed``, the text that keeps the first period of each run."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, all_runs, best, left = [], [], [], []
        for text in batch.column("text").to_pylist():
            document = words(text)
            runs = runs_of(_numbered(document))
            n_words.append(len(document))
            all_runs.append([dict(zip(("start", "length", "period"), r)) for r in runs])
            top = greatest(runs)
            best.append(dict(zip(("start", "length", "period"), top)) if top else None)
            left.append(collapsed(document, runs).decode())
        columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(all_runs, _RUNS)]
        columns += [pa.array(best, _RUNS.value_type), pa.array(left, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "greatest", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    one = "struct<start:bigint,length:bigint,period:bigint>"
    return map_batches(docs, run, f"doc_id {kind}, n_words bigint, runs array<{one}>, greatest {one}, collapsed string")


def repeat_tail(docs: DataFrame, seed, *, doc_id: str = "doc_id", text: str = "text", every: int = 10) -> DataFrame:
    """``doc_id`` and ``text`` with planted runs: where ``seed`` (a whole number of the row) is divisible by ``every``,
    a part of the words from some place on is repeated to the end.

    With ``g`` the seed divided by ``every``, the place is ``g % n`` and the part ``1 + (n - place) / (3 + g % 8)`` words.
    Other texts stay as they are; a null seed plants nothing.
    """
    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), seed.cast("long").alias("seed"))
    split = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    df = df.select("doc_id", "text", F.expr(f"seed div {every}").alias("g"), F.when(F.col("seed") % every == 0, split).alias("words"))
    n = F.when(F.size("words") > 0, F.size("words"))  # null for all others, which makes their tail null
    df = df.select("doc_id", "text", "g", "words", n.alias("n"), (F.col("g") % n).cast("int").alias("at"))
    df = df.select("*", (F.col("n") - F.col("at")).alias("rest"))
    df = df.select("*", F.expr("1 + rest div (3 + g % 8)").cast("int").alias("part"))
    part = F.slice("words", F.col("at") + 1, F.col("part"))
    times = F.ceil(F.col("rest") / F.col("part")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(part, times)), F.lit(1), F.col("rest"))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("at")), tail), " ")
    return df.select("doc_id", F.coalesce(changed, F.col("text")).alias("text"))
