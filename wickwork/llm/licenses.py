"""Licence scans: a generalised suffix automaton over the words of licence texts.

The automaton holds every run of words of every template and phrase. Each document's words
go through it once, which gives the matching statistics: for every position the longest run
ending there that stands in some template. Phrases are read off where they are a suffix of
that run. Maximal runs of at least ``least`` words (or of a whole shorter template) are then
chained per template, in the order of both texts, and a chain that covers at least ``cover``
of the template's words is a span.

The automaton depends on the templates alone; it is built once in each Python worker.
Documents are neither shuffled nor cut.

Defined cases: a null or empty text has no words and nothing in it. Of chains over the same
place each template reports its own; ties go to the earliest. Repeated documents give the
same rows each. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wickwork.llm.common import lower_words, map_batches
from wickwork.llm.suffix import SuffixAutomaton


@dataclass(frozen=True)
class Template:
    label: str
    text: str


# Phrases, each found wherever its words stand one after another.
PHRASES = (
    Template("gpl", "GNU General Public License"),
    Template("apache", "Apache License"),
    Template("cc-by", "CC BY"),
    Template("mit", "MIT License"),
)

# Notices as they commonly stand in files.
TEMPLATES = (
    Template("all-rights-reserved", "All rights reserved"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    Template("mit-notice", "Released under the MIT License"),
    Template("cc-by-4.0", "Licensed under CC BY 4.0"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    Template(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version.",
    ),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
    ),
)


class Automaton(SuffixAutomaton):
    """The automaton with the places where each state's runs end."""

    def __init__(self, sequences: list[list[bytes]]):
        super().__init__()
        self.ends = [self.add(s) for s in sequences]
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.link]  # (sequence, words up to its end)
        for k, states in enumerate(self.ends):
            for i, v in enumerate(states):
                self.places[v].append((k, i + 1))
        for v in sorted(range(1, len(self.link)), key=lambda v: -self.length[v]):
            if self.link[v] > 0:
                self.places[self.link[v]] += self.places[v]


class Scanner:
    def __init__(self, phrases, templates, least: int, cover: float):
        self.phrases, self.templates, self.least, self.cover = phrases, templates, least, cover
        sequences = [lower_words(t.text) for t in (*templates, *phrases)]
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton(sequences)
        # Of each state: the phrases that are a suffix of its runs, with their lengths.
        self.ending: list[list[tuple[int, int]]] = [[] for _ in self.automaton.link]
        for k in range(len(phrases)):
            states = self.automaton.ends[len(templates) + k]
            if states:
                self.ending[states[-1]].append((k, len(states)))
        for v in sorted(range(1, len(self.ending)), key=lambda v: self.automaton.length[v]):
            self.ending[v] += self.ending[self.automaton.link[v]]

    def scan(self, document: list[bytes]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, float]]]:
        """Phrases as (first, last, label), spans as (first, last, label, covered share); words, ends exclusive."""
        following, link, length, ending = self.automaton.next, self.automaton.link, self.automaton.length, self.ending
        root = following[0].get
        v = n = 0
        found, runs = [], []
        for i, word in enumerate(document):
            if not v:
                v = root(word, 0)
                n = 1 if v else 0
                continue
            t = following[v].get(word)
            if t is None:
                runs.append((i, n, v))
                while t is None and v:
                    v = link[v]
                    t = following[v].get(word)
                n = length[v]
                if t is None:
                    n = 0
                    continue
            v = t
            n += 1
            for k, size in ending[v]:
                if size <= n:
                    found.append((i + 1 - size, i + 1, self.phrases[k].label))
        if v:
            runs.append((len(document), n, v))
        return found, self._spans(runs)

    def _spans(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
        """Chain the maximal runs of each template."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for end, n, v in runs:
            for k, place in self.automaton.places[v]:
                if k < len(self.templates) and n >= min(self.least, self.sizes[k]):
                    by_template.setdefault(k, []).append((end, place, n))
        spans = []
        for k, pieces in by_template.items():
            size = self.sizes[k]
            best: list[tuple[int, int]] = []  # covered words, first document word
            for i, (end, place, n) in enumerate(pieces):
                choice = (n, end - n)
                for j in range(i - 1, -1, -1):
                    before, there, _ = pieces[j]
                    if end - n - before > size:
                        break
                    new = min(n, end - before, place - there)
                    if new > 0 and best[j][0] + new > choice[0]:
                        choice = (best[j][0] + new, best[j][1])
                best.append(choice)
            taken: list[tuple[int, int]] = []  # apart and in order, so only neighbours can be met
            for i in sorted(range(len(pieces)), key=lambda i: (-best[i][0], pieces[i][0])):
                covered, first = best[i]
                if covered < self.cover * size:
                    break
                at = bisect_left(taken, (first, 0))
                if (at == len(taken) or pieces[i][0] <= taken[at][0]) and (not at or first >= taken[at - 1][1]):
                    taken.insert(at, (first, pieces[i][0]))
                    spans.append((first, pieces[i][0], self.templates[k].label, covered / size))
        return sorted(spans)


_built: dict[tuple, Scanner] = {}


def _scanner(*key) -> Scanner:
    if key not in _built:
        _built.clear()
        _built[key] = Scanner(*key)
    return _built[key]


_FOUND = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("label", pa.string())]))
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("label", pa.string()), ("covered", pa.float64())]))


def find_licenses(
    docs: DataFrame,
    phrases: tuple[Template, ...] = PHRASES,
    templates: tuple[Template, ...] = TEMPLATES,
    *,
    least: int = 4,
    cover: float = 0.7,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``phrases`` and ``spans`` (word ranges, ends exclusive)."""

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = _scanner(phrases, templates, least, cover)
        n_words, found, spans = [], [], []
        for t in batch.column("text").to_pylist():
            document = lower_words(t)
            places, chains = scanner.scan(document)
            n_words.append(len(document))
            found.append([{"first": a, "last": b, "label": x} for a, b, x in places])
            spans.append([{"first": a, "last": b, "label": x, "covered": c} for a, b, x, c in chains])
        columns = {"doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64())}
        return pa.RecordBatch.from_pydict(columns | {"phrases": pa.array(found, _FOUND), "spans": pa.array(spans, _SPANS)})

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint,"
        " phrases array<struct<first:int,last:int,label:string>>,"
        " spans array<struct<first:int,last:int,label:string,covered:double>>"
    )
    return map_batches(docs, scan, schema)
