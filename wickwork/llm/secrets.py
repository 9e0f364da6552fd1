"""Secret scans: all rules in one minimal deterministic automaton, one pass over the bytes.

The rules' regular expressions are reversed, joined and compiled by subset construction and
minimisation into one transition array. Reading a text once from its end, the array tells for
every byte which rules have a match that begins there. From those places, in order, a small
forward automaton of the rule gives the longest match; a place inside the previous match of
the same rule is passed over. Only a text in which the pass found anything is read again, to
note the places. So each rule's matches are leftmost, longest and do not overlap,
and text without secrets costs one array look-up a byte, however many rules there are.

The array depends on the rules alone, not on the data; it is compiled on the driver and
broadcast. Documents are neither shuffled nor cut.

Defined cases: a null or empty text has no spans. Equal spans of different rules are all kept,
in the order of the rules. Repeated documents give the same spans each. Only ``doc_id`` and
``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import getitem

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wickwork.llm.automaton import Machine, Syntax, any_case, compile_patterns
from wickwork.llm.common import map_batches


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a match; of it, what follows the longest ``head`` has to have ``least`` bytes.

    Letters of ``head`` stand for either case when ``any_case`` is set. Matches that are too
    short are dropped after they were found, so they still hide what lies inside them. A
    length stated here costs no states; one stated in the pattern counts in the automaton.
    """

    name: str
    pattern: str
    head: str = ""
    least: int = 0
    any_case: bool = False

    def nodes(self):
        head = Syntax(self.head).read()
        if self.any_case:
            head = any_case(head)
        return head, ("seq", [head, Syntax(self.pattern).read()])


# The rules, the three base kinds first.
RULES = (
    Rule("assign", "[A-Za-z0-9+/_.=-]+", head="(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?", least=6, any_case=True),
    Rule("access", "[A-Z0-9]+", head="AKIA", least=16),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("private_key", "-----BEGIN ([A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", "[A-Za-z0-9]+", head="gh[oprsu]_", least=36),
    Rule("slack", "[A-Za-z0-9-]+", head="xox[abprs]-", least=10),
    Rule("google", "[A-Za-z0-9_-]+", head="AIza", least=35),
)
BASE = ("assign", "access", "hex")

_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        nodes = [r.nodes() for r in rules]
        self.begins = compile_patterns([whole for _, whole in nodes], search=True, backwards=True)
        self.first: list | None = None  # of the array's rows; made by each worker
        self.whole = [compile_patterns([whole], search=False, backwards=False) for _, whole in nodes]
        self.heads = [compile_patterns([head], search=False, backwards=False) if r.head else None for r, (head, _) in zip(rules, nodes)]

    def starts(self, data: bytes) -> list[tuple[int, int]]:
        """(byte offset, state) of every place where a rule's match begins, last first."""
        machine = self.begins
        if self.first is None:
            self.first = machine.rows()
        columns = data[::-1].translate(machine.classes)
        if not reduce(getitem, columns, self.first)[-1]:
            return []
        table, accepting, state = machine.table, machine.accepting, machine.start
        found = []
        for i, c in enumerate(columns):
            state = table[state + c]
            if state >= accepting:
                found.append((i, state))
        last = len(data) - 1
        return [(last - i, state) for i, state in found]

    def scan(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start and rule; code points, end exclusive."""
        if not text:
            return []
        data = text.encode()
        ends = [0] * len(self.rules)
        found = []
        for at, state in reversed(self.starts(data)):
            for k in self.begins.accepts[state // self.begins.width]:
                if at >= ends[k]:
                    ends[k] = longest(self.whole[k], data, at)
                    value = longest(self.heads[k], data, at) if self.heads[k] else at
                    if ends[k] - value >= self.rules[k].least:
                        found.append((at, k, ends[k]))
        found.sort()
        if len(data) == len(text):
            return [(self.rules[k].name, a, b) for a, k, b in found]
        points = {}
        place = point = 0
        for byte in sorted({x for a, _, b in found for x in (a, b)}):
            point += len(data[place:byte].decode())
            place = byte
            points[byte] = point
        return [(self.rules[k].name, points[a], points[b]) for a, k, b in found]


def longest(machine: Machine, data: bytes, at: int) -> int:
    """Where the longest match from ``at`` ends."""
    table, state, end = machine.table, machine.start, at
    for i in range(at, len(data)):
        state = table[state + machine.classes[data[i]]]
        if state >= machine.accepting:
            end = i + 1
        elif not state:
            break
    return end


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id`` and ``spans``, sorted by start and rule."""
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(rules))

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        find = scanner.value.scan
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "spans": pa.array(spans, _SPANS)})

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(docs, scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPAN_TYPE}")


def mask(text: str, spans: list[tuple[str, int, int]], put: str = "[REDACTED]") -> str:
    """``text`` with each run of overlapping spans replaced."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], put]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The documents with their secrets masked; every column stays, ``n_chars`` follows the new text."""
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(rules))
    put = docs.columns.index(text)

    def change(batch: pa.RecordBatch) -> pa.RecordBatch:
        find = scanner.value.scan
        old = batch.column(put).to_pylist()
        new = [mask(t, spans) if (spans := find(t)) else t for t in old]
        return batch.set_column(put, batch.schema.field(put), pa.array(new, batch.schema.field(put).type))

    changed = map_batches(docs, change, docs.schema)
    if n_chars and n_chars in docs.columns:
        changed = changed.withColumn(n_chars, F.char_length(text).cast(docs.schema[n_chars].dataType))
    return changed
