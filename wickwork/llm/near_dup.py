"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its word shingles. Sets that are equal are one *class* from the start.
Each class has ``COORDINATES`` minwise hashes. A path token is ``TOKEN`` of them together, so
sets of similarity s share one with probability s ** TOKEN.

``TREES`` independent trees branch all classes: at a node, two tokens are selected by a hash of
the node, and a class goes to one child for each of them, named by its values. Below the first
level ``CHILDREN`` tokens are selected, twice as many as the about 1 / 0.8 ** TOKEN that would keep a pair at
the threshold meeting in expectation, so that its chance hardly falls however deep the tree grows.

What a node does:

- At most ``SMALL`` classes: all pairs that may be similar are tested.
- Otherwise each class is tested with the node's first one. Then nodes whose classes are all connected, through any
  node of any tree, have nothing to add and end. So a group of thousands of near copies
  costs as much as its links to a few first classes.
- Of the nodes that are left, those of at most ``MIDDLE`` classes and ``WEIGHT`` shingles are compared
  exhaustively within their task. Classes that may be similar to one of another component bring their whole sets
  there, and what leaves the task are only links that join two components: a spanning forest, fewer rows
  than the node has classes. Pairs that fail the test are never written.
- Larger ones branch on. Those left after ``LEVELS`` levels, and lighter ones of too many shingles, are compared in
  blocks, each two blocks for themselves, so no task holds a whole one. The comparisons inside tasks still grow with
  the square of such a node: it is a group of copies just under the threshold, whose pairs further branching
  hardly lessens (four children of a group of similarity s have 4 * s ** 6 of them).

Pairs are sifted by a 128-bit sketch (two bits of each of 64 minwise hashes; a pair at the threshold is
lost with a chance under one in a million) and by size; the rest is confirmed on the full sets,
computed anew from the texts, once for all the nodes that want a class. Similarity is exact: ``100 * intersection >=
percent * union``. A pair at the threshold that does not meet in a tree does so in another: with ten trees one
pair in 10 ** 6 is missed at the first level, one in 80,000 at the second and one in 8,000 at the
ninth; pairs above it far less.

Levels, links and components stay distributed. What is broadcast, the ids of classes whose
texts are needed, is checked to be few megabytes; beyond that the texts are joined
by a shuffle. A class tested with very many others is copied to as many groups as hold ``GROUP`` of them each.

Defined cases: a null text, or one without words, has an empty set and links to nothing. A text
of fewer words than a shingle is one shingle. Documents without an id take part; a component
is named by its least id, and by none if it has none. Repeated documents are one class. Of the
documents only ``doc_id`` and ``text`` are read, so other columns cannot clash. Shingles and
classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wickwork.llm import common
from wickwork.llm.common import cut, map_batches, map_in_arrow, register_cache, release_caches, slices, within_broadcast
from wickwork.llm.graph import components

TREES = 10
TOKEN = 3
CHILDREN = 4
COORDINATES = 128
SMALL = 16
MIDDLE = 2048
WEIGHT = 1 << 21
LEVELS = 4
GROUP = 1024
_BLOCK = 128
_OUT_BYTES = 4 * 1024 * 1024  # shingles given to Spark at a time
_TESTED = 64  # sets held against one at a time
# Of 128 sketch bits, 64 * (1 - s) differ on average; five standard deviations more are let pass at s = 0.8.
SKETCH_BITS = 34

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
_random = np.random.Generator(np.random.PCG64(20240229))
_XOR = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)[:, None]
_TIMES = (_random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


class _WordHashes(dict):
    """64-bit hashes of words seen; emptied when it has grown to its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()
register_cache(__name__, _hashes.clear)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles: runs of ``size`` words, A-Z lower-cased."""
    words = text.encode().lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    take = min(size, n)
    acc = np.full(n - take + 1, np.uint64(take), np.uint64)
    for k in range(take):
        acc = (acc ^ h[k : n - take + 1 + k]) * _MIX
        acc ^= acc >> np.uint64(29)
    return np.unique(acc * _MIX_2)


def minwise(x: np.ndarray) -> np.ndarray:
    """``COORDINATES`` minwise hashes of a set, as 32-bit numbers."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(x), 2048):
        np.minimum(least, ((x[None, k : k + 2048] ^ _XOR) * _TIMES).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _bits(values: np.ndarray, bit: int) -> int:
    ones = (values[:64] >> np.uint32(bit)) & np.uint32(1)
    return int(np.packbits(ones.astype(np.uint8)).view(">i8")[0])


def describe(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``n``, ``id`` (the class; null for an empty set), sketch ``s1``, ``s2`` and ``mins``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, n, s1, s2, mins = [], [], [], [], []
        for text in batch.column("text").to_pylist():
            x = shingles(text, size)
            n.append(len(x))
            if len(x):
                m = minwise(x)
                ids.append(np.int64(xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63)))
                s1.append(_bits(m, 0))
                s2.append(_bits(m, 1))
                mins.append(m.view(np.int32))
            else:
                for column in (ids, s1, s2, mins):
                    column.append(None)
        columns = {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "n": pa.array(n, pa.int64())}
        columns |= {name: pa.array(v, pa.int64()) for name, v in (("id", ids), ("s1", s1), ("s2", s2))}
        return pa.RecordBatch.from_pydict(columns | {"mins": pa.array(mins, pa.list_(pa.int32()))})

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key bigint, n bigint, id bigint, s1 bigint, s2 bigint, mins array<int>"
    return map_batches(docs.select("doc_id", "text_key", "text"), run, schema)


def _roots() -> Column:
    """The first level's nodes of a class: two tokens a tree, on coordinates of their own."""
    nodes = []
    for tree in range(TREES):
        for branch in range(2):
            first = (2 * tree + branch) * TOKEN
            nodes.append(F.xxhash64(F.lit(tree), F.lit(branch), *[F.get("mins", F.lit(first + k)) for k in range(TOKEN)]))
    return F.array(*nodes)


def _children() -> Column:
    """The children of ``node`` to which a class goes: coordinates selected by a hash of the node."""
    picked = [[F.pmod(F.xxhash64("node", F.lit(b), F.lit(k)), F.lit(COORDINATES)).cast("int") for k in range(TOKEN)] for b in range(CHILDREN)]
    return F.array(*[F.xxhash64("node", F.lit(b), *[F.get("mins", c) for c in picked[b]]) for b in range(CHILDREN)])


def _alike(a, b, percent: int) -> Column:
    """Whether two classes may be similar: sketch and size."""
    differ = F.bit_count(a("s1").bitwiseXOR(b("s1"))) + F.bit_count(a("s2").bitwiseXOR(b("s2")))
    return (differ <= SKETCH_BITS) & (100 * F.least(a("n"), b("n")) >= percent * F.greatest(a("n"), b("n")))


_MEMBER = ("id", "n", "s1", "s2", "comp")


def _member() -> Column:
    return F.struct(*_MEMBER)


def _level(rows: DataFrame) -> DataFrame:
    """Rows of nodes with classes not yet connected, with the node's ``size``, ``weight`` in shingles and ``first`` member."""
    sizes = rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum("n").alias("weight"),
        F.min(_member()).alias("first"),
        F.min("comp").alias("lo"),
        F.max("comp").alias("hi"),
    )
    return rows.join(sizes.where("lo <> hi").drop("lo", "hi"), "node")


def _sieved(nodes: DataFrame, percent: int, pairs: bool) -> DataFrame:
    """What may be similar in a node of bounded size, of different components: the ``pairs`` ``a`` < ``b``, or the ``node`` and ``id`` of
    all classes that are in such a pair.

    A node's members are compared as arrays, a block of members with all at a time; a pair found
    in several nodes of a batch is given once.
    """
    members = nodes.groupBy("node").agg(F.collect_list(_member()).alias("members")).select("node", "members")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("members")
        ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
        fields = dict(zip(_MEMBER, (c.to_numpy() for c in lists.flatten().flatten())))
        found = [np.empty((0, 2), np.int64)]
        for node, first, last in zip(batch.column("node").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
            ids, n, s1, s2, comp = (fields[c][first:last] for c in _MEMBER)
            flagged = np.zeros(last - first, bool)
            for k in range(0, last - first, _BLOCK):
                part = slice(k, k + _BLOCK)
                differ = np.bitwise_count((s1[part, None] ^ s1).view(np.uint64)).astype(np.int16)
                differ += np.bitwise_count((s2[part, None] ^ s2).view(np.uint64))
                sizes = 100 * np.minimum(n[part, None], n) >= percent * np.maximum(n[part, None], n)
                fits = (differ <= SKETCH_BITS) & sizes & (comp[part, None] != comp)
                if pairs:
                    x, y = np.nonzero(fits & (ids[part, None] < ids))
                    found.append(np.stack([ids[k + x], ids[y]], axis=1))
                else:
                    flagged[part] = fits.any(axis=1)
            if flagged.any():
                found.append(np.stack([np.full(int(flagged.sum()), node), ids[flagged]], axis=1))
        rows = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(rows[:, k].copy()) for k in range(2)], names)

    names = ["a", "b"] if pairs else ["node", "id"]
    return map_batches(members, run, ", ".join(f"{c} bigint" for c in names))


def _to_first(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of a node's first member and others of different components that may be similar."""
    pairs = nodes.where(F.col("comp") != F.col("first.comp")).where(_alike(lambda c: F.col(c), lambda c: F.col(f"first.{c}"), percent))
    return pairs.select(F.col("first.id").alias("a"), F.col("id").alias("b"))


def _starred(pairs: DataFrame) -> DataFrame:
    """Pairs as groups of a hub and at most about ``GROUP`` classes: ``node``, ``id``, ``hub``."""
    pairs = pairs.distinct()
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))
    dealt = cut(pairs.join(parts, "a").select("a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), "parts")).alias("node")))
    hubs = dealt.select("node", F.col("a").alias("id"), F.lit(True).alias("hub")).distinct()
    return hubs.unionByName(dealt.select("node", F.col("b").alias("id"), F.lit(False).alias("hub")))


def _common(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others, none of them empty."""
    joined = np.concatenate(others)
    at = np.searchsorted(x, joined)
    at[at == len(x)] = 0
    starts = np.cumsum([0, *[len(y) for y in others[:-1]]])
    return np.add.reduceat(x[at] == joined, starts, dtype=np.int64)


class _Group:
    """The classes of a node that have come to its task."""

    def __init__(self):
        self.rows: list[tuple[int, int, int, int, bool]] = []  # id, s1, s2, comp, hub
        self.sets: list[np.ndarray] = []

    def links(self, percent: int) -> list[tuple[int, int]]:
        """Pairs of similar sets, each of which joins two components. With a hub, only pairs with it are tested."""
        m = len(self.rows)
        ids, s1, s2, root, hub = (np.array(c) for c in zip(*self.rows))
        n = np.array([len(x) for x in self.sets])
        found = []
        for i in np.flatnonzero(hub).tolist() or range(m - 1):
            later = np.arange(m) if hub.any() else np.arange(i + 1, m)
            differ = np.bitwise_count((s1[later] ^ s1[i]).view(np.uint64)).astype(np.int16)
            differ += np.bitwise_count((s2[later] ^ s2[i]).view(np.uint64))
            sizes = 100 * np.minimum(n[later], n[i]) >= percent * np.maximum(n[later], n[i])
            later = later[(differ <= SKETCH_BITS) & sizes & (root[later] != root[i])]
            while len(later):
                some, later = later[:_TESTED], later[_TESTED:]
                common = _common(self.sets[i], [self.sets[j] for j in some])
                alike = some[100 * common >= percent * (n[i] + n[some] - common)]
                if len(alike):
                    joined, where = np.unique(root[alike], return_index=True)
                    found += [(int(ids[i]), int(ids[alike[k]])) for k in where]
                    root[np.isin(root, joined)] = root[i]
                    later = later[root[later] != root[i]]
        return found


def _confirmed(groups: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` inside groups (``node``, ``id``, ``comp``, ``hub``), confirmed on the full sets.

    Texts are read for the classes in question only, each one's set is made once and sent to all its groups.
    """
    wanted = groups.groupBy("id").agg(F.first("comp").alias("comp"), F.collect_list(F.struct("node", "hub")).alias("groups"))
    wanted = cut(wanted.join(classes.select("id", "s1", "s2", "doc"), "id").select("id", "s1", "s2", "comp", "groups", "doc.*"))
    places = wanted.agg(F.count(F.lit(1)), F.sum(F.size("groups"))).first()
    keys = wanted.withColumnsRenamed({"doc_id": "__doc", "text_key": "__key"})
    if 64 * places[0] + 16 * (places[1] or 0) <= common.BROADCAST_BYTES:
        keys = F.broadcast(keys)
    same = docs["doc_id"].eqNullSafe(keys["__doc"]) & (docs["text_key"] == keys["__key"])
    # Rows that repeat an id and text are one.
    texts = docs.join(keys, same).select("id", "s1", "s2", "comp", "groups", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches(but=__name__)
        for batch in slices(batches):
            ids = batch.select(["id", "s1", "s2", "comp"])
            rows: list[tuple[int, int, bool, bytes]] = []
            held = 0

            def out() -> pa.RecordBatch:
                at, nodes, hubs, made = (list(c) for c in zip(*rows))
                arrays = [pa.array(nodes, pa.int64()), pa.array(hubs, pa.bool_()), *ids.take(pa.array(at, pa.int64())).columns]
                names = ["node", "hub", "id", "s1", "s2", "comp", "shingles"]
                return pa.RecordBatch.from_arrays([*arrays, pa.array(made, pa.binary())], names)

            for k, (text, groups) in enumerate(zip(batch.column("text").to_pylist(), batch.column("groups").to_pylist())):
                made = shingles(text, size).tobytes()
                for g in groups:
                    rows.append((k, g["node"], g["hub"], made))
                    held += len(made)
                    if held >= _OUT_BYTES:
                        yield out()
                        rows.clear()
                        held = 0
            if rows:
                yield out()

    rows = map_in_arrow(texts, sets, "node bigint, hub boolean, id bigint, s1 bigint, s2 bigint, comp bigint, shingles binary")
    rows = rows.repartition("node").sortWithinPartitions("node", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches(but=__name__)
        node, group = None, _Group()

        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], ["a", "b"])

        for batch in batches:
            nodes = batch.column("node").to_numpy()
            columns = [batch.column(c).to_pylist() for c in ("id", "s1", "s2", "comp", "hub")]
            made = batch.column("shingles")
            for k, row in enumerate(zip(*columns)):
                if nodes[k] != node:
                    if len(group.rows) > 1:
                        yield out(group.links(percent))
                    node, group = nodes[k], _Group()
                if not group.rows or group.rows[-1][0] != row[0]:
                    group.rows.append(row)
                    group.sets.append(np.frombuffer(made[k].as_py(), np.uint64))
        if len(group.rows) > 1:
            yield out(group.links(percent))

    return map_in_arrow(rows, run, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, *, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: ``doc_id``, ``text_key``, ``n_shingles``, ``component_id`` (the least id reachable over
    links) and ``component``, which names the component even if it has no ids (null: an empty set)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    described = cut(describe(docs, shingle))
    classes = cut(
        described.where("id is not null")
        .groupBy("id")
        .agg(
            F.min(F.struct("doc_id", "text_key")).alias("doc"),
            F.min("doc_id").alias("least"),
            *[F.first(c).alias(c) for c in ("n", "s1", "s2", "mins")],
        )
    )
    links = _Links(classes, docs, shingle, percent)
    rows = classes.select(F.explode(_roots()).alias("node"), "id", "n", "s1", "s2", F.col("id").alias("comp"))
    for level in range(LEVELS + 1):
        nodes = cut(_level(rows))
        if not nodes.take(1):
            break
        small, larger = nodes.where(F.col("size") <= SMALL), nodes.where(F.col("size") > SMALL)
        links.confirm(_starred(_sieved(small, percent, True).union(_to_first(larger, percent))))
        mixed = cut(_level(links.relabel(larger.select("node", *_MEMBER))))
        if not mixed.take(1):
            break
        larger = F.col("size") > MIDDLE
        ended = mixed if level == LEVELS else mixed.where(~larger)
        flagged = cut(_sieved(_blocks(ended), percent, False))
        links.confirm(flagged.withColumn("hub", F.lit(False)))
        large = mixed.where(larger)
        if level == LEVELS or not large.take(1):
            break
        large = large.select("node", "id").join(classes.select("id", "n", "s1", "s2", "mins"), "id")
        rows = links.relabel(large.select(F.explode(_children()).alias("node"), "id", "n", "s1", "s2"))
    return _results(described, links.relabel(classes.select("id", "least")))


class _Links:
    """The components made by the links confirmed so far."""

    def __init__(self, classes: DataFrame, docs: DataFrame, size: int, percent: int):
        self.classes, self.docs, self.size, self.percent = classes, docs, size, percent
        self.labels: DataFrame | None = None  # class -> least class of its component, for classes that are not the least

    def confirm(self, groups: DataFrame) -> None:
        """Test the pairs inside ``groups`` (``node``, ``id``, ``hub``)."""
        if not groups.take(1):
            return
        links = cut(_confirmed(self.relabel(groups), self.classes, self.docs, self.size, self.percent))
        if links.take(1):
            self.labels = components(links if self.labels is None else links.union(self.labels))

    def relabel(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component of their class as ``comp``."""
        rows = rows.drop("comp")
        if self.labels is None:
            return rows.withColumn("comp", F.col("id"))
        found = self.labels.select(F.col("a").alias("id"), F.col("b").alias("found"))
        return rows.join(found, "id", "left").withColumn("comp", F.coalesce("found", "id")).drop("found")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes above ``MIDDLE`` classes or ``WEIGHT`` shingles as nodes of two blocks of members each, so that every two members meet in
    one; others as they are."""
    parts = F.greatest(F.ceil(F.col("size") / max(1, MIDDLE // 2)), F.ceil(F.col("weight") / max(1, WEIGHT // 2)))
    parts = F.when((F.col("size") <= MIDDLE) & (F.col("weight") <= WEIGHT), F.lit(1)).otherwise(F.least(parts, F.col("size")))
    nodes = nodes.withColumn("blocks", parts).withColumn("block", F.pmod(F.xxhash64("node", "id"), "blocks"))
    nodes = nodes.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other"))
    return nodes.withColumn("node", F.when(F.col("blocks") == 1, F.col("node")).otherwise(pair)).select("node", *_MEMBER)


def _results(described: DataFrame, named: DataFrame) -> DataFrame:
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = named.join(least, "comp").select("id", "comp", "component_id")
    return described.join(named, "id", "left").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("comp").alias("component"),
    )


def drop_near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all their columns, one of each component: that with the least id.

    Among rows without an id, or with the same one, the least hash of the text decides, and of
    rows equal in both any one stays. Texts with an empty set all stay. What is joined to the
    documents are the ids that go, and those of repeated rows.
    """
    found = cut(near_duplicates(docs, shingle=shingle, percent=percent, doc_id=doc_id, text=text).where("component is not null"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("text_key").alias("text_key"))
    kept = found.groupBy("component").agg(F.min(order).alias("kept"))
    gone = found.join(kept, "component").where(order != F.col("kept")).select("doc_id", "text_key").distinct()
    left = _matched(docs, gone, doc_id, text, "left_anti")
    repeated = found.groupBy("doc_id", "text_key").count().where("count > 1")
    if repeated.take(1):
        once = _matched(left, repeated, doc_id, text, "left_semi").dropDuplicates([doc_id, text])
        left = _matched(left, repeated, doc_id, text, "left_anti").union(once)
    return left


def _matched(docs: DataFrame, rows: DataFrame, doc_id: str, text: str, how: str) -> DataFrame:
    """The documents whose id and text are among ``rows`` (``doc_id``, ``text_key``), or are not."""
    rows = within_broadcast(cut(rows.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))))
    return docs.join(rows, docs[doc_id].eqNullSafe(rows["__id"]) & (F.xxhash64(docs[text]) == rows["__key"]), how)
