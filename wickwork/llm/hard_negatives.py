"""Hard negatives by an inverted multi-index with certified stops.

For an anchor, its *positives* are the rows of its label with the highest scores (inner products). For each positive
the *window* holds scores from ``low`` to ``high`` hundredths of the positive's; its hard negatives are the highest rows
of other labels in the window.

1. Vectors are cut in two halves. A codebook of each half is fitted on a sample of at most ``SAMPLE`` rows (and ``SAMPLE_VALUES`` numbers); all rows
   are then put into the cell of their two nearest codewords. Each codeword keeps its *radius*, the distance of its
   farthest half over all rows, so that a half of it scores at most its codeword's score plus the
   radius times the length of the anchor's half.
2. Per anchor, a multi-sequence heap gives the cells in order of the sum of the two half bounds. It takes a
   codeword of each half next to one taken before, so no list of all cells is sorted.
3. In a round, an anchor asks for its next cells until they hold ``ROUND_ROWS`` rows, four times as many in each further
   round. Asked cells are scored in blocks of at most about ``BLOCK_ROWS`` rows with ``BLOCK_ANCHORS`` anchors, as a matrix
   product; a block gives the few rows that can still enter an anchor's lists. The lists are merged by
   Spark. A cell with any number of rows, or asked for by any number of anchors, is many blocks.
4. An anchor is done when its lists are *certified*: the bound of the next cell lies below the last row of every
   full list, or below the window. First so for positives, then, their windows known, for negatives.

The result is that of comparing all pairs. How many cells are visited depends on the data: vectors without
clusters in many dimensions have bounds so wide that nearly all cells are.

What reaches the driver are the sample and the directory, one count a cell: at most ``MOST_CODES ** 2`` of them.
What a round asks for grows with the anchors; it is never collected.

Defined cases: rows with a null id, label or vector, with a null or non-finite component, or one beyond ``LARGEST`` take no
part. Shorter vectors are filled up with zeros to the longest. Rows equal in id, label and vector are one. Rows of
one id that differ are rows of their own, and a row is not a positive of itself only. An anchor without other
rows of its label gives nothing; an empty table gives no rows. Equal scores are ordered by id, and then by a hash.
Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wickwork.llm.common import cut, map_in_arrow

SAMPLE, SAMPLE_VALUES = 16_384, 1 << 22
ROWS_PER_CELL = 1024
LEAST_CODES, MOST_CODES = 4, 256
ROUND_ROWS = 4096
BLOCK_ROWS = 2048
BLOCK_ANCHORS = 1024
LARGEST = float(1 << 26)
_FIT_ROUNDS = 12


def _fit(halves: np.ndarray, codes: int) -> np.ndarray:
    """Codewords of the sample's halves by Lloyd's rounds from evenly spaced rows."""
    if not len(halves):
        return np.zeros((codes, halves.shape[1]))
    words = halves[np.linspace(0, len(halves) - 1, codes).astype(int)].copy()
    for _ in range(_FIT_ROUNDS):
        nearest = _nearest(halves, words)
        counts = np.bincount(nearest, minlength=codes)
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, halves)
        words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], words)
    return words


def _nearest(halves: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(axis=1) - 2 * (halves @ words.T), axis=1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix, filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return flat.reshape(len(column), dims).astype(np.float64)
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


class Codebooks:
    """Two half-space codebooks, and what is known of the rows in their cells."""

    def __init__(self, sample: np.ndarray, codes: int):
        self.dims, self.codes = sample.shape[1], codes
        self.cut = self.dims // 2
        self.words = [_fit(h, codes) for h in self.halves(sample)]
        self.radius = [np.zeros(codes), np.zeros(codes)]
        self.rows = np.zeros((codes, codes), np.int64)

    def halves(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors[:, : self.cut], vectors[:, self.cut :]]

    def bounds(self, anchor: np.ndarray) -> list[np.ndarray]:
        """Per half, the most that a row of each codeword can add to the score. Rounding is paid for by a small surplus."""
        out = []
        for half, words, radius in zip(self.halves(anchor[None, :]), self.words, self.radius):
            length = np.linalg.norm(half)
            most = (words @ half[0]) + length * radius
            out.append(most + 1e-9 * (1 + length * (np.linalg.norm(words, axis=1) + radius)))
        return out

    def visit(self, anchor: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Bound, cell and rows of the cells that have rows, the highest bound first, by a multi-sequence heap."""
        first, second = self.bounds(anchor)
        one, two = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
        a, b = first.tolist(), second.tolist()
        heap = [(-(a[one[0]] + b[two[0]]), 0, 0)]
        taken = [-1] * self.codes  # per place in the first list, the last place taken in the second
        while heap:
            most, i, j = heapq.heappop(heap)
            taken[i] = j
            x, y = one[i], two[j]
            if self.rows[x, y]:
                yield -most, x * self.codes + y, int(self.rows[x, y])
            if j + 1 < self.codes and (i == 0 or taken[i - 1] > j):
                heapq.heappush(heap, (-(a[x] + b[two[j + 1]]), i, j + 1))
            if i + 1 < self.codes and taken[i + 1] == j - 1:
                heapq.heappush(heap, (-(a[one[i + 1]] + b[y]), i + 1, j))


def _usable(rows: DataFrame, vec_id: str, vector: str, label: str, is_anchor: Column) -> DataFrame:
    df = rows.select(
        F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")
    )
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= LARGEST))
    df = df.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(sound)
    return df.withColumn("key", F.xxhash64("id", "label", "x"))


def _index(rows: DataFrame) -> tuple[DataFrame, DataFrame, Codebooks] | None:
    """All rows with their ``cell``, written once; the rows of each cell; and the codebooks with radii and counts."""
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n:
        return None
    drawn = rows.select("key", "x").orderBy("key").limit(max(256, min(SAMPLE, SAMPLE_VALUES // max(dims, 1)))).toArrow()
    codes = min(MOST_CODES, max(LEAST_CODES, int(np.ceil(np.sqrt(n / ROWS_PER_CELL)))))
    books = Codebooks(_matrix(drawn["x"].combine_chunks(), max(dims, 2)), codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), books.dims)
            near = [_nearest(h, w) for h, w in zip(books.halves(x), books.words)]
            far = [np.linalg.norm(h - w[k], axis=1) for h, w, k in zip(books.halves(x), books.words, near)]
            columns = {c: batch.column(c) for c in ("key", "id", "label", "anchor")}
            columns["x"] = pa.ListArray.from_arrays(np.arange(0, x.size + 1, books.dims, dtype=np.int32), x.ravel())
            columns["cell"] = pa.array(near[0] * codes + near[1], pa.int64())
            columns |= {f"far{k}": pa.array(f, pa.float64()) for k, f in enumerate(far)}
            yield pa.RecordBatch.from_pydict(columns)

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    schema = f"key bigint, id {kinds['id']}, label {kinds['label']}, anchor boolean, x array<double>, cell bigint, far0 double, far1 double"
    indexed = cut(map_in_arrow(rows.select("key", "id", "label", "anchor", "x"), run, schema))
    directory = cut(indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("far0").alias("far0"), F.max("far1").alias("far1")))
    for cell, count, *far in directory.collect():
        x, y = divmod(cell, codes)
        books.rows[x, y] = count
        for half, code, distance in zip(books.radius, (x, y), far):
            half[code] = max(half[code], distance)
    return indexed.drop("far0", "far1"), directory.select("cell", "rows"), books


_WANT = "key bigint, label {label}, x array<double>, windows array<struct<low:double,high:double,least:double>>, cell bigint"


def _asked(anchors: DataFrame, books: Codebooks, round_rows: int) -> DataFrame:
    """The cells that each anchor asks for in this round, and in one row with a null cell the bound of its next one.

    ``anchors``: ``key``, ``label``, ``x``, ``seen`` (cells visited before), ``floor`` (no cell below it is wanted), ``windows``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), books.dims)
            floors, seen = batch.column("floor").to_pylist(), batch.column("seen").to_pylist()
            rows, cells, bounds, counts = [], [], [], []
            for k in range(batch.num_rows):
                held, asked, following = 0, 0, None
                for place, (bound, cell, count) in enumerate(books.visit(x[k])):
                    if place < seen[k]:
                        continue
                    if floors[k] is not None and bound < floors[k]:
                        break
                    if held >= round_rows:
                        following = bound
                        break
                    held, asked = held + count, asked + 1
                    rows.append(k)
                    cells.append(cell)
                    bounds.append(None)
                    counts.append(None)
                rows.append(k)
                cells.append(None)
                bounds.append(following)
                counts.append(seen[k] + asked)
            taken = pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "label", "x", "windows")], ["key", "label", "x", "windows"]).take(pa.array(rows, pa.int64()))
            arrays = [*taken.columns, pa.array(cells, pa.int64()), pa.array(bounds, pa.float64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*taken.schema.names, "cell", "next", "seen"])

    kind = anchors.schema["label"].dataType.simpleString()
    schema = _WANT.format(label=kind) + ", next double, seen bigint"
    return cut(map_in_arrow(anchors.select("key", "label", "x", "seen", "floor", "windows"), run, schema))


def _blocks(asked: DataFrame, indexed: DataFrame, directory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and askers of the cells asked for, each copied to the blocks (``cell``, ``part``, ``crowd``) it belongs to."""
    asked = asked.where("cell is not null")
    crowds = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("askers"))
    shape = crowds.join(directory, "cell").select(
        "cell", F.ceil(F.col("rows") / BLOCK_ROWS).alias("parts"), F.ceil(F.col("askers") / BLOCK_ANCHORS).alias("crowds")
    )
    shape = F.broadcast(cut(shape))  # one row a cell
    rows = indexed.join(shape, "cell").withColumn("part", F.pmod(F.xxhash64("key"), "parts")).withColumn("crowd", _each("crowds"))
    wants = asked.join(shape, "cell").withColumn("crowd", F.pmod(F.xxhash64("key"), "crowds")).withColumn("part", _each("parts"))
    return rows.drop("parts", "crowds"), wants.select("cell", "part", "crowd", "key", "label", "x", "windows")


def _each(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))


def _scored(asked: DataFrame, indexed: DataFrame, directory: DataFrame, dims: int, same_label: bool, most: int) -> DataFrame:
    """``anchor``, ``window``, ``key``, ``id``, ``score``: per anchor and window the ``most`` highest rows of each block."""
    rows, wants = _blocks(asked, indexed, directory)
    group = ["cell", "part", "crowd"]
    ddl = f"anchor bigint, window int, key bigint, id {indexed.schema['id'].dataType.simpleString()}, score double"
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        keys, order = np.unique(left["key"].to_numpy(), return_index=True)  # equal rows are one
        x = _matrix(left["x"].combine_chunks(), dims)[order]
        labels, ids = (left[c].combine_chunks().take(pa.array(order)) for c in ("label", "id"))
        by_id = pc.rank(ids, tiebreaker="dense").to_numpy()
        codes = pa.concat_arrays([labels, right["label"].combine_chunks()]).dictionary_encode().indices.to_numpy()
        mine, theirs = codes[: len(keys)], codes[len(keys) :]
        anchor_keys, windows = right["key"].to_numpy(), right["windows"].to_pylist()
        scores = _matrix(right["x"].combine_chunks(), dims) @ x.T
        out: list[list[np.ndarray]] = [[], [], [], []]
        for k, row in enumerate(scores):
            fits = (mine == theirs[k]) & (keys != anchor_keys[k]) if same_label else mine != theirs[k]
            for w, window in enumerate(windows[k]):
                inside = fits & (row >= window["least"])
                if not same_label:
                    inside &= (100 * row >= window["low"]) & (100 * row <= window["high"])
                at = np.flatnonzero(inside)
                if len(at) > most:
                    at = at[row[at] >= np.partition(row[at], -most)[-most]]  # all that equal the last, for ids to decide
                    at = at[np.lexsort((keys[at], by_id[at], -row[at]))[:most]]
                for column, values in zip(out, (np.full(len(at), k), np.full(len(at), w), at, row[at])):
                    column.append(values)
        who, window, at, score = (np.concatenate(c) for c in out)
        columns = [pa.array(anchor_keys[who]), pa.array(window.astype(np.int32)), pa.array(keys[at]), ids.take(pa.array(at)), pa.array(score)]
        return pa.Table.from_arrays(columns, schema=schema)

    return rows.groupBy(*group).cogroup(wants.groupBy(*group)).applyInArrow(run, ddl)


def _highest(found: DataFrame, most: int) -> DataFrame:
    place = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= most)


def _search(anchors: DataFrame, indexed: DataFrame, directory: DataFrame, books: Codebooks, same_label: bool, most: int) -> DataFrame:
    """``anchor``, ``window``, ``rank``, ``key``, ``id``, ``score``: the certified lists of ``anchors`` (``key``, ``label``, ``x``, ``windows``)."""
    lists, rows = None, ROUND_ROWS
    waiting = anchors.withColumn("seen", F.lit(0).cast("long")).withColumn("floor", _floor())
    while True:
        asked = _asked(waiting, books, rows)
        found = _scored(asked, indexed, directory, books.dims, same_label, most)
        lists = cut(_highest(found if lists is None else lists.drop("rank").unionByName(found), most))
        lasts = lists.where(F.col("rank") == most).groupBy(F.col("anchor").alias("key"))
        lasts = lasts.agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("lasts"))
        after = asked.where("cell is null and next is not null").join(lasts, "key", "left")
        windows = F.transform("windows", lambda w, k: F.struct(w["low"].alias("low"), w["high"].alias("high"), _last(k).alias("least")))
        after = after.withColumn("windows", windows).withColumn("floor", _floor()).where("next >= floor")
        waiting = cut(after.select("key", "label", "x", "windows", "seen", "floor"))
        if not waiting.take(1):
            return lists
        rows *= 4


def _last(window: Column) -> Column:
    """The last score of a full list."""
    return F.coalesce(F.try_element_at("lasts", window), F.lit(float("-inf")))


def _floor() -> Column:
    """The least score that can still enter a list."""

    def of(w: Column) -> Column:
        surplus = 1e-9 * (1 + F.abs(w["low"]))
        return F.when(w["low"] > w["high"], F.lit(float("inf"))).otherwise(F.greatest(w["least"], w["low"] / 100 - surplus))

    return F.array_min(F.transform("windows", of))


def _window(low: Column, high: Column) -> Column:
    return F.struct(low.cast("double").alias("low"), high.cast("double").alias("high"), F.lit(float("-inf")).alias("least"))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score`` (doubles).

    ``is_anchor`` is a condition over ``rows``. Scores of whole numbers are exact below 2 ** 53.
    """
    usable = _usable(rows, vec_id, vector, label, is_anchor)
    made = _index(usable)
    if made is None:
        score = F.lit(None).cast("double")
        ids = [F.col("id").alias(c) for c in ("anchor_id", "positive_id", "negative_id")]
        empty = usable.where(F.lit(False)).select(*ids, F.lit(0).alias("rank"), score.alias("positive_score"), score.alias("negative_score"))
        return empty.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    indexed, directory, books = made
    anchors = indexed.where("anchor").dropDuplicates(["key"]).select("key", "id", "label", "x")
    everything = F.lit(None).cast("double")
    first = anchors.withColumn("windows", F.array(_window(everything, everything)))
    near = _search(first, indexed, directory, books, True, positives)
    near = near.select(F.col("anchor").alias("key"), F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ordered = F.sort_array(F.collect_list(F.struct("place", "positive_score")))
    windows = F.transform(ordered, lambda p: _window(low * p["positive_score"], high * p["positive_score"]))
    second = anchors.join(near.groupBy("key").agg(windows.alias("windows")), "key")
    far = _search(second, indexed, directory, books, False, negatives)
    far = far.select(
        F.col("anchor").alias("key"), (F.col("window") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = anchors.select("key", F.col("id").alias("anchor_id"))
    return far.join(near, ["key", "place"]).join(named, "key").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
