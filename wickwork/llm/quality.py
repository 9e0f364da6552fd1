"""Quality rules: measures of each text, held against thresholds that follow the data.

Thresholds come from quantile sketches per language and source. A sketch counts the values of
a measure in bins whose width is a sixteenth of the value or less; two sketches merge by adding
their counts, so they are aggregated before the shuffle, in any order, with one result. A
source's upper threshold is its third quartile, plus three times the distance of the quartiles,
plus a slack; a source with too few documents takes its language's sketch, and one whose
language has too few takes the merged sketch of all. Documents are then joined with their
source's thresholds.

All of it is DataFrame functions. The measures are taken once, from the whole text, and written
to the checkpoint folder as a narrow table (no text); thresholds are one row a source, and the
join's plan, with splits of hot sources, is left to Spark.

Defined cases: a null or empty text has no words, fails the base rule and stays out of the
sketches, as do all that fail it. A null language or source is a group of its own. Repeated
documents count each. An empty table gives no rows. Only ``doc_id``, ``text``, ``lang`` and
``source`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wickwork.llm.common import cut, within_broadcast

# White space that parts words, and characters that count as symbols.
_WHITE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Measures with adaptive thresholds, in thousandths, and the slack added to each threshold.
SLACK = {"symbol_rate": 100, "capital_rate": 100, "dup_line_rate": 500, "repeat_rate": 350}
LEAST_DOCS = 50


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def _pairs(array: Column, n: Column) -> Column:
    """Neighbours in an array of n items."""
    return F.arrays_zip(F.slice(array, 1, n).alias("a"), F.slice(array, 2, n).alias("b"))


def measure(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``doc_id``, the keys, the base counts and the rates. Each step is used more than once by the next, so none is evaluated twice."""
    df = docs.select(F.col(doc_id).alias("doc_id"), *keys, F.coalesce(F.col(text), F.lit("")).alias("text"))
    df = df.select(
        "doc_id",
        *keys,
        F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.trim(F.translate(line, _WHITE, "")) != "").alias("lines"),
        _without(F.col("text"), _WHITE).cast("long").alias("word_chars"),
        (F.char_length("text") - _without(F.col("text"), _SYMBOLS)).cast("long").alias("n_symbols"),
        (F.char_length("text") - _without(F.col("text"), _CAPITALS)).cast("long").alias("n_capitals"),
    )
    counts = ["word_chars", "n_symbols", "n_capitals"]
    n = F.greatest(F.size("words") - 2, F.lit(0))
    df = df.select(
        "doc_id",
        *keys,
        *counts,
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            F.arrays_zip(*[F.slice("words", k + 1, n).alias(x) for k, x in enumerate("abc")]),
            lambda w: F.concat_ws(" ", w["a"], w["b"], w["c"]),
        ).alias("windows"),
    )
    counts += ["n_words", "n_lines", "n_dup_lines"]
    # Windows in order of their words, each with its place; equal neighbours are repeats.
    placed = F.sort_array(F.arrays_zip(F.col("windows").alias("w"), F.sequence(F.lit(0), F.size("windows") - 1).alias("at")))
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    df = df.select("doc_id", *keys, *counts, F.when(repeats, placed).alias("placed"))
    same = F.filter(_pairs(F.col("placed"), F.size("placed") - 1), lambda p: p["a"]["w"] == p["b"]["w"])
    df = df.select("doc_id", *keys, *counts, F.when(F.col("placed").isNotNull(), same).alias("same"))
    places = F.sort_array(F.array_distinct(F.concat(F.col("same")["a"]["at"], F.col("same")["b"]["at"])))
    df = df.select("doc_id", *keys, *counts, places.alias("places"))
    steps = F.aggregate(_pairs(F.col("places"), F.size("places") - 1), F.lit(3), lambda n, p: n + F.least(F.lit(3), p["b"] - p["a"]))
    repeated = F.when(F.col("places").isNotNull(), steps).otherwise(0).cast("long")
    df = df.select("doc_id", *keys, *counts, repeated.alias("n_repeat_words"))

    def rate(part: str, whole: str) -> Column:
        return F.expr(f"1000 * {part} div greatest({whole}, 1)")

    return df.select(
        "doc_id",
        *keys,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        rate("n_symbols", "n_words").alias("symbol_rate"),
        rate("n_capitals", "word_chars").alias("capital_rate"),
        rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"),
    )


def bin_of(value: Column) -> Column:
    """The bin of a whole number from 0: itself below 32, then sixteen bins for each doubling."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return 16 * shift + F.call_function("shiftright", value, shift)


def least_of(bin_number: Column) -> Column:
    """The least value of a bin."""
    shift = F.greatest(F.floor(bin_number / 16) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (bin_number - 16 * shift).cast("long"), shift)


def sketches(measured: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Counts per key, measure and bin of the documents that pass the base rule."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in SLACK]))
    rows = measured.where(~F.col("base_failed")).select(*keys, each.alias("x"))
    return rows.groupBy(*keys, "x.measure", "x.bin").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def upper_thresholds(sketch: DataFrame, *keys: str) -> DataFrame:
    """One row a key: the number of documents, and a column for each measure's threshold."""
    key = Window.partitionBy(*keys, "measure")
    ranked = sketch.select(
        *keys, "measure", "bin", F.sum("n").over(key).alias("docs"), F.sum("n").over(key.orderBy("bin")).alias("up_to")
    )
    quartile = [least_of(F.min(F.when(4 * F.col("up_to") >= k * F.col("docs"), F.col("bin")))) for k in (1, 3)]
    fences = ranked.groupBy(*keys, "measure").agg(F.first("docs").alias("docs"), quartile[0].alias("q1"), quartile[1].alias("q3"))
    slack = F.element_at(F.create_map(*[F.lit(x) for pair in SLACK.items() for x in pair]), F.col("measure"))
    fence = F.col("q3") + 3 * (F.col("q3") - F.col("q1")) + slack
    return fences.groupBy(*keys).agg(
        F.max("docs").alias("docs"), *[F.max(F.when(F.col("measure") == m, fence)).alias(m) for m in SLACK]
    )


def judge(measured: DataFrame, keys: tuple[str, str] = ("lang", "source"), least_docs: int = LEAST_DOCS) -> DataFrame:
    """``measured`` with ``kept``: the base rule and every measure at most its threshold."""
    measured = cut(measured)
    sketch = cut(sketches(measured, keys))
    levels = [
        upper_thresholds(sketch, *keys),
        upper_thresholds(merge_sketches(sketch, keys[0]), keys[0]),
        upper_thresholds(merge_sketches(sketch.withColumn("every", F.lit(1)), "every"), "every"),
    ]
    fine, wide, whole = (
        t.select(
            *[c for c in t.columns if c not in ("docs", *SLACK)],
            F.struct(F.col("docs"), *[F.col(m) for m in SLACK]).alias(name),
        )
        for t, name in zip(levels, ("fine", "wide", "whole"))
    )
    wide = wide.withColumnRenamed(keys[0], "wide_key")
    chosen = fine.join(wide, F.col(keys[0]).eqNullSafe(F.col("wide_key"))).select(
        *[F.col(k).alias(f"t_{k}") for k in keys],
        F.when(F.col("fine.docs") >= least_docs, F.col("fine"))
        .when(F.col("wide.docs") >= least_docs, F.col("wide"))
        .otherwise(whole.select("whole").scalar())  # one row
        .alias("limits"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in keys]
    within = [F.col(m) <= F.col(f"limits.{m}") for m in SLACK]
    passes = ~F.col("base_failed")
    for w in within:
        passes = passes & F.coalesce(w, F.lit(False))
    return measured.join(chosen, same[0] & same[1], "left").select(*measured.columns, passes.alias("kept"))


def keep_good(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns.

    A row is found again by its id and a hash of its text, so rows with the same id, or none,
    are told apart. What is joined to the documents are the rows that go.
    """
    row = F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"))
    measured = measure(docs.select(row.alias("row"), "lang", "source", text), doc_id="row", text=text)
    gone = judge(measured).where(~F.col("kept")).select(F.col("doc_id.id").alias("__id"), F.col("doc_id.hash").alias("__hash"))
    gone = within_broadcast(cut(gone.distinct()))
    return docs.join(gone, docs[doc_id].eqNullSafe(gone["__id"]) & (F.xxhash64(docs[text]) == gone["__hash"]), "left_anti")
