"""Token counts: an exact histogram of encoded lengths, and suffix sums over it.

Documents are aggregated by their number of tokens, which is all that any question about
context limits needs: how many documents and tokens there are up to a limit, what cutting at
a limit keeps, and which length a quantile has. The histogram is exact, merges across
partitions before the shuffle, and has at most one row for each length.

Suffix sums are taken in two steps, within blocks of lengths and over the blocks' totals, so
that no task holds all lengths.

Defined cases: a null or empty text has no tokens and counts as length 0. Repeated documents
count each. An empty table gives no rows. Other columns of the documents are not read.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from wickwork.llm.common import cut, map_batches

# The split pattern that belongs to the byte-level vocabulary files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLOCK = 1024

_encodings: dict[str, tiktoken.Encoding] = {}


def _encoding(path: str) -> tiktoken.Encoding:
    """This worker's encoder of a rank file."""
    if path not in _encodings:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def encoded_lengths(docs: DataFrame, ranks: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``n_tokens`` of each document's whole text."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = _encoding(ranks).encode_ordinary
        n = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64())})

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(docs, count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """One row for each length that occurs, taken as a limit.

    ``docs_over``: longer documents; ``tokens_over``: all of their tokens; ``tokens_kept``:
    tokens left when every document is cut at the limit; ``docs_total``, ``tokens_total``;
    ``quantile``: the share of documents that are not longer.
    """
    histogram = cut(
        histogram.select(
            "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / _BLOCK).alias("block")
        )
    )
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    blocks = histogram.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens"))
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(longer), none).alias("docs_after"),
        F.coalesce(F.sum("tokens").over(longer), none).alias("tokens_after"),
        F.sum("docs").over(everything).alias("docs_total"),
        F.sum("tokens").over(everything).alias("tokens_total"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    rows = histogram.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.coalesce(F.sum("n_docs").over(within), none) + F.col("docs_after")).alias("docs_over"),
        (F.coalesce(F.sum("tokens").over(within), none) + F.col("tokens_after")).alias("tokens_over"),
        "docs_total",
        "tokens_total",
    )
    return rows.select(
        "n_tokens",
        "n_docs",
        "docs_over",
        "tokens_over",
        (F.col("tokens_total") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_kept"),
        "docs_total",
        "tokens_total",
        (F.lit(1.0) - F.col("docs_over") / F.col("docs_total")).alias("quantile"),
    )
