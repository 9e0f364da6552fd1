"""The training-data pipeline: quality rules, near-dedup, decontamination, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each result but
the last as Parquet to the shared folder, reads it again for the next stage, and then removes
what that stage has read. If a stage fails, nothing of the run stays. What the last stage reads stays
until its result, which is not yet computed, has been used.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wickwork.llm import decontaminate, near_dup, packing, quality, secrets
from wickwork.llm.common import read_table
from wickwork.session import new_folder, remove

# Near-dedup, secret scans and packing depend on hashes, automata and a tokenizer file, so no SQL gives the rows.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a threshold rejects go."""
    return quality.keep_good(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a similarity of 0.8 on five-word shingles, the document with the least id stays."""
    return near_dup.drop_near_duplicates(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a run of ten words of a benchmark item, or a whole shorter item, go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folders = read_table(spark, sf_dir, "documents"), []
    try:
        for name, stage in STAGES[:-1]:
            folders.append(new_folder(spark, name))
            stage(spark, docs, sf_dir).write.parquet(folders[-1])
            docs = spark.read.parquet(folders[-1])
            for done in folders[:-1]:
                remove(spark, done)
            del folders[:-1]
        return STAGES[-1][1](spark, docs, sf_dir)
    except BaseException:
        for folder in folders:
            remove(spark, folder)
        raise
