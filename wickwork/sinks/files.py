"""Staged JSON lines, and their load into bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wickwork import layout
from wickwork.sinks.tables import append
from wickwork.sources.landed import bronze_to_json, read_candle_ndjson


def stage_ndjson(bronze: DataFrame, path: str, rows_per_file: int = 2_000_000) -> None:
    """Candles as JSON lines, one folder per coin.

    Rows are gathered by coin first, so a coin's lines end in few files; a coin with much of
    the data is split over many tasks when the sizes are known.
    """
    (
        bronze_to_json(bronze)
        .hint("rebalance", F.col("coin_id"))
        .write.partitionBy("coin_id")
        .option("maxRecordsPerFile", rows_per_file)
        .mode("overwrite")
        .text(path)
    )


def load_ndjson(spark: SparkSession, glob: str, table_path: str) -> None:
    """Append every candle line under a glob to the named bronze table.

    A plain append: loading the same files again adds versions, which silver reduces.
    """
    append(read_candle_ndjson(spark, glob), table_path, layout.BRONZE)
