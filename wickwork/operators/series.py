"""Series that share timestamps, put side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def align_series(entries: DataFrame) -> DataFrame:
    """Long series rows as one row per price timestamp: price, market cap and total volume.

    Prices drive: a cap or volume without a price at its timestamp is dropped, a price
    without them keeps nulls. Of repeated timestamps the last entry counts. One aggregate
    replaces two outer joins; a response's entries meet on the map side already.
    """

    def last(kind: str) -> Column:
        of_kind = F.col("kind") == kind
        return F.max_by(F.when(of_kind, F.col("value")), F.when(of_kind, F.col("pos")))

    return (
        entries.groupBy("coin_id", "request", "ts_ms")
        .agg(
            F.count_if(F.col("kind") == "prices").alias("__prices"),
            last("prices").alias("price"),
            last("market_caps").alias("market_cap"),
            last("total_volumes").alias("total_volume"),
        )
        .filter("__prices > 0")
        .drop("__prices")
    )
