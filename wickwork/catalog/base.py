"""Registration of queries and helpers they share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL where the answer can be stated in SQL.

    Timestamps leave a query without a zone, as the driver tables hold them.
    """

    def register(build: Callable[[SparkSession, str], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return zoneless(build(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def zoneless(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def ctes(*parts: str) -> str:
    """A WITH clause from named parts."""
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"
