"""Row checks, table constraints and job counters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

_PRICES = ("open", "high", "low", "close")
_PARSED = ("open_time", "close_time", "trade_count")


def is_sane(df: DataFrame) -> Column:
    """Prices above zero, high at or above low, volume at or above zero, all of them finite numbers.

    Times and trade count, where ``df`` has them, have to have parsed.
    """

    def number(name: str) -> Column:
        c = F.col(name)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        return c

    checks = [number(c) > 0 for c in _PRICES]
    checks += [number("high") >= number("low"), number("volume") >= 0]
    checks += [F.col(c).isNotNull() for c in _PARSED if c in df.columns]
    all_hold = checks[0]
    for check in checks[1:]:
        all_hold = all_hold & check
    # A null (text that did not parse) makes the conjunction null or false: rejected.
    return F.coalesce(all_hold, F.lit(False))


def sane(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows to keep and the rows to reject."""
    ok = is_sane(df)
    return df.filter(ok), df.filter(~ok)


def reject_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows fetched, kept and skipped, overall or per group, in one pass."""
    ok = is_sane(df)
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("fetched"),
        F.count_if(ok).alias("kept"),
        F.count_if(~ok).alias("skipped"),
    )


def job_counters(df: DataFrame, counters: Mapping[str, Column]) -> DataFrame:
    """One row of named counts over ``df``: its rows and those each condition holds for."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in counters.items()])


def check_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Null count per column, one row per column."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, violations)")


def check_unique(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def check_domain(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """Rows whose value is neither null nor one of ``allowed``."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent.

    Orphan keys are found on the distinct child keys, so a key with very many child rows
    crosses the network once per task; only when there are orphans do child rows join.
    """
    missing = child.select(key).distinct().join(parent.select(key), key, "left_anti")
    return child.join(missing, key, "left_semi")
