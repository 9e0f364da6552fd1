"""Keyed upsert as one join, with partial updates and guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wickwork.operators.rollup import latest_per_key


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | Mapping[str, Column] | None = None,
    when: Column | None = None,
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """``target`` after merging ``source`` into it by key.

    A source key the target lacks is inserted with every column the source has (others are
    null). On a match, the columns in ``update`` take the source's values, or the given
    expressions over ``t.`` and ``s.`` columns; None means every non-key column of the
    source. ``when`` is a further condition on a match; where it is not true the target row
    stays as it is.

    The source may repeat a key: ``order_by`` ranks its rows and the first one counts. Give
    it whenever keys can repeat, or the join would multiply rows. Both sides then hold a key
    at most once, so no key can be hot in the join.

    Target rows look their changes up in the source, and new keys are found on key columns alone. It is one
    plan for any size: where Spark finds the source small enough to broadcast, the target is not shuffled.
    A key with a null in it matches nothing: target rows with one stay, source rows with one are inserted.
    """
    keys = list(keys)
    if order_by is not None:
        source = latest_per_key(source, keys, list(order_by))
    if update is None:
        update = [c for c in target.columns if c in source.columns and c not in keys]
    changes = dict(update) if isinstance(update, Mapping) else {c: F.col(f"s.{c}") for c in update}

    same_key = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    t = target.alias("t")
    s = source.withColumn("__in_source", F.lit(True)).alias("s")
    joined = t.join(s, same_key, "left")
    applies = F.col("s.__in_source").isNotNull()
    if when is not None:
        applies = applies & F.coalesce(when, F.lit(False))

    def inserted(name: str) -> Column:
        return F.col(f"s.{name}") if name in source.columns else F.lit(None)

    columns, new_columns = [], []
    for field in target.schema.fields:
        name, dtype = field.name, field.dataType
        new_columns.append(inserted(name).cast(dtype).alias(name))
        value = F.col(f"t.{name}")
        if name in changes and name not in keys:
            value = F.when(applies, changes[name].cast(dtype)).otherwise(value)
        columns.append(value.cast(dtype).alias(name))
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    new = source.join(known, keys, "left_anti").alias("s").select(*new_columns)
    return joined.select(*columns).unionByName(new)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """``df`` without the rows the condition is true for; unknown is not true."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
