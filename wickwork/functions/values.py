"""Amount expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wickwork.schemas import MONEY


def money(text: Column) -> Column:
    """Text to an exact amount; anything unparsable, NaN and infinities included, is null."""
    return text.try_cast(MONEY)


def whole(text: Column) -> Column:
    """Text to a long, null when it is not one."""
    return text.try_cast("bigint")


def nine_places(value: Column) -> Column:
    """A double as an amount with nine decimal places, rounded half up."""
    return value.cast(MONEY)


def present(text: Column) -> Column:
    """True when a text field is there and not empty."""
    return F.coalesce(text, F.lit("")) != ""
