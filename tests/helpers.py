"""Small hand-made frames."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from wickwork import schemas as S


def utc(*parts) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def candle(coin="a", hour=0, day=1, open=10, high=12, low=9, close=11, volume=5, published=None, **more):
    opened = utc(2024, 1, day, hour)
    row = {
        "coin_id": coin,
        "interval": "1h",
        "open_time": opened,
        "close_time": utc(2024, 1, day, hour, 59, 59),
        "open": open,
        "high": high,
        "low": low,
        "close": close,
        "volume": volume,
        "quote_volume": 7,
        "trade_count": 3,
        "is_closed": True,
        "publish_time": published,
    }
    row.update(more)
    return row


def frame(spark, rows, schema):
    """Dicts as a frame of a schema; whole numbers and text become decimals where it has them."""
    out = []
    for row in rows:
        values = []
        for f in schema.fields:
            v = row.get(f.name)
            if v is not None and f.dataType.typeName() == "decimal":
                v = Decimal(str(v))
            values.append(v)
        out.append(tuple(values))
    return spark.createDataFrame(out, schema)


def bronze(spark, rows):
    return frame(spark, rows, S.CANDLE)


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())
