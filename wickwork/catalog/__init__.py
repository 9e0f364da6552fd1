"""Every operator as a query over the driver tables, with the same answer stated in SQL."""

from __future__ import annotations

from wickwork.catalog import candles, metrics, quality, registry, serving, sources, streams, upserts
from wickwork.catalog.base import SQL, QUERIES

__all__ = ["QUERIES", "SQL", "candles", "metrics", "quality", "registry", "serving", "sources", "streams", "upserts"]
