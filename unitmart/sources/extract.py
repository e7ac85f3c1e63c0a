"""Incremental extraction with a high-water mark.

``updated_at > watermark`` is a plain comparison with a constant, so Catalyst
pushes it into the source scan (parquet row-group statistics, JDBC WHERE).
Watermarks travel as ISO strings (UTC wall clock, or with an offset), never
as driver-side datetime objects, so no local time zone leaks in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(iso: str) -> Column:
    """A constant UTC instant (``timestamp_ntz``) from ISO text; ``Z`` and
    ``+hh:mm`` offsets are converted to UTC."""
    return F.lit(iso).cast("timestamp").cast("timestamp_ntz")


def parse_instant(col: Column | str) -> Column:
    """Instant text -> UTC ``timestamp_ntz``; malformed or missing -> null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def incremental(feed: DataFrame, watermark: str | None, column: str = "updated_at",
                lookback_seconds: int = 0, ordered: bool = False) -> DataFrame:
    """Rows changed strictly after the watermark (all rows without one).

    ``lookback_seconds`` re-reads a window before the mark, catching rows
    committed late with an older timestamp; CDC absorbs the repeats.
    ``ordered`` adds the source's ``ORDER BY updated_at`` (a range shuffle),
    only needed when files must be written in time order.
    """
    out = feed
    if watermark is not None:
        bound = instant(watermark)
        if lookback_seconds:
            bound = bound - F.make_dt_interval(secs=F.lit(lookback_seconds))
        out = out.filter(F.col(column) > bound)
    if ordered:
        out = out.orderBy(column)
    return out
