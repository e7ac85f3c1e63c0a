"""Read paths of the source feeds: tenant slice, point lookup, pages.

A page is ``orderBy(unique key).offset(o).limit(n)``; Spark plans it as a
per-partition bounded top-(o+n) followed by a merge of those small heaps, so
it never sorts the whole table. The explicit unique order makes pages stable
between calls. The heaps grow with the offset; ``deep_page`` finds the place of
the offset from row counts of key ranges and reads only that range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cluster import place_among, quantile_bounds
from ..model import PAGE_DEFAULT_LIMIT, PAGE_MAX_LIMIT


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """First row whose key equals ``value`` (none if absent)."""
    return df.filter(F.col(key) == F.lit(value)).limit(1)


def validate_page(limit: int, offset: int) -> None:
    if not (1 <= limit <= PAGE_MAX_LIMIT) or offset < 0:
        raise ValueError(f"invalid pagination: limit={limit} offset={offset}")


def page(df: DataFrame, order_by: Sequence[str], offset: int = 0,
         limit: int = PAGE_DEFAULT_LIMIT) -> DataFrame:
    validate_page(limit, offset)
    return df.orderBy(*order_by).offset(offset).limit(limit)


RANGES = 64          # key ranges counted at a time
NEAR = 20_000        # rows that a page may pass over within its range


def _ranges(df: DataFrame, key: str) -> list[tuple[Column, int, bool]]:
    """Disjoint ranges of a numeric or time key in order: filter, rows, and
    whether the key is the same in all rows (nulls first, as in the order)."""
    bounds = quantile_bounds(df, key, RANGES)
    place = place_among(F.col(key), bounds) * 2
    if bounds:  # rows at a bound are a range of their own: a frequent key is cut out
        at = F.get(F.array(*map(F.lit, bounds)), place_among(F.col(key), bounds))
        place = place + F.coalesce((at == F.col(key)).cast("int"), F.lit(0))
    counted = df.groupBy(place.alias("place")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("greatest"))
    out = []
    for r in sorted(counted.collect(), key=lambda r: (r.place is not None, r.place)):
        own = F.col(key).isNull() if r.place is None else (F.col(key) >= F.lit(r.least)) & (F.col(key) <= F.lit(r.greatest))
        out.append((own, r.rows, r.least == r.greatest))
    return out


def page_parts(df: DataFrame, order_by: Sequence[str], offset: int, limit: int) -> list[tuple[Column, int, int]]:
    """Where a page lies: (filter, offset, limit) of its parts in order.

    Prefix sums over the rows of key ranges tell the range that holds the
    offset; that range is cut again until few rows of it come before the page,
    by the next column where all rows have one key. A round reads key columns
    only and sends one row per range to the driver. A page that goes on beyond
    its range takes the rest from the following ranges.
    """
    parts, following = [], []  # following: later ranges, the nearest first
    within, columns = F.lit(True), list(order_by)
    while True:
        ranges = _ranges(df.filter(within), columns[0])
        before = 0
        for i, (own, rows, same) in enumerate(ranges):
            if before + rows > offset:
                break
            before += rows
        else:
            return []  # the offset is behind the last row
        following = [(within & f, n) for f, n, _ in ranges[i + 1:]] + following
        within, offset = within & own, offset - before
        last = same and len(columns) == 1
        if rows <= NEAR or last:
            break
        if same:
            columns = columns[1:]
    parts.append((within, offset, min(limit, rows - offset)))
    need = limit - parts[0][2]
    for own, rows in following:
        if need <= 0:
            break
        parts.append((own, 0, min(need, rows)))
        need -= parts[-1][2]
    return parts


def deep_page(df: DataFrame, order_by: Sequence[str], offset: int = 0,
              limit: int = PAGE_DEFAULT_LIMIT) -> DataFrame:
    """The same rows as ``page``. ``order_by`` are numeric or time columns;
    rows that are equal in all of them may come in any order."""
    validate_page(limit, offset)
    parts = page_parts(df, order_by, offset, limit)
    if not parts:
        return df.limit(0)
    pages = [df.filter(own).orderBy(*order_by).offset(o).limit(n) for own, o, n in parts]
    return reduce(DataFrame.unionAll, pages).orderBy(*order_by)


def page_after(df: DataFrame, key: str, after=None, limit: int = PAGE_DEFAULT_LIMIT) -> DataFrame:
    """Keyset page: rows with ``key > after`` in key order. The filter is
    pushed into the scan, so a deep page costs the same as the first one."""
    validate_page(limit, 0)
    if after is not None:
        df = df.filter(F.col(key) > F.lit(after))
    return df.orderBy(key).limit(limit)


def next_offset(df: DataFrame, offset: int, limit: int) -> int | None:
    """Offset of the following page, or None after the last one."""
    validate_page(limit, offset)
    has_more = df.limit(offset + limit + 1).count() > offset + limit
    return offset + limit if has_more else None


def tenant_slice(df: DataFrame, unit: str, bu_col: str = "bu_id") -> DataFrame:
    return df.filter(F.col(bu_col) == F.lit(unit))
