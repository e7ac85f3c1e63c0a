"""Write order over several columns: a space-filling (Z-order) key.

Every column is turned into a rank of ``BITS`` bits (its place among quantiles
of the table, or in a list of known values), and the bits of the ranks are
interleaved. Rows that are near in all columns are then near in the files, so
the minima and maxima of a row group are narrow in each of them, and a filter
on any one skips row groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 8


def place_among(col: Column, bounds: Sequence) -> Column:
    """How many of the sorted ``bounds`` are less than the value, as a balanced
    tree of comparisons; null for null."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col <= F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(col.isNotNull(), tree(0, len(bounds)))


def quantile_bounds(df: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list:
    """At most ``parts - 1`` distinct values that cut a numeric or time column
    into parts of about equal size: one row reaches the driver."""
    row = df.agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], accuracy).alias("q")).first()
    return sorted(set(row.q or ()))


def z_key(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """Interleaved bits of the ranks (null ranks as 0), the highest first."""
    key = F.lit(0).cast("bigint")
    width = len(ranks)
    for i, rank in enumerate(ranks):
        rank = F.coalesce(rank, F.lit(0)).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            key = key + F.shiftleft(bit, b * width + (width - 1 - i))
    return key


def clustered(df: DataFrame, columns: Sequence[str], known: Mapping[str, Sequence] | None = None,
              files: int | None = None, bits: int = BITS) -> DataFrame:
    """The rows in the order of the key: one range of it per task. ``known``
    lists the values of columns that are not numeric or times; other values
    come after them."""
    ranks = []
    for c in columns:
        if known and c in known:
            values = list(known[c])
            scale = max(1, ((1 << bits) - 1) // max(len(values), 1))  # over the whole range of ranks
            place = F.array_position(F.array(*map(F.lit, values)), F.col(c)) - 1
            ranks.append(F.when(place >= 0, place * scale).otherwise((1 << bits) - 1))
        else:
            ranks.append(place_among(F.col(c), quantile_bounds(df, c, 1 << bits)))
    keyed = df.withColumn("_z", z_key(ranks, bits))
    ranged = keyed.repartitionByRange(files, "_z") if files else keyed.repartitionByRange("_z")
    return ranged.sortWithinPartitions("_z").drop("_z")
