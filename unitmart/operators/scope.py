"""Tenant scoping of dimension rows, including rows shared between units.

One pass serves every unit: a row becomes one row per entitled unit
(``explode`` of a short array), with ``bu_id`` re-homed to that unit. There is
no join and no per-unit rescan, so the cost is one narrow projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tenant import entitled_units, known_unit, visible_to
from ..model import BUSINESS_UNITS, SHARED_BU


def expand_shared(dim: DataFrame, units: Sequence[str] = BUSINESS_UNITS,
                  bu_col: str = "bu_id", shared_with_col: str = "shared_with",
                  revoke: bool = False, delete_flag: str = "is_deleted") -> DataFrame:
    """Own rows stay with their unit; SHARED rows are copied to each entitled unit.

    With ``revoke`` a SHARED version is also copied, as a delete, to every
    configured unit it does *not* list, so a unit that lost the entitlement
    drops the row at that version instead of keeping a stale copy (the
    default keeps the stale copy, as the per-unit filter does).
    """
    cols = dim.columns
    if not revoke:
        exploded = dim.withColumn("_unit", F.explode(entitled_units(bu_col, shared_with_col)))
        return (
            exploded.filter(known_unit(F.col("_unit"), units))
            .withColumn(bu_col, F.col("_unit"))
            .select(*cols)
        )
    shared = F.col(bu_col) == SHARED_BU
    every = F.array(*[F.lit(u) for u in units])
    exploded = dim.withColumn("_unit", F.explode(F.when(shared, every).otherwise(F.array(bu_col))))
    listed = F.coalesce(F.array_contains(entitled_units(bu_col, shared_with_col), F.col("_unit")),
                        F.lit(False))
    return (
        exploded.filter(known_unit(F.col("_unit"), units))
        .withColumn(delete_flag, F.when(shared & ~listed, F.lit(1)).otherwise(F.col(delete_flag)))
        .withColumn(bu_col, F.col("_unit"))
        .select(*cols)
    )


def scope_for_unit(dim: DataFrame, unit: str, bu_col: str = "bu_id",
                   shared_with_col: str = "shared_with") -> DataFrame:
    """Rows visible to one unit, re-homed to it (a tenant's own pipeline)."""
    return dim.filter(visible_to(unit, bu_col, shared_with_col)).withColumn(bu_col, F.lit(unit))
