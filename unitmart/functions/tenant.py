"""Tenant expressions: which business units a row belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import BUSINESS_UNITS, SHARED_BU, SHARED_WITH_SEPARATOR


def entitled_units(bu_col: str = "bu_id", shared_with_col: str = "shared_with") -> Column:
    """Array of units a dimension row is visible to.

    Own rows belong to their unit; ``SHARED`` rows to every unit listed in the
    pipe-separated ``shared_with`` (elements are not trimmed; a null list
    entitles nobody).
    """
    bu = F.col(bu_col)
    return F.when(bu == SHARED_BU, F.split(F.col(shared_with_col), SHARED_WITH_SEPARATOR)) \
        .otherwise(F.array(bu))


def visible_to(unit: str, bu_col: str = "bu_id", shared_with_col: str = "shared_with") -> Column:
    """Row predicate for one unit (the per-tenant form of ``entitled_units``)."""
    bu = F.col(bu_col)
    return (bu == F.lit(unit)) | (
        (bu == SHARED_BU)
        & F.coalesce(F.array_contains(F.split(F.col(shared_with_col), SHARED_WITH_SEPARATOR),
                                      F.lit(unit)), F.lit(False))
    )


def known_unit(col: Column, units: Sequence[str] = BUSINESS_UNITS) -> Column:
    return col.isin(list(units))
