"""The gate between incoming changes and a unit's current state.

One function serves batch and streaming frames, so both admit the same rows:

1. fail: a ``SHARED`` row of an object that cannot be shared raises; with
   ``strict`` a row without a configured unit does too. The check sees the
   incoming rows, before anything is re-homed or filtered.
2. keep out: rows of no or of an unconfigured unit are not admitted.
3. drop: rows without a sequence are dropped.
4. scope: shared dimension rows are copied to every entitled unit (``_own``
   tells a unit's own row from a copy).

What steps 2 and 3 reject is counted through ``observe``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.tenant import known_unit
from ..model import BUSINESS_UNITS, OBJECTS, SHARED_BU
from .quality import expect_or_fail
from .scope import expand_shared


def _rules(shared: bool, sequence: str, units: Sequence[str]) -> tuple[Column, Column]:
    """(has a unit that the object may have, has a sequence)."""
    bu = F.col("bu_id")
    ok = known_unit(bu, units)
    if shared:
        ok = ok | (bu == SHARED_BU)
    return F.coalesce(ok, F.lit(False)), F.col(sequence).isNotNull()


def rejection_metrics(shared: bool, sequence: str, units: Sequence[str]) -> list[Column]:
    has_unit, has_sequence = _rules(shared, sequence, units)
    return [F.count(F.lit(1)).alias("seen"),
            F.coalesce(F.sum((~has_unit).cast("bigint")), F.lit(0)).alias("unconfigured_unit"),
            F.coalesce(F.sum((has_unit & ~has_sequence).cast("bigint")), F.lit(0)).alias(f"dropped_valid_{sequence}")]


def admit(feed: DataFrame, shared: bool = False, sequence: str = "updated_at",
          units: Sequence[str] = BUSINESS_UNITS, keys: Sequence[str] = (), strict: bool = False,
          revoke: bool = False, delete_flag: str = "is_deleted",
          observation: Observation | str | None = None,
          extra_metrics: Sequence[Column] = ()) -> DataFrame:
    has_unit, has_sequence = _rules(shared, sequence, units)
    if strict:
        names = ", ".join(f"'{u}'" for u in [*units, *([SHARED_BU] if shared else [])])
        feed = expect_or_fail(feed, "valid_bu", f"bu_id IS NOT NULL AND bu_id IN ({names})", keys)
    elif not shared:
        feed = expect_or_fail(feed, "valid_bu", f"bu_id IS NULL OR bu_id <> '{SHARED_BU}'", keys)
    if observation is not None:
        feed = feed.observe(observation, *rejection_metrics(shared, sequence, units), *extra_metrics)
    rows = feed.filter(has_unit & has_sequence)
    if not shared:
        return rows
    return expand_shared(rows.withColumn("_own", F.col("bu_id") != SHARED_BU), units,
                         revoke=revoke, delete_flag=delete_flag)


def admit_object(feed: DataFrame, obj: str, units: Sequence[str] = BUSINESS_UNITS, **kw) -> DataFrame:
    spec = OBJECTS[obj]
    return admit(feed, spec.shared, spec.sequence, units, spec.keys, delete_flag=spec.delete_flag, **kw)
