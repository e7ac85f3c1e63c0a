"""Batch silver: change feed -> tenant scope -> SCD1 current state.

Each tenant only ever processes its own landing directory and keeps its own
silver table, so the effective CDC key is (bu_id, key): a key whose versions
arrive under two units is current in both. The gate (``operators.gate``) comes
before CDC; it copies shared dimension rows to every entitled unit. When a unit owns a key that is also shared with it, the later version
wins and the own row wins a tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tenant import known_unit
from ..model import BUSINESS_UNITS, OBJECTS
from ..operators.cdc import latest_per_key
from ..operators.gate import admit_object
from ..sources.binding import ENTITIES


def to_silver(feed: DataFrame, obj: str, units: Sequence[str] = BUSINESS_UNITS,
              keep_tombstones: bool = False, method: str = "window",
              revoke: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """``columns``: what the reader needs besides the keys; only these and the
    ordering columns go through the shuffle."""
    spec = OBJECTS[obj]
    if columns is not None:
        order = {*tenant_keys(obj), spec.sequence, spec.delete_flag, *spec.tie_breakers, *columns}
        order |= {"shared_with"} if spec.shared else set()
        feed = feed.select(*[c for c in feed.columns if c in order])
    scoped = admit_object(feed, obj, units, revoke=revoke)
    if columns is not None and spec.shared:
        scoped = scoped.drop("shared_with")
    ties = (("_own",) if spec.shared else ()) + spec.tie_breakers
    state = latest_per_key(scoped, tenant_keys(obj), spec.sequence, spec.delete_flag, ties,
                           keep_tombstones=keep_tombstones, method=method)
    return state.drop("_own") if spec.shared else state


def tenant_keys(obj: str) -> tuple[str, ...]:
    keys = OBJECTS[obj].keys
    return keys if "bu_id" in keys else (*keys, "bu_id")


def silver(spark: SparkSession, sf_dir: str, obj: str,
           units: Sequence[str] = BUSINESS_UNITS, **kw) -> DataFrame:
    return to_silver(ENTITIES[obj](spark, sf_dir), obj, units, **kw)


def unit_filter(feed: DataFrame, units: Sequence[str]) -> DataFrame:
    """Restrict a (non-shared) feed to some units before CDC: exact, because a
    unit's silver only ever sees that unit's files."""
    return feed.filter(known_unit(F.col("bu_id"), units))
