"""Staging: landed text -> typed, admitted changes of the configured units.

Works on batch and streaming frames alike. Steps, in order: parse
(array-of-struct) -> instants to UTC -> tenant (the path tenant is stamped on
the rows of objects that cannot be shared) -> gate (``operators.gate``, the
same as the batch path's).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import BUSINESS_UNITS
from ..operators.gate import admit
from ..operators.quality import expect_or_drop
from ..sources.extract import parse_instant
from ..sources.landing import TENANT, parse_landing


def stage(raw: DataFrame, schema: T.StructType, instants: Sequence[str] = ("updated_at",),
          shared: bool = False, sequence: str = "updated_at",
          units: Sequence[str] = BUSINESS_UNITS, keys: Sequence[str] = (), revoke: bool = False,
          observation: Observation | str | None = None, rescue: bool = False) -> DataFrame:
    """``observation`` also counts rows whose payload tenant disagrees with
    the path's; ``rescue`` keeps fields outside the schema in ``_rescued``."""
    rows = parse_landing(raw, schema, rescue)
    for c in instants:
        if c in rows.columns:
            rows = rows.withColumn(c, parse_instant(c))
    extra = []
    if "bu_id" not in rows.columns:  # a feed without tenants: only the drop rule
        rows = expect_or_drop(rows, f"valid_{sequence}", f"{sequence} IS NOT NULL", observation)
    else:
        if not shared and TENANT in rows.columns:
            rows = rows.withColumn("_path_mismatch", ~F.col("bu_id").eqNullSafe(F.col(TENANT)))
            rows = rows.withColumn("bu_id", F.col(TENANT))
            extra = [F.sum(F.col("_path_mismatch").cast("int")).alias("path_payload_mismatch")]
        rows = admit(rows, shared, sequence, units, keys, revoke=revoke, observation=observation,
                     extra_metrics=extra)
    return rows.drop(*[c for c in (TENANT, "batch", "_file", "_path_mismatch") if c in rows.columns])
