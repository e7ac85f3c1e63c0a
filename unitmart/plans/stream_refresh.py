"""Streaming refresh of silver: landed batches -> bronze -> staging -> keyed
state, one set of triggered flows per object, then gold from the state views.

Everything is incremental: re-running after new batches land only processes
the new files and appends their changes. What the gate rejects is counted in
the progress of each silver flow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..model import BUSINESS_UNITS, OBJECTS
from ..sources.landing import instant_columns, landing_schema
from ..streaming.flows import (await_all, run_bronze, run_silver, start_bronze,
                               start_quarantine, start_silver)
from ..streaming.quality_log import QualityLog
from ..streaming.staging import stage
from ..streaming.state import ChangeTable
from .silver import tenant_keys


def state_table(spark: SparkSession, root: str, obj: str) -> ChangeTable:
    spec = OBJECTS[obj]
    ties = (("_own",) if spec.shared else ()) + spec.tie_breakers
    return ChangeTable(spark, f"{root}/silver/{obj}", tenant_keys(obj), spec.sequence,
                       spec.delete_flag, ties)


def stream_object(spark: SparkSession, root: str, source_system: str, obj: str,
                  feed_schema, units: Sequence[str] = BUSINESS_UNITS, fmt: str = "lines",
                  revoke: bool = False, rescue: bool = False, log: QualityLog | None = None,
                  archive: str | None = None) -> ChangeTable:
    """Run the object's bronze and silver flows once (``availableNow``).
    ``rescue`` keeps fields outside the schema, ``log`` stores the rules' counts,
    ``archive`` takes landed files that are done with."""
    spec = OBJECTS[obj]
    schema = landing_schema(feed_schema)
    instants = instant_columns(feed_schema) or [spec.sequence]

    def staged(raw: DataFrame) -> DataFrame:
        return stage(raw, schema, instants, shared=spec.shared, sequence=spec.sequence, units=units,
                     keys=spec.keys, revoke=revoke, observation=f"quality_{obj}", rescue=rescue)

    table = state_table(spark, root, obj)
    landing = f"{root}/landing/{source_system}/{obj}"
    run_bronze(spark, landing, f"{root}/bronze/{obj}", f"{root}/ck/bronze_{obj}", fmt, archive=archive)
    run_silver(spark, f"{root}/bronze/{obj}", f"{root}/ck/silver_{obj}", staged, table, log=log, flow=f"silver_{obj}")
    return table


def stream_objects(spark: SparkSession, root: str, objects: dict[str, tuple[str, object]],
                   units: Sequence[str] = BUSINESS_UNITS, fmt: str = "lines",
                   keep_quarantine: bool = False) -> dict[str, ChangeTable]:
    """Run the flows of several objects concurrently: all bronze flows, then
    all silver flows (``objects``: name -> (source system, feed schema)).
    ``keep_quarantine`` also keeps unparseable landed texts per object under
    ``{root}/quarantine/{object}``."""
    tables = {obj: state_table(spark, root, obj) for obj in objects}
    await_all([start_bronze(spark, f"{root}/landing/{src}/{obj}", f"{root}/bronze/{obj}",
                            f"{root}/ck/bronze_{obj}", fmt)
               for obj, (src, _) in objects.items()])
    queries = []
    for obj, (_, feed_schema) in objects.items():
        spec = OBJECTS[obj]
        schema = landing_schema(feed_schema)
        instants = instant_columns(feed_schema) or [spec.sequence]
        staged = (lambda sc, ins, sp: lambda raw: stage(
            raw, sc, ins, shared=sp.shared, sequence=sp.sequence, units=units, keys=sp.keys,
            observation=f"quality_{sp.name}"))(schema, instants, spec)
        queries.append(start_silver(spark, f"{root}/bronze/{obj}", f"{root}/ck/silver_{obj}",
                                    staged, tables[obj]))
        if keep_quarantine:
            queries.append(start_quarantine(spark, f"{root}/bronze/{obj}",
                                            f"{root}/quarantine/{obj}",
                                            f"{root}/ck/quarantine_{obj}", schema))
    await_all(queries)
    return tables


def silver_view(table: ChangeTable, feed_schema) -> DataFrame:
    """Live rows of a state table in the feed's columns (empty before the
    first batch)."""
    view = table.view()
    if view is None:
        return table.spark.createDataFrame([], feed_schema)
    return view.select(*feed_schema.fieldNames())
