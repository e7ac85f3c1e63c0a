"""One incremental run of the whole flow for every object: ingest the new
changes, run the triggered bronze/silver flows, then publish gold marts from
the silver state and the enterprise roll-ups.

Re-running after new changes arrive only lands, streams and merges what is
new, and publishes only the units that the new changes touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import BUSINESS_UNITS, OBJECTS
from ..operators import marts
from ..operators.publish import materialize, read_table, table_path
from ..session import path_exists
from ..sources.ingest import ingest
from ..streaming.state import ChangeTable
from .refresh import MART_INPUTS, MORE_MARTS, ROLLUPS
from .stream_refresh import silver_view, stream_objects


def run_all(spark: SparkSession, feeds: dict[str, DataFrame], root: str,
            units: Sequence[str] = BUSINESS_UNITS) -> dict[str, str]:
    """``feeds``: object name -> its source DataFrame (a change feed)."""
    for obj, feed in feeds.items():
        ingest(spark, feed, OBJECTS[obj].source_system, obj, f"{root}/landing", f"{root}/audit")
    schemas = {obj: f.schema for obj, f in feeds.items()}
    tables = stream_objects(
        spark, root, {obj: (OBJECTS[obj].source_system, schema) for obj, schema in schemas.items()}, units=units)
    published = publish_changed(spark, tables, schemas, root)
    return {name: table_path(root, layer, name) for mart in published
            for layer, name in [("gold", mart), *(("enterprise", r) for r, (m, _) in ROLLUPS.items() if m == mart)]}


def published_upto(spark: SparkSession, root: str, mart: str) -> dict[str, int]:
    """Last change batch of each object that the published mart holds."""
    path = f"{root}/published/{mart}"
    if not path_exists(spark, path):
        return {}
    return {r.object: int(r.upto) for r in spark.read.parquet(path).groupBy("object").agg(F.max("upto").alias("upto")).collect()}


def publish_changed(spark: SparkSession, tables: dict[str, ChangeTable], schemas: dict, root: str,
                    mart_names: Sequence[str] = tuple(MART_INPUTS)) -> dict[str, list[str] | None]:
    """Publish marts and their roll-ups anew for the units with changes since
    the mart was published last; other units' files stay as they are.

    The units come from the names of the change batches' partitions, so nothing
    is read to find them. Returns the units of each mart (None: all of them, the
    first time or after a compaction). What a mart holds is noted after its
    tables are written: a crash before repeats the same units.
    """
    inputs = {**MART_INPUTS, **MORE_MARTS}
    done: dict[str, list[str] | None] = {}
    for mart in mart_names:
        if not all(obj in tables for obj in inputs[mart]):
            continue
        before = published_upto(spark, root, mart)
        upto = {obj: tables[obj].last_batch() for obj in inputs[mart]}
        parts = [tables[obj].touched(before[obj]) if obj in before else None for obj in inputs[mart]]
        units = None if any(p is None for p in parts) else sorted(set().union(*parts))
        done[mart] = units
        if units == []:
            continue
        views = [silver_view(tables[obj], schemas[obj]) for obj in inputs[mart]]
        if units is not None:  # reaches the partitions of the change tables
            views = [v.filter(F.col("bu_id").isin(units)) for v in views]
        path = table_path(root, "gold", mart)
        materialize(getattr(marts, mart)(*views), path, units)
        for name, (of, rollup) in ROLLUPS.items():
            if of == mart:
                materialize(rollup(read_table(spark, path, units)), table_path(root, "enterprise", name), units)
        spark.createDataFrame(list(upto.items()), "object string, upto bigint").coalesce(1) \
            .write.mode("append").parquet(f"{root}/published/{mart}")
    return done
