"""Batch refresh of the materialised layers: silver -> gold -> enterprise.

Each layer is written (partitioned by ``bu_id``) and the next one reads the
written table, so lineage is cut at every layer and a lost executor only
recomputes from the last written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..model import BUSINESS_UNITS
from ..operators import enterprise, marts
from ..operators.publish import materialize, read_table, table_path
from ..sources.binding import ENTITIES
from .silver import to_silver

MART_INPUTS = {
    "sales_mart": ("deals",),
    "finance_mart": ("gl_invoices", "cost_centers"),
    "customer_mart": ("companies", "contacts", "deals"),
}
# marts that are refreshed by name only
MORE_MARTS = {"vendor_bitmaps": ("gl_invoices", "cost_centers")}
ROLLUPS = {
    "bu_sales_performance": ("sales_mart", enterprise.bu_sales_performance),
    "bu_finance_performance": ("finance_mart", enterprise.bu_finance_performance),
    "bu_customer_performance": ("customer_mart", enterprise.bu_customer_performance),
}


def refresh(spark: SparkSession, sf_dir: str, base: str, units: Sequence[str] = BUSINESS_UNITS,
            mart_names: Sequence[str] = tuple(MART_INPUTS), prefix: str = "",
            rollups: bool = True, layout: str = "partitioned",
            feeds: dict[str, DataFrame] | None = None) -> dict[str, str]:
    """Rebuild the given marts (and the silver tables they need). All units are
    a full refresh, which replaces whole tables; fewer replace their partitions.
    ``feeds`` stand in for the bound change feeds of some objects.

    ``layout="partitioned"``: one table per mart, a ``bu_id=`` partition per
    unit. ``layout="isolated"``: every unit's gold marts under its own
    location ``{base}/{prefix}{unit}/gold/{mart}`` (a unit can be handed over
    as a directory); the enterprise roll-up then unions the unit marts by
    name.
    """
    if layout == "isolated":
        return _refresh_isolated(spark, sf_dir, base, units, mart_names, prefix, rollups, feeds)
    paths: dict[str, str] = {}
    feeds = feeds or {}
    only = None if set(units) >= set(BUSINESS_UNITS) else units
    inputs = {**MART_INPUTS, **MORE_MARTS}
    needed = sorted({obj for m in mart_names for obj in inputs[m]})
    for obj in needed:
        paths[obj] = table_path(base, "silver", obj, prefix)
        feed = feeds[obj] if obj in feeds else ENTITIES[obj](spark, sf_dir)
        materialize(to_silver(feed, obj, units), paths[obj], only)
    s = {obj: read_table(spark, paths[obj], units) for obj in needed}
    for m in mart_names:
        paths[m] = table_path(base, "gold", m, prefix)
        materialize(getattr(marts, m)(*(s[obj] for obj in inputs[m])), paths[m], only)
    if rollups:
        for name, (mart, fn) in ROLLUPS.items():
            if mart in mart_names:
                paths[name] = table_path(base, "enterprise", name, prefix)
                materialize(fn(read_table(spark, paths[mart])), paths[name])
    return paths


def _refresh_isolated(spark: SparkSession, sf_dir: str, base: str, units: Sequence[str],
                      mart_names: Sequence[str], prefix: str, rollups: bool,
                      feeds: dict[str, DataFrame] | None) -> dict[str, str]:
    shared = refresh(spark, sf_dir, base, units, mart_names, prefix, rollups=False, feeds=feeds)
    paths = {k: v for k, v in shared.items() if k not in MART_INPUTS}
    for m in mart_names:
        mart = read_table(spark, shared[m])
        for unit in units:
            unit_path = table_path(f"{base}/{prefix}{unit}", "gold", m)
            # one unit's partition, written where only that unit's readers look
            mart.filter(mart["bu_id"] == unit).write.mode("overwrite").parquet(unit_path)
            paths[f"{unit}.{m}"] = unit_path
    if rollups:
        for name, (mart, fn) in ROLLUPS.items():
            if mart in mart_names:
                unit_marts = [spark.read.parquet(paths[f"{u}.{mart}"]) for u in units]
                paths[name] = table_path(base, "enterprise", name, prefix)
                materialize(fn(enterprise.union_units(unit_marts)), paths[name])
    return paths
