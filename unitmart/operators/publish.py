"""Materialised tables: one directory per (layer, table), partitioned by unit.

Tenant isolation is a partition directory (``bu_id=…``), so a unit's reader
prunes to its own files. A full publish replaces the whole table. Publishing
named units replaces exactly theirs: a named unit that has no rows any more
loses its partition, the other units' files stay untouched. A table without
rows keeps one empty file, so that it can be read with its columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import list_names, remove_path


def table_path(base: str, layer: str, name: str, prefix: str = "") -> str:
    """``{base}/{prefix}{layer}/{name}``; ``prefix`` isolates environments."""
    return f"{base.rstrip('/')}/{prefix}{layer}/{name}"


# partition of the empty file of a table without rows; no unit has this name
NO_UNIT = "bu_id=EMPTY"


def keep_readable(df: DataFrame, path: str) -> None:
    """A partitioned write of no rows leaves no file to take columns from: add
    an empty one."""
    if not any(name.startswith("bu_id=") for name in list_names(df.sparkSession, path)):
        df.sparkSession.createDataFrame([], df.drop("bu_id").schema).write.mode("overwrite").parquet(f"{path}/{NO_UNIT}")


def materialize(df: DataFrame, path: str, units: Sequence[str] | None = None) -> None:
    """``units``: the units that ``df`` is the new content of; None means all."""
    if units is None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bu_id").parquet(path)
        keep_readable(df, path)
        return
    seen = Observation()
    rows = df.filter(F.col("bu_id").isin(list(units))).observe(seen, F.collect_set("bu_id").alias("units"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bu_id").parquet(path))
    for unit in set(units) - set(seen.get["units"] or []):  # at most the named units
        remove_path(df.sparkSession, f"{path}/bu_id={unit}")
    keep_readable(df, path)


def read_table(spark: SparkSession, path: str, units: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if units is None else df.filter(df["bu_id"].isin(list(units)))
