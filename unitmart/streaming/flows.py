"""Triggered (``availableNow``) flows: landing -> bronze -> staging -> silver.

Each flow is a Structured Streaming query with its own checkpoint, so every
landed file is taken exactly once across runs (the file source remembers
paths), and a run processes whatever arrived since the last one, then stops.
A micro-batch takes at most ``MAX_BYTES_PER_TRIGGER`` of files, so a backlog is
worked off in bounded steps.
Checkpoints and tables live under the shared checkpoint root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.landing import LANDING_PARTITIONS, TENANT, quarantine, read_landing
from ..session import path_exists
from .quality_log import QualityLog
from .state import ChangeTable


MAX_BYTES_PER_TRIGGER = str(64 << 30)
COMPRESSION = "zstd"  # landed text and the rows parsed from it repeat themselves


def _await(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced by awaitTermination
        raise query.exception()


def start_bronze(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint: str,
                 fmt: str = "lines", partitions: tuple[str, ...] = LANDING_PARTITIONS, archive: str | None = None):
    """Start the triggered flow appending new landed files to the bronze table
    (one row per line or per file); returns the running query, or None when
    nothing has been landed for the object yet. With an ``archive`` folder,
    files of finished batches move there (when the next batch begins), so that
    listing does not grow with history."""
    if not path_exists(spark, landing_dir):
        return None
    raw = read_landing(spark, landing_dir, fmt=fmt, stream=True, partitions=partitions,
                       max_bytes=MAX_BYTES_PER_TRIGGER, archive=archive)
    parts = [c for c in (TENANT,) if c in raw.columns]
    return (raw.writeStream.format("parquet").partitionBy(*parts)
            .option("compression", COMPRESSION).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(bronze_dir))


def run_bronze(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint: str,
               fmt: str = "lines", partitions: tuple[str, ...] = LANDING_PARTITIONS,
               archive: str | None = None) -> None:
    await_all([start_bronze(spark, landing_dir, bronze_dir, checkpoint, fmt, partitions, archive)])


def await_all(queries) -> None:
    """Wait for concurrently started triggered flows; re-raise the first failure."""
    for q in queries:
        if q is not None:
            _await(q)


def bronze_schema(partitions: tuple[str, ...] = LANDING_PARTITIONS) -> str:
    """Bronze columns: the landed text, its partition values and source file."""
    return ", ".join(["value string", *[f"{c} string" for c in partitions], "_file string"])


def bronze_stream(spark: SparkSession, bronze_dir: str,
                  partitions: tuple[str, ...] = LANDING_PARTITIONS) -> DataFrame:
    return (spark.readStream.schema(bronze_schema(partitions))
            .option("maxBytesPerTrigger", MAX_BYTES_PER_TRIGGER).parquet(bronze_dir))


def run_staging_to_table(spark: SparkSession, bronze_dir: str, staged_dir: str, checkpoint: str,
                         stage: Callable[[DataFrame], DataFrame],
                         partitions: tuple[str, ...] = LANDING_PARTITIONS) -> None:
    """Persist the staged changes (a private table, used for inspection)."""
    if not path_exists(spark, bronze_dir):
        return
    _await(stage(bronze_stream(spark, bronze_dir, partitions)).writeStream.format("parquet")
           .option("compression", COMPRESSION).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start(staged_dir))


def start_silver(spark: SparkSession, bronze_dir: str, checkpoint: str,
                 stage: Callable[[DataFrame], DataFrame], table: ChangeTable,
                 partitions: tuple[str, ...] = LANDING_PARTITIONS):
    """Start the triggered flow applying staged changes of new bronze rows to
    the keyed state; returns the running query (None without a bronze table)."""
    if not path_exists(spark, bronze_dir):
        return None
    return (stage(bronze_stream(spark, bronze_dir, partitions)).writeStream
            .foreachBatch(table.foreach_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_silver(spark: SparkSession, bronze_dir: str, checkpoint: str,
               stage: Callable[[DataFrame], DataFrame], table: ChangeTable,
               partitions: tuple[str, ...] = LANDING_PARTITIONS, log: QualityLog | None = None,
               flow: str = "silver") -> None:
    """``log`` stores what the flow's rules counted, also if the flow fails."""
    query = start_silver(spark, bronze_dir, checkpoint, stage, table, partitions)
    if query is None:
        return
    if log is not None:
        log.track(query, flow)
    try:
        await_all([query])
    finally:
        if log is not None:
            log.store([query])


def start_quarantine(spark: SparkSession, bronze_dir: str, quarantine_dir: str, checkpoint: str,
                     schema, partitions: tuple[str, ...] = LANDING_PARTITIONS):
    """Start the triggered flow keeping landed texts that parse to nothing
    (malformed or empty files), with the file they came from."""
    if not path_exists(spark, bronze_dir):
        return None
    return (quarantine(bronze_stream(spark, bronze_dir, partitions), schema).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .start(quarantine_dir))
