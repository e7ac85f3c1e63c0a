"""Incremental ingestion: extract -> land -> batch id -> audit -> publish.

The source is read once. A run lands its rows in a directory of its own that
no reader lists (``_runs/{run}``); row count, digest and new watermark are
totalled by that write. Then

* nothing new: the run is dropped;
* a batch of this system and object with an equal row count and complete
  digest is audited already: the run is dropped (replay is a no-op);
* else one audit row commits the run, and its directory is renamed to
  ``batch={id}``.

The audit row decides: ``settle`` (the first step of each run) renames a run
that was audited before a crash and removes every other one. The watermark
*is* the audit (``max(watermark_after)`` of successful batches), so there is no
second copy that could run ahead of the data. One writer per object.

Only scalars reach the driver: row count, the new watermark and the digest.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import ID_LENGTH, digest_measures, digest_text
from ..model import AUDIT_FAILED, AUDIT_SCHEMA, AUDIT_SUCCESS
from ..session import list_names, move_path, path_exists, remove_path
from .extract import incremental, instant
from .landing import DEFAULT_RECORDS_PER_FILE, stamp_lineage, write_landing

RUNS = "_runs"  # file listings pass by names that begin with an underscore
WATERMARK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
AUDIT_COLUMNS = ("batch_id", "source_system", "source_object", "run_timestamp",
                 "records_extracted", "watermark_before", "watermark_after", "status")


@dataclass(frozen=True)
class BatchResult:
    batch_id: str | None
    records: int
    watermark_before: str | None
    watermark_after: str | None
    status: str  # SUCCESS, SKIPPED (already audited), EMPTY (nothing new)
    path: str | None


def _read_audit(spark: SparkSession, audit_root: str) -> DataFrame | None:
    if not path_exists(spark, audit_root):
        return None
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_root)


def current_watermark(spark: SparkSession, audit_root: str, source_system: str,
                      object_name: str) -> str | None:
    audit = _read_audit(spark, audit_root)
    if audit is None:
        return None
    row = (audit.filter((F.col("status") == AUDIT_SUCCESS)
                        & (F.col("source_system") == source_system)
                        & (F.col("source_object") == object_name))
           .agg(F.date_format(F.max("watermark_after"), WATERMARK_FORMAT).alias("wm")).first())
    return row["wm"] if row else None


def _landed(spark: SparkSession, audit_root: str, source_system: str, object_name: str) -> DataFrame | None:
    """Audit rows of the landed batches of one object of one system."""
    audit = _read_audit(spark, audit_root)
    return None if audit is None else audit.filter(
        (F.col("status") == AUDIT_SUCCESS) & (F.col("source_system") == source_system)
        & (F.col("source_object") == object_name))


def landed_as(spark: SparkSession, audit_root: str, source_system: str, object_name: str, digest: str,
              rows: int) -> tuple[str, bool]:
    """(batch id for this content, whether it is landed already). The same
    content is an audited batch of this system and object with an equal row
    count and complete digest; a different one that shares the short id gets a
    longer id."""
    done = _landed(spark, audit_root, source_system, object_name)
    if done is None:
        return digest[:ID_LENGTH], False
    same = done.filter((F.col("content_digest") == digest) & (F.col("records_extracted") == rows)).first()
    if same is not None:
        return same["batch_id"], True
    taken = done.filter(F.col("batch_id") == digest[:ID_LENGTH]).limit(1).count() > 0
    return (digest if taken else digest[:ID_LENGTH]), False


def append_audit(spark: SparkSession, audit_root: str, batch: str, source_system: str,
                 object_name: str, records: int, wm_before: str | None, wm_after: str | None,
                 status: str = AUDIT_SUCCESS, digest: str | None = None, run: str | None = None) -> None:
    row = spark.createDataFrame(
        [(batch, source_system, object_name, records, wm_before, wm_after, status, digest, run)],
        "batch_id string, source_system string, source_object string, records_extracted long, "
        "wb string, wa string, status string, content_digest string, run_id string")
    out = row.select(
        "batch_id", "source_system", "source_object",
        F.current_timestamp().alias("run_timestamp"), "records_extracted",
        F.col("wb").cast("timestamp").cast("timestamp_ntz").alias("watermark_before"),
        F.col("wa").cast("timestamp").cast("timestamp_ntz").alias("watermark_after"),
        "status", "content_digest", "run_id")
    out.coalesce(1).write.mode("append").parquet(audit_root)


def object_path(landing_root: str, source_system: str, object_name: str) -> str:
    return f"{landing_root}/{source_system}/{object_name}"


def settle(spark: SparkSession, landing_root: str, audit_root: str, source_system: str, object_name: str) -> None:
    """Finish what a crashed run left: publish it if it is audited, else drop it."""
    path = object_path(landing_root, source_system, object_name)
    runs = list_names(spark, f"{path}/{RUNS}")
    if not runs:
        return
    done = _landed(spark, audit_root, source_system, object_name)
    batches = {} if done is None else {
        r.run_id: r.batch_id for r in done.filter(F.col("run_id").isin(runs)).select("run_id", "batch_id").collect()}
    for run in runs:
        _publish(spark, path, run, batches.get(run))


def _publish(spark: SparkSession, path: str, run: str, batch: str | None) -> None:
    """Rename an audited run to its batch; without a batch remove it."""
    if batch is None or path_exists(spark, f"{path}/batch={batch}"):
        remove_path(spark, f"{path}/{RUNS}/{run}")
    else:
        move_path(spark, f"{path}/{RUNS}/{run}", f"{path}/batch={batch}")


def ingest(spark: SparkSession, feed: DataFrame, source_system: str, object_name: str,
           landing_root: str, audit_root: str, watermark: str | None = None,
           use_stored_watermark: bool = True, fmt: str = "lines",
           sequence: str = "updated_at", ingested_at: Column | None = None, tenant_col: str | None = "bu_id",
           records_per_file: int = DEFAULT_RECORDS_PER_FILE,
           lookback_seconds: int = 0) -> BatchResult:
    """Land the rows of ``feed`` changed after the watermark as one batch.

    ``watermark`` overrides the stored one (replays, back-fills);
    ``lookback_seconds`` also re-reads rows committed late with a timestamp
    just before the mark (the strict ``>`` would miss them; CDC absorbs the
    repeats).
    """
    settle(spark, landing_root, audit_root, source_system, object_name)
    wm_before = watermark
    if wm_before is None and use_stored_watermark:
        wm_before = current_watermark(spark, audit_root, source_system, object_name)
    extract = incremental(feed, wm_before, sequence, lookback_seconds=lookback_seconds)
    path, run = object_path(landing_root, source_system, object_name), uuid.uuid4().hex
    measures = digest_measures(extract) | {"_wm": (F.date_format(sequence, WATERMARK_FORMAT), "max")}
    landed = stamp_lineage(extract, source_system, object_name, None, ingested_at)
    try:
        seen = write_landing(landed, f"{path}/{RUNS}/{run}", fmt, None, records_per_file, tenant_col, measures=measures)
    except Exception:
        remove_path(spark, f"{path}/{RUNS}/{run}")
        append_audit(spark, audit_root, run, source_system, object_name, 0, wm_before, wm_before, AUDIT_FAILED, run=run)
        raise
    rows, wm_after = int(seen.get("_rows") or 0), seen.get("_wm")
    if rows == 0:
        _publish(spark, path, run, None)
        return BatchResult(None, 0, wm_before, wm_before, "EMPTY", None)
    digest = digest_text(f"{source_system}.{object_name}", wm_before, seen)
    batch, landed_before = landed_as(spark, audit_root, source_system, object_name, digest, rows)
    if landed_before:
        _publish(spark, path, run, None)
        return BatchResult(batch, rows, wm_before, wm_after, "SKIPPED", f"{path}/batch={batch}")
    append_audit(spark, audit_root, batch, source_system, object_name, rows, wm_before, wm_after,
                 digest=digest, run=run)
    _publish(spark, path, run, batch)
    return BatchResult(batch, rows, wm_before, wm_after, AUDIT_SUCCESS, f"{path}/batch={batch}")


def run_of(spark: SparkSession, audit_root: str, batch: str) -> str:
    """Run that landed a batch."""
    return _read_audit(spark, audit_root).filter(F.col("batch_id") == batch).first()["run_id"]


def audit_table(spark: SparkSession, audit_root: str) -> DataFrame:
    audit = _read_audit(spark, audit_root)
    if audit is None:
        raise FileNotFoundError(audit_root)
    return audit.select(*AUDIT_COLUMNS)


__all__ = ["ingest", "settle", "current_watermark", "audit_table", "BatchResult", "instant"]
