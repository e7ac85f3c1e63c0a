"""Current state of a keyed object from an append-only change table (SCD1
without a MERGE-capable table format).

A micro-batch only appends its staged changes, under its own batch id, so a
retried batch replaces what it wrote. The state is ``latest_per_key`` over the
last snapshot and the changes after it; it does not depend on how the changes
were cut into batches. ``compact`` stores that state as a new snapshot, at the
session's shuffle width, then moves the pointer (one appended row) and removes
what it superseded. Tombstones are kept, so an older change that arrives after
a delete never revives a key. One writer per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import DELETED, apply_changes, latest_per_key, live
from ..operators.publish import NO_UNIT, keep_readable
from ..session import list_names, path_exists, remove_path, unsorted_writes

BATCH = "_batch"
COMPRESSION = "zstd"


class ChangeTable:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str],
                 sequence: str = "updated_at", delete_flag: str = "is_deleted",
                 tie_breakers: Sequence[str] = ()):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.rule = dict(sequence=sequence, delete_flag=delete_flag, tie_breakers=tuple(tie_breakers))

    def pointer(self) -> tuple[int, int]:
        """(snapshot number, last batch in it); (-1, -1) before the first."""
        path = f"{self.root}/pointer"
        if not path_exists(self.spark, path):
            return -1, -1
        row = self.spark.read.parquet(path).agg(F.max(F.struct("snapshot", "upto")).alias("p")).first()
        return int(row.p.snapshot), int(row.p.upto)

    def batches(self) -> list[int]:
        """Stored batches, in order (without those that a snapshot replaced)."""
        return sorted(int(n.split("=")[1]) for n in list_names(self.spark, f"{self.root}/changes") if n.startswith(BATCH))

    def last_batch(self) -> int:
        return max([self.pointer()[1], *self.batches()])

    def touched(self, after: int) -> list[str] | None:
        """Units with changes in batches after ``after``, from the names of their
        partitions; None (any unit) if a snapshot has replaced such a batch."""
        if self.pointer()[1] > after:
            return None
        names = {n for b in self.batches() if b > after
                 for n in list_names(self.spark, f"{self.root}/changes/{BATCH}={b}") if n.startswith("bu_id=")}
        return sorted(n.split("=", 1)[1] for n in names - {NO_UNIT})

    def append(self, changes: DataFrame, batch_id: int) -> None:
        if batch_id <= self.pointer()[1]:
            return  # a retried batch that a snapshot already holds
        parts = ["bu_id"] if "bu_id" in changes.columns else []
        path = f"{self.root}/changes/{BATCH}={batch_id}"
        with unsorted_writes(changes.sparkSession):
            changes.write.mode("overwrite").partitionBy(*parts).option("compression", COMPRESSION).parquet(path)
        if parts:
            keep_readable(changes, path)

    foreach_batch = append

    def _snapshot(self, number: int) -> DataFrame | None:
        return None if number < 0 else self.spark.read.parquet(f"{self.root}/snapshots/n={number}")

    def _changes(self, number: int, after: int) -> DataFrame | None:
        path, known = f"{self.root}/changes", self._snapshot(number)
        if not path_exists(self.spark, path):
            return None
        reader = self.spark.read
        if known is not None:  # every batch may be in the snapshot by now
            reader = reader.schema(known.drop(DELETED).withColumn(BATCH, F.lit(0)).schema)
        return reader.parquet(path).filter(F.col(BATCH) > after)

    def state(self) -> DataFrame | None:
        """All keys including tombstones (``_deleted``)."""
        number, upto = self.pointer()
        changes = self._changes(number, upto)
        if number < 0:
            return None if changes is None else latest_per_key(
                changes.drop(BATCH), self.keys, keep_tombstones=True, **self.rule)
        current = self._snapshot(number)
        return current if changes is None else apply_changes(current, changes.drop(BATCH), self.keys, **self.rule)

    def view(self) -> DataFrame | None:
        s = self.state()
        return None if s is None else live(s)

    def compact(self) -> None:
        number, upto = self.pointer()
        changes = self._changes(number, upto)
        last = None if changes is None else changes.agg(F.max(BATCH)).first()[0]
        if last is None:
            return
        self.state().write.mode("overwrite").parquet(f"{self.root}/snapshots/n={number + 1}")
        (self.spark.createDataFrame([(number + 1, int(last))], "snapshot bigint, upto bigint").coalesce(1)
         .write.mode("append").parquet(f"{self.root}/pointer"))
        old = [r[0] for r in changes.select(BATCH).distinct().collect()]  # batches since the last snapshot
        for path in [f"changes/{BATCH}={b}" for b in old] + [f"snapshots/n={number}"]:
            remove_path(self.spark, f"{self.root}/{path}")
