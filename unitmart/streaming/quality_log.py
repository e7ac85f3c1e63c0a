"""Stored quality log: what the rules of each flow counted, per micro-batch.

The gate's counts (``DataFrame.observe``) end in the progress of a streaming
query, which is gone when the query is. ``QualityLog`` listens to all queries
of the session and stores the counts of the flows it is asked to: one row per
flow, batch and rule, and one row ``flow_failed`` with the error for a flow that
a fail rule has stopped. A batch that is run again is logged again;
``quality_counts`` keeps the last entry.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

LOG_SCHEMA = ("query_id string, flow string, batch bigint, rule string, rows bigint, detail string, "
              "logged_at string")
FAILED = "flow_failed"
STORE_ROWS = 10_000     # entries kept before those of tracked flows are stored
WAIT_SECONDS = 120


class QualityLog(StreamingQueryListener):
    """Use as a context: the listener is removed at its end."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._entries: dict[str, list[tuple]] = {}  # query id -> rows
        self._flows: dict[str, str] = {}            # tracked query id -> flow
        self._ended: set[str] = set()               # run ids
        self._change = threading.Condition()

    def __enter__(self) -> QualityLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [(str(p.id), flow, int(p.batchId), rule, int(value or 0), None, p.timestamp)
                for flow, counts in p.observedMetrics.items() for rule, value in counts.asDict().items()]
        with self._change:
            self._entries.setdefault(str(p.id), []).extend(rows)
            full = sum(map(len, self._entries.values())) >= STORE_ROWS
        if full:
            self._store(list(self._flows))

    def onQueryTerminated(self, event) -> None:
        with self._change:
            if event.exception:
                key = str(event.id)
                self._entries.setdefault(key, []).append((key, None, None, FAILED, 1, event.exception[:2000], None))
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def track(self, query, flow: str) -> None:
        """Name the flow that a started query runs."""
        with self._change:
            self._flows[str(query.id)] = flow

    def store(self, queries: Sequence) -> None:
        """Write the entries of ended queries; waits for their last events."""
        runs = {str(q.runId) for q in queries}
        with self._change:
            if not self._change.wait_for(lambda: runs <= self._ended, WAIT_SECONDS):
                raise TimeoutError("the listener has not seen the end of a flow")
            self._ended -= runs
        self._store([str(q.id) for q in queries])

    def _store(self, ids: Sequence[str]) -> None:
        with self._change:
            rows = [(key, self._flows.get(key, flow), *rest) for i in ids for key, flow, *rest in self._entries.pop(i, [])]
        if rows:
            self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def quality_counts(spark: SparkSession, path: str) -> DataFrame:
    """(flow, batch, rule, rows, detail): the last entry of each batch and rule."""
    last = Window.partitionBy("query_id", "flow", "batch", "rule").orderBy(F.desc("logged_at"), F.desc("rows"))
    return (spark.read.schema(LOG_SCHEMA).parquet(path).withColumn("_n", F.row_number().over(last)).where("_n = 1")
            .select("flow", "batch", "rule", "rows", "detail"))
