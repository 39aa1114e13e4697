"""M-7: counters of streaming runs that survive them.

A listener receives the progress of every micro-batch from Spark and appends it to a Parquet
folder, so what a run read can be asked for after its session has ended.
"""
from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = ("query_id string, run_id string, batch_id long, started string, input_rows long, "
                   "state_rows long, dropped_by_watermark long, duration_ms long")


class ProgressLog(StreamingQueryListener):
    """Collects the progress of all queries of a session while it is registered.

    The callbacks only note the rows (they must not block the stream); :meth:`flush` writes them.
    """

    def __init__(self, path: str):
        self.path, self.rows, self.ended = path, [], {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        self._end_of(event.runId)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        states = p.stateOperators
        with self._lock:
            self.rows.append((str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows,
                              sum(s.numRowsTotal for s in states),
                              sum(s.numRowsDroppedByWatermark for s in states), p.batchDuration))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end_of(event.runId).set()

    def _end_of(self, run_id) -> threading.Event:
        with self._lock:
            return self.ended.setdefault(str(run_id), threading.Event())

    def flush(self, spark: SparkSession, run_id, timeout: float = 60.0) -> int:
        """Wait for the last event of a run, append what has come in; returns the row count."""
        self._end_of(run_id).wait(timeout)
        with self._lock:
            rows, self.rows = self.rows, []
        if rows:
            spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)
