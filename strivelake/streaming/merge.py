"""T-1 / T-3 / K-5: incremental merge of the change log into the current-state table.

``readStream`` -> ``foreachBatch(merge)`` -> ``trigger(availableNow=True)``. Micro-batch *n* keeps
the latest event per key and appends it to the state as changes *n*; base and changes are folded
when the changes have grown (:mod:`strivelake.sources.state`). Deletes stay as markers, so the
state is the newest change of every key for any arrival order. The checkpoint advances only after
the batch function returns (at-least-once), and a retried batch rewrites its own parts from the
same input, so the result is exactly-once.

A quality gate may stand in front: rows that break a rule go to a quarantine folder, and a batch
with too large a share of them stops the run before anything is written.

A version log that cannot be read stops the run, a first load needs an empty folder, and a
checkpoint never writes below versions of another checkpoint: the state cannot be replaced by
a single batch, nor a replay be hidden under newer versions.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strivelake.operators.cdc import (
    fold_changes, initial_state, latest_per_key, live_rows, op_histogram, parse_changes, to_state_rows,
)
from strivelake.operators.quality import Gate
from strivelake.sources.changes import read_changes
from strivelake.sources.state import (
    StatePolicy, append_changes, fold, foreign_versions, holds_data, layout, needs_fold, read_state,
)
from strivelake.sources.tables import default_format
from strivelake.streaming.progress import ProgressLog

KNOWN_OPS = ("c", "r", "u", "d")

# Called with the live rows of a batch's keys before and after it, and the batch id.
Watch = Callable[[DataFrame, DataFrame, int], None]


@dataclass
class MergeRun:
    table: str
    checkpoint: str
    batches: int
    metrics: list = field(default_factory=list)


# MERGE condition of the Delta path: the order of LOG_ORDER. Deletes are marked, not removed.
NEWER = ("(s.kafka_offset > t.kafka_offset OR t.kafka_offset IS NULL "
         "OR (s.kafka_offset = t.kafka_offset AND s.kafka_partition >= t.kafka_partition))")


def merge_batch_delta(spark: SparkSession, latest: DataFrame, table: str) -> None:
    """Delta MERGE: only files holding touched keys are rewritten; markers stay in the table."""
    from delta.tables import DeltaTable

    rows = to_state_rows(latest)
    if not DeltaTable.isDeltaTable(spark, table):
        if live_rows(rows).isEmpty():
            raise ValueError("first load of the state table: no upsert event")
        rows.write.format("delta").mode("overwrite").save(table)
        return
    (DeltaTable.forPath(spark, table).alias("t")
     .merge(rows.alias("s"), "t.id = s.id")
     .whenMatchedUpdateAll(condition=NEWER)
     .whenNotMatchedInsertAll()
     .execute())


def load_state(spark: SparkSession, table: str) -> DataFrame:
    """The live rows of the state, in whichever format the jobs wrote it."""
    if default_format() == "delta":
        from delta.tables import DeltaTable
        if DeltaTable.isDeltaTable(spark, table):
            return live_rows(spark.read.format("delta").load(table))
    return read_state(spark, table)


def merge_batch(spark: SparkSession, batch: DataFrame, batch_id: int, table: str,
                fmt: str = "parquet", writer: str | None = None,
                policy: StatePolicy = StatePolicy(), gate: Gate | None = None,
                watch: Watch | None = None) -> dict:
    """The foreachBatch body: parse, keep the latest event per id, append, fold when due.

    ``watch`` maintains what is derived from the state; it runs before the batch is listed, so a
    retry runs it again (Parquet state only). ``writer`` identifies the checkpoint. Returns the batch counters: events_read, ids_touched,
    by_op (changes per operation, deletes included), and quarantined when a gate stands in front.
    """
    seen = Observation("events")
    parsed = parse_changes(batch).observe(seen, F.count(F.lit(1)).alias("events_read"))
    metrics = {"batch_id": int(batch_id)}
    checked = None
    if gate is not None:
        checked = gate.check(parsed).persist(StorageLevel.MEMORY_AND_DISK)
        parsed = gate.passed(checked)
    latest = latest_per_key(parsed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if checked is not None:
            metrics["quarantined"] = gate.divert(checked, batch_id)
        known_op = F.when(F.col("last_op").isin(*KNOWN_OPS), F.col("last_op")).otherwise("other")
        by_op = {r["last_op"]: r["n"]
                 for r in op_histogram(latest.select(known_op.alias("last_op"))).collect()}
        metrics.update(seen.get, ids_touched=sum(by_op.values()), by_op=by_op)
        if not by_op:  # nothing parsed: no new version, the state stays as it was
            return metrics
        if fmt == "delta":
            merge_batch_delta(spark, latest, table)
            return metrics
        if foreign_versions(spark, table, batch_id, writer):
            raise RuntimeError(f"{table} has versions from {batch_id} on that this checkpoint did not "
                               "write; use a new table folder to replay")
        stored = layout(spark, table, below=batch_id)
        first = stored.base is None and not stored.pending
        if first and holds_data(spark, table, except_version=batch_id):
            raise RuntimeError(f"{table} holds data but no committed version below {batch_id}")
        if first and initial_state(latest).isEmpty():
            raise ValueError("first load of the state table: no upsert event")
        if watch is not None:
            rows = to_state_rows(latest)
            stored_rows = rows.limit(0) if first else read_state(spark, table, below=batch_id, markers=True)
            before = stored_rows.join(latest.select("id"), "id", "left_semi").select(*rows.columns)
            watch(live_rows(before), live_rows(fold_changes(before, rows)), batch_id)
        append_changes(to_state_rows(latest), table, batch_id, writer)
        if needs_fold(layout(spark, table, below=batch_id + 1), policy):
            metrics["live_rows"] = fold(spark, table, batch_id, writer, policy)
        return metrics
    finally:
        latest.unpersist()
        if checked is not None:
            checked.unpersist()


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The query id that Spark keeps in a checkpoint folder (another folder, another id)."""
    return spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]


def run_incremental_merge(spark: SparkSession, source: str, table: str, checkpoint: str, *,
                          fmt: str = "parquet", options: dict | None = None,
                          table_format: str | None = None, policy: StatePolicy = StatePolicy(),
                          gate: Gate | None = None, watch: Watch | None = None,
                          progress: ProgressLog | None = None,
                          starting_offsets: dict | None = None) -> MergeRun:
    """One run: everything new in the log since the checkpoint, then stop.

    ``fmt`` is the log source (parquet/json folder or kafka); ``table_format`` is ``delta`` when
    Delta is on the class path (default), else the bucketed Parquet state. A first run may start
    from saved offsets; ``progress`` keeps Spark's counters of every batch.
    """
    metrics: list = []
    table_fmt = table_format or default_format()

    def body(df: DataFrame, batch_id: int) -> None:
        metrics.append(merge_batch(spark, df, batch_id, table, table_fmt,
                                   checkpoint_id(spark, checkpoint), policy, gate, watch))

    log = read_changes(spark, source, fmt=fmt, options=options, starting_offsets=starting_offsets)
    if progress is not None:
        spark.streams.addListener(progress)
    q = (log.writeStream.foreachBatch(body)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    try:
        q.awaitTermination()
    finally:
        if progress is not None:
            progress.flush(spark, q.runId)
            spark.streams.removeListener(progress)
    if q.exception() is not None:  # pragma: no cover - surfaced by awaitTermination
        raise q.exception()
    if metrics and metrics[-1]["ids_touched"] and "live_rows" not in metrics[-1]:
        metrics[-1]["live_rows"] = load_state(spark, table).count()   # M-7: keys and versions are read
    return MergeRun(table=table, checkpoint=checkpoint, batches=len(metrics), metrics=metrics)


def reset_and_replay(spark: SparkSession, source: str, table: str, checkpoint: str, **kw) -> MergeRun:
    """K-5 / T-3: forget progress by using a new checkpoint and a new table folder.

    The caller picks fresh paths (nothing is deleted; a table that another checkpoint wrote
    is refused); the replay rebuilds the state from the earliest record.
    """
    return run_incremental_merge(spark, source, table, checkpoint, **kw)
