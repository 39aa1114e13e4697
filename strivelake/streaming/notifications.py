"""T-2 / K-6: continuous notifications, one message per create event.

``readStream`` (log) -> create filter -> (repeated deliveries dropped) -> ``foreachBatch``: join
with the names table (built and persisted once per run) or with a log of names at the event's time, message text, and one call of the sink with both frames,
messages and rejects. The shipped sink appends both to Parquet folders; an HTTP poster is a
caller-supplied ``sink(messages, rejects, batch_id)``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strivelake.operators.notify import creates, names_table, notifications, once_per_create
from strivelake.sources.changes import read_changes

Sink = Callable[[DataFrame, DataFrame, int], None]
KEEP = ("kafka_partition", "kafka_offset", "id", "employee_id")


def parquet_sink(folder: str, rejects_folder: str | None = None) -> Sink:
    """Write each batch (idempotent per batch id: one sub-folder per batch); rejects go to
    ``rejects_folder``, by default ``<folder>_rejects``."""
    rejects_folder = rejects_folder or f"{folder.rstrip('/')}_rejects"

    def sink(messages: DataFrame, rejects: DataFrame, batch_id: int) -> None:
        for df, out in ((messages, folder), (rejects, rejects_folder)):
            df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={int(batch_id)}")
    return sink


def create_stream(spark: SparkSession, source: str, *, fmt: str = "parquet",
                  options: dict | None = None, once_within: str | None = None) -> DataFrame:
    """The create events of the log; with ``once_within`` repeated deliveries are dropped."""
    opts = dict(options or {})
    if fmt == "kafka":  # a new consumer starts at the end of the topic
        opts.setdefault("startingOffsets", "latest")
    if once_within is None:
        return creates(read_changes(spark, source, fmt=fmt, options=opts), timed=True)
    log = read_changes(spark, source, fmt=fmt, options=opts, arrival=True)
    return once_per_create(creates(log, carry=("arrived_at",), timed=True), once_within)


def run_notifications(spark: SparkSession, source: str, names: DataFrame | Callable[[], DataFrame],
                      sink: Sink | str, checkpoint: str, *, fmt: str = "parquet",
                      options: dict | None = None, available_now: bool = True, muted: bool = False,
                      once_within: str | None = None, keep: tuple[str, ...] = KEEP) -> StreamingQuery:
    """Start the query; ``muted`` consumes the log without calling the sink.

    ``sink`` is a function, or ``"memory:<name>"`` for Spark's in-memory table sink (the
    messages only, queryable as ``<name>``; for tests and notebooks). ``names`` is the names
    table, built and persisted for the life of the query, or a function that gives the log of
    names: it is called for every batch, and a name is the one at the event's time.
    ``once_within`` sends one message for a create that the log repeats within that time.
    """
    created = create_stream(spark, source, fmt=fmt, options=options, once_within=once_within)
    lookup = None if callable(names) else names_table(names).persist(StorageLevel.MEMORY_AND_DISK)
    if isinstance(sink, str) and sink.startswith("memory:"):
        messages, _ = notifications(created, names() if lookup is None else lookup, keep=keep,
                                    looked_up=lookup is not None, at_event=lookup is None)
        w = (messages.writeStream.format("memory").queryName(sink.split(":", 1)[1])
             .outputMode("append"))
    else:
        def body(df: DataFrame, batch_id: int) -> None:
            if muted:
                return
            batch = df.persist(StorageLevel.MEMORY_AND_DISK)  # parsed once for both frames
            try:
                found = notifications(batch, names(), keep=keep, at_event=True) if lookup is None \
                    else notifications(batch, lookup, keep=keep, looked_up=True)
                sink(*found, batch_id)
            finally:
                batch.unpersist()

        w = created.writeStream.foreachBatch(body)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def notify_once(spark: SparkSession, source: str, names: DataFrame | Callable[[], DataFrame],
                sink: Sink, checkpoint: str, **kw) -> None:
    """One availableNow run to its end; the names persisted for it are released."""
    query = run_notifications(spark, source, names, sink, checkpoint, available_now=True, **kw)
    try:
        query.awaitTermination()
    finally:
        if not callable(names):
            names_table(names).unpersist()   # the same plan: Spark's cache finds it
