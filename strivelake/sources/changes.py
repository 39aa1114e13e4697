"""S-1 / S-2: change-log sources.

A Kafka topic when the connector is on the class path, otherwise a folder of
log records ``(value, partition, offset)`` in Parquet or JSON. The streaming
checkpoint replaces the reference's hand-kept offsets file: a run with
``trigger(availableNow=True)`` reads everything new and stops; a run with
nothing new executes zero batches and leaves the state untouched.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strivelake.schemas import LOG_SCHEMA


def read_changes(spark: SparkSession, source: str, *, fmt: str = "parquet",
                 streaming: bool = True, options: dict | None = None,
                 starting_offsets: dict | None = None, arrival: bool = False) -> DataFrame:
    """Log records as (value, partition, offset), with ``arrival`` also arrived_at.

    ``starting_offsets`` (partition to next offset, as :func:`saved_offsets` gives) starts a run at
    saved offsets; partitions that are not listed start at their first record. Kafka seeks to
    them; a folder has no offsets to seek to, so older records are filtered at the scan. A
    checkpoint that exists goes on from its own progress; the filter then holds as well.
    ``arrived_at`` is the time of the topic's record or of the folder's file: it never runs
    backwards, so a watermark on it calls no record late.

    ``fmt="kafka"``: ``source`` is the topic; pass ``kafka.bootstrap.servers`` in
    ``options``. Batch reads take earliest -> latest. ``minPartitions`` defaults to
    the cluster parallelism so that one heavy topic partition is read by several
    tasks. Folder sources are split by ``spark.sql.files.maxPartitionBytes``.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        reader = spark.readStream if streaming else spark.read
        reader = reader.format("kafka").option("subscribe", source)
        # a JSON of offsets must name every partition of the topic
        opts.setdefault("startingOffsets", json.dumps({source: {str(p): int(o) for p, o in starting_offsets.items()}})
                        if starting_offsets else "earliest")
        if not streaming:
            opts.setdefault("endingOffsets", "latest")
        # a hot topic partition is split over several tasks instead of one
        parallelism = _default_parallelism(spark)
        if parallelism:
            opts.setdefault("minPartitions", str(parallelism))
        df = reader.options(**opts).load()
        return df.select(F.col("value").cast("string").alias("value"),
                         F.col("partition").cast("int").alias("partition"),
                         F.col("offset").cast("long").alias("offset"),
                         *([F.col("timestamp").alias("arrived_at")] if arrival else []))
    reader = (spark.readStream if streaming else spark.read).schema(LOG_SCHEMA).options(**opts)
    moment = [F.col("_metadata.file_modification_time").alias("arrived_at")] if arrival else []
    log = reader.format(fmt).load(source).select("value", "partition", "offset", *moment)
    if starting_offsets:
        first = F.create_map(*[F.lit(int(x)) for item in starting_offsets.items() for x in item])
        log = log.filter(F.col("offset") >= F.coalesce(F.try_element_at(first, F.col("partition")), F.lit(0)))
    return log


def saved_offsets(next_offsets: DataFrame) -> dict[int, int]:
    """(kafka_partition, next_offset) rows as a dictionary: one entry per partition of the topic."""
    return {r["kafka_partition"]: r["next_offset"] for r in next_offsets.collect()}


def _default_parallelism(spark: SparkSession) -> int | None:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        return None


def write_log_files(log: DataFrame, folder: str, *, fmt: str = "parquet") -> None:
    """Append log records to a folder read by :func:`read_changes` (one write = one run's input)."""
    log.select("value", "partition", "offset").write.mode("append").format(fmt).save(folder)
