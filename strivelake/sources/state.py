"""S-5 / T-1: the current state of the change log, in Spark's bucketed tables.

A state folder holds

* ``base-<n>``: the newest row of every key up to batch n, bucketed and sorted by the key,
* ``changes-<n>``: the newest change per key of batch n alone, a plain Parquet folder,
* ``_versions``: an append-only log of what has been written completely, with row counts.

A micro-batch appends its changes, so its cost follows the batch, not the state. Once the pending
changes are a certain share of the base, base and changes are folded into a new base: a full outer
join in which the base is not shuffled (its bucketing is the join's partitioning) and the result
is written bucket by bucket. The number of buckets follows the row count, so a bucket stays at the
size of one task, and grows with the table.

Deletes stay in the state as markers (the row of the delete with its offset and partition). Without
them an older change that arrives after the delete would bring the key back. Readers do not see
markers; a fold drops those whose event is older than the newest event by the retention.

The state is the newest change of every key by ``LOG_ORDER``, whatever the order and the batches in
which the changes arrive. Base and changes of one batch are rewritten by a retry under the same
name and listed only when complete, so a batch counts once.
"""
from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strivelake.operators.cdc import expire_markers, fold_changes, live_rows, newest_rows
from strivelake.sources.tables import is_missing

VERSIONS = "_versions"
LOG_SCHEMA = "version long, kind string, buckets int, row_count long, live long, writer string, schema string"
BASE, CHANGES = "base", "changes"
KEY = "id"


@dataclass(frozen=True)
class StatePolicy:
    """When to fold and how large a bucket may be."""
    bucket_rows: int = 1_000_000       # rows of a bucket, about 200 MB
    fold_share: float = 0.25           # pending changes, as a share of the base
    fold_batches: int = 64             # or that many pending batches
    retention_ms: int | None = 30 * 24 * 3600 * 1000   # of delete markers; None: for ever

    def buckets(self, rows: int) -> int:
        return max(1, -(-int(rows) // self.bucket_rows))


@dataclass(frozen=True)
class Layout:
    """The base and the pending changes of a state."""
    base: Row | None
    pending: list

    @property
    def pending_rows(self) -> int:
        return sum(r["row_count"] for r in self.pending)

    @property
    def rows(self) -> int:
        return (self.base["row_count"] if self.base else 0) + self.pending_rows


def part_path(path: str, kind: str, version: int) -> str:
    return f"{path.rstrip('/')}/{kind}-{int(version)}"


# ------------------------------------------------------------------ version log
def list_versions(spark: SparkSession, path: str) -> DataFrame:
    """What has been written completely; only "path not found" counts as an empty log."""
    log = f"{path.rstrip('/')}/{VERSIONS}"
    try:
        rows = spark.read.schema(LOG_SCHEMA).parquet(log)
    except AnalysisException as error:
        if is_missing(error):
            return spark.createDataFrame([], LOG_SCHEMA)
        raise
    bad = F.raise_error(F.lit(f"damaged version log {log}")).cast("long")
    return rows.withColumn("version", F.when(F.col("version").isNull(), bad).otherwise(F.col("version")))


def layout(spark: SparkSession, path: str, below: int | None = None) -> Layout:
    """The newest base (of batches under ``below``) and the changes written since, oldest first."""
    log = list_versions(spark, path)
    if below is not None:
        log = log.filter(F.col("version") < F.lit(int(below)))
    newest = log.filter(F.col("kind") == BASE).agg(F.max("version")).first()[0]
    kept = log.filter((F.col("kind") == CHANGES) & (F.col("version") > F.lit(-1 if newest is None else newest))
                      | (F.col("kind") == BASE) & (F.col("version") == F.lit(newest)))
    # a retried batch is listed twice; at most fold_batches rows
    rows = kept.dropDuplicates(["version", "kind"]).orderBy("version").collect()
    return Layout(next((r for r in rows if r["kind"] == BASE), None), [r for r in rows if r["kind"] == CHANGES])


def foreign_versions(spark: SparkSession, path: str, version: int, writer: str | None) -> bool:
    """Whether the state has versions at or above ``version`` that ``writer`` did not write."""
    return not list_versions(spark, path).filter(
        (F.col("version") >= F.lit(int(version))) & ~F.col("writer").eqNullSafe(F.lit(writer))).isEmpty()


def holds_data(spark: SparkSession, path: str, except_version: int) -> bool:
    """Whether the folder has Parquet files of other batches (a listing only)."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(path).select("path"))
    except AnalysisException as error:
        if is_missing(error):
            return False
        raise
    own = f"/({BASE}|{CHANGES})-{int(except_version)}/"
    return not files.filter(~F.col("path").rlike(own)).isEmpty()


def _commit(spark: SparkSession, path: str, row: tuple) -> None:
    (spark.createDataFrame([row], LOG_SCHEMA).coalesce(1)
     .write.mode("append").parquet(f"{path.rstrip('/')}/{VERSIONS}"))


# ------------------------------------------------------------------ parts
def _table_name(path: str, version: int, buckets: int) -> str:
    return f"state_{hashlib.md5(path.encode()).hexdigest()[:16]}_{int(version)}_{int(buckets)}"


def _read_base(spark: SparkSession, path: str, row: Row) -> DataFrame:
    """The base as a bucketed table; the session's catalog learns of it when it does not know it."""
    name = _table_name(path, row["version"], row["buckets"])
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(row).fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) "
                  f"SORTED BY ({KEY}) INTO {row['buckets']} BUCKETS "
                  f"LOCATION '{part_path(path, BASE, row['version'])}'")
    return spark.table(name)


def _schema(row: Row) -> StructType:
    return StructType.fromJson(json.loads(row["schema"]))


def read_state(spark: SparkSession, path: str, *, below: int | None = None,
               markers: bool = False) -> DataFrame:
    """S-5: the live rows of the state (with ``markers`` also the delete markers)."""
    known = layout(spark, path, below)
    if not known.rows and known.base is None and not known.pending:
        raise FileNotFoundError(f"no committed version under {path}")
    state = _fold(spark, path, known)
    return state if markers else live_rows(state)


def _pending(spark: SparkSession, path: str, known: Layout) -> DataFrame:
    files = [part_path(path, CHANGES, r["version"]) for r in known.pending]
    rows = spark.read.schema(_schema(known.pending[-1])).parquet(*files)
    return newest_rows(rows) if len(files) > 1 else rows


def _fold(spark: SparkSession, path: str, known: Layout) -> DataFrame:
    if known.base is None:
        return _pending(spark, path, known)
    base = _read_base(spark, path, known.base)
    return fold_changes(base, _pending(spark, path, known)) if known.pending else base


def append_changes(changes: DataFrame, path: str, version: int, writer: str | None) -> None:
    """Write the newest changes of one batch and list them."""
    spark, seen = changes.sparkSession, Observation()
    watched = changes.observe(seen, F.count(F.lit(1)).alias("n"))
    watched.write.mode("overwrite").parquet(part_path(path, CHANGES, version))
    _commit(spark, path, (int(version), CHANGES, None, seen.get["n"], None, writer, changes.schema.json()))


def needs_fold(known: Layout, policy: StatePolicy) -> bool:
    return bool(known.pending) and (
        known.base is None or len(known.pending) >= policy.fold_batches
        or known.pending_rows >= policy.fold_share * known.base["row_count"])


def fold(spark: SparkSession, path: str, version: int, writer: str | None,
         policy: StatePolicy = StatePolicy()) -> int:
    """Write base and pending changes up to ``version`` as a new base; returns its live rows.

    The count of buckets stays while they hold at most twice the wanted rows: then the base is
    joined and rewritten without a shuffle.
    """
    known = layout(spark, path, below=version + 1)
    buckets = known.base["buckets"] if known.base else 0
    state = _fold(spark, path, known)
    if policy.retention_ms is not None:
        newest = state.agg(F.max("last_event_ts_ms")).first()[0] if known.base is None else \
            _newest_event(spark, path, known)
        state = expire_markers(state, newest, policy.retention_ms)
    if not buckets or policy.buckets(known.rows) > 2 * buckets:
        buckets = policy.buckets(known.rows)
        state = state.repartition(buckets, KEY)
    seen = Observation()
    watched = state.observe(seen, F.count(F.lit(1)).alias("n"),
                            F.count_if(F.col("last_op") != "d").alias("live"))
    (watched.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).mode("overwrite")
     .option("path", part_path(path, BASE, version)).saveAsTable(_table_name(path, version, buckets)))
    counts = seen.get
    _commit(spark, path, (int(version), BASE, buckets, counts["n"], counts["live"], writer, state.schema.json()))
    return counts["live"]


def _newest_event(spark: SparkSession, path: str, known: Layout):
    """The newest event time of base and changes (one column is read)."""
    parts = [_read_base(spark, path, known.base).select("last_event_ts_ms")]
    if known.pending:
        parts.append(_pending(spark, path, known).select("last_event_ts_ms"))
    rows = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    return rows.agg(F.max("last_event_ts_ms")).first()[0]
