"""Change-data operators: envelope parsing, latest event per key, merge into state, offsets.

All functions are pure ``DataFrame -> DataFrame``; the streaming driver in
:mod:`strivelake.streaming.merge` applies them to each micro-batch.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strivelake.functions.expressions import evaluate_once
from strivelake.schemas import ACTIVITY_COLUMNS, STATE_COLUMNS, UNION_ENVELOPE

# -------------------------------------------------------------------- P-1
def _image(envelope: str) -> Column:
    """The change of one envelope shape as a struct: op, time and row image (after, else before)."""
    part = F.col(envelope).getField
    return F.struct(part("op").alias("op"), part("ts_ms").alias("ts_ms"),
                    F.coalesce(part("after"), part("before")).alias("row"))


def parse_changes(df: DataFrame, *, value: str = "value", partition: str = "partition",
                  offset: str = "offset") -> DataFrame:
    """Change rows of wrapped (under ``payload``) and flat envelopes, as CHANGE_COLUMNS.

    One ``from_json`` with a union schema reads both shapes; every part is taken from the wrapped
    shape first. Records without a row image or an op (malformed, null) are dropped.
    """
    envelope = evaluate_once(F.from_json(F.col(value).cast("string"), UNION_ENVELOPE))
    both = df.select(envelope.alias("e"), F.col(partition).cast("int").alias("kafka_partition"),
                     F.col(offset).cast("long").alias("kafka_offset")) \
        .select("kafka_partition", "kafka_offset", _image("e.payload").alias("inner"), _image("e").alias("outer"))
    merged = both.select("kafka_partition", "kafka_offset", *[
        F.coalesce(f"inner.{part}", f"outer.{part}").alias(name)
        for part, name in (("op", "op"), ("ts_ms", "last_event_ts_ms"), ("row", "row"))])
    known = merged.where("op IS NOT NULL AND row IS NOT NULL")
    return known.select("op", "last_event_ts_ms", "kafka_partition", "kafka_offset", "row.*")


# -------------------------------------------------------------------- M-1 / W-1
LOG_ORDER = ("kafka_offset", "kafka_partition")
# Offsets of different partitions say nothing of each other. Where a key may move between
# partitions its changes are ordered by the source's time, then by their place in the log.
SOURCE_ORDER = ("last_event_ts_ms", "kafka_offset", "kafka_partition")


def top_row(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per non-null key: the first in ``order``.

    Planned as a partial WindowGroupLimit before the shuffle, so a hot key ships one row
    per map task, not all its events.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    ranked = rows.where(F.col(key).isNotNull()).select("*", rank.alias("_rank"))
    return ranked.where("_rank = 1").drop("_rank")


def latest_per_key(changes: DataFrame, key: str = "id",
                   order: tuple[str, ...] = LOG_ORDER) -> DataFrame:
    """Last event per key (offset desc, partition as tie-break; D-1); op -> last_op.

    Null keys are dropped (D-19).
    """
    return top_row(changes.withColumnRenamed("op", "last_op"), key, *(F.desc(c) for c in order))


def newest_rows(rows: DataFrame, key: str = "id", order: tuple[str, ...] = LOG_ORDER) -> DataFrame:
    """The newest of several state rows (or delete markers) of a key."""
    return top_row(rows, key, *(F.desc(c) for c in order))


def to_state_rows(latest: DataFrame) -> DataFrame:
    """State rows of the latest changes; a delete becomes a marker (``last_op = 'd'``)."""
    return latest.select(*STATE_COLUMNS)


# -------------------------------------------------------------------- M-2
def live_rows(state: DataFrame) -> DataFrame:
    """A state without its delete markers."""
    return state.filter(~F.col("last_op").eqNullSafe(F.lit("d")))


def initial_state(latest: DataFrame) -> DataFrame:
    """First load: keep the non-deletes of the latest-per-key rows."""
    return live_rows(to_state_rows(latest))


# -------------------------------------------------------------------- M-3 / J-4
def fold_changes(target: DataFrame, changes: DataFrame, key: str = "id", *, guard: bool = True,
                 order: tuple[str, ...] = LOG_ORDER) -> DataFrame:
    """Target rows and changes folded to the newer one of each key, delete markers included.

    One full outer join; either side is read once, and a target bucketed by the key is not
    shuffled. With ``guard`` the stored row stays when it is newer by ``order`` than the change: a
    fold is then independent of the order in which changes arrive (D-2). Rows of the target
    without a key match nothing and stay.
    """
    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(F.lit(True).alias(f"{p}_here"), *[F.col(c).alias(f"{p}_{c}") for c in STATE_COLUMNS])

    both = side(target, "t").join(side(to_state_rows(changes), "s"),
                                  F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")
    applies = F.col("s_here").isNotNull()
    if guard:
        version = {p: F.struct(*[F.col(f"{p}_{c}") for c in order]) for p in "st"}
        applies &= F.col("t_here").isNull() | (version["s"] >= version["t"])
    return both.select(*[F.when(applies, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)
                         for c in STATE_COLUMNS])


def merge_state(target: DataFrame, changes: DataFrame, key: str = "id", *,
                guard: bool = True, order: tuple[str, ...] = LOG_ORDER) -> DataFrame:
    """MERGE semantics on ``key`` without a table format: the live rows after a fold.

    matched & d -> delete; matched & not d -> replace; not matched & not d -> insert; not
    matched & d -> ignored; a change older than the stored row is ignored. The result has no
    markers: where older changes can still arrive, keep the state of :func:`fold_changes` instead.
    """
    return live_rows(fold_changes(target, changes, key, guard=guard, order=order))


def expire_markers(state: DataFrame, newest_ms: int | None, retention_ms: int) -> DataFrame:
    """A state without the delete markers whose event is older than the newest one by the retention.

    An older change of such a key that still arrives would count as new. Markers without a time stay.
    """
    if newest_ms is None:
        return state
    old = F.col("last_event_ts_ms") < F.lit(int(newest_ms) - int(retention_ms))
    return state.filter(~((F.col("last_op") == F.lit("d")) & F.coalesce(old, F.lit(False))))


def merge_state_anti_union(target: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """The same MERGE without the ordering guard: untouched target rows plus upserts."""
    ch = to_state_rows(changes)
    kept = target.join(ch.select(key), key, "left_anti")
    return kept.select(*STATE_COLUMNS).unionByName(ch.filter(F.col("last_op") != F.lit("d")))


# -------------------------------------------------------------------- M-8
def insert_if_absent(target: DataFrame, source: DataFrame, key: str = "id",
                     order: tuple[str, ...] = LOG_ORDER) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``: the first source row per key is
    inserted when the key is not in the target; existing rows are kept as they are."""
    first = top_row(source, key, *(F.asc(c) for c in order))
    new = first.join(target.select(key), key, "left_anti")
    return target.unionByName(new.select(*target.columns))


# -------------------------------------------------------------------- M-4 / M-5
def partition_max_offsets(changes: DataFrame) -> DataFrame:
    """Highest parsed offset per log partition (partial + final aggregate)."""
    return (changes.groupBy("kafka_partition")
            .agg(F.max("kafka_offset").alias("max_offset")))


def next_offsets(previous: DataFrame | None, batch_max: DataFrame) -> DataFrame:
    """Next offset to read per partition: ``greatest(batch_max + 1, previous)`` (D-3).

    Partitions only in ``previous`` keep their offset; partitions only in the
    batch start at ``batch_max + 1``.
    """
    nxt = batch_max.select("kafka_partition",
                           (F.col("max_offset") + 1).alias("_batch_next"))
    if previous is None:
        return nxt.select("kafka_partition", F.col("_batch_next").alias("next_offset"))
    prev = previous.select("kafka_partition", F.col("next_offset").alias("_prev"))
    return (prev.join(nxt, "kafka_partition", "full_outer")
            .select("kafka_partition",
                    F.greatest(F.col("_batch_next"), F.col("_prev")).alias("next_offset")))


# -------------------------------------------------------------------- M-6 / M-7
def op_histogram(latest: DataFrame) -> DataFrame:
    """Changes per operation, deletes included."""
    return latest.groupBy("last_op").agg(F.count(F.lit(1)).alias("n"))


def run_metrics(changes: DataFrame, latest: DataFrame, state: DataFrame) -> DataFrame:
    """Counters of one run as (metric, value) rows: events parsed, ids touched, live rows."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(name).alias("metric"), "value")
    return (one(changes, "events_read")
            .unionByName(one(latest, "ids_touched"))
            .unionByName(one(state, "live_rows")))
