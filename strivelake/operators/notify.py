"""Notifications for new activities: create-only filter, name lookup, message text.

Works on a batch or a streaming DataFrame alike; the streaming query lives in
:mod:`strivelake.streaming.notifications`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strivelake.functions.expressions import (
    duration_minutes, evaluate_once, message_text, strip_ws,
)
from strivelake.schemas import ACTIVITY_COLUMNS, UNION_ENVELOPE

DEFAULT_FIRST, DEFAULT_LAST = "Un", "collègue"


def creates(log: DataFrame, *, value: str = "value", partition: str = "partition",
            offset: str = "offset", carry: tuple[str, ...] = (), timed: bool = False) -> DataFrame:
    """P-8: payload = ``payload`` when present else the root; keep op = 'c' with an ``after`` image.

    ``carry`` names further columns of the log to keep; ``timed`` adds event_ts_ms."""
    e = F.from_json(F.col(value).cast("string"), UNION_ENVELOPE)
    df = log.select(F.col(partition).cast("int").alias("kafka_partition"),
                    F.col(offset).cast("long").alias("kafka_offset"), *carry, evaluate_once(e).alias("e"))
    wrapped = F.col("e.payload").isNotNull()
    op = F.when(wrapped, F.col("e.payload.op")).otherwise(F.col("e.op"))
    after = F.when(wrapped, F.col("e.payload.after")).otherwise(F.col("e.after"))
    ts_ms = F.when(wrapped, F.col("e.payload.ts_ms")).otherwise(F.col("e.ts_ms"))
    extra = (*carry, "event_ts_ms") if timed else carry
    return (df.select("kafka_partition", "kafka_offset", *carry, op.alias("op"), after.alias("after"),
                      ts_ms.alias("event_ts_ms"))
            .filter((F.col("op") == F.lit("c")) & F.col("after").isNotNull())
            .select("kafka_partition", "kafka_offset", *extra,
                    *[F.col(f"after.{c}").alias(c) for c in ACTIVITY_COLUMNS]))


def once_per_create(created: DataFrame, window: str) -> DataFrame:
    """T-2: the first of several deliveries of a create, on a stream with arrived_at.

    Change capture delivers at least once, also at new offsets; a create is known by its id and
    source time (by its place in the log where one is missing). The keys stay in the state store
    for ``window`` of arrival time, across restarts of the query.
    """
    known = F.col("id").isNotNull() & F.col("event_ts_ms").isNotNull()
    event = F.when(known, F.concat_ws("@", "id", "event_ts_ms")) \
        .otherwise(F.concat_ws("/", F.lit("at"), "kafka_partition", "kafka_offset"))
    return (created.withColumn("_event", event).withWatermark("arrived_at", window)
            .dropDuplicatesWithinWatermark(["_event"]).drop("_event"))


def names_ranges(names_log: DataFrame) -> DataFrame:
    """(employee_id, first_name, last_name, valid_from_ms, valid_to_ms) of a log of name changes.

    The log has the names sheet's columns and valid_from_ms; of several rows of one moment the
    greatest name counts, as in :func:`names_table`."""
    one = (names_log.filter(F.col("valid_from_ms").isNotNull())
           .select("employee_id", "valid_from_ms",
                   F.struct(F.coalesce(strip_ws("Prénom"), F.lit("")).alias("first"),
                            F.coalesce(strip_ws("Nom"), F.lit("")).alias("last")).alias("n"))
           .groupBy("employee_id", "valid_from_ms").agg(F.max("n").alias("n")))
    to = F.lead("valid_from_ms").over(Window.partitionBy("employee_id").orderBy("valid_from_ms"))
    return one.select("employee_id", F.col("n.first").alias("first_name"), F.col("n.last").alias("last_name"),
                      "valid_from_ms", to.alias("valid_to_ms"))


def with_names_at(df: DataFrame, names_log: DataFrame, ts_ms: str = "event_ts_ms") -> DataFrame:
    """J-5 at the event's time: the name whose range holds ``ts_ms`` (default before the first one).

    An equi join on the employee with the range as residual; ranges of an employee do not
    overlap, so an event keeps one row."""
    r = names_ranges(names_log).withColumnRenamed("employee_id", "_employee")
    inside = ((F.col("employee_id") == F.col("_employee")) & (F.col(ts_ms) >= F.col("valid_from_ms"))
              & (F.col("valid_to_ms").isNull() | (F.col(ts_ms) < F.col("valid_to_ms"))))
    return (df.join(r, inside, "left")
            .withColumn("full_name", F.concat(F.coalesce("first_name", F.lit(DEFAULT_FIRST)), F.lit(" "),
                                              F.coalesce("last_name", F.lit(DEFAULT_LAST))))
            .drop("_employee", "first_name", "last_name", "valid_from_ms", "valid_to_ms"))


def names_table(names: DataFrame) -> DataFrame:
    """(employee_id, first, last) stripped, one row per id (deterministic pick for duplicates)."""
    return (names.select("employee_id",
                         F.struct(F.coalesce(strip_ws("Prénom"), F.lit("")).alias("first"),
                                  F.coalesce(strip_ws("Nom"), F.lit("")).alias("last"))
                         .alias("n"))
            .groupBy("employee_id").agg(F.max("n").alias("n"))
            .select("employee_id", F.col("n.first").alias("first_name"),
                    F.col("n.last").alias("last_name")))


def with_names(df: DataFrame, names: DataFrame, *, looked_up: bool = False) -> DataFrame:
    """J-5: left join on employee_id, default ("Un", "collègue") for unknown ids.

    ``looked_up``: ``names`` is a (persisted) result of :func:`names_table` already."""
    return (df.join(names if looked_up else names_table(names), "employee_id", "left")
            .withColumn("full_name", F.concat(
                F.coalesce(F.col("first_name"), F.lit(DEFAULT_FIRST)), F.lit(" "),
                F.coalesce(F.col("last_name"), F.lit(DEFAULT_LAST))))
            .drop("first_name", "last_name"))


def with_duration(df: DataFrame) -> DataFrame:
    """F-16: minutes between start and end (min 1); null when a date does not parse."""
    return df.withColumn("duration_min", duration_minutes("start_date", "end_date"))


def with_message(df: DataFrame) -> DataFrame:
    """F-17..F-19 on a frame with full_name, activity_type, duration_min, distance_m, comment."""
    return df.withColumn("message", message_text(
        F.col("full_name"), F.col("activity_type"), F.col("duration_min"),
        F.col("distance_m"), F.col("comment")))


def notifications(created: DataFrame, names: DataFrame, *, keep: tuple[str, ...] = ("id", "employee_id"),
                  looked_up: bool = False, at_event: bool = False) -> tuple[DataFrame, DataFrame]:
    """(messages, rejects): one message per create event; events whose dates do not
    parse go to ``rejects`` instead of stopping the consumer (D-16). ``at_event``: ``names`` is a
    log of names, looked up at the event's time."""
    named = with_names_at(created, names) if at_event else with_names(created, names, looked_up=looked_up)
    df = with_duration(named)
    ok = with_message(df.filter(F.col("duration_min").isNotNull()))
    rejects = df.filter(F.col("duration_min").isNull()).select(
        *keep, "start_date", "end_date", F.lit("unparseable date").alias("reason"))
    return ok.select(*keep, "message"), rejects
