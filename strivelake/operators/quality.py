"""Data-quality operators: the declarative column checks, failed-row rules and job assertions.

Column checks share one aggregation: a per-id partial aggregate (one shuffle,
map-side combined, so a hot or null id is pre-aggregated before it moves) and
a global sum. Failed-row rules are a single narrow pass that tags each row
with the names of the rules it breaks.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strivelake.functions.expressions import expected_distance_range, parse_ts

REQUIRED = ("id", "employee_id", "start_date", "end_date", "activity_type")
CHECK_SCHEMA = "check string, metric bigint, threshold bigint, passed boolean"


def operational(activities: DataFrame) -> DataFrame:
    """The source table's shape: ISO text parsed once to timestamps (unparseable -> null)."""
    ts = lambda c: parse_ts(c).cast("timestamp_ntz")
    return activities.select("id", "employee_id", ts("start_date").alias("start_date"),
                             "activity_type", "distance_m", ts("end_date").alias("end_date"),
                             "comment", ts("created_at").alias("created_at"))


def _check(name: str, metric: Column, threshold: int, passed: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), metric.cast("long").alias("metric"),
                    F.lit(int(threshold)).cast("long").alias("threshold"), passed.alias("passed"))


def scan(df: DataFrame, key: str = "id", required: tuple[str, ...] = REQUIRED,
         also_required: tuple[str, ...] = ("created_at",), min_col: str = "distance_m",
         valid_min: int = 0, now: dt.datetime | None = None) -> DataFrame:
    """Q-1..Q-8, Q-12: one row per check (check, metric, threshold, passed)."""
    broken = failed_row_rules(now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    cols = [c for c in required if c != key] + [c for c in also_required if c in df.columns]
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_miss_{c}") for c in cols],
        F.count_if(F.col(min_col) < F.lit(valid_min)).alias("_invalid"),
        *[F.count_if(cond).alias(f"_{name}") for name, cond in broken.items()],
    )
    k = F.col(key)
    tot = per_key.agg(
        F.sum("_n").alias("rows"),
        F.coalesce(F.sum(F.when(k.isNull(), F.col("_n"))), F.lit(0)).alias(f"miss_{key}"),
        *[F.coalesce(F.sum(f"_miss_{c}"), F.lit(0)).alias(f"miss_{c}") for c in cols],
        F.count_if(k.isNotNull() & (F.col("_n") > 1)).alias("dups"),
        F.coalesce(F.sum("_invalid"), F.lit(0)).alias("invalid"),
        *[F.coalesce(F.sum(f"_{name}"), F.lit(0)).alias(name) for name in broken],
    )
    rows = F.coalesce(F.col("rows"), F.lit(0))
    checks = [_check("row_count > 0", rows, 0, rows > 0)]
    for c in [key] + cols:
        m = F.col(f"miss_{c}")
        checks.append(_check(f"missing_count({c}) = 0", m, 0, m == 0))
    checks.append(_check(f"duplicate_count({key}) = 0", F.col("dups"), 0, F.col("dups") == 0))
    checks.append(_check(f"invalid_count({min_col}) = 0", F.col("invalid"), 0,
                         F.col("invalid") == 0))
    checks += [_check(f"failed_rows({name}) = 0", F.col(name), 0, F.col(name) == 0) for name in broken]
    return tot.select(F.inline(F.array(*checks)))


FAILED_ROW_RULES = (
    "end_before_start",
    "duration_not_positive",
    "blank_activity_type",
    "start_in_far_future",
)


def failed_row_rules(now: dt.datetime) -> dict[str, Column]:
    """The fail conditions of Q-5..Q-8 by rule name."""
    limit = F.lit(now).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return {
        "end_before_start": F.col("end_date") < F.col("start_date"),
        "duration_not_positive": F.col("end_date") <= F.col("start_date"),
        "blank_activity_type": F.trim(F.col("activity_type")) == F.lit(""),
        "start_in_far_future": F.col("start_date") > limit,
    }


def failed_rows(df: DataFrame, now: dt.datetime) -> DataFrame:
    """Q-5..Q-8: every (rule, row) where the rule's fail condition holds."""
    conds = failed_row_rules(now)
    tags = F.filter(F.array(*[F.when(F.coalesce(conds[n], F.lit(False)), F.lit(n))
                              for n in FAILED_ROW_RULES]), lambda x: x.isNotNull())
    return (df.select(F.explode(tags).alias("check"), "id", "employee_id", "start_date",
                      "end_date", "activity_type"))


# ------------------------------------------------------------------ gate in front of a load
BROKEN = "broken_checks"
GATE_REQUIRED = ("id", "employee_id", "start_date", "end_date", "activity_type", "created_at")


class QualityStop(RuntimeError):
    """Too large a share of a batch breaks the checks; nothing of the batch was written."""


def broken_checks(now: dt.datetime, required: tuple[str, ...] = GATE_REQUIRED) -> Column:
    """Names of the row checks (Q-2, Q-4..Q-8) that a change row with ISO text breaks, in order.

    A delete carries the last image of a row that may have been bad all along: only its id counts.
    """
    moments = {c: parse_ts(c).cast("timestamp_ntz") for c in ("start_date", "end_date", "created_at")}
    conds = {f"missing({c})": moments.get(c, F.col(c)).isNull() for c in required}
    conds["negative(distance_m)"] = F.col("distance_m") < 0
    start, end = moments["start_date"], moments["end_date"]
    limit = F.lit(now).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    conds |= {"end_before_start": end < start, "duration_not_positive": end <= start,
              "blank_activity_type": F.trim("activity_type") == "", "start_in_far_future": start > limit}
    delete = F.col("op") == "d"
    tags = [F.when(F.coalesce(cond, F.lit(False)) & (F.lit(name == "missing(id)") | ~delete), F.lit(name))
            for name, cond in conds.items()]
    return F.filter(F.array(*tags), lambda x: x.isNotNull())


@dataclass(frozen=True)
class Gate:
    """Row checks in front of a load: rows that break one go to ``sink(rows, batch_id)``.

    A batch in which more than ``stop_share`` of the rows fail raises :class:`QualityStop` before
    anything is written. The counts are taken over the persisted batch.
    """
    sink: Callable[[DataFrame, int], None]
    now: dt.datetime
    stop_share: float = 1.0

    def check(self, changes: DataFrame) -> DataFrame:
        return changes.withColumn(BROKEN, broken_checks(self.now))

    def passed(self, checked: DataFrame) -> DataFrame:
        return checked.filter(F.size(BROKEN) == 0).drop(BROKEN)

    def divert(self, checked: DataFrame, batch_id: int) -> int:
        """Stop or write the failing rows; returns their number."""
        counts = checked.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size(BROKEN) > 0).alias("bad")).first()
        if counts["bad"] > self.stop_share * counts["n"]:
            raise QualityStop(f"batch {batch_id}: {counts['bad']} of {counts['n']} rows break the checks")
        self.sink(checked.filter(F.size(BROKEN) > 0), batch_id)
        return counts["bad"]


def quarantine_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A sink of a gate: one sub-folder per batch, rewritten by a retry."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={int(batch_id)}")
    return write


def distance_plausibility(activities: DataFrame) -> DataFrame:
    """F-20: activities whose distance does not fit the sport (none expected, missing, out of range)."""
    expected, lo, hi = expected_distance_range("activity_type")
    d = F.col("distance_m")
    reason = (F.when(~expected & d.isNotNull(), F.lit("distance_not_expected"))
              .when(expected & d.isNull(), F.lit("distance_missing"))
              .when(expected & ((d < lo) | (d > hi)), F.lit("distance_out_of_range")))
    return (activities.select("id", "activity_type", "distance_m",
                              lo.alias("expected_min_m"), hi.alias("expected_max_m"),
                              reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


# ------------------------------------------------------------------ assertions
def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A-4: key groups occurring more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def duplicate_sample(df: DataFrame, keys: list[str], size: int = 5) -> DataFrame:
    """O-2: the first ``size`` duplicate groups in key order (a top-k, no global sort)."""
    return duplicate_keys(df, keys).orderBy(*keys).limit(size)


def unique_key_report(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Q-9 as data: (table_name, key_columns, duplicate_groups, passed)."""
    n = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicate_groups"))
    return n.select(F.lit(label).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                    "duplicate_groups", (F.col("duplicate_groups") == 0).alias("passed"))


def assert_unique(df: DataFrame, keys: list[str], label: str, size: int = 5) -> None:
    """Q-9: turn a failed uniqueness report into an error that shows ``size`` groups."""
    found = unique_key_report(df, keys, label).first()
    if not found["passed"]:
        sample = [tuple(r) for r in duplicate_sample(df, keys, size).collect()]
        raise ValueError(f"{label}: {found['duplicate_groups']} duplicate group(s) of "
                         f"({found['key_columns']}), such as {sample}")


def null_key_report(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Q-10 as data: rows with a null in any key column."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.agg(F.count_if(cond).alias("null_key_rows")).select(
        F.lit(label).alias("table_name"), "null_key_rows",
        (F.col("null_key_rows") == 0).alias("passed"))


def assert_not_null(df: DataFrame, keys: list[str], label: str) -> None:
    row = null_key_report(df, keys, label).first()
    if row["null_key_rows"]:
        raise ValueError(f"{label}: {row['null_key_rows']} row(s) with a null key")


def not_empty_report(df: DataFrame, label: str) -> DataFrame:
    """Q-11 as data: whether the table has at least one row (reads at most one row)."""
    return (df.limit(1).agg(F.count(F.lit(1)).alias("_n"))
            .select(F.lit(label).alias("table_name"), (F.col("_n") > 0).alias("has_rows")))


def assert_not_empty(df: DataFrame, label: str) -> None:
    if df.isEmpty():
        raise ValueError(f"{label} is empty")
