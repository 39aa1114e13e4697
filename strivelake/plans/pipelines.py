"""Composite jobs C-1..C-6: bronze, ref, silver, gold, export and the whole chain.

Each job reads and writes tables by path; paths are chosen by the caller (on a
cluster, folders on the shared store). The query catalog runs them in fresh
folders under the session checkpoint directory.
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strivelake.operators import commute, gold, quality
from strivelake.plans.inputs import Inputs
from strivelake.rules import Rules
from strivelake.session import scratch_path
from strivelake.sources.changes import write_log_files
from strivelake.sources.export import export_sorted
from strivelake.sources.reference import read_reference
from strivelake.sources.tables import default_format, read_table, write_table
from strivelake.streaming.merge import MergeRun, load_state, reset_and_replay, run_incremental_merge
from strivelake.streaming.notifications import notify_once, parquet_sink


# ------------------------------------------------------------------ C-1 bronze
@dataclass
class BronzeRun:
    base: str
    log: str
    table: str
    checkpoint: str
    runs: list[MergeRun]


def incremental_bronze(spark: SparkSession, i: Inputs, batches=(0, 1, 2), **kw) -> BronzeRun:
    """Append each log batch to the log folder and run one availableNow merge after each.

    ``kw`` goes to the merge (policy, gate)."""
    base = scratch_path(spark, "bronze")
    run = BronzeRun(base=base, log=f"{base}/log", table=f"{base}/state",
                    checkpoint=f"{base}/_checkpoint", runs=[])
    for b in batches:
        write_log_files(i.log_batch(b), run.log)
        run.runs.append(run_incremental_merge(spark, run.log, run.table, run.checkpoint, **kw))
    return run


def run_again(spark: SparkSession, run: BronzeRun) -> MergeRun:
    """Another run with the same checkpoint: nothing new, so no batch and no new version."""
    return run_incremental_merge(spark, run.log, run.table, run.checkpoint)


def replay(spark: SparkSession, run: BronzeRun) -> MergeRun:
    """Reset: a new checkpoint and a new table folder, replaying the whole log."""
    return reset_and_replay(spark, run.log, f"{run.base}/state_replay",
                            f"{run.base}/_checkpoint_replay")


def bronze_job(spark: SparkSession, log: str, table: str, checkpoint: str, *,
               fmt: str = "parquet", options: dict | None = None,
               table_format: str | None = None) -> MergeRun:
    return run_incremental_merge(spark, log, table, checkpoint, fmt=fmt, options=options,
                                 table_format=table_format)


# ------------------------------------------------------------------ C-2 ref
def ref_job(spark: SparkSession, rh_path: str, sport_path: str, out: str, *,
            fmt: str = "parquet", table_format: str | None = None) -> tuple[str, str]:
    """Load both sheets, normalise, write ref/rh and ref/sport (Delta tables when installed)."""
    table = table_format or default_format()
    rh = read_reference(spark, rh_path, fmt=fmt, is_rh=True)
    sport = read_reference(spark, sport_path, fmt=fmt)
    return (write_table(rh, f"{out}/ref/rh", fmt=table),
            write_table(sport, f"{out}/ref/sport", fmt=table))


# ------------------------------------------------------------------ C-3 silver
def require_employee(employees: DataFrame, employee_id: int) -> None:
    if commute.only_employee(employees, employee_id).isEmpty():
        raise ValueError(f"employee_id={employee_id} not found in ref/rh")


def silver_job(spark: SparkSession, bronze: DataFrame, rh: DataFrame, routes: DataFrame,
               out: str, *, only_employee: int | None = None, strict: bool = False,
               table_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """silver/activities and silver/rh_enriched, read back from the tables written; the
    one-employee mode writes elsewhere (D-10)."""
    acts = gold.silver_activities(bronze)
    if only_employee is not None:
        require_employee(rh, only_employee)
        acts = commute.only_employee(acts, only_employee)
        rh = commute.only_employee(rh, only_employee)
        out = f"{out}/only_employee={int(only_employee)}"
    enriched = commute.enrich_employees(rh, routes, strict=strict)
    for df, name in ((acts, "activities"), (enriched, "rh_enriched")):
        write_table(df, f"{out}/silver/{name}", fmt=table_format or default_format())
    return read_table(spark, f"{out}/silver/activities"), read_table(spark, f"{out}/silver/rh_enriched")


# ------------------------------------------------------------------ C-4 gold
def gold_job(spark: SparkSession, activities: DataFrame, enriched: DataFrame,
             sport_ref: DataFrame, rules: Rules, as_of: dt.date, out: str | None = None, *,
             table_format: str | None = None) -> DataFrame:
    """Compute gold, run the checks once on a persisted result, then write.

    A failed check raises before the previous output is touched.
    """
    quality.assert_unique(enriched, ["employee_id"], "silver/rh_enriched")
    # one scan of the activities: the per-year counts feed both the year list and the join
    by_year = gold.activities_by_year(activities).persist(StorageLevel.MEMORY_AND_DISK)
    result = gold.benefits(enriched, sport_ref, activities, rules, as_of,
                           by_year=by_year).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _check_and_write(result, out, table_format)
    except BaseException:
        result.unpersist()
        raise
    finally:
        by_year.unpersist()
    return result


def _check_and_write(result: DataFrame, out: str | None, table_format: str | None) -> None:
    # Q-9 and Q-10 in one pass: per-key counts (partial aggregate), then one row
    per_key = result.groupBy("employee_id", "year").agg(F.count(F.lit(1)).alias("n"))
    checks = per_key.agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") > 1).alias("dup_groups"),
        F.coalesce(F.sum(F.when(F.col("employee_id").isNull() | F.col("year").isNull(),
                                F.col("n"))), F.lit(0)).alias("null_keys"),
    ).first()
    if checks["dup_groups"]:
        quality.assert_unique(result, ["employee_id", "year"], "gold/benefits_employee_year")
    if checks["null_keys"]:
        raise ValueError(f"gold: {checks['null_keys']} row(s) with a null key")
    if out:
        write_table(result, out, fmt=table_format or default_format())


# ------------------------------------------------------------------ C-5 export
def export_job(spark: SparkSession, gold_path: str, out: str, *, single_file: bool = False) -> str:
    return export_sorted(read_table(spark, gold_path), out, single_file=single_file)


# ------------------------------------------------------------------ notifications
def notification_run(spark: SparkSession, i: Inputs, *, log_batch=None, names=None,
                     **kw) -> tuple[DataFrame, DataFrame]:
    """(messages, rejects) of the notification stream, read back from its sink folders.

    One run per log batch with the same checkpoint; ``kw`` goes to the query."""
    base = scratch_path(spark, "notify")
    log, sink_dir, ckpt = f"{base}/log", f"{base}/messages", f"{base}/_checkpoint"
    for b in (0, 1, 2):
        write_log_files((log_batch or i.log_batch)(b), log)
        notify_once(spark, log, names or i.names, parquet_sink(sink_dir, f"{base}/rejects"), ckpt, **kw)
    return (spark.read.parquet(sink_dir).drop("batch"),
            spark.read.parquet(f"{base}/rejects").drop("batch"))


# ------------------------------------------------------------------ C-6 end to end
def end_to_end(spark: SparkSession, i: Inputs, rules: Rules, as_of: dt.date) -> DataFrame:
    """Change log -> streaming bronze -> silver -> gold, through written tables."""
    run = incremental_bronze(spark, i)
    bronze = load_state(spark, run.table)
    acts, rh = silver_job(spark, bronze, i.employees, i.routes, f"{run.base}/lake")
    gold_path = f"{run.base}/lake/gold"
    gold_job(spark, acts, rh, i.sport_ref, rules, as_of, out=gold_path).unpersist()
    return read_table(spark, gold_path)
