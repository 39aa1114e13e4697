"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables at ``sf_dir`` (through :class:`Inputs`) and
tables. Queries that exercise sinks, tables or streams write to a new folder
under the session's checkpoint directory and return what they read back.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strivelake.functions.expressions import km_label, parse_ts
from strivelake.operators import cdc, commute, gold, notify, profile, quality
from strivelake.plans import pipelines
from strivelake.plans.inputs import Inputs
from strivelake.rules import FIXTURE_AS_OF, FIXTURE_RULES
from strivelake.session import scratch_path
from strivelake.sources.changes import read_changes, saved_offsets, write_log_files
from strivelake.sources.export import export_sorted, read_export
from strivelake.sources.fixtures import sport_sheet
from strivelake.sources.reference import (
    declared_sports, read_reference, sanitize_columns,
)
from strivelake.sources.state import StatePolicy, read_state
from strivelake.sources.tables import read_table, write_table
from strivelake.streaming.gold_view import GoldView
from strivelake.streaming.merge import run_incremental_merge
from strivelake.streaming.progress import ProgressLog, read_progress

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

ONE_EMPLOYEE = 7
QUALITY_NOW = dt.datetime(2002, 1, 1)


def query(name: str) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _gold(i: Inputs, rules=FIXTURE_RULES) -> DataFrame:
    return gold.benefits(i.enriched, i.sport_ref, i.activities, rules, FIXTURE_AS_OF)


def _changes(i: Inputs, *batches: int) -> DataFrame:
    log = i.change_log
    if batches:
        log = log.filter(F.col("batch").isin(list(batches)))
    return cdc.parse_changes(log.drop("batch"))


def _latest(i: Inputs, *batches: int) -> DataFrame:
    return cdc.latest_per_key(_changes(i, *batches))


def _spine(i: Inputs) -> DataFrame:
    by_year = gold.activities_by_year(i.activities)
    years = gold.year_array(gold.activity_years(by_year, FIXTURE_AS_OF))
    return gold.employee_year_spine(i.enriched.select("employee_id"), years)


# ============================================================ sources and sinks
@query("src_cdc_scan")
def src_cdc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1: bounded scan of the whole log folder: records and offset range per partition."""
    i = Inputs(spark, sf_dir)
    folder = scratch_path(spark, "log") + "/log"
    for b in (0, 1, 2):
        write_log_files(i.log_batch(b), folder)
    log = read_changes(spark, folder, streaming=False)
    return (log.groupBy(F.col("partition").alias("kafka_partition"))
            .agg(F.count(F.lit(1)).alias("records"),
                 F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"),
                 F.count_if(F.col("value").isNull()).alias("null_values")))


@query("src_cdc_empty_batch")
def src_cdc_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2: a run with nothing new executes no batch and leaves the state as it was."""
    run = pipelines.incremental_bronze(spark, Inputs(spark, sf_dir))
    again = pipelines.run_again(spark, run)
    if again.batches != 0:
        raise AssertionError(f"empty run executed {again.batches} batch(es)")
    return read_state(spark, run.table)


@query("src_reference_load")
def src_reference_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3/P-2/F-1: the RH sheet written with raw headers, read back and normalised."""
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "sheet") + "/rh"
    i.employee_sheet.write.mode("overwrite").parquet(path)
    return read_reference(spark, path, is_rh=True)


@query("src_state_scan")
def src_state_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-5: a scan of the state while changes are pending: only the first batch is folded, the
    other two lie beside the base with their delete markers."""
    run = pipelines.incremental_bronze(spark, Inputs(spark, sf_dir),
                                       policy=StatePolicy(fold_share=float("inf")))
    return read_state(spark, run.table)


@query("src_export_readback")
def src_export_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-7: an export written as many range-partitioned part files, all read back (D-13)."""
    path = scratch_path(spark, "export") + "/gold"
    export_sorted(_gold(Inputs(spark, sf_dir)), path)
    back = read_export(spark, path)
    if not back.inputFiles():
        raise FileNotFoundError(path)
    return back


@query("sink_overwrite_roundtrip")
def sink_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-1: a full replace with a new schema (ref/rh, then rh_enriched) reads back the second."""
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "table") + "/rh"
    write_table(i.employees, path)
    write_table(i.enriched, path)
    return read_table(spark, path)


@query("sink_sorted_export")
def sink_sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-2/O-1: range-partitioned, sorted export: rows out of order inside a file, and files
    (in name order) whose keys start before those of the file ahead end."""
    path = scratch_path(spark, "export") + "/gold"
    export_sorted(_gold(Inputs(spark, sf_dir)), path)
    key = F.struct("year", "employee_id")
    rows = read_export(spark, path).select(
        key.alias("key"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("row"))
    inside = rows.select((before > F.col("key")).alias("bad")).agg(
        F.count("*").alias("n_rows"), F.count_if("bad").alias("rows_out_of_order"))
    files = rows.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    ahead = F.lag("high").over(Window.orderBy("file"))  # one row per file
    overlaps = files.select((ahead > F.col("low")).alias("bad")).agg(F.count_if("bad")).scalar()
    return inside.withColumn("files_out_of_order", overlaps)


@query("job_export_stored_gold")
def job_export_stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-5: the export job from the stored gold table, read back."""
    i = Inputs(spark, sf_dir)
    base = scratch_path(spark, "export-job")
    pipelines.gold_job(spark, i.activities, i.enriched, i.sport_ref, FIXTURE_RULES, FIXTURE_AS_OF,
                       out=f"{base}/gold").unpersist()
    return read_export(spark, pipelines.export_job(spark, f"{base}/gold", f"{base}/export"))


def _ref_job(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    base = scratch_path(spark, "ref-job")
    i.employee_sheet.write.parquet(f"{base}/rh")
    sport_sheet(spark, sf_dir).write.parquet(f"{base}/sport")
    pipelines.ref_job(spark, f"{base}/rh", f"{base}/sport", base)
    return read_table(spark, f"{base}/ref/{table}")


@query("job_ref_rh")
def job_ref_rh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-2: the reference job, RH sheet."""
    return _ref_job(spark, sf_dir, "rh")


@query("job_ref_sport")
def job_ref_sport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-2: the reference job, sport sheet."""
    return _ref_job(spark, sf_dir, "sport")


# ============================================================ streaming
@query("stream_incremental_merge")
def stream_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1/C-1: three availableNow runs, one per log file batch; the final state."""
    run = pipelines.incremental_bronze(spark, Inputs(spark, sf_dir))
    return read_state(spark, run.table)


@query("stream_reset_replay")
def stream_reset_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-3/K-5: after three incremental runs, a fresh checkpoint + table replays everything."""
    run = pipelines.incremental_bronze(spark, Inputs(spark, sf_dir))
    replay = pipelines.replay(spark, run)
    return read_state(spark, replay.table)


@query("stream_notifications")
def stream_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2/K-6: the notification stream over the log into a Parquet sink, read back."""
    return pipelines.notification_run(spark, Inputs(spark, sf_dir))[0]


@query("stream_notification_rejects")
def stream_notification_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-6/D-16: the create events that the notification stream set aside."""
    return pipelines.notification_run(spark, Inputs(spark, sf_dir))[1]


GATE_NOW = dt.datetime(2024, 1, 29)


def _gated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    folder = scratch_path(spark, "quarantine")
    gate = quality.Gate(quality.quarantine_folder(folder), GATE_NOW)
    run = pipelines.incremental_bronze(spark, Inputs(spark, sf_dir), gate=gate)
    return read_state(spark, run.table), spark.read.parquet(folder).drop("batch")


@query("stream_gated_state")
def stream_gated_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-1..Q-8 in front of the load: the state of the changes that pass the row checks."""
    return _gated(spark, sf_dir)[0]


@query("stream_quarantine")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes that the gate set aside, with the checks they break."""
    rows = _gated(spark, sf_dir)[1]
    return rows.withColumn(quality.BROKEN, F.array_join(quality.BROKEN, ","))


@query("stream_gold_view")
def stream_gold_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-4/A-1 maintained by the changes of three merged batches."""
    i = Inputs(spark, sf_dir)
    view = GoldView(scratch_path(spark, "goldview"), i.enriched, i.sport_ref, FIXTURE_RULES, FIXTURE_AS_OF)
    pipelines.incremental_bronze(spark, i, watch=view.apply)
    return view.read(spark)


@query("stream_activity_counts")
def stream_activity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1 as the sum of the +1/-1 of every merged batch."""
    i = Inputs(spark, sf_dir)
    view = GoldView(scratch_path(spark, "goldview"), i.enriched, i.sport_ref, FIXTURE_RULES, FIXTURE_AS_OF)
    pipelines.incremental_bronze(spark, i, watch=view.apply)
    return view.counts(spark)


@query("stream_from_saved_offsets")
def stream_from_saved_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1: a new run over the whole log that starts at the offsets saved after batch 0."""
    i = Inputs(spark, sf_dir)
    saved = saved_offsets(cdc.next_offsets(None, cdc.partition_max_offsets(_changes(i, 0))))
    base = scratch_path(spark, "offsets")
    write_log_files(i.log, f"{base}/log")
    run_incremental_merge(spark, f"{base}/log", f"{base}/state", f"{base}/ck", starting_offsets=saved)
    return read_state(spark, f"{base}/state")


@query("stream_progress_totals")
def stream_progress_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-7: what three runs read, by the progress rows that outlive them."""
    folder = scratch_path(spark, "progress")
    pipelines.incremental_bronze(spark, Inputs(spark, sf_dir), progress=ProgressLog(folder))
    rows = read_progress(spark, folder).filter("input_rows > 0")
    return rows.agg(F.countDistinct("run_id").alias("runs"), F.sum("input_rows").alias("records"))


@query("stream_notifications_once")
def stream_notifications_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2 over a log that repeats records, in a batch and in the next one: one message a create."""
    i = Inputs(spark, sf_dir)
    messages, _ = pipelines.notification_run(
        spark, i, log_batch=i.repeated_batch, once_within="1 day",
        keep=("kafka_partition", "id", "employee_id", "event_ts_ms"))
    return messages


@query("stream_names_at_event")
def stream_names_at_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-5 at the event's time: the log of names is read anew for every batch."""
    i = Inputs(spark, sf_dir)
    return pipelines.notification_run(spark, i, names=lambda: i.names_log)[0]


# ============================================================ projections / filters
@query("cdc_parse_envelopes")
def cdc_parse_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(Inputs(spark, sf_dir))


@query("ref_sanitize_columns")
def ref_sanitize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize_columns(Inputs(spark, sf_dir).employee_sheet)


@query("gold_salary_normalized")
def gold_salary_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = gold.with_salary(Inputs(spark, sf_dir).employees)
    return e.select("employee_id", "Salaire_brut", "annual_gross_salary")


@query("silver_activities")
def silver_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-5: business columns of the current state built from the whole log."""
    return gold.silver_activities(cdc.initial_state(_latest(Inputs(spark, sf_dir))))


@query("silver_one_employee")
def silver_one_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-6: the single-employee dry run (filter pushed into the orders scan)."""
    i = Inputs(spark, sf_dir)
    pipelines.require_employee(i.employees, ONE_EMPLOYEE)
    return commute.only_employee(i.activities, ONE_EMPLOYEE)


@query("gold_activities_by_year")
def gold_activities_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.activities_by_year(Inputs(spark, sf_dir).activities)


@query("notify_creates")
def notify_creates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notify.creates(Inputs(spark, sf_dir).log)


@query("ref_declared_sports")
def ref_declared_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared_sports(Inputs(spark, sf_dir).sport_ref)


@query("gold_benefits_employee_year")
def gold_benefits_employee_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-4 flagship: 17 KPI columns per employee and year."""
    return _gold(Inputs(spark, sf_dir))


# ============================================================ change-data operators
@query("cdc_latest_per_key")
def cdc_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.to_state_rows(_latest(Inputs(spark, sf_dir)))


@query("cdc_initial_load")
def cdc_initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.initial_state(_latest(Inputs(spark, sf_dir)))


@query("cdc_merge_state")
def cdc_merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3/J-4: state of batch 0 merged with the latest changes of batches 1 and 2."""
    i = Inputs(spark, sf_dir)
    return cdc.merge_state(cdc.to_state_rows(_latest(i, 0)), _latest(i, 1, 2))


@query("cdc_merge_state_stepwise")
def cdc_merge_state_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3 batch by batch, the newest batch first: delete markers keep older changes out."""
    i = Inputs(spark, sf_dir)
    state = cdc.to_state_rows(_latest(i, 2))
    for b in (0, 1):
        state = cdc.fold_changes(state, _latest(i, b))
    return cdc.live_rows(state)


@query("cdc_merge_moved_keys")
def cdc_merge_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-1/M-3 for keys that move between partitions: batches folded by the source's time."""
    i = Inputs(spark, sf_dir)
    state = None
    for b in (0, 1, 2):
        moved = (_changes(i, b).withColumn("kafka_partition", ((F.col("id") + F.col("kafka_offset") % 3) % 4).cast("int"))
                 .withColumn("kafka_offset", F.col("kafka_offset") % 997))
        latest = cdc.latest_per_key(moved, order=cdc.SOURCE_ORDER)
        state = cdc.to_state_rows(latest) if state is None else \
            cdc.fold_changes(state, latest, order=cdc.SOURCE_ORDER)
    return cdc.live_rows(state)


@query("cdc_merge_anti_union")
def cdc_merge_anti_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3 without the ordering guard (anti join + union form)."""
    i = Inputs(spark, sf_dir)
    return cdc.merge_state_anti_union(cdc.initial_state(_latest(i, 0)), _latest(i, 1, 2))


@query("cdc_partition_max_offsets")
def cdc_partition_max_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.partition_max_offsets(_changes(Inputs(spark, sf_dir)))


@query("cdc_next_offsets")
def cdc_next_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-5: checkpoint after batch 0, advanced by the maxima of batches 1 and 2."""
    i = Inputs(spark, sf_dir)
    offsets = None
    for b in (0, 1, 2):
        offsets = cdc.next_offsets(offsets, cdc.partition_max_offsets(_changes(i, b)))
    return offsets


@query("cdc_op_histogram")
def cdc_op_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.op_histogram(_latest(Inputs(spark, sf_dir)))


@query("cdc_run_metrics")
def cdc_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    changes = _changes(i)
    latest = cdc.latest_per_key(changes)
    return cdc.run_metrics(changes, latest, cdc.initial_state(latest))


@query("cdc_insert_if_absent")
def cdc_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-8: rows of batches 1 and 2 inserted only for ids absent from the batch-0 state."""
    i = Inputs(spark, sf_dir)
    target = cdc.initial_state(_latest(i, 0))
    source = cdc.to_state_rows(_changes(i, 1, 2).withColumnRenamed("op", "last_op"))
    return cdc.insert_if_absent(target, source)


# ============================================================ joins
@query("gold_employee_year_spine")
def gold_employee_year_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spine(Inputs(spark, sf_dir))


@query("gold_sport_flag_join")
def gold_sport_flag_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return (_spine(i).join(gold.sport_flag(i.sport_ref), "employee_id", "left")
            .select("employee_id", "activity_year",
                    F.coalesce("sport_practice_declared", F.lit(False))
                    .alias("sport_practice_declared")))


@query("gold_activity_count_join")
def gold_activity_count_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-3 as gold does it: the counts of an employee as one map, looked up behind the explode."""
    i = Inputs(spark, sf_dir)
    spine = gold.counted_spine(i.enriched.select("employee_id"), gold.activities_by_year(i.activities),
                               FIXTURE_AS_OF)
    return spine.withColumn("physical_activities_count_year",
                            F.coalesce("physical_activities_count_year", F.lit(0).cast("long")))


@query("notify_with_names")
def notify_with_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return notify.with_names(notify.creates(i.log), i.names).select(
        "kafka_offset", "employee_id", "full_name")


@query("ref_commute_mode")
def ref_commute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).employees.select(
        "employee_id", "Moyen_de_déplacement", "commute_mode")


@query("silver_travel_mode")
def silver_travel_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = commute.with_travel_mode(Inputs(spark, sf_dir).employees)
    return e.select("employee_id", "commute_mode", "google_travel_mode", "max_allowed_km")


@query("silver_route_distance")
def silver_route_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).enriched.select(
        "employee_id", "Adresse_du_domicile", "google_travel_mode", "distance_km")


@query("silver_missing_routes")
def silver_missing_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return commute.missing_routes(i.employees, i.routes)


# ============================================================ aggregation / distinct
@query("gold_years")
def gold_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_year = gold.activities_by_year(Inputs(spark, sf_dir).activities)
    return gold.activity_years(by_year, FIXTURE_AS_OF)


@query("gold_years_fallback")
def gold_years_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-2 fallback: over the activities whose start does not parse there is no year."""
    a = Inputs(spark, sf_dir).activities
    bad = a.filter(parse_ts("start_date").isNull())
    return gold.activity_years(gold.activities_by_year(bad), FIXTURE_AS_OF)


@query("gold_sport_flag")
def gold_sport_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sport_flag(Inputs(spark, sf_dir).sport_ref)


@query("quality_duplicate_keys")
def quality_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-4/O-2: the five-group sample the uniqueness assertion reports (sport reference)."""
    return quality.duplicate_sample(Inputs(spark, sf_dir).sport_ref, ["employee_id"])


@query("gold_summary")
def gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_summary(_gold(Inputs(spark, sf_dir)))


@query("profile_value_counts")
def profile_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-6/O-3: with the place of each value in the output order."""
    counts = profile.value_counts(Inputs(spark, sf_dir).employees, "Moyen_de_déplacement")
    return counts.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


@query("profile_columns")
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_profile(Inputs(spark, sf_dir).employees)


# ============================================================ scalar functions
@query("silver_commute_mode")
def silver_commute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-3: an existing mode wins over the raw one, blanks and nulls do not."""
    k = F.col("employee_id")
    given = Inputs(spark, sf_dir).employees.withColumn("commute_mode", F.when(
        k % 3 == 0, F.lit("Marche/running")).when(k % 3 == 1, F.lit("")))
    return commute.with_commute_mode(given).select("employee_id", "Moyen_de_déplacement", "commute_mode")


@query("silver_commute_anomaly")
def silver_commute_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).enriched.select(
        "employee_id", "distance_km", "max_allowed_km", "anomaly_commute")


@query("silver_employees_enriched")
def silver_employees_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-3: silver/rh_enriched."""
    return Inputs(spark, sf_dir).enriched


@query("gold_eligibility")
def gold_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(Inputs(spark, sf_dir)).select(
        "employee_id", "year", "sport_practice_declared", "eligible_prime_sportive",
        "eligibility_reason")


@query("gold_eligibility_anomaly_allowed")
def gold_eligibility_anomaly_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-11/F-14 with exclude_commute_anomaly = false."""
    rules = FIXTURE_RULES.with_(exclude_commute_anomaly=False)
    return _gold(Inputs(spark, sf_dir), rules).select(
        "employee_id", "year", "eligible_prime_sportive", "eligibility_reason", "prime_amount")


@query("gold_prime_amount")
def gold_prime_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(Inputs(spark, sf_dir)).select(
        "employee_id", "year", "annual_gross_salary", "prime_rate", "prime_amount")


@query("gold_wellbeing_days")
def gold_wellbeing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(Inputs(spark, sf_dir)).select(
        "employee_id", "year", "physical_activities_count_year", "eligible_wellbeing_days",
        "wellbeing_days_granted")


@query("notify_duration")
def notify_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notify.with_duration(Inputs(spark, sf_dir).activities).select("id", "duration_min")


@query("notify_km_label")
def notify_km_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = Inputs(spark, sf_dir).activities
    return a.filter(F.col("distance_m").isNotNull()).select(
        "id", "distance_m", km_label("distance_m").alias("km_label"))


@query("notify_messages")
def notify_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-16..F-19: every activity as a create event -> message text."""
    i = Inputs(spark, sf_dir)
    messages, _ = notify.notifications(i.activities, i.names)
    return messages


@query("notify_rejects")
def notify_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-16: create events whose dates do not parse are set aside, not fatal."""
    i = Inputs(spark, sf_dir)
    _, rejects = notify.notifications(i.activities, i.names)
    return rejects


@query("quality_distance_plausible")
def quality_distance_plausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distance_plausibility(Inputs(spark, sf_dir).activities)


# ============================================================ data quality
@query("quality_scan")
def quality_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scan(quality.operational(Inputs(spark, sf_dir).activities), now=QUALITY_NOW)


@query("quality_scan_change_rows")
def quality_scan_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-1..Q-8 on the parsed change rows, where ids repeat (duplicate_count fails)."""
    return quality.scan(quality.operational(_changes(Inputs(spark, sf_dir))), now=QUALITY_NOW)


@query("quality_failed_rows")
def quality_failed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failed_rows(quality.operational(Inputs(spark, sf_dir).activities),
                               QUALITY_NOW)


@query("quality_unique_keys")
def quality_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return (quality.unique_key_report(i.enriched, ["employee_id"], "silver/rh_enriched")
            .unionByName(quality.unique_key_report(gold.activities_by_year(i.activities),
                                                   ["employee_id", "activity_year"],
                                                   "activities_by_year"))
            .unionByName(quality.unique_key_report(_gold(i), ["employee_id", "year"],
                                                   "gold/benefits_employee_year"))
            .unionByName(quality.unique_key_report(i.sport_ref, ["employee_id"], "ref/sport")))


@query("quality_null_keys")
def quality_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_key_report(_gold(Inputs(spark, sf_dir)), ["employee_id", "year"],
                                   "gold/benefits_employee_year")


@query("quality_not_empty")
def quality_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    a = i.activities
    return (quality.not_empty_report(a, "activities")
            .unionByName(quality.not_empty_report(i.employees, "ref/rh"))
            .unionByName(quality.not_empty_report(i.log, "change log"))
            .unionByName(quality.not_empty_report(a.filter(parse_ts("start_date").isNull()
                                                            & parse_ts("end_date").isNull()),
                                                  "activities without any date")))


# ============================================================ composite
@query("pipeline_end_to_end")
def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-6: change log -> streaming bronze -> silver -> gold."""
    return pipelines.end_to_end(spark, Inputs(spark, sf_dir), FIXTURE_RULES, FIXTURE_AS_OF)
