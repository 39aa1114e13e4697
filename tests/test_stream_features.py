"""Change-driven gold, repeated deliveries, saved offsets, names by time, moved keys, progress."""
import datetime as dt
import json

from pyspark.sql import functions as F

from strivelake.operators import cdc, gold, notify
from strivelake.plans.inputs import Inputs
from strivelake.rules import FIXTURE_RULES
from strivelake.schemas import GOLD_COLUMNS, STATE_COLUMNS
from strivelake.sources.changes import read_changes, saved_offsets, write_log_files
from strivelake.sources.state import read_state
from strivelake.streaming.gold_view import GoldView, count_deltas
from strivelake.streaming.merge import run_incremental_merge
from strivelake.streaming.notifications import notify_once, parquet_sink
from strivelake.streaming.progress import ProgressLog, read_progress

from conftest import SF_SMALL
from test_cdc import env, row, srow, state_rows

AS_OF = dt.date(2002, 1, 1)
SCHEMA = "value string, partition int, offset long"


def record(k, employee, start, op="u", ts=1):
    r = dict(row(k), employee_id=employee, start_date=start)
    image = "before" if op == "d" else "after"
    return json.dumps({"op": op, image: r, "ts_ms": ts})


def append(spark, base, records):
    write_log_files(spark.createDataFrame(records, SCHEMA), f"{base}/log")


def test_gold_view_follows_every_batch(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    people = i.enriched.filter("employee_id < 6")
    view = GoldView(f"{tmp_dir}/view", people, i.sport_ref, FIXTURE_RULES, AS_OF)
    batches = [
        [(record(1, 1, "2001-05-01T10:00:00Z"), 0, 1), (record(2, 1, "2001-06-01T10:00:00Z"), 0, 2),
         (record(3, 2, "2001-06-01T10:00:00Z"), 0, 3)],
        [(record(4, 1, "2001-07-01T10:00:00Z"), 0, 4), (record(9, 99, "2001-07-01T10:00:00Z"), 0, 5)],
        # a move to another employee and year, a new year, an older change that must not count
        [(record(3, 4, "2000-06-01T10:00:00Z"), 0, 10), (record(4, 1, "1999-07-01T10:00:00Z"), 0, 3)],
        # the only activity of 2000 goes, so does its year
        [(record(3, 4, "2000-06-01T10:00:00Z", "d"), 0, 12), (record(5, 5, "not-a-date"), 0, 13)],
        [(record(k, 1, "2001-06-01T10:00:00Z", "d"), 0, 20 + k) for k in (1, 2, 4, 9)],
    ]
    touched = []
    for n, records in enumerate(batches):
        append(spark, tmp_dir, records)
        run_incremental_merge(spark, f"{tmp_dir}/log", f"{tmp_dir}/state", f"{tmp_dir}/ck", watch=view.apply)
        acts = gold.silver_activities(read_state(spark, f"{tmp_dir}/state"))
        key = lambda df: sorted(map(str, df.select(*GOLD_COLUMNS).collect()))
        assert key(view.read(spark)) == key(gold.benefits(people, i.sport_ref, acts, FIXTURE_RULES, AS_OF))
        touched.append(view.rows_of_batch(spark, n).count())
    n = people.count()
    # all of 2001; one employee-year; all of 2000 and one; 2000 removed; 2001 removed, the fallback year added
    assert touched == [n, 1, n + 1, n, 2 * n]


def test_count_deltas_cancel(spark):
    before = state_rows(spark, [srow(1, "c", 0, 1), srow(2, "c", 0, 2)])
    assert count_deltas(before, before).count() == 0
    lost = count_deltas(before, before.filter("id = 1")).collect()
    assert [r.physical_activities_count_year for r in lost] == [-1]


def test_one_message_for_repeated_deliveries(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    sent = lambda: spark.read.parquet(f"{tmp_dir}/out")

    def run():
        notify_once(spark, f"{tmp_dir}/log", i.names, parquet_sink(f"{tmp_dir}/out"), f"{tmp_dir}/ck",
                    once_within="1 day")

    at = "2025-01-01T10:00:00Z"
    append(spark, tmp_dir, [(record(1, 1, at, "c", 5), 0, 1), (record(1, 1, at, "c", 5), 0, 2),
                            (record(2, 1, at, "c", 5), 0, 3)])
    run()
    assert sorted(r.id for r in sent().collect()) == [1, 2]
    # a restart: a repeat at a new offset, the same id created again later, rows without identity
    append(spark, tmp_dir, [(record(1, 1, at, "c", 5), 1, 9), (record(1, 1, at, "c", 6), 0, 10),
                            (record(None, 1, at, "c", 7), 0, 11), (record(None, 1, at, "c", 7), 0, 12)])
    run()
    assert sorted(str(r.id) for r in sent().collect()) == ["1", "1", "2", "None", "None"]


def test_resume_from_saved_offsets(spark, tmp_dir):
    append(spark, tmp_dir, [(env("c", row(k)), k % 2, k) for k in range(10)])
    log = read_changes(spark, f"{tmp_dir}/log", streaming=False)
    saved = saved_offsets(cdc.next_offsets(None, cdc.partition_max_offsets(cdc.parse_changes(log))))
    assert saved == {0: 9, 1: 10}
    append(spark, tmp_dir, [(env("c", row(k)), k % 3, k) for k in range(10, 20)])
    rest = read_changes(spark, f"{tmp_dir}/log", streaming=False, starting_offsets=saved)
    # nothing lost, nothing repeated; partition 2 was unknown and is read from its start
    assert sorted(r.offset for r in rest.collect()) == list(range(10, 20))
    for table in ("a", "b"):     # b: the second run goes on from the checkpoint
        run = run_incremental_merge(spark, f"{tmp_dir}/log", f"{tmp_dir}/{table}", f"{tmp_dir}/ck-{table}",
                                    starting_offsets=saved)
        assert run.metrics[0]["events_read"] == 10
    append(spark, tmp_dir, [(env("c", row(20)), 0, 20)])
    run = run_incremental_merge(spark, f"{tmp_dir}/log", f"{tmp_dir}/b", f"{tmp_dir}/ck-b", starting_offsets=saved)
    assert run.metrics[0]["events_read"] == 1
    assert {r.id for r in read_state(spark, f"{tmp_dir}/b").collect()} == set(range(10, 21))


def test_names_at_the_time_of_the_event(spark):
    log = spark.createDataFrame([(1, " Ann ", "Old", 100), (1, "Ann", "New", 200), (1, "Ann", "Newer", 200),
                                 (2, None, "X", 0), (3, "Z", "Z", None)],
                                "employee_id long, `Prénom` string, Nom string, valid_from_ms long")
    events = spark.createDataFrame([(1, 99), (1, 100), (1, 199), (1, 200), (1, None), (2, 5), (3, 5), (None, 5)],
                                   "employee_id long, event_ts_ms long")
    got = sorted((str(r.employee_id), str(r.event_ts_ms), r.full_name)
                 for r in notify.with_names_at(events, log).collect())
    assert got == sorted([("1", "99", "Un collègue"), ("1", "100", "Ann Old"), ("1", "199", "Ann Old"),
                          ("1", "200", "Ann Newer"), ("1", "None", "Un collègue"), ("2", "5", " X"),
                          ("3", "5", "Un collègue"), ("None", "5", "Un collègue")])


def test_moved_keys_are_ordered_by_the_source(spark):
    """Key 1 moves from partition 0 (offset 50) to partition 1 (offset 3): the later change wins."""
    old, new = srow(1, "u", 0, 50, dist=1), srow(1, "u", 1, 3, dist=2)
    at = F.when(F.col("kafka_partition") == 0, 10).otherwise(20).cast("long")
    a, b = (state_rows(spark, [r]).withColumn("last_event_ts_ms", at) for r in (old, new))
    for first, second in ((a, b), (b, a)):
        folded = cdc.fold_changes(first, second, order=cdc.SOURCE_ORDER)
        assert [r.distance_m for r in folded.collect()] == [2]
    both = cdc.newest_rows(a.unionByName(b), order=cdc.SOURCE_ORDER)
    assert [r.distance_m for r in both.select(*STATE_COLUMNS).collect()] == [2]


def test_progress_outlives_the_run(spark, tmp_dir):
    for n in (3, 4):
        append(spark, tmp_dir, [(env("c", row(10 * n + k)), 0, 10 * n + k) for k in range(n)])
        run_incremental_merge(spark, f"{tmp_dir}/log", f"{tmp_dir}/state", f"{tmp_dir}/ck",
                              progress=ProgressLog(f"{tmp_dir}/progress"))
    rows = [r for r in read_progress(spark, f"{tmp_dir}/progress").collect() if r.input_rows]
    assert sorted(r.input_rows for r in rows) == [3, 4] and len({r.run_id for r in rows}) == 2
    assert len({r.query_id for r in rows}) == 1


def test_names_given_as_a_function_are_read_for_every_batch(spark, tmp_dir):
    calls = []
    names = spark.createDataFrame([(1, "Ann", "Old", 0)], "employee_id long, `Prénom` string, Nom string, valid_from_ms long")
    for n in (1, 2):
        append(spark, tmp_dir, [(record(n, 1, "2025-01-01T10:00:00Z", "c", n), 0, n)])
        notify_once(spark, f"{tmp_dir}/log", lambda: calls.append(1) or names, parquet_sink(f"{tmp_dir}/out"),
                    f"{tmp_dir}/ck")
    assert len(calls) == 2
    assert all("Ann Old" in r.message for r in spark.read.parquet(f"{tmp_dir}/out").collect())


def test_quality_checks_of_the_gate(spark):
    from strivelake.operators.quality import broken_checks
    base = {"op": "u", **row(1)}
    cases = [({}, []), ({"id": None}, ["missing(id)"]), ({"distance_m": -1}, ["negative(distance_m)"]),
             ({"end_date": base["start_date"]}, ["duration_not_positive"]),
             ({"start_date": "2039-01-01T00:00:00Z", "end_date": "2039-01-01T01:00:00Z"}, ["start_in_far_future"]),
             ({"activity_type": None, "end_date": "x"}, ["missing(end_date)", "missing(activity_type)"]),
             ({"op": "d", "distance_m": -1, "activity_type": " "}, []), ({"op": "d", "id": None}, ["missing(id)"])]
    full = dict(base, created_at=base["start_date"])
    df = spark.createDataFrame([dict(full, **change) for change, _ in cases], cdc_columns())
    got = [r.b for r in df.select(broken_checks(dt.datetime(2030, 1, 1)).alias("b")).collect()]
    assert got == [want for _, want in cases]


def cdc_columns():
    return ("op string, id long, employee_id long, start_date string, activity_type string, distance_m long, "
            "end_date string, comment string, created_at string")


