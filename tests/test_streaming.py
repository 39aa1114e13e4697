import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strivelake.operators import cdc
from strivelake.operators.quality import Gate, quarantine_folder
from strivelake.plans import pipelines
from strivelake.plans.inputs import Inputs
from strivelake.schemas import STATE_COLUMNS
from strivelake.sources.changes import read_changes, write_log_files
from strivelake.sources import state
from strivelake.sources.state import StatePolicy, list_versions, read_state
from strivelake.streaming.merge import checkpoint_id, merge_batch, run_incremental_merge

from conftest import SF_SMALL
from plan_text import plan_text


def event(k, dist):
    row = {"id": k, "employee_id": k, "start_date": "2025-01-01T10:00:00Z", "activity_type": "Runing",
           "distance_m": dist, "end_date": "2025-01-01T11:00:00Z", "comment": None, "created_at": "2025-01-01T10:00:00Z"}
    return json.dumps({"op": "u", "after": row, "ts_ms": 1})


def rows(df):
    return sorted(tuple(r) for r in df.select(*STATE_COLUMNS).collect())


def test_incremental_equals_batch_and_restart_is_noop(spark):
    i = Inputs(spark, SF_SMALL)
    run = pipelines.incremental_bronze(spark, i)
    assert [r.batches for r in run.runs] == [1, 1, 1]
    m = run.runs[0].metrics[0]
    assert m["events_read"] >= m["ids_touched"] > 0 and m["live_rows"] > 0
    # the batches are thirds of the offsets at any size
    assert all(x["ids_touched"] > 0 for r in run.runs for x in r.metrics)
    assert sum(m["by_op"].values()) == m["ids_touched"] and set(m["by_op"]) <= {"c", "r", "u", "d"}
    now = read_state(spark, run.table)
    expected = cdc.initial_state(cdc.latest_per_key(cdc.parse_changes(i.log)))
    assert rows(now) == rows(expected)
    assert run.runs[2].metrics[0]["live_rows"] == now.count()
    v = list_versions(spark, run.table).count()
    again = pipelines.run_again(spark, run)
    assert again.batches == 0 and list_versions(spark, run.table).count() == v   # S-2
    replay = pipelines.replay(spark, run)                                 # T-3 / K-5
    once = cdc.initial_state(cdc.latest_per_key(cdc.parse_changes(i.log)))
    assert rows(read_state(spark, replay.table)) == rows(once)


def test_retried_batch_rewrites_same_version(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    log, table, ckpt = f"{tmp_dir}/log", f"{tmp_dir}/state", f"{tmp_dir}/ckpt"
    write_log_files(i.log_batch(0), log)
    run_incremental_merge(spark, log, table, ckpt)
    first = rows(read_state(spark, table))
    # a crash before the checkpoint commit replays batch 0 of the same checkpoint
    batch = read_changes(spark, log, streaming=False)
    merge_batch(spark, batch, 0, table, writer=checkpoint_id(spark, ckpt))
    assert rows(read_state(spark, table)) == first
    # another checkpoint would hide its replay below the versions there: refused
    with pytest.raises(Exception, match="this checkpoint did not write"):
        run_incremental_merge(spark, log, table, f"{tmp_dir}/ckpt2")
    assert rows(read_state(spark, table)) == first


def test_state_is_never_replaced_by_one_batch(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    log, table, ckpt = f"{tmp_dir}/log", f"{tmp_dir}/state", f"{tmp_dir}/ckpt"
    write_log_files(i.log_batch(0), log)
    run_incremental_merge(spark, log, table, ckpt)
    first = rows(read_state(spark, table))
    batch = read_changes(spark, log, streaming=False)
    # data but no readable log: neither a later nor a first batch may write
    spark.read.parquet(f"{table}/base-0").write.parquet(f"{tmp_dir}/lost/base-0")
    with pytest.raises(RuntimeError, match="no committed version"):
        merge_batch(spark, batch, 1, f"{tmp_dir}/lost", writer="x")
    # a damaged log raises instead of counting as no version
    spark.range(1).selectExpr("'x' AS other").write.mode("append").parquet(f"{table}/_versions")
    with pytest.raises(Exception, match="damaged version log"):
        merge_batch(spark, batch, 1, table, writer=checkpoint_id(spark, ckpt))
    assert rows(cdc.live_rows(spark.read.parquet(f"{table}/base-0"))) == first


SCHEMA = "value string, partition int, offset long"


def run_events(spark, base, records, **kw):
    """Append records (value, partition, offset) and run one merge; the state as {id: distance}."""
    write_log_files(spark.createDataFrame(records, SCHEMA), f"{base}/log")
    run = run_incremental_merge(spark, f"{base}/log", f"{base}/state", f"{base}/ck", **kw)
    return run, {r.id: r.distance_m for r in read_state(spark, f"{base}/state").collect()}


def removal(k):
    return event(k, None).replace('"op": "u"', '"op": "d"').replace('"after"', '"before"')


def test_small_batches_leave_the_base_alone(spark, tmp_dir):
    run_events(spark, tmp_dir, [(event(k, k), 0, k) for k in range(40)])
    policy = StatePolicy(fold_share=0.1)
    for n in (1, 2, 3):
        run, now = run_events(spark, tmp_dir, [(event(7, 90 + n), 0, 100 + n)], policy=policy)
        assert now == {k: (90 + n if k == 7 else k) for k in range(40)}
        assert run.metrics[0]["live_rows"] == 40
        known = state.layout(spark, f"{tmp_dir}/state")
        assert known.base["version"] == 0 and [r["row_count"] for r in known.pending] == [1] * n
    run_events(spark, tmp_dir, [(event(8, 1), 0, 200), (removal(9), 0, 201)], policy=policy)   # 5 of 40: folded
    known = state.layout(spark, f"{tmp_dir}/state")
    assert known.base["version"] == 4 and not known.pending
    assert (known.base["row_count"], known.base["live"]) == (40, 39)


def test_older_change_after_a_delete_does_not_revive(spark, tmp_dir):
    for share in (0.0, float("inf")):           # folded at once, or pending beside the base
        base, policy = f"{tmp_dir}/{share}", StatePolicy(fold_share=share)
        run_events(spark, base, [(event(1, 1), 0, 1), (event(2, 2), 0, 2)], policy=policy)
        assert run_events(spark, base, [(removal(1), 0, 9)], policy=policy)[1] == {2: 2}
        assert run_events(spark, base, [(event(1, 5), 0, 5)], policy=policy)[1] == {2: 2}
        assert run_events(spark, base, [(event(1, 12), 0, 12)], policy=policy)[1] == {1: 12, 2: 2}


def test_markers_expire_after_the_retention(spark, tmp_dir):
    policy = StatePolicy(fold_share=0.0, retention_ms=1000)
    at = lambda text, ms: text.replace('"ts_ms": 1', f'"ts_ms": {ms}')
    markers = lambda: {r.id for r in read_state(spark, f"{tmp_dir}/state", markers=True)
                       .filter("last_op = 'd'").collect()}
    run_events(spark, tmp_dir, [(event(1, 1), 0, 1), (event(2, 2), 0, 2)], policy=policy)
    run_events(spark, tmp_dir, [(at(removal(1), 500), 0, 3)], policy=policy)
    assert markers() == {1}
    run_events(spark, tmp_dir, [(at(event(2, 3), 1500), 0, 4)], policy=policy)
    assert markers() == {1}
    run_events(spark, tmp_dir, [(at(event(2, 4), 1501), 0, 5)], policy=policy)
    assert markers() == set()


def test_buckets_follow_the_rows(spark, tmp_dir):
    policy = StatePolicy(bucket_rows=10, fold_share=0.0)
    buckets = lambda: state.layout(spark, f"{tmp_dir}/state").base["buckets"]
    run_events(spark, tmp_dir, [(event(k, k), 0, k) for k in range(40)], policy=policy)
    assert buckets() == 4
    run_events(spark, tmp_dir, [(event(k, k), 0, k) for k in range(40, 80)], policy=policy)
    assert buckets() == 4
    _, now = run_events(spark, tmp_dir, [(event(k, k), 0, k) for k in range(80, 120)], policy=policy)
    assert buckets() == 12 and now == {k: k for k in range(120)}


def test_the_base_is_not_shuffled(spark, tmp_dir):
    """Neither a read with pending changes nor the rewrite of a fold moves the base."""
    policy = StatePolicy(bucket_rows=10, fold_share=float("inf"))
    run_events(spark, tmp_dir, [(event(k, k), 0, k) for k in range(40)], policy=policy)
    run_events(spark, tmp_dir, [(event(k, -k), 0, 100 + k) for k in range(5)], policy=policy)
    now = read_state(spark, f"{tmp_dir}/state")
    plan = plan_text(now, "simple")
    base, changes = plan.split("Exchange hashpartitioning")              # one, on the changes' side
    assert "FullOuter" in base and "Bucketed: true" in base and "changes-1" in changes
    assert {r.id: r.distance_m for r in now.collect()} == {k: (-k if k < 5 else k) for k in range(40)}
    state.fold(spark, f"{tmp_dir}/state", 1, None, policy)
    files = {f.rsplit("_", 1)[1] for f in spark.read.parquet(f"{tmp_dir}/state/base-1").inputFiles()}
    assert len(files) == len(spark.read.parquet(f"{tmp_dir}/state/base-1").inputFiles()) == 4   # one a bucket


def test_gate_diverts_and_stops(spark, tmp_dir):
    quarantine = f"{tmp_dir}/quarantine"
    gate = Gate(quarantine_folder(quarantine), dt.datetime(2026, 1, 1), stop_share=0.5)
    good, bad = event(1, 1), event(2, -5)
    run, now = run_events(spark, tmp_dir, [(good, 0, 1), (bad, 0, 2)], gate=gate)
    assert now == {1: 1} and run.metrics[0]["quarantined"] == 1
    # a bad update leaves the row as it was; a delete passes even when its image is bad
    empty = event(1, 3).replace("Runing", " ")
    assert run_events(spark, tmp_dir, [(empty, 0, 3), (event(3, 3), 0, 4)], gate=gate)[1] == {1: 1, 3: 3}
    assert run_events(spark, tmp_dir, [(removal(3).replace("Runing", " "), 0, 5)], gate=gate)[1] == {1: 1}
    found = spark.read.parquet(quarantine)
    assert {(r.kafka_offset, tuple(r.broken_checks)) for r in found.collect()} == \
        {(2, ("negative(distance_m)",)), (3, ("blank_activity_type",))}
    with pytest.raises(Exception, match="2 of 3 rows break the checks"):
        run_events(spark, tmp_dir, [(event(5, -1), 0, 6), (event(6, -1), 0, 7), (event(7, 7), 0, 8)], gate=gate)
    assert {r.id for r in read_state(spark, f"{tmp_dir}/state").collect()} == {1}
    assert found.count() == spark.read.parquet(quarantine).count()


def test_notification_stream_matches_batch(spark):
    from strivelake.operators import notify
    i = Inputs(spark, SF_SMALL)
    streamed, rejects = pipelines.notification_run(spark, i)
    created = notify.creates(i.log)
    batch, bad = notify.notifications(notify.creates(i.log), i.names,
                                    keep=("kafka_partition", "kafka_offset", "id", "employee_id"))
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(streamed) == key(batch)
    assert streamed.count() > 0 and rejects.count() > 0
    assert key(rejects) == key(bad)
    assert streamed.count() + rejects.count() == created.count()
    assert streamed.filter(F.col("message").isNull()).count() == 0


def test_json_log_folder_source(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    log = f"{tmp_dir}/jsonlog"
    write_log_files(i.log, log, fmt="json")
    run = run_incremental_merge(spark, log, f"{tmp_dir}/state", f"{tmp_dir}/ckpt", fmt="json")
    assert run.batches == 1
    expected = cdc.initial_state(cdc.latest_per_key(cdc.parse_changes(i.log)))
    assert rows(read_state(spark, run.table)) == rows(expected)


def test_notifications_memory_sink(spark, tmp_dir):
    from strivelake.streaming.notifications import run_notifications
    i = Inputs(spark, SF_SMALL)
    write_log_files(i.log, f"{tmp_dir}/log")
    q = run_notifications(spark, f"{tmp_dir}/log", i.names, "memory:strivelake_test_messages",
                          f"{tmp_dir}/ck")
    q.awaitTermination()
    got = spark.table("strivelake_test_messages")
    assert got.count() == spark.read.parquet(f"{tmp_dir}/log").filter(
        F.col("value").contains('"op":"c"') & ~F.col("value").contains("not-a-date")).count()


def test_late_older_change_does_not_roll_back(spark, tmp_dir):
    import json
    r = {"id": 1, "employee_id": 1, "start_date": "2025-01-01T10:00:00Z", "activity_type": "Runing",
         "distance_m": 9, "end_date": "2025-01-01T11:00:00Z", "comment": None, "created_at": None}
    newer = json.dumps({"op": "u", "after": r, "ts_ms": 2})
    older = json.dumps({"op": "u", "after": dict(r, distance_m=1), "ts_ms": 1})
    schema = "value string, partition int, offset long"
    log, table, ck = f"{tmp_dir}/log", f"{tmp_dir}/state", f"{tmp_dir}/ck"
    write_log_files(spark.createDataFrame([(newer, 0, 10)], schema), log)
    run_incremental_merge(spark, log, table, ck)
    write_log_files(spark.createDataFrame([(older, 0, 5)], schema), log)   # arrives late
    run = run_incremental_merge(spark, log, table, ck)
    assert run.batches == 1
    assert [x.distance_m for x in read_state(spark, table).collect()] == [9]
