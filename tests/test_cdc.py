import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plan_text import plan_text

from strivelake.operators import cdc
from strivelake.schemas import STATE_COLUMNS


def row(i, emp=1, kind="Runing", dist=1000):
    return {"id": i, "employee_id": emp, "start_date": "2025-01-01T10:00:00Z",
            "activity_type": kind, "distance_m": dist, "end_date": "2025-01-01T11:00:00Z",
            "comment": None, "created_at": "2025-01-01T10:00:00Z"}


def env(op, r, ts=1, wrapped=True):
    body = {"op": op, "after": None if op == "d" else r, "before": r if op == "d" else None,
            "ts_ms": ts}
    return json.dumps({"payload": body} if wrapped else body)


def log_df(spark, records):
    return spark.createDataFrame(records, "value string, partition int, offset long")


def test_parse_both_envelopes_and_drop_junk(spark):
    recs = [(env("c", row(1)), 0, 0), (env("u", row(1, dist=5), wrapped=False), 0, 1),
            (env("d", row(2)), 1, 2), ("{not json", 0, 3), (None, 0, 4),
            (json.dumps({"payload": {"op": "c"}}), 0, 5),          # no row image
            (json.dumps({"op": None, "after": row(3)}), 0, 6)]     # no op
    got = cdc.parse_changes(log_df(spark, recs)).orderBy("kafka_offset").collect()
    assert [(r.op, r.id, r.kafka_offset) for r in got] == [("c", 1, 0), ("u", 1, 1), ("d", 2, 2)]
    assert got[1].distance_m == 5
    assert got[0].last_event_ts_ms == 1


def test_latest_per_key_offset_then_partition(spark):
    recs = [(env("c", row(1, dist=1)), 0, 10), (env("u", row(1, dist=2)), 0, 11),
            (env("u", row(1, dist=3)), 1, 11), (env("c", row(2)), 2, 5)]
    latest = cdc.latest_per_key(cdc.parse_changes(log_df(spark, recs)))
    got = {r.id: (r.distance_m, r.last_op) for r in latest.collect()}
    assert got == {1: (3, "u"), 2: (1000, "c")}


def test_latest_per_key_plan_has_partial_window_group_limit(spark):
    recs = [(env("c", row(1)), 0, 0)]
    latest = cdc.latest_per_key(cdc.parse_changes(log_df(spark, recs)))
    plan = plan_text(latest)
    assert "WindowGroupLimit" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def state_rows(spark, rows):
    return spark.createDataFrame(rows, cdc_schema(spark))


def cdc_schema(spark):
    from strivelake.schemas import ACTIVITY_SCHEMA
    from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
    return StructType(list(ACTIVITY_SCHEMA.fields) + [
        StructField("last_op", StringType()), StructField("last_event_ts_ms", LongType()),
        StructField("kafka_partition", IntegerType()), StructField("kafka_offset", LongType())])


def srow(i, op, part, off, dist=1):
    r = row(i, dist=dist)
    return tuple(r[c] for c in r) + (op, 1, part, off)


def test_merge_cases(spark):
    target = state_rows(spark, [srow(1, "c", 0, 1), srow(2, "c", 0, 2), srow(3, "c", 0, 3)])
    changes = state_rows(spark, [srow(1, "d", 0, 10), srow(2, "u", 0, 11, dist=9),
                                 srow(4, "c", 0, 12), srow(5, "d", 0, 13)])
    got = {r.id: (r.distance_m, r.last_op)
           for r in cdc.merge_state(target, changes).collect()}
    # 1 deleted, 2 updated, 3 untouched, 4 inserted, 5 (delete of unknown) ignored
    assert got == {2: (9, "u"), 3: (1, "c"), 4: (1, "c")}
    anti = {r.id: (r.distance_m, r.last_op)
            for r in cdc.merge_state_anti_union(target, changes).collect()}
    assert anti == got


def test_merge_keeps_target_rows_without_a_key(spark):
    target = state_rows(spark, [srow(1, "c", 0, 1), srow(None, "c", 0, 2)])
    changes = state_rows(spark, [srow(1, "d", 0, 10), srow(3, "c", 0, 11)])
    assert {r.id for r in cdc.merge_state(target, changes).collect()} == {None, 3}


def test_merge_reads_each_side_once(spark, tmp_dir):
    state_rows(spark, [srow(1, "c", 0, 1)]).write.parquet(f"{tmp_dir}/t")
    state_rows(spark, [srow(1, "u", 0, 2)]).write.parquet(f"{tmp_dir}/c")
    plan = plan_text(cdc.merge_state(spark.read.parquet(f"{tmp_dir}/t"), spark.read.parquet(f"{tmp_dir}/c")))
    assert plan.count("Location: InMemoryFileIndex") == 2


def test_merge_guard_ignores_stale_change(spark):
    target = state_rows(spark, [srow(1, "u", 0, 50, dist=7)])
    stale = state_rows(spark, [srow(1, "u", 0, 20, dist=1)])
    assert cdc.merge_state(target, stale).first().distance_m == 7
    assert cdc.merge_state(target, stale, guard=False).first().distance_m == 1


def test_merge_is_idempotent(spark):
    target = state_rows(spark, [srow(1, "c", 0, 1), srow(2, "c", 0, 2)])
    changes = state_rows(spark, [srow(1, "u", 0, 10, dist=4), srow(2, "d", 0, 11),
                                 srow(3, "c", 0, 12)])
    once = cdc.merge_state(target, changes)
    twice = cdc.merge_state(once, changes)
    key = lambda df: sorted(tuple(r) for r in df.select(*STATE_COLUMNS).collect())
    assert key(once) == key(twice)


events = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["c", "u", "r", "d"]),
                            st.integers(0, 3)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(evs=events, cuts=st.lists(st.integers(0, 40), max_size=3))
def test_any_batch_split_gives_the_same_state(spark, evs, cuts):
    recs = [(env(op, row(k, dist=off)), k % 2, off) for off, (k, op, _) in enumerate(evs)]
    full = cdc.initial_state(cdc.latest_per_key(cdc.parse_changes(log_df(spark, recs))))
    bounds = sorted(set([0, len(recs)] + [min(c, len(recs)) for c in cuts]))
    state = None
    for a, b in zip(bounds, bounds[1:]):
        latest = cdc.latest_per_key(cdc.parse_changes(log_df(spark, recs[a:b])))
        if state is None:
            state = cdc.initial_state(latest)
        else:
            state = cdc.merge_state(state, latest)
        state = spark.createDataFrame(state.collect(), cdc_schema(spark))
    key = lambda df: sorted(tuple(r) for r in df.select(*STATE_COLUMNS).collect())
    assert key(state) == key(full)


def test_insert_if_absent_keeps_existing_and_first_new(spark):
    target = state_rows(spark, [srow(1, "c", 0, 1)])
    source = state_rows(spark, [srow(1, "c", 0, 5, dist=99), srow(2, "c", 0, 6, dist=1),
                                srow(2, "c", 0, 7, dist=2)])
    got = {r.id: r.distance_m for r in cdc.insert_if_absent(target, source).collect()}
    assert got == {1: 1, 2: 1}


def test_next_offsets(spark):
    prev = spark.createDataFrame([(0, 10), (1, 20)], "kafka_partition int, next_offset long")
    batch = spark.createDataFrame([(0, 14), (1, 5), (2, 3)], "kafka_partition int, max_offset long")
    got = {r[0]: r[1] for r in cdc.next_offsets(prev, batch).collect()}
    # D-3: a batch max below the stored offset does not move it (no over-advance)
    assert got == {0: 15, 1: 20, 2: 4}
    assert {r[0]: r[1] for r in cdc.next_offsets(None, batch).collect()} == {0: 15, 1: 6, 2: 4}


def test_op_histogram_and_metrics(spark):
    recs = [(env("c", row(1)), 0, 0), (env("u", row(1)), 0, 1), (env("d", row(2)), 0, 2)]
    ch = cdc.parse_changes(log_df(spark, recs))
    latest = cdc.latest_per_key(ch)
    assert {r[0]: r[1] for r in cdc.op_histogram(latest).collect()} == {"u": 1, "d": 1}
    m = {r.metric: r.value for r in cdc.run_metrics(ch, latest, cdc.initial_state(latest)).collect()}
    assert m == {"events_read": 3, "ids_touched": 2, "live_rows": 1}


def test_null_ids_are_rejected(spark):
    r = row(None)
    recs = [(env("c", r), 0, 0), (env("c", row(1)), 0, 1)]
    latest = cdc.latest_per_key(cdc.parse_changes(log_df(spark, recs)))
    assert [x.id for x in latest.collect()] == [1]
    assert latest.filter(F.col("id").isNull()).count() == 0
