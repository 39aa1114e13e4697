import datetime as dt

import pytest

from strivelake.operators import quality

SCHEMA = ("id long, employee_id long, start_date timestamp_ntz, activity_type string, "
          "distance_m long, end_date timestamp_ntz, comment string, created_at timestamp_ntz")
T0 = dt.datetime(2025, 1, 1, 10)
T1 = dt.datetime(2025, 1, 1, 11)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_scan_counts(spark):
    df = table(spark, [
        (1, 1, T0, "Tennis", None, T1, None, T0),
        (1, 1, T0, "Tennis", -5, T1, None, T0),          # duplicate id, negative distance
        (2, None, None, "Runing", 10, T1, None, None),    # missing employee, start, created
        (None, 3, T0, None, 10, None, None, T0),         # missing id, type, end
        (None, 3, T0, "x", 10, T1, None, T0),
    ])
    got = {r.check: (r.metric, r.passed) for r in quality.scan(df).collect()}
    assert got["row_count > 0"] == (5, True)
    assert got["missing_count(id) = 0"] == (2, False)
    assert got["missing_count(employee_id) = 0"] == (1, False)
    assert got["missing_count(start_date) = 0"] == (1, False)
    assert got["missing_count(end_date) = 0"] == (1, False)
    assert got["missing_count(activity_type) = 0"] == (1, False)
    assert got["missing_count(created_at) = 0"] == (1, False)
    assert got["duplicate_count(id) = 0"] == (1, False)      # null ids are not duplicates
    assert got["invalid_count(distance_m) = 0"] == (1, False)
    assert got["failed_rows(end_before_start) = 0"] == (0, True)
    late = {r.check: r.metric for r in quality.scan(df, now=dt.datetime(2024, 1, 1)).collect()}
    assert late["failed_rows(start_in_far_future) = 0"] == 4
    empty = {r.check: r.passed for r in quality.scan(df.limit(0)).collect()}
    assert empty["row_count > 0"] is False


def test_failed_rows(spark):
    df = table(spark, [
        (1, 1, T0, "Tennis", None, T0, None, T0),                       # zero duration
        (2, 1, T1, "Tennis", None, T0, None, T0),                       # end before start
        (3, 1, T0, "  ", None, T1, None, T0),                           # blank type
        (4, 1, dt.datetime(2030, 1, 1), "Tennis", None, dt.datetime(2030, 1, 2), None, T0),
        (5, 1, None, "Tennis", None, T1, None, T0),                     # null start: no rule fires
    ])
    got = sorted((r.check, r.id) for r in quality.failed_rows(df, dt.datetime(2025, 6, 1)).collect())
    assert got == [("blank_activity_type", 3), ("duration_not_positive", 1),
                   ("duration_not_positive", 2), ("end_before_start", 2),
                   ("start_in_far_future", 4)]


def test_assertions(spark):
    df = spark.createDataFrame([(1, 2001), (1, 2001), (2, None)], "employee_id long, year int")
    with pytest.raises(ValueError, match="duplicate"):
        quality.assert_unique(df, ["employee_id", "year"], "gold")
    with pytest.raises(ValueError, match="null key"):
        quality.assert_not_null(df, ["employee_id", "year"], "gold")
    with pytest.raises(ValueError, match="empty"):
        quality.assert_not_empty(df.limit(0), "gold")
    quality.assert_unique(df.dropDuplicates(), ["employee_id", "year"], "gold")
    r = quality.unique_key_report(df, ["employee_id", "year"], "gold").first()
    assert (r.duplicate_groups, r.passed) == (1, False)
    assert quality.not_empty_report(df.limit(0), "x").first().has_rows is False


def test_duplicate_sample_is_sorted_top5(spark):
    df = spark.createDataFrame([(k,) for k in range(20, 0, -1) for _ in range(2)], "employee_id long")
    got = [r.employee_id for r in quality.duplicate_sample(df, ["employee_id"]).collect()]
    assert got == [1, 2, 3, 4, 5]


def test_distance_plausibility(spark):
    df = spark.createDataFrame([(1, "Tennis", 100), (2, "Runing", None), (3, "Natation", 6000),
                                (4, "Runing", 5000), (5, "Tennis", None)],
                               "id long, activity_type string, distance_m long")
    got = {r.id: r.reason for r in quality.distance_plausibility(df).collect()}
    assert got == {1: "distance_not_expected", 2: "distance_missing", 3: "distance_out_of_range"}
