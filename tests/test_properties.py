"""Gold and the quality scan against plain-Python brute force on random inputs."""
import datetime as dt
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strivelake.operators import gold, quality
from strivelake.rules import Rules

AS_OF = dt.date(2002, 1, 1)
MODES = ["Marche/running", "Vélo/Trottinette/Autres", "Transports en commun", None]
SALARIES = ["1000", "2500,50", "3000 €", "n/a", None]
SPORTS = [None, "", "  ", "Tennis"]
DATES = ["2000-03-01T10:00:00Z", "2001-07-01T00:00:00Z", "2001-12-31T23:59:59Z", "bad"]

employee = st.tuples(st.sampled_from(SALARIES), st.sampled_from(MODES), st.booleans())
settings_ = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_gold(emps, sports, acts, rules):
    counts = Counter()
    years = set()
    for emp_id, date in acts:
        if date != "bad":
            y = int(date[:4])
            counts[(emp_id, y)] += 1
            years.add(y)
    years = years or {AS_OF.year}
    declared = defaultdict(bool)
    for emp_id, s in sports:
        declared[emp_id] |= s is not None and s.strip(" ") != ""
    out = {}
    for emp_id, (sal, mode, anomaly) in emps.items():
        salary = None
        if sal is not None:
            txt = "".join(ch for ch in sal.replace(",", ".") if ch in "0123456789.-")
            try:
                salary = float(txt)
            except ValueError:
                salary = None
        sportive = mode in rules.sportive_commute_modes
        for y in years:
            d = declared[emp_id]
            elig = d and sportive and (not rules.exclude_commute_anomaly or not anomaly)
            n = counts[(emp_id, y)]
            reason = ("no_sport_declared" if not d else "commute_not_sportive" if not sportive
                      else "commute_anomaly" if rules.exclude_commute_anomaly and anomaly
                      else "eligible_prime")
            out[(emp_id, y)] = (elig, salary * rules.prime_rate if elig and salary is not None else 0.0,
                                n, n >= rules.min_activities_for_wellbeing, reason)
    return out


@settings_
@given(emps=st.lists(employee, min_size=1, max_size=6),
       sports=st.lists(st.tuples(st.integers(0, 7), st.sampled_from(SPORTS)), max_size=10),
       acts=st.lists(st.tuples(st.integers(0, 7), st.sampled_from(DATES)), max_size=20),
       exclude=st.booleans(), minimum=st.integers(1, 3))
def test_gold_equals_brute_force(spark, emps, sports, acts, exclude, minimum):
    rules = Rules(min_activities_for_wellbeing=minimum, exclude_commute_anomaly=exclude)
    emp_map = dict(enumerate(emps))
    e = spark.createDataFrame(
        [(k, sal, mode, None, None, None, anomaly) for k, (sal, mode, anomaly) in emp_map.items()],
        "employee_id long, Salaire_brut string, commute_mode string, google_travel_mode string, "
        "distance_km double, max_allowed_km double, anomaly_commute boolean")
    s = spark.createDataFrame(sports, "employee_id long, Pratique_dun_sport string")
    a = spark.createDataFrame([(i, k, d) for i, (k, d) in enumerate(acts)],
                              "id long, employee_id long, start_date string")
    got = {(r.employee_id, r.year): (r.eligible_prime_sportive, r.prime_amount,
                                     r.physical_activities_count_year, r.eligible_wellbeing_days,
                                     r.eligibility_reason)
           for r in gold.benefits(e, s, a, rules, AS_OF).collect()}
    want = brute_gold(emp_map, sports, acts, rules)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and got[k][2:] == want[k][2:], k
        assert abs(got[k][1] - want[k][1]) < 1e-9, k


row = st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.integers(0, 3)),
                st.booleans(), st.one_of(st.none(), st.sampled_from(["Tennis", ""])),
                st.one_of(st.none(), st.integers(-3, 3)), st.booleans(), st.booleans())


@settings_
@given(rows=st.lists(row, max_size=25))
def test_quality_scan_equals_brute_force(spark, rows):
    t = dt.datetime(2025, 1, 1)
    data = [(i, e, t if s else None, ty, d, t if en else None, None, t if c else None)
            for (i, e, s, ty, d, en, c) in rows]
    df = spark.createDataFrame(data, "id long, employee_id long, start_date timestamp_ntz, "
                                     "activity_type string, distance_m long, end_date timestamp_ntz, "
                                     "comment string, created_at timestamp_ntz")
    now = dt.datetime(2025, 1, 1)
    both = lambda r: r[2] is not None and r[5] is not None
    got = {r.check: r.metric for r in quality.scan(df, now=now).collect()}
    ids = Counter(r[0] for r in data if r[0] is not None)
    want = {
        "row_count > 0": len(data),
        "missing_count(id) = 0": sum(r[0] is None for r in data),
        "missing_count(employee_id) = 0": sum(r[1] is None for r in data),
        "missing_count(start_date) = 0": sum(r[2] is None for r in data),
        "missing_count(end_date) = 0": sum(r[5] is None for r in data),
        "missing_count(activity_type) = 0": sum(r[3] is None for r in data),
        "missing_count(created_at) = 0": sum(r[7] is None for r in data),
        "duplicate_count(id) = 0": sum(1 for v in ids.values() if v > 1),
        "invalid_count(distance_m) = 0": sum(r[4] is not None and r[4] < 0 for r in data),
        "failed_rows(end_before_start) = 0": sum(both(r) and r[5] < r[2] for r in data),
        "failed_rows(duration_not_positive) = 0": sum(both(r) and r[5] <= r[2] for r in data),
        "failed_rows(blank_activity_type) = 0": sum(r[3] is not None and not r[3].strip(" ") for r in data),
        "failed_rows(start_in_far_future) = 0": sum(
            r[2] is not None and r[2] > now + dt.timedelta(days=1) for r in data),
    }
    assert got == want


sport = st.one_of(st.sampled_from(["Runing", "Randonnée", "Tennis", "Natation", "Voile", "Yoga"]),
                  st.text(alphabet="abcXYZé ", min_size=1, max_size=8))
distance = st.one_of(st.none(), st.just(0), st.integers(1, 120_000),
                     st.sampled_from([50, 150, 1050, 1150, 2450, 9950, 99950]))
comment = st.one_of(st.none(), st.just(""), st.text(alphabet="ab é!", max_size=6))


@settings_
@given(rows=st.lists(st.tuples(sport, st.integers(1, 600), distance, comment), min_size=1,
                     max_size=20))
def test_message_text_equals_the_rule(spark, rows):
    from pyspark.sql import functions as F

    from strivelake.functions import expressions as X
    from test_functions import _expected_message
    df = spark.createDataFrame([("P1 N", s, m, d, c) for s, m, d, c in rows],
                               "n string, s string, m long, d long, c string")
    got = [r[0] for r in df.select(X.message_text(F.col("n"), F.col("s"), F.col("m"),
                                                  F.col("d"), F.col("c"))).collect()]
    assert got == [_expected_message("P1 N", s, m, d, c) for s, m, d, c in rows]
