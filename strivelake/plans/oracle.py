"""DuckDB SQL that recomputes each registered query from the base tables.

The SQL deliberately does not share the Spark code path: fixtures are built
with CASE/arithmetic straight from the driver tables, change events are read
from ``events`` without any JSON, and each operator is re-stated in plain SQL.
Common table expressions are assembled on demand with their dependencies.
"""
from __future__ import annotations

import datetime as dt

from strivelake.rules import FIXTURE_AS_OF, FIXTURE_RULES, Rules

_CTES: dict[str, str] = {}
_DEPS: dict[str, tuple[str, ...]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    _CTES[name] = sql
    _DEPS[name] = deps


def build(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{_CTES[n]}\n)" for n in order) + "\n" + body


ISO_S = "%Y-%m-%dT%H:%M:%SZ"
ISO_US = "%Y-%m-%dT%H:%M:%S.%fZ"
STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x=x)


def parse(x: str) -> str:
    return f"try_cast({x} AS TIMESTAMP)"


# ---------------------------------------------------------------- fixtures
cte("f_activities", f"""
SELECT o_orderkey AS id, o_custkey AS employee_id,
  CASE WHEN o_orderkey % 211 = 0 THEN 'not-a-date' ELSE strftime(st, '{ISO_S}') END AS start_date,
  activity_type,
  CASE WHEN activity_type IN ('Tennis','Badminton','Escalade','Voile') THEN NULL
       WHEN o_orderkey % 173 = 0 THEN -1000
       ELSE (o_orderkey * 37) % 17500 END AS distance_m,
  strftime(CASE WHEN o_orderkey % 199 = 0 THEN st - INTERVAL 1 MINUTE
                ELSE st + to_minutes(CAST(20 + o_orderkey % 161 AS BIGINT)) END, '{ISO_S}') AS end_date,
  CASE o_orderkey % 4 WHEN 0 THEN 'Belle séance' WHEN 1 THEN '' ELSE NULL END AS comment,
  strftime(o_orderdate, '{ISO_S}') AS created_at
FROM (SELECT o_orderkey, o_custkey, o_orderdate,
             CASE WHEN o_orderkey % 227 = 0 THEN o_orderdate + INTERVAL 40 YEAR ELSE o_orderdate END
               + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS st,
             CASE WHEN o_orderkey % 181 = 0 THEN '  ' ELSE
             (['Runing','Randonnée','Tennis','Badminton','Escalade','Natation','Triathlon','Voile'])
               [CAST(o_orderkey % 8 AS INTEGER) + 1] END AS activity_type
      FROM orders)""")

cte("f_employee_sheet", """
SELECT c_custkey AS "ID salarié", c_name AS "Nom", 'P' || CAST(c_custkey AS VARCHAR) AS "Prénom",
  CASE c_custkey % 4 WHEN 0 THEN s WHEN 1 THEN replace(s, '.', ',') WHEN 2 THEN s || ' €'
       ELSE 'n/a' END AS "Salaire brut",
  CASE c_mktsegment WHEN 'MACHINERY' THEN '  Marche/Running '
       WHEN 'AUTOMOBILE' THEN 'véhicule thermique/électrique'
       WHEN 'BUILDING' THEN 'VELO/Trottinette/Autres'
       WHEN 'HOUSEHOLD' THEN 'Transports en commun'
       WHEN 'FURNITURE' THEN 'Cheval' END AS "Moyen de déplacement",
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN ''
       ELSE 'addr-' || CAST(c_custkey % 400 AS VARCHAR) END AS "Adresse du domicile"
FROM (SELECT *, CAST(CAST(round(abs(c_acctbal) * 10, 2) AS DECIMAL(14,2)) AS VARCHAR) AS s
      FROM customer)""")

CANON_MODE = """CASE lower({x})
       WHEN 'transports en commun' THEN 'Transports en commun'
       WHEN 'véhicule thermique/électrique' THEN 'véhicule thermique/électrique'
       WHEN 'vehicule thermique/electrique' THEN 'véhicule thermique/électrique'
       WHEN 'marche/running' THEN 'Marche/running'
       WHEN 'vélo/trottinette/autres' THEN 'Vélo/Trottinette/Autres'
       WHEN 'velo/trottinette/autres' THEN 'Vélo/Trottinette/Autres' END"""

cte("f_employees", f"""
SELECT "ID salarié" AS employee_id, "Nom", "Prénom", "Salaire brut" AS "Salaire_brut",
  "Moyen de déplacement" AS "Moyen_de_déplacement", "Adresse du domicile" AS "Adresse_du_domicile",
  {CANON_MODE.format(x=strip('"Moyen de déplacement"'))} AS commute_mode
FROM f_employee_sheet""", "f_employee_sheet")

cte("f_names", """
SELECT "ID salarié" AS employee_id,
  CASE WHEN "ID salarié" % 19 = 0 THEN 'Q' || "Prénom" ELSE "Prénom" END AS "Prénom", "Nom"
FROM f_employee_sheet WHERE "ID salarié" % 17 <> 0""", "f_employee_sheet")

cte("f_sport_sheet", """
SELECT c_custkey AS "ID salarié",
  unnest(CASE WHEN c_custkey % 31 = 0 THEN [NULL, 'Tennis']
              ELSE [([NULL, '', '  ', 'Tennis', 'Runing'])[CAST(c_custkey % 5 AS INTEGER) + 1]]
         END) AS "Pratique d'un sport"
FROM customer WHERE c_custkey % 37 <> 0""")

cte("f_sport", """
SELECT "ID salarié" AS employee_id, "Pratique d'un sport" AS "Pratique_dun_sport" FROM f_sport_sheet""",
    "f_sport_sheet")

cte("f_routes", """
SELECT DISTINCT 'addr-' || CAST(c_custkey % 400 AS VARCHAR) AS home_address,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'WALK' WHEN 'BUILDING' THEN 'BICYCLE' END AS travel_mode,
  ((c_custkey % 400) * 97) % 32000 AS meters
FROM customer
WHERE c_custkey % 23 <> 0 AND c_custkey % 29 <> 0 AND (c_custkey % 400) % 41 <> 0
  AND c_mktsegment IN ('MACHINERY', 'BUILDING')""")

cte("f_travel", """
SELECT 'Marche/running' AS mode, 'WALK' AS travel_mode, CAST(15.0 AS DOUBLE) AS max_km
UNION ALL SELECT 'Vélo/Trottinette/Autres', 'BICYCLE', CAST(25.0 AS DOUBLE)""")

cte("f_enriched", f"""
SELECT e.employee_id, e."Nom", e."Prénom", e."Salaire_brut", e."Moyen_de_déplacement",
  e."Adresse_du_domicile", e.commute_mode, t.travel_mode AS google_travel_mode,
  r.km AS distance_km, t.max_km AS max_allowed_km,
  coalesce(r.km > t.max_km, false) AS anomaly_commute
FROM (SELECT *, CASE WHEN {strip('"Adresse_du_domicile"')} <> ''
                     THEN {strip('"Adresse_du_domicile"')} END AS home
      FROM f_employees) e
LEFT JOIN f_travel t ON e.commute_mode = t.mode
LEFT JOIN (SELECT home_address, travel_mode,
                  round(CAST(min(meters) AS DOUBLE) / CAST(1000 AS DOUBLE), 3) AS km
           FROM f_routes GROUP BY home_address, travel_mode) r
  ON r.home_address = e.home AND r.travel_mode = t.travel_mode""",
    "f_employees", "f_routes", "f_travel")

cte("f_by_year", f"""
SELECT employee_id, CAST(year(ts) AS INTEGER) AS activity_year,
  count(*) AS physical_activities_count_year
FROM (SELECT employee_id, {parse('start_date')} AS ts FROM f_activities)
WHERE ts IS NOT NULL GROUP BY employee_id, CAST(year(ts) AS INTEGER)""", "f_activities")

cte("f_sport_flag", """
SELECT employee_id, bool_or(coalesce(trim("Pratique_dun_sport") <> '', false)) AS sport_practice_declared
FROM f_sport GROUP BY employee_id""", "f_sport")


def years_cte(name: str, by_year: str, as_of: dt.date) -> None:
    cte(name, f"""
SELECT DISTINCT activity_year FROM {by_year}
UNION ALL SELECT CAST({as_of.year} AS INTEGER) WHERE NOT EXISTS (SELECT 1 FROM {by_year})""", by_year)


years_cte("f_years", "f_by_year", FIXTURE_AS_OF)

GOLD_COLUMNS = ("employee_id, year, annual_gross_salary, commute_mode, google_travel_mode, "
                "distance_km, max_allowed_km, anomaly_commute, sport_practice_declared, "
                "physical_activities_count_year, eligible_prime_sportive, prime_rate, prime_amount, "
                "eligible_wellbeing_days, wellbeing_days_granted, eligibility_reason, load_date")


def salary_sql(x: str) -> str:
    return (f"try_cast(regexp_replace(replace(CAST({x} AS VARCHAR), ',', '.'), '[^0-9.-]', '', 'g')"
            " AS DOUBLE)")


def gold_sql(enriched: str, years: str, sport_flag: str, by_year: str,
             rules: Rules = FIXTURE_RULES, as_of: dt.date = FIXTURE_AS_OF) -> str:
    modes = ", ".join("'" + m.replace("'", "''") + "'" for m in rules.sportive_commute_modes)
    excl = "true" if rules.exclude_commute_anomaly else "false"
    rate = f"CAST({float(rules.prime_rate)!r} AS DOUBLE)"
    eligible = f"(g.declared AND g.sportive AND (NOT {excl} OR NOT g.anom))"
    return f"""
SELECT g.employee_id, g.year, g.annual_gross_salary, g.commute_mode, g.google_travel_mode,
  g.distance_km, g.max_allowed_km, g.anomaly_commute,
  g.declared AS sport_practice_declared, g.cnt AS physical_activities_count_year,
  {eligible} AS eligible_prime_sportive,
  {rate} AS prime_rate,
  CAST(CASE WHEN {eligible} AND g.annual_gross_salary IS NOT NULL
            THEN g.annual_gross_salary * {rate} ELSE 0.0 END AS DOUBLE) AS prime_amount,
  g.cnt >= {int(rules.min_activities_for_wellbeing)} AS eligible_wellbeing_days,
  CAST(CASE WHEN g.cnt >= {int(rules.min_activities_for_wellbeing)}
            THEN {int(rules.wellbeing_days)} ELSE 0 END AS INTEGER) AS wellbeing_days_granted,
  CASE WHEN NOT g.declared THEN 'no_sport_declared'
       WHEN NOT g.sportive THEN 'commute_not_sportive'
       WHEN {excl} AND g.anom THEN 'commute_anomaly'
       ELSE 'eligible_prime' END AS eligibility_reason,
  DATE '{as_of.isoformat()}' AS load_date
FROM (
  SELECT e.employee_id, y.activity_year AS year,
    {salary_sql('e."Salaire_brut"')} AS annual_gross_salary,
    e.commute_mode, e.google_travel_mode, e.distance_km, e.max_allowed_km, e.anomaly_commute,
    coalesce(s.sport_practice_declared, false) AS declared,
    CAST(coalesce(a.physical_activities_count_year, 0) AS BIGINT) AS cnt,
    coalesce(e.commute_mode IN ({modes}), false) AS sportive,
    coalesce(e.anomaly_commute, false) AS anom
  FROM {enriched} e CROSS JOIN {years} y
  LEFT JOIN {sport_flag} s ON s.employee_id = e.employee_id
  LEFT JOIN {by_year} a ON a.employee_id = e.employee_id AND a.activity_year = y.activity_year
) g"""


cte("f_gold", gold_sql("f_enriched", "f_years", "f_sport_flag", "f_by_year"),
    "f_enriched", "f_years", "f_sport_flag", "f_by_year")

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = build(body, *ctes)


oracle("gold_benefits_employee_year", "SELECT * FROM f_gold", "f_gold")

# ---------------------------------------------------------------- change log (no JSON)
cte("f_changes", f"""
SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'r' WHEN 'view' THEN 'u'
                       WHEN 'click' THEN 'u' WHEN 'error' THEN 'd' END AS op,
  CAST(epoch_us(ts) // 1000 AS BIGINT) AS last_event_ts_ms,
  CAST(user_id % 4 AS INTEGER) AS kafka_partition,
  event_id AS kafka_offset,
  user_id AS id, user_id AS employee_id,
  CASE WHEN event_id % 89 = 0 THEN 'not-a-date' ELSE strftime(ts, '{ISO_US}') END AS start_date,
  event_type AS activity_type,
  CAST(floor(value * 100) AS BIGINT) AS distance_m,
  strftime(ts + INTERVAL 30 MINUTE, '{ISO_US}') AS end_date,
  props AS comment,
  strftime(ts, '{ISO_US}') AS created_at,
  least(2, CAST((event_id - lo) * 3 // (hi - lo + 1) AS INTEGER)
           + CASE WHEN event_id % 53 = 0 THEN 1 ELSE 0 END) AS batch
FROM events, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events)
WHERE event_id % 101 <> 0 AND event_id % 97 <> 0
  AND event_type IN ('signup', 'purchase', 'view', 'click', 'error')""")

ROW_COLS = "id, employee_id, start_date, activity_type, distance_m, end_date, comment, created_at"
STATE_COLS = ROW_COLS + ", last_op, last_event_ts_ms, kafka_partition, kafka_offset"
CHANGE_COLS = "op, last_event_ts_ms, kafka_partition, kafka_offset, " + ROW_COLS


def latest_cte(name: str, batches: tuple[int, ...] | None) -> None:
    where = "" if batches is None else f"WHERE batch IN ({', '.join(map(str, batches))})"
    cte(name, f"""
SELECT {ROW_COLS}, op AS last_op, last_event_ts_ms, kafka_partition, kafka_offset, batch FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY kafka_offset DESC, kafka_partition DESC) AS rn
  FROM f_changes {where}) WHERE rn = 1""", "f_changes")


latest_cte("f_latest_all", None)
latest_cte("f_latest_b0", (0,))
latest_cte("f_latest_b12", (1, 2))
cte("f_state_all", f"SELECT {STATE_COLS} FROM f_latest_all WHERE last_op <> 'd'", "f_latest_all")
cte("f_state_b0", f"SELECT {STATE_COLS} FROM f_latest_b0 WHERE last_op <> 'd'", "f_latest_b0")


cte("f_state_unguarded", f"""
SELECT {STATE_COLS} FROM f_state_b0 WHERE id NOT IN (SELECT id FROM f_latest_b12)
UNION ALL SELECT {STATE_COLS} FROM f_latest_b12 WHERE last_op <> 'd'""", "f_state_b0", "f_latest_b12")

# ---------------------------------------------------------------- notifications
SPORT_LABEL = """CASE {x} WHEN 'Runing' THEN 'course' WHEN 'Randonnée' THEN 'randonnée'
  WHEN 'Tennis' THEN 'tennis' WHEN 'Badminton' THEN 'badminton' WHEN 'Escalade' THEN 'escalade'
  WHEN 'Natation' THEN 'natation' WHEN 'Triathlon' THEN 'triathlon' ELSE lower({x}) END"""


def km_sql(m: str) -> str:
    return f"replace(printf('%.1f', CAST({m} AS DOUBLE) / 1000.0), '.', ',')"


def duration_sql(start: str, end: str) -> str:
    d = f"(epoch_us({parse(end)}) - epoch_us({parse(start)}))"
    return f"CASE WHEN {d} IS NULL THEN NULL ELSE greatest(1, CAST(floor({d} / 60000000) AS BIGINT)) END"


def message_sql(name: str, sport: str, minutes: str, dist: str, comment: str) -> str:
    sport = f"coalesce({sport}, 'sport')"
    has = f"coalesce({dist} <> 0, false)"
    km = km_sql(dist)
    mins = f"CAST({minutes} AS VARCHAR)"
    label = SPORT_LABEL.format(x=sport)
    return f"""(CASE
  WHEN {sport} = 'Runing' AND {has} THEN 'Bravo ' || {name} || ' ! Tu viens de courir ' || {km} || ' km en ' || {mins} || ' min ! Quelle énergie ! 🔥🏅'
  WHEN {sport} = 'Randonnée' AND {has} THEN 'Magnifique ' || {name} || ' ! Une randonnée de ' || {km} || ' km terminée en ' || {mins} || ' min ! 🌄'
  WHEN {has} THEN 'Bravo ' || {name} || ' ! Tu viens de finir ton activité de ' || {label} || ' (' || {km} || ' km) en ' || {mins} || ' min ! 🔥'
  ELSE 'Bravo ' || {name} || ', tu viens de finir ton activité de ' || {label} || ' qui t''a pris ' || {mins} || ' min ! 🔥'
END || CASE WHEN coalesce({comment} <> '', false) THEN ' ("' || {comment} || '")' ELSE '' END)"""


FULL_NAME = (f"coalesce({strip('n.\"Prénom\"')}, 'Un') || ' ' || "
             f"coalesce({strip('n.\"Nom\"')}, 'collègue')")
cte("f_creates", f"""
SELECT kafka_partition, kafka_offset, last_event_ts_ms, {ROW_COLS} FROM f_changes WHERE op = 'c'""", "f_changes")

# ---------------------------------------------------------------- by-year variants
cte("f_by_year_bad", f"""
SELECT employee_id, CAST(year(ts) AS INTEGER) AS activity_year, count(*) AS physical_activities_count_year
FROM (SELECT employee_id, {parse('start_date')} AS ts FROM f_activities WHERE {parse('start_date')} IS NULL)
WHERE ts IS NOT NULL GROUP BY employee_id, CAST(year(ts) AS INTEGER)""", "f_activities")
years_cte("f_years_bad", "f_by_year_bad", FIXTURE_AS_OF)
cte("f_e2e_acts", f"SELECT {ROW_COLS} FROM f_state_all", "f_state_all")
cte("f_by_year_e2e", f"""
SELECT employee_id, CAST(year(ts) AS INTEGER) AS activity_year, count(*) AS physical_activities_count_year
FROM (SELECT employee_id, {parse('start_date')} AS ts FROM f_e2e_acts)
WHERE ts IS NOT NULL GROUP BY employee_id, CAST(year(ts) AS INTEGER)""", "f_e2e_acts")
years_cte("f_years_e2e", "f_by_year_e2e", FIXTURE_AS_OF)
cte("f_gold_e2e", gold_sql("f_enriched", "f_years_e2e", "f_sport_flag", "f_by_year_e2e"),
    "f_enriched", "f_years_e2e", "f_sport_flag", "f_by_year_e2e")
cte("f_gold_keep_anomaly",
    gold_sql("f_enriched", "f_years", "f_sport_flag", "f_by_year",
             FIXTURE_RULES.with_(exclude_commute_anomaly=False)),
    "f_enriched", "f_years", "f_sport_flag", "f_by_year")
cte("f_spine", "SELECT e.employee_id, y.activity_year FROM f_enriched e CROSS JOIN f_years y",
    "f_enriched", "f_years")

# ---------------------------------------------------------------- quality
cte("f_operational", f"""
SELECT id, employee_id, {parse('start_date')} AS start_date, activity_type, distance_m,
  {parse('end_date')} AS end_date, comment, {parse('created_at')} AS created_at
FROM f_activities""", "f_activities")

# ================================================================ oracle per key
oracle("src_cdc_scan", """
SELECT CAST(user_id % 4 AS INTEGER) AS kafka_partition, count(*) AS records,
  min(event_id) AS min_offset, max(event_id) AS max_offset,
  CAST(count_if(event_id % 101 = 0) AS BIGINT) AS null_values
FROM events GROUP BY CAST(user_id % 4 AS INTEGER)""")
# the newest change of every key of the whole log, in whatever batches and order it was merged
for _k in ("src_cdc_empty_batch", "stream_incremental_merge", "src_state_scan", "stream_reset_replay",
           "cdc_initial_load", "cdc_merge_state", "cdc_merge_state_stepwise"):
    oracle(_k, "SELECT * FROM f_state_all", "f_state_all")
oracle("cdc_merge_anti_union", "SELECT * FROM f_state_unguarded", "f_state_unguarded")
# the gate: deletes pass, the other rows need a start that parses and lies before GATE_NOW + 1 day
cte("f_gate", f"""
SELECT *, CASE WHEN op = 'd' THEN '' WHEN event_start IS NULL THEN 'missing(start_date)'
               WHEN event_start > TIMESTAMP '2024-01-30 00:00:00' THEN 'start_in_far_future' ELSE '' END AS broken_checks
FROM (SELECT *, {parse('start_date')} AS event_start FROM f_changes)""", "f_changes")
oracle("stream_quarantine", f"SELECT {CHANGE_COLS}, broken_checks FROM f_gate WHERE broken_checks <> ''", "f_gate")


def newest_sql(source: str, order: str, where: str = "true") -> str:
    return f"""
SELECT {STATE_COLS} FROM (
  SELECT *, op AS last_op, row_number() OVER (PARTITION BY id ORDER BY {order} DESC) AS rn
  FROM {source} WHERE {where}) WHERE rn = 1 AND last_op <> 'd'"""


oracle("stream_gated_state", newest_sql("f_gate", "kafka_offset", "broken_checks = ''"), "f_gate")
oracle("stream_from_saved_offsets", newest_sql(
    "f_changes c JOIN (SELECT kafka_partition AS p, max(kafka_offset) AS seen FROM f_changes WHERE batch = 0 GROUP BY 1) s"
    " ON c.kafka_partition = s.p", "kafka_offset", "kafka_offset > seen"), "f_changes")
# offsets and partitions as the moved log has them; the true order is that of the events
cte("f_moved", f"""
SELECT op, {ROW_COLS}, last_event_ts_ms, CAST((id + kafka_offset % 3) % 4 AS INTEGER) AS kafka_partition,
  kafka_offset % 997 AS kafka_offset, kafka_offset AS event_id FROM f_changes""", "f_changes")
oracle("cdc_merge_moved_keys", newest_sql("f_moved", "event_id"), "f_moved")
oracle("stream_activity_counts", "SELECT * FROM f_by_year_e2e", "f_by_year_e2e")
oracle("stream_gold_view", "SELECT * FROM f_gold_e2e", "f_gold_e2e")
oracle("stream_progress_totals", "SELECT CAST(3 AS BIGINT) AS runs, count(*) AS records FROM events")
oracle("stream_notifications_once", f"""
SELECT c.kafka_partition, c.id, c.employee_id, c.last_event_ts_ms AS event_ts_ms,
  {message_sql(FULL_NAME, 'c.activity_type', duration_sql('c.start_date', 'c.end_date'),
               'c.distance_m', 'c.comment')} AS message
FROM f_creates c LEFT JOIN f_names n ON n.employee_id = c.employee_id
WHERE {duration_sql('c.start_date', 'c.end_date')} IS NOT NULL""", "f_creates", "f_names")
NAME_AT = (f"CASE WHEN n.employee_id IS NULL OR (c.employee_id % 5 = 0 AND c.last_event_ts_ms < 1704844800000) "
           f"THEN 'Un collègue' WHEN c.employee_id % 3 = 0 AND c.last_event_ts_ms >= 1705276800000 "
           f"THEN 'R' || c.employee_id || ' ' || {strip('n.\"Nom\"')} ELSE {FULL_NAME} END")
oracle("stream_names_at_event", f"""
SELECT c.kafka_partition, c.kafka_offset, c.id, c.employee_id,
  {message_sql('(' + NAME_AT + ')', 'c.activity_type', duration_sql('c.start_date', 'c.end_date'),
               'c.distance_m', 'c.comment')} AS message
FROM f_creates c LEFT JOIN f_names n ON n.employee_id = c.employee_id
WHERE {duration_sql('c.start_date', 'c.end_date')} IS NOT NULL""", "f_creates", "f_names")
oracle("job_ref_rh", "SELECT * FROM f_employees", "f_employees")
oracle("job_ref_sport", "SELECT * FROM f_sport", "f_sport")
oracle("job_export_stored_gold", "SELECT * FROM f_gold", "f_gold")
oracle("src_reference_load", "SELECT * FROM f_employees", "f_employees")
oracle("src_export_readback", "SELECT * FROM f_gold", "f_gold")
oracle("sink_sorted_export", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS rows_out_of_order, CAST(0 AS BIGINT) AS files_out_of_order
FROM f_gold""", "f_gold")
oracle("sink_overwrite_roundtrip", "SELECT * FROM f_enriched", "f_enriched")
oracle("stream_notifications", f"""
SELECT c.kafka_partition, c.kafka_offset, c.id, c.employee_id,
  {message_sql(FULL_NAME, 'c.activity_type', duration_sql('c.start_date', 'c.end_date'),
               'c.distance_m', 'c.comment')} AS message
FROM f_creates c LEFT JOIN f_names n ON n.employee_id = c.employee_id
WHERE {duration_sql('c.start_date', 'c.end_date')} IS NOT NULL""", "f_creates", "f_names")

oracle("stream_notification_rejects", f"""
SELECT kafka_partition, kafka_offset, id, employee_id, start_date, end_date, 'unparseable date' AS reason
FROM f_creates WHERE {duration_sql('start_date', 'end_date')} IS NULL""", "f_creates")

oracle("cdc_parse_envelopes", f"SELECT {CHANGE_COLS} FROM f_changes", "f_changes")
oracle("ref_sanitize_columns", """
SELECT "ID salarié" AS "ID_salarié", "Nom", "Prénom", "Salaire brut" AS "Salaire_brut",
  "Moyen de déplacement" AS "Moyen_de_déplacement", "Adresse du domicile" AS "Adresse_du_domicile"
FROM f_employee_sheet""", "f_employee_sheet")
oracle("gold_salary_normalized", f"""
SELECT employee_id, "Salaire_brut", {salary_sql('"Salaire_brut"')} AS annual_gross_salary
FROM f_employees""", "f_employees")
oracle("silver_activities", f"SELECT {ROW_COLS} FROM f_state_all", "f_state_all")
oracle("silver_one_employee", "SELECT * FROM f_activities WHERE employee_id = 7", "f_activities")
oracle("gold_activities_by_year", "SELECT * FROM f_by_year", "f_by_year")
oracle("notify_creates", f"SELECT kafka_partition, kafka_offset, {ROW_COLS} FROM f_creates", "f_creates")
oracle("ref_declared_sports", f"""
SELECT employee_id, {strip('"Pratique_dun_sport"')} AS "Pratique_dun_sport" FROM f_sport
WHERE "Pratique_dun_sport" IS NOT NULL AND {strip('"Pratique_dun_sport"')} <> ''""", "f_sport")

oracle("cdc_latest_per_key", f"SELECT {STATE_COLS} FROM f_latest_all", "f_latest_all")
oracle("cdc_partition_max_offsets", """
SELECT kafka_partition, max(kafka_offset) AS max_offset FROM f_changes GROUP BY kafka_partition""",
       "f_changes")
oracle("cdc_next_offsets", """
SELECT kafka_partition, max(m) + 1 AS next_offset
FROM (SELECT kafka_partition, batch, max(kafka_offset) AS m FROM f_changes GROUP BY ALL)
GROUP BY kafka_partition""", "f_changes")
oracle("cdc_op_histogram", "SELECT last_op, count(*) AS n FROM f_latest_all GROUP BY last_op",
       "f_latest_all")
oracle("cdc_run_metrics", """
SELECT 'events_read' AS metric, count(*) AS value FROM f_changes
UNION ALL SELECT 'ids_touched', count(*) FROM f_latest_all
UNION ALL SELECT 'live_rows', count(*) FROM f_state_all""", "f_changes", "f_latest_all", "f_state_all")
oracle("cdc_insert_if_absent", f"""
SELECT {STATE_COLS} FROM f_state_b0
UNION ALL
SELECT {ROW_COLS}, op AS last_op, last_event_ts_ms, kafka_partition, kafka_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY kafka_offset, kafka_partition) AS rn
  FROM f_changes WHERE batch IN (1, 2)) s
WHERE rn = 1 AND id NOT IN (SELECT id FROM f_state_b0)""", "f_state_b0", "f_changes")

oracle("gold_employee_year_spine", "SELECT * FROM f_spine", "f_spine")
oracle("gold_sport_flag_join", """
SELECT s.employee_id, s.activity_year, coalesce(f.sport_practice_declared, false) AS sport_practice_declared
FROM f_spine s LEFT JOIN f_sport_flag f ON f.employee_id = s.employee_id""", "f_spine", "f_sport_flag")
oracle("gold_activity_count_join", """
SELECT s.employee_id, s.activity_year,
  CAST(coalesce(a.physical_activities_count_year, 0) AS BIGINT) AS physical_activities_count_year
FROM f_spine s LEFT JOIN f_by_year a
  ON a.employee_id = s.employee_id AND a.activity_year = s.activity_year""", "f_spine", "f_by_year")
oracle("notify_with_names", f"""
SELECT c.kafka_offset, c.employee_id, {FULL_NAME} AS full_name
FROM f_creates c LEFT JOIN f_names n ON n.employee_id = c.employee_id""", "f_creates", "f_names")
oracle("ref_commute_mode", """SELECT employee_id, "Moyen_de_déplacement", commute_mode FROM f_employees""",
       "f_employees")
oracle("silver_commute_mode", """
SELECT employee_id, "Moyen_de_déplacement",
  CASE WHEN employee_id % 3 = 0 THEN 'Marche/running' ELSE commute_mode END AS commute_mode
FROM f_employees""", "f_employees")
oracle("silver_travel_mode", """
SELECT e.employee_id, e.commute_mode, t.travel_mode AS google_travel_mode, t.max_km AS max_allowed_km
FROM f_employees e LEFT JOIN f_travel t ON e.commute_mode = t.mode""", "f_employees", "f_travel")
oracle("silver_route_distance", """
SELECT employee_id, "Adresse_du_domicile", google_travel_mode, distance_km FROM f_enriched""",
       "f_enriched")
oracle("silver_missing_routes", f"""
SELECT DISTINCT e.home AS home_address, t.travel_mode
FROM (SELECT *, CASE WHEN {strip('"Adresse_du_domicile"')} <> ''
                     THEN {strip('"Adresse_du_domicile"')} END AS home FROM f_employees) e
JOIN f_travel t ON e.commute_mode = t.mode
WHERE e.home IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM f_routes r WHERE r.home_address = e.home AND r.travel_mode = t.travel_mode)""",
       "f_employees", "f_travel", "f_routes")

oracle("gold_years", "SELECT * FROM f_years", "f_years")
oracle("gold_years_fallback", "SELECT * FROM f_years_bad", "f_years_bad")
oracle("gold_sport_flag", "SELECT * FROM f_sport_flag", "f_sport_flag")
oracle("quality_duplicate_keys", """
SELECT employee_id, count(*) AS n FROM f_sport GROUP BY employee_id HAVING count(*) > 1
ORDER BY employee_id LIMIT 5""", "f_sport")
oracle("gold_summary", """
SELECT count(*) AS total_rows,
  CAST(count_if(eligible_prime_sportive) AS BIGINT) AS eligible_prime_rows,
  CAST(count_if(eligible_wellbeing_days) AS BIGINT) AS eligible_wellbeing_rows,
  CAST(count_if(anomaly_commute) AS BIGINT) AS commute_anomaly_rows
FROM f_gold""", "f_gold")
oracle("profile_value_counts", """
SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS place FROM (
  SELECT "Moyen_de_déplacement" AS value, count(*) AS n FROM f_employees
  WHERE "Moyen_de_déplacement" IS NOT NULL GROUP BY 1)""", "f_employees")
oracle("profile_columns", """
SELECT 1 AS position, 'employee_id' AS column_name, 'bigint' AS data_type, count(employee_id) AS non_null FROM f_employees
UNION ALL SELECT 2, 'Nom', 'string', count("Nom") FROM f_employees
UNION ALL SELECT 3, 'Prénom', 'string', count("Prénom") FROM f_employees
UNION ALL SELECT 4, 'Salaire_brut', 'string', count("Salaire_brut") FROM f_employees
UNION ALL SELECT 5, 'Moyen_de_déplacement', 'string', count("Moyen_de_déplacement") FROM f_employees
UNION ALL SELECT 6, 'Adresse_du_domicile', 'string', count("Adresse_du_domicile") FROM f_employees
UNION ALL SELECT 7, 'commute_mode', 'string', count(commute_mode) FROM f_employees""", "f_employees")

oracle("silver_commute_anomaly", """
SELECT employee_id, distance_km, max_allowed_km, anomaly_commute FROM f_enriched""", "f_enriched")
oracle("silver_employees_enriched", "SELECT * FROM f_enriched", "f_enriched")
oracle("gold_eligibility", """
SELECT employee_id, year, sport_practice_declared, eligible_prime_sportive, eligibility_reason
FROM f_gold""", "f_gold")
oracle("gold_eligibility_anomaly_allowed", """
SELECT employee_id, year, eligible_prime_sportive, eligibility_reason, prime_amount
FROM f_gold_keep_anomaly""", "f_gold_keep_anomaly")
oracle("gold_prime_amount", """
SELECT employee_id, year, annual_gross_salary, prime_rate, prime_amount FROM f_gold""", "f_gold")
oracle("gold_wellbeing_days", """
SELECT employee_id, year, physical_activities_count_year, eligible_wellbeing_days,
  wellbeing_days_granted FROM f_gold""", "f_gold")
oracle("notify_duration", f"SELECT id, {duration_sql('start_date', 'end_date')} AS duration_min FROM f_activities",
       "f_activities")
oracle("notify_km_label", f"""
SELECT id, distance_m, {km_sql('distance_m')} AS km_label FROM f_activities WHERE distance_m IS NOT NULL""",
       "f_activities")
oracle("notify_messages", f"""
SELECT a.id, a.employee_id,
  {message_sql(FULL_NAME, 'a.activity_type', duration_sql('a.start_date', 'a.end_date'),
               'a.distance_m', 'a.comment')} AS message
FROM f_activities a LEFT JOIN f_names n ON n.employee_id = a.employee_id
WHERE {duration_sql('a.start_date', 'a.end_date')} IS NOT NULL""", "f_activities", "f_names")
oracle("notify_rejects", f"""
SELECT id, employee_id, start_date, end_date, 'unparseable date' AS reason FROM f_activities
WHERE {duration_sql('start_date', 'end_date')} IS NULL""", "f_activities")


def _contains_any(x: str, kws) -> str:
    return "(" + " OR ".join(f"contains({x}, '{k}')" for k in kws) + ")"


_S = "lower(activity_type)"
_NO = _contains_any(_S, ("escalade", "tennis", "badminton", "football", "basket", "rugby",
                         "judo", "boxe", "équitation", "equitation", "voile"))
_LO = (f"CASE WHEN {_contains_any(_S, ('triathlon',))} THEN 20000 WHEN {_contains_any(_S, ('natation',))} "
       f"THEN 500 WHEN {_contains_any(_S, ('randonn', 'runing', 'course'))} THEN 1000 ELSE 1000 END")
_HI = (f"CASE WHEN {_contains_any(_S, ('triathlon',))} THEN 120000 WHEN {_contains_any(_S, ('natation',))} "
       f"THEN 5000 WHEN {_contains_any(_S, ('randonn', 'runing', 'course'))} THEN 17500 ELSE 20000 END")
oracle("quality_distance_plausible", f"""
SELECT * FROM (
  SELECT id, activity_type, distance_m,
    CAST(CASE WHEN NOT {_NO} THEN {_LO} END AS BIGINT) AS expected_min_m,
    CAST(CASE WHEN NOT {_NO} THEN {_HI} END AS BIGINT) AS expected_max_m,
    CASE WHEN {_NO} AND distance_m IS NOT NULL THEN 'distance_not_expected'
         WHEN NOT {_NO} AND distance_m IS NULL THEN 'distance_missing'
         WHEN NOT {_NO} AND (distance_m < {_LO} OR distance_m > {_HI}) THEN 'distance_out_of_range'
    END AS reason
  FROM f_activities) WHERE reason IS NOT NULL""", "f_activities")

def scan_sql(src: str) -> str:
    return f"""
, t AS (SELECT count(*) AS rows,
    CAST(count_if(id IS NULL) AS BIGINT) AS m_id,
    CAST(count_if(employee_id IS NULL) AS BIGINT) AS m_emp,
    CAST(count_if(start_date IS NULL) AS BIGINT) AS m_start,
    CAST(count_if(end_date IS NULL) AS BIGINT) AS m_end,
    CAST(count_if(activity_type IS NULL) AS BIGINT) AS m_type,
    CAST(count_if(created_at IS NULL) AS BIGINT) AS m_created,
    CAST(count_if(distance_m < 0) AS BIGINT) AS invalid,
    CAST(count_if(end_date < start_date) AS BIGINT) AS q5,
    CAST(count_if(end_date <= start_date) AS BIGINT) AS q6,
    CAST(count_if(trim(activity_type) = '') AS BIGINT) AS q7,
    CAST(count_if(start_date > TIMESTAMP '2002-01-01 00:00:00' + INTERVAL 1 DAY) AS BIGINT) AS q8,
    (SELECT count(*) FROM (SELECT id FROM {src} WHERE id IS NOT NULL
                           GROUP BY id HAVING count(*) > 1)) AS dups
  FROM {src})
SELECT 'row_count > 0' AS "check", rows AS metric, CAST(0 AS BIGINT) AS threshold, rows > 0 AS passed FROM t
UNION ALL SELECT 'missing_count(id) = 0', m_id, 0, m_id = 0 FROM t
UNION ALL SELECT 'missing_count(employee_id) = 0', m_emp, 0, m_emp = 0 FROM t
UNION ALL SELECT 'missing_count(start_date) = 0', m_start, 0, m_start = 0 FROM t
UNION ALL SELECT 'missing_count(end_date) = 0', m_end, 0, m_end = 0 FROM t
UNION ALL SELECT 'missing_count(activity_type) = 0', m_type, 0, m_type = 0 FROM t
UNION ALL SELECT 'missing_count(created_at) = 0', m_created, 0, m_created = 0 FROM t
UNION ALL SELECT 'duplicate_count(id) = 0', dups, 0, dups = 0 FROM t
UNION ALL SELECT 'invalid_count(distance_m) = 0', invalid, 0, invalid = 0 FROM t
UNION ALL SELECT 'failed_rows(end_before_start) = 0', q5, 0, q5 = 0 FROM t
UNION ALL SELECT 'failed_rows(duration_not_positive) = 0', q6, 0, q6 = 0 FROM t
UNION ALL SELECT 'failed_rows(blank_activity_type) = 0', q7, 0, q7 = 0 FROM t
UNION ALL SELECT 'failed_rows(start_in_far_future) = 0', q8, 0, q8 = 0 FROM t"""


cte("f_operational_changes", f"""
SELECT id, employee_id, {parse('start_date')} AS start_date, activity_type, distance_m,
  {parse('end_date')} AS end_date, comment, {parse('created_at')} AS created_at
FROM f_changes""", "f_changes")
oracle("quality_scan", scan_sql("f_operational"), "f_operational")
oracle("quality_scan_change_rows", scan_sql("f_operational_changes"), "f_operational_changes")
oracle("quality_failed_rows", """
SELECT 'end_before_start' AS "check", id, employee_id, start_date, end_date, activity_type
FROM f_operational WHERE end_date < start_date
UNION ALL SELECT 'duration_not_positive', id, employee_id, start_date, end_date, activity_type
FROM f_operational WHERE end_date <= start_date
UNION ALL SELECT 'blank_activity_type', id, employee_id, start_date, end_date, activity_type
FROM f_operational WHERE trim(activity_type) = ''
UNION ALL SELECT 'start_in_far_future', id, employee_id, start_date, end_date, activity_type
FROM f_operational WHERE start_date > TIMESTAMP '2002-01-01 00:00:00' + INTERVAL 1 DAY""",
       "f_operational")


def _dup_report(label: str, keys: str, src: str) -> str:
    return (f"SELECT '{label}' AS table_name, '{keys}' AS key_columns, count(*) AS duplicate_groups, "
            f"count(*) = 0 AS passed FROM (SELECT {keys} FROM {src} GROUP BY {keys} HAVING count(*) > 1)")


oracle("quality_unique_keys", "\nUNION ALL ".join([
    _dup_report("silver/rh_enriched", "employee_id", "f_enriched"),
    _dup_report("activities_by_year", "employee_id,activity_year", "f_by_year"),
    _dup_report("gold/benefits_employee_year", "employee_id,year", "f_gold"),
    _dup_report("ref/sport", "employee_id", "f_sport"),
]), "f_enriched", "f_by_year", "f_gold", "f_sport")
oracle("quality_null_keys", """
SELECT 'gold/benefits_employee_year' AS table_name,
  CAST(count_if(employee_id IS NULL OR year IS NULL) AS BIGINT) AS null_key_rows,
  count_if(employee_id IS NULL OR year IS NULL) = 0 AS passed FROM f_gold""", "f_gold")
oracle("quality_not_empty", f"""
SELECT 'activities' AS table_name, EXISTS (SELECT 1 FROM orders) AS has_rows
UNION ALL SELECT 'ref/rh', EXISTS (SELECT 1 FROM customer)
UNION ALL SELECT 'change log', EXISTS (SELECT 1 FROM events)
UNION ALL SELECT 'activities without any date',
  EXISTS (SELECT 1 FROM f_activities WHERE {parse('start_date')} IS NULL AND {parse('end_date')} IS NULL)""",
       "f_activities")
oracle("pipeline_end_to_end", "SELECT * FROM f_gold_e2e", "f_gold_e2e")
