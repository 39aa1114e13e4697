"""Reference-shaped inputs derived by Spark from the driver tables (see FIXTURES.md).

Every mapping is arithmetic or CASE on base columns, so the work grows with the
tables and a plain SQL engine can repeat it. Nothing here collects data.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strivelake.schemas import ACTIVITY_COLUMNS

# Fixed values of the fixture mapping (FIXTURES.md §2).
ACTIVITY_TYPES = ["Runing", "Randonnée", "Tennis", "Badminton", "Escalade", "Natation",
                  "Triathlon", "Voile"]
TYPES_WITHOUT_DISTANCE = ["Tennis", "Badminton", "Escalade", "Voile"]
SEGMENT_TO_MODE = {
    "MACHINERY": "  Marche/Running ",
    "AUTOMOBILE": "véhicule thermique/électrique",
    "BUILDING": "VELO/Trottinette/Autres",
    "HOUSEHOLD": "Transports en commun",
    "FURNITURE": "Cheval",
}
SEGMENT_TO_TRAVEL = {"MACHINERY": "WALK", "BUILDING": "BICYCLE"}
SPORT_BY_MOD5 = [None, "", "  ", "Tennis", "Runing"]
EVENT_TO_OP = {"signup": "c", "purchase": "r", "view": "u", "click": "u", "error": "d"}
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
BATCHES = 3

# Raw sheet headers, as in the workbooks.
COL_ID = "ID salarié"
COL_SPORT_RAW = "Pratique d'un sport"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(key == F.lit(k), F.lit(v)) if expr is None
                else expr.when(key == F.lit(k), F.lit(v)))
    return expr


# --------------------------------------------------------------------- activities
def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operational activities in change-row shape (timestamps as ISO text) from orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    # one start in 227 lies far ahead of any order
    start_ts = F.timestamp_add("SECOND", k % 86400, F.when(
        k % 227 == 0, F.timestamp_add("YEAR", F.lit(40), F.col("o_orderdate")))
        .otherwise(F.col("o_orderdate")))
    end_ts = F.when(k % 199 == 0, F.timestamp_add("MINUTE", F.lit(-1), start_ts)).otherwise(
        F.timestamp_add("MINUTE", F.lit(20) + k % 161, start_ts))
    kind = F.when(k % 181 == 0, F.lit("  ")).otherwise(
        F.element_at(F.array(*[F.lit(t) for t in ACTIVITY_TYPES]), (k % 8 + 1).cast("int")))
    return o.select(
        k.alias("id"),
        F.col("o_custkey").alias("employee_id"),
        F.when(k % 211 == 0, F.lit("not-a-date"))
         .otherwise(F.date_format(start_ts, ISO_SECONDS)).alias("start_date"),
        kind.alias("activity_type"),
        F.when(kind.isin(TYPES_WITHOUT_DISTANCE), F.lit(None).cast("long"))
         .when(k % 173 == 0, F.lit(-1000).cast("long")).otherwise((k * 37) % 17500).alias("distance_m"),
        F.date_format(end_ts, ISO_SECONDS).alias("end_date"),
        F.when(k % 4 == 0, F.lit("Belle séance")).when(k % 4 == 1, F.lit(""))
         .otherwise(F.lit(None).cast("string")).alias("comment"),
        F.date_format(F.col("o_orderdate"), ISO_SECONDS).alias("created_at"),
    )


# --------------------------------------------------------------------- RH sheet
def _salary_text(key: Column, acctbal: Column) -> Column:
    plain = F.round(F.abs(acctbal) * 10, 2).cast("decimal(14,2)").cast("string")
    return (F.when(key % 4 == 0, plain)
            .when(key % 4 == 1, F.regexp_replace(plain, r"\.", ","))
            .when(key % 4 == 2, F.concat(plain, F.lit(" €")))
            .otherwise(F.lit("n/a")))


def employee_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The RH workbook with its raw headers (spaces, accents) from customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    return c.select(
        k.alias(COL_ID),
        F.col("c_name").alias("Nom"),
        F.concat(F.lit("P"), k.cast("string")).alias("Prénom"),
        _salary_text(k, F.col("c_acctbal")).alias("Salaire brut"),
        _case(F.col("c_mktsegment"), SEGMENT_TO_MODE).alias("Moyen de déplacement"),
        F.when(k % 23 == 0, F.lit(None).cast("string"))
         .when(k % 29 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("addr-"), (k % 400).cast("string"))).alias("Adresse du domicile"),
    )


def names_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ID salarié, Prénom, Nom) of the names file; keys % 17 = 0 are absent, keys % 19 = 0
    have a second row with another first name."""
    first = F.when(F.col(COL_ID) % 19 == 0, F.array(F.col("Prénom"), F.concat(F.lit("Q"), "Prénom"))) \
        .otherwise(F.array("Prénom"))
    return (employee_sheet(spark, sf_dir)
            .filter(F.col(COL_ID) % 17 != 0)
            .select(COL_ID, F.explode(first).alias("Prénom"), "Nom"))


def sport_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sport workbook: one row per employee (two for keys % 31 = 0), keys % 37 = 0 absent."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    by_mod = F.element_at(F.array(*[F.lit(v).cast("string") for v in SPORT_BY_MOD5]),
                          (k % 5 + 1).cast("int"))
    values = F.when(k % 31 == 0, F.array(F.lit(None).cast("string"), F.lit("Tennis"))) \
        .otherwise(F.array(by_mod))
    return (c.filter(k % 37 != 0)
            .select(k.alias(COL_ID), F.explode(values).alias(COL_SPORT_RAW)))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """routes(home_address, travel_mode, meters): numbers % 41 = 0 are missing, numbers % 7 = 0
    have a second, longer route."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    number = k % 400
    travel = _case(F.col("c_mktsegment"), SEGMENT_TO_TRAVEL)
    return (c.filter((k % 23 != 0) & (k % 29 != 0) & (number % 41 != 0) & travel.isNotNull())
            .select(F.concat(F.lit("addr-"), number.cast("string")).alias("home_address"),
                    travel.alias("travel_mode"),
                    F.explode(F.when(number % 7 == 0, F.array((number * 97) % 32000,
                                                              (number * 97) % 32000 + 5000))
                              .otherwise(F.array((number * 97) % 32000))).alias("meters"))
            .distinct())


# --------------------------------------------------------------------- change log
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-event log records (value, partition, offset, batch) from events.

    Wrapped envelopes for even offsets, flat for odd ones; every 97th record is
    malformed text, every 101st has a null value and every 89th start date does not
    parse. The batches are thirds of the offset range at any size; every 53rd record
    arrives one batch late, so offsets are out of order across batches.
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    uid = F.col("user_id")
    op = _case(F.col("event_type"), EVENT_TO_OP)
    created = F.date_format(F.col("ts"), ISO_MICROS)
    start = F.when(eid % 89 == 0, F.lit("not-a-date")).otherwise(created)
    row = F.struct(
        uid.alias("id"),
        uid.alias("employee_id"),
        start.alias("start_date"),
        F.col("event_type").alias("activity_type"),
        F.floor(F.col("value") * 100).cast("long").alias("distance_m"),
        F.date_format(F.timestamp_add("MINUTE", F.lit(30), F.col("ts")), ISO_MICROS).alias("end_date"),
        F.col("props").alias("comment"),
        created.alias("created_at"),
    )
    flat = F.struct(
        op.alias("op"),
        F.when(op != F.lit("d"), row).alias("after"),
        F.when(op == F.lit("d"), row).alias("before"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
    )
    value = (F.when(eid % 101 == 0, F.lit(None).cast("string"))
             .when(eid % 97 == 0, F.concat(F.lit('{"payload": {"op": "u", "after": {"id": '),
                                           uid.cast("string")))
             .when(eid % 2 == 0, F.to_json(F.struct(flat.alias("payload"))))
             .otherwise(F.to_json(flat)))
    low, high = (e.select(f("event_id")).scalar() for f in (F.min, F.max))
    third = F.floor((eid - low) * BATCHES / (high - low + 1)).cast("int")
    batch = F.least(third + F.when(eid % 53 == 0, 1).otherwise(0), F.lit(BATCHES - 1))
    return e.select(
        value.alias("value"),
        (uid % 4).cast("int").alias("partition"),
        eid.alias("offset"),
        batch.alias("batch"),
    )


def log_batch(log: DataFrame, batch: int) -> DataFrame:
    return log.filter(F.col("batch") == batch).drop("batch")


def repeated_batch(log: DataFrame, batch: int) -> DataFrame:
    """The batch, every 7th record of it again, and every 5th record of the batch before; repeats
    have offsets of their own, far behind the first deliveries."""
    again = [(F.col("batch") == batch) & (F.col("offset") % 7 == 0),
             (F.col("batch") == batch - 1) & (F.col("offset") % 5 == 0)]
    out = log.filter(F.col("batch") == batch)
    for k, which in enumerate(again, 1):
        out = out.unionByName(log.filter(which).withColumn("offset", F.col("offset") + k * 10**9))
    return out.drop("batch")


RENAMED_FROM = 1705276800000    # 2024-01-15 UTC
HIRED_FROM = 1704844800000      # 2024-01-10 UTC


def names_log(names: DataFrame) -> DataFrame:
    """The names sheet with valid_from_ms: keys % 5 = 0 only from HIRED_FROM, keys % 3 = 0 have
    another first name from RENAMED_FROM."""
    k = F.col("employee_id")
    first = names.withColumn("valid_from_ms", F.when(k % 5 == 0, F.lit(HIRED_FROM)).otherwise(F.lit(0)).cast("long"))
    renamed = (names.filter(k % 3 == 0).withColumn("Prénom", F.concat(F.lit("R"), k.cast("string")))
               .withColumn("valid_from_ms", F.lit(RENAMED_FROM).cast("long")))
    return first.unionByName(renamed)


__all__ = ["activities", "employee_sheet", "names_sheet", "sport_sheet", "routes",
           "change_log", "log_batch", "table", "ACTIVITY_COLUMNS"]
