"""Explicit schemas for every stage (no inference)."""
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType,
)

# Change row: ids and distance as longs, timestamps kept as ISO text.
ACTIVITY_SCHEMA = StructType([
    StructField("id", LongType()),
    StructField("employee_id", LongType()),
    StructField("start_date", StringType()),
    StructField("activity_type", StringType()),
    StructField("distance_m", LongType()),
    StructField("end_date", StringType()),
    StructField("comment", StringType()),
    StructField("created_at", StringType()),
])

ACTIVITY_COLUMNS = [f.name for f in ACTIVITY_SCHEMA.fields]

# Flat envelope {op, after, before, ts_ms}; the wrapped one nests it under "payload".
FLAT_ENVELOPE = StructType([
    StructField("op", StringType()),
    StructField("after", ACTIVITY_SCHEMA),
    StructField("before", ACTIVITY_SCHEMA),
    StructField("ts_ms", LongType()),
])

# One schema that reads both shapes in a single from_json pass.
UNION_ENVELOPE = StructType(
    [StructField("payload", FLAT_ENVELOPE)] + list(FLAT_ENVELOPE.fields)
)

# A log record as a Kafka source exposes it (value may also be binary).
LOG_SCHEMA = StructType([
    StructField("value", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
])

CHANGE_COLUMNS = ["op", "last_event_ts_ms", "kafka_partition", "kafka_offset"] + ACTIVITY_COLUMNS

# Current-state (bronze) table, key "id".
STATE_COLUMNS = ACTIVITY_COLUMNS + ["last_op", "last_event_ts_ms", "kafka_partition", "kafka_offset"]

OFFSETS_SCHEMA = StructType([
    StructField("kafka_partition", IntegerType()),
    StructField("next_offset", LongType()),
])

ENRICHED_EXTRA = StructType([
    StructField("commute_mode", StringType()),
    StructField("google_travel_mode", StringType()),
    StructField("distance_km", DoubleType()),
    StructField("max_allowed_km", DoubleType()),
    StructField("anomaly_commute", BooleanType()),
])

GOLD_SCHEMA = StructType([
    StructField("employee_id", LongType()),
    StructField("year", IntegerType()),
    StructField("annual_gross_salary", DoubleType()),
    StructField("commute_mode", StringType()),
    StructField("google_travel_mode", StringType()),
    StructField("distance_km", DoubleType()),
    StructField("max_allowed_km", DoubleType()),
    StructField("anomaly_commute", BooleanType()),
    StructField("sport_practice_declared", BooleanType()),
    StructField("physical_activities_count_year", LongType()),
    StructField("eligible_prime_sportive", BooleanType()),
    StructField("prime_rate", DoubleType()),
    StructField("prime_amount", DoubleType()),
    StructField("eligible_wellbeing_days", BooleanType()),
    StructField("wellbeing_days_granted", IntegerType()),
    StructField("eligibility_reason", StringType()),
    StructField("load_date", DateType()),
])

GOLD_COLUMNS = [f.name for f in GOLD_SCHEMA.fields]
