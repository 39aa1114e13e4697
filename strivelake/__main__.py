"""Command-line jobs: ``python -m strivelake <job> ...`` (or ``spark-submit`` this module).

Jobs: bronze, ref, silver, gold, export, notify, quality. Paths may be local
folders or any Hadoop-compatible URI; each job prints its counters and exits
with status 1 on a failed check (ValueError), like the batch jobs it replaces.
"""
from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    from strivelake.session import prepare
    spark = SparkSession.builder.appName("strivelake").getOrCreate()
    return prepare(spark)


def _log_options(args) -> dict:
    opts = {}
    if getattr(args, "bootstrap", None):
        opts["kafka.bootstrap.servers"] = args.bootstrap
    for kv in getattr(args, "option", None) or []:
        k, _, v = kv.partition("=")
        opts[k] = v
    return opts


def job_bronze(spark, args) -> int:
    from strivelake.streaming.merge import run_incremental_merge
    run = run_incremental_merge(spark, args.log, args.table, args.checkpoint, fmt=args.format,
                                options=_log_options(args), table_format=args.table_format)
    if not run.batches:
        print("no new change events")
        return 0
    for m in run.metrics:
        print(f"batch {m['batch_id']}: events read {m.get('events_read')}, "
              f"ids touched {m.get('ids_touched')}, changes by op {m.get('by_op')}, "
              f"live rows {m.get('live_rows')}")
    return 0


def job_ref(spark, args) -> int:
    from strivelake.plans.pipelines import ref_job
    rh, sport = ref_job(spark, args.rh, args.sport, args.out, fmt=args.format,
                        table_format=args.table_format)
    print(f"ref/rh -> {rh}\nref/sport -> {sport}")
    return 0


def job_silver(spark, args) -> int:
    from strivelake.plans.pipelines import silver_job
    from strivelake.sources.tables import read_table
    from strivelake.streaming.merge import load_state
    acts, enriched = silver_job(spark, load_state(spark, args.bronze), read_table(spark, args.rh),
                                spark.read.parquet(args.routes), args.out,
                                only_employee=args.only_employee, strict=args.strict,
                                table_format=args.table_format)
    counts = enriched.agg(F.count(F.lit(1)).alias("rows"),
                          F.count_if("anomaly_commute").alias("anomalies")).first()
    print(f"silver/rh_enriched: {counts['rows']} rows, {counts['anomalies']} commute anomalies")
    return 0


def job_gold(spark, args) -> int:
    from strivelake.operators.gold import gold_summary
    from strivelake.plans.pipelines import gold_job
    from strivelake.rules import load_rules
    from strivelake.sources.tables import read_table
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
    g = gold_job(spark, read_table(spark, args.activities), read_table(spark, args.rh_enriched),
                 read_table(spark, args.sport), load_rules(args.rules), as_of, out=args.out,
                 table_format=args.table_format)
    s = gold_summary(g).first()
    g.unpersist()
    print(f"gold: {s['total_rows']} rows, eligible prime {s['eligible_prime_rows']}, "
          f"eligible wellbeing days {s['eligible_wellbeing_rows']}")
    return 0


def job_export(spark, args) -> int:
    from strivelake.plans.pipelines import export_job
    path = export_job(spark, args.gold, args.out, single_file=args.single_file)
    print(f"export -> {path}")
    return 0


def job_notify(spark, args) -> int:
    from strivelake.sources.reference import read_reference
    from strivelake.streaming.notifications import parquet_sink, run_notifications
    names = read_reference(spark, args.names, fmt=args.names_format)
    q = run_notifications(spark, args.log, names, parquet_sink(args.out), args.checkpoint,
                          fmt=args.format, options=_log_options(args),
                          available_now=not args.continuous, muted=args.muted)
    q.awaitTermination()
    print(f"notifications -> {args.out}")
    return 0


def job_quality(spark, args) -> int:
    from strivelake.operators.quality import operational, scan
    acts = spark.read.parquet(args.activities)
    if "start_date" in acts.columns and dict(acts.dtypes)["start_date"] == "string":
        acts = operational(acts)
    now = dt.datetime.fromisoformat(args.now) if args.now else dt.datetime.now(dt.timezone.utc) \
        .replace(tzinfo=None)
    checks = scan(acts, now=now).collect()
    for r in checks:
        print(f"{'PASS' if r['passed'] else 'FAIL'} {r['check']} (metric {r['metric']})")
    return 0 if all(r["passed"] for r in checks) else 1


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strivelake")
    p.add_argument("--input-bytes", type=int,
                   help="input volume; sizes shuffle partitions, split size and AQE targets")
    sub = p.add_subparsers(dest="job", required=True)

    def log_args(sp):
        sp.add_argument("--log", required=True, help="log folder, or the topic with --format kafka")
        sp.add_argument("--format", default="parquet", choices=["parquet", "json", "kafka"])
        sp.add_argument("--bootstrap", help="kafka.bootstrap.servers")
        sp.add_argument("--option", action="append", help="extra source option k=v")

    b = sub.add_parser("bronze", help="incremental merge of the change log (availableNow)")
    log_args(b)
    b.add_argument("--table", required=True)
    b.add_argument("--checkpoint", required=True, help="a new folder replays from the start")
    r = sub.add_parser("ref", help="load the RH and sport sheets")
    r.add_argument("--rh", required=True)
    r.add_argument("--sport", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    s = sub.add_parser("silver", help="silver activities + enriched employees")
    s.add_argument("--bronze", required=True)
    s.add_argument("--rh", required=True)
    s.add_argument("--routes", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--only-employee", type=int)
    s.add_argument("--strict", action="store_true")
    g = sub.add_parser("gold", help="benefits per employee and year")
    g.add_argument("--activities", required=True)
    g.add_argument("--rh-enriched", required=True)
    g.add_argument("--sport", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--rules")
    g.add_argument("--as-of")
    e = sub.add_parser("export", help="sorted Parquet export")
    e.add_argument("--gold", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--single-file", action="store_true")
    n = sub.add_parser("notify", help="one message per create event")
    log_args(n)
    n.add_argument("--names", required=True)
    n.add_argument("--names-format", default="parquet", choices=["parquet", "csv"])
    n.add_argument("--out", required=True)
    n.add_argument("--checkpoint", required=True)
    n.add_argument("--muted", action="store_true")
    n.add_argument("--continuous", action="store_true")
    q = sub.add_parser("quality", help="declarative checks on the activities table")
    q.add_argument("--activities", required=True)
    q.add_argument("--now")
    for sp in (b, r, s, g):
        sp.add_argument("--table-format", choices=["parquet", "delta"],
                        help="delta where it is installed, else versioned Parquet")
    return p


JOBS = {"bronze": job_bronze, "ref": job_ref, "silver": job_silver, "gold": job_gold,
        "export": job_export, "notify": job_notify, "quality": job_quality}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or _session()
    if args.input_bytes:
        from strivelake.session import apply_cluster_settings
        apply_cluster_settings(spark, args.input_bytes)
    try:
        return JOBS[args.job](spark, args)
    except ValueError as exc:
        print(f"FAIL: {exc}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
