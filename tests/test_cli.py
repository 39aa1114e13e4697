"""The command-line jobs chained end to end on the smallest driver tables."""
from strivelake.__main__ import main
from strivelake.plans.inputs import Inputs
from strivelake.sources import fixtures
from strivelake.sources.changes import write_log_files
from strivelake.sources.tables import read_table

from conftest import SF_SMALL


def test_jobs_chain(spark, tmp_dir, capsys):
    i = Inputs(spark, SF_SMALL)
    write_log_files(i.log, f"{tmp_dir}/log")
    i.employee_sheet.write.parquet(f"{tmp_dir}/rh_sheet")
    fixtures.sport_sheet(spark, SF_SMALL).write.parquet(f"{tmp_dir}/sport_sheet")
    fixtures.names_sheet(spark, SF_SMALL).write.parquet(f"{tmp_dir}/names_sheet")
    i.routes.write.parquet(f"{tmp_dir}/routes")
    i.activities.write.parquet(f"{tmp_dir}/activities")
    lake = f"{tmp_dir}/lake"
    run = lambda *a: main(list(a), spark=spark)
    assert run("bronze", "--log", f"{tmp_dir}/log", "--table", f"{lake}/bronze",
               "--checkpoint", f"{tmp_dir}/ck") == 0
    assert run("bronze", "--log", f"{tmp_dir}/log", "--table", f"{lake}/bronze",
               "--checkpoint", f"{tmp_dir}/ck") == 0
    assert "no new change events" in capsys.readouterr().out
    assert run("ref", "--rh", f"{tmp_dir}/rh_sheet", "--sport", f"{tmp_dir}/sport_sheet",
               "--out", lake) == 0
    assert run("silver", "--bronze", f"{lake}/bronze", "--rh", f"{lake}/ref/rh",
               "--routes", f"{tmp_dir}/routes", "--out", lake) == 0
    assert run("gold", "--activities", f"{lake}/silver/activities", "--rh-enriched",
               f"{lake}/silver/rh_enriched", "--sport", f"{lake}/ref/sport", "--out",
               f"{lake}/gold", "--as-of", "2002-01-01") == 0
    assert run("export", "--gold", f"{lake}/gold", "--out", f"{tmp_dir}/export") == 0
    assert spark.read.parquet(f"{tmp_dir}/export").count() == read_table(spark, f"{lake}/gold").count()
    assert run("notify", "--log", f"{tmp_dir}/log", "--names", f"{tmp_dir}/names_sheet",
               "--out", f"{tmp_dir}/messages", "--checkpoint", f"{tmp_dir}/ck_notify") == 0
    assert spark.read.parquet(f"{tmp_dir}/messages").count() > 0
    # the fixture activities break the duration and date rules on purpose: exit status 1
    assert run("quality", "--activities", f"{tmp_dir}/activities", "--now", "2002-01-01") == 1
    out = capsys.readouterr().out
    assert "FAIL missing_count(start_date) = 0" in out and "PASS row_count > 0" in out


def test_input_bytes_applies_cluster_settings(spark):
    from strivelake.__main__ import parser
    from strivelake.session import apply_cluster_settings
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    args = parser().parse_args(["--input-bytes", str(1024 ** 4), "export", "--gold", "g",
                                "--out", "o"])
    assert args.input_bytes == 1024 ** 4
    try:
        apply_cluster_settings(spark, args.input_bytes)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4096"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
