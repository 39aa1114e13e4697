import datetime as dt

import pytest

from strivelake.plans import pipelines
from strivelake.plans.inputs import Inputs
from strivelake.rules import FIXTURE_RULES
from strivelake.sources import fixtures
from strivelake.sources.tables import read_table, table_exists, write_table

from conftest import SF_SMALL

AS_OF = dt.date(2002, 1, 1)


def test_ref_job_writes_both_tables(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    i.employee_sheet.write.parquet(f"{tmp_dir}/rh_sheet")
    fixtures.sport_sheet(spark, SF_SMALL).write.parquet(f"{tmp_dir}/sport_sheet")
    pipelines.ref_job(spark, f"{tmp_dir}/rh_sheet", f"{tmp_dir}/sport_sheet", tmp_dir)
    rh = read_table(spark, f"{tmp_dir}/ref/rh")
    sport = read_table(spark, f"{tmp_dir}/ref/sport")
    assert "commute_mode" in rh.columns and rh.count() == i.employees.count()
    assert sport.columns == ["employee_id", "Pratique_dun_sport"]


def test_silver_one_employee_mode_writes_elsewhere(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    acts = i.activities.withColumn("last_op", i.activities.id.cast("string"))
    _, enriched = pipelines.silver_job(spark, acts, i.employees, i.routes, tmp_dir, only_employee=7)
    assert [r.employee_id for r in enriched.collect()] == [7]
    assert table_exists(spark, f"{tmp_dir}/only_employee=7/silver/rh_enriched")
    assert not table_exists(spark, f"{tmp_dir}/silver/rh_enriched")
    with pytest.raises(ValueError, match="not found"):
        pipelines.silver_job(spark, acts, i.employees, i.routes, tmp_dir, only_employee=10 ** 9)


def test_gold_job_checks_before_writing_and_export(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    out = f"{tmp_dir}/gold"
    g = pipelines.gold_job(spark, i.activities, i.enriched, i.sport_ref, FIXTURE_RULES, AS_OF, out=out)
    n = g.count()
    g.unpersist()
    files = read_table(spark, out).inputFiles()
    dup = i.enriched.unionByName(i.enriched.limit(1))
    with pytest.raises(ValueError, match="duplicate"):
        pipelines.gold_job(spark, i.activities, dup, i.sport_ref, FIXTURE_RULES, AS_OF, out=out)
    assert read_table(spark, out).inputFiles() == files         # the failed run wrote nothing
    path = pipelines.export_job(spark, out, f"{tmp_dir}/export")
    back = spark.read.parquet(path)
    assert back.count() == n
    rows = [(r.year, r.employee_id) for r in back.collect()]
    assert rows == sorted(rows)                                 # part files in order are sorted
    with pytest.raises(ValueError, match="empty"):
        write_table(back.limit(0), f"{tmp_dir}/empty")
        pipelines.export_job(spark, f"{tmp_dir}/empty", f"{tmp_dir}/export2")
