"""Plan shapes of registered queries (what the scale design relies on)."""
import re

import __spark_entry__ as E
from plan_text import plan_text

from conftest import SF_SMALL


def plan(spark, name):
    return plan_text(E.queries()[name](spark, SF_SMALL))


def test_one_employee_filter_reaches_the_scan(spark):
    p = plan(spark, "silver_one_employee")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_custkey,7\)", p)


def test_activities_read_only_needed_columns(spark):
    p = plan(spark, "gold_activities_by_year")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas and all("o_totalprice" not in s and "o_orderpriority" not in s for s in schemas)


def test_quality_scan_shuffles_once_on_id(spark):
    p = plan(spark, "quality_scan")
    assert len(re.findall(r"Arguments: hashpartitioning\(id#", p)) == 1
    assert "partial_count" in p


def test_latest_per_key_uses_partial_window_limit(spark):
    p = plan(spark, "cdc_latest_per_key")
    assert re.search(r"WindowGroupLimit.*Partial", p) or "Partial" in p.split("WindowGroupLimit", 1)[1]


def test_no_nested_loop_or_python_in_flagship_and_merges(spark):
    for name in ("gold_benefits_employee_year", "gold_years", "cdc_merge_state",
                 "notify_messages", "silver_employees_enriched"):
        p = plan(spark, name)
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
                    "ArrowEvalPython"):
            assert bad not in p, (name, bad)
