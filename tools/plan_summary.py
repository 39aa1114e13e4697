"""Print the physical-operator skeleton of every registered query (after execution,
so AQE's final plan is shown): exchanges, joins, aggregates, window limits, scans.

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(
    r"(Exchange \w+(\([^)]*\))?|BroadcastExchange|BroadcastHashJoin \S+ \S+ \w+( \w+)?"
    r"|SortMergeJoin \S+ \S+ \w+|ShuffledHashJoin \S+ \S+ \w+|BroadcastNestedLoopJoin|CartesianProduct"
    r"|FileScan parquet [^\[]*|Scan parquet|HashAggregate\(keys=\[[^\]]*\]|SortAggregate\(key=\[[^\]]*\]"
    r"|ObjectHashAggregate|WindowGroupLimit \[[^\]]*\], \[[^\]]*\], \w+\(\), \d+, \w+|Window \[|Generate \w+"
    r"|InMemoryTableScan|Union|TakeOrderedAndProject|PushedFilters: \[[^\]]*\]|BatchEvalPython|ArrowEvalPython)")


def skeleton(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        m = KEEP.search(line)
        if m:
            out.append(line[:m.start()] + m.group(0)[:140])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from strivelake.plans.catalog import QUERIES
    from strivelake.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Physical plan skeletons\n")
    print(f"Final (post-AQE) plans of every registered query at `{sf_dir}`, local[8],")
    print("generated by `tools/plan_summary.py`. Only the operators that decide cost are")
    print("kept: scans (with pushed filters), exchanges, joins, aggregates and window limits.")
    print("Queries over written tables show the read-back plan.\n")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()  # after the run: the final adaptive plan
        plan = buf.getvalue()
        print(f"## {name}\n\n```")
        print("\n".join(skeleton(plan)) or "(narrow scan/project only)")
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
