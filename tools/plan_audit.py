"""Execute every query of the main library and summarise the physical plans of all its
jobs, staged inputs included, from Spark's event log: the last plan that adaptive
execution reports for each SQL execution. Writes PLANS.md.
Usage: python tools/plan_audit.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from barlake import bindings  # noqa: E402
from barlake.session import get_session  # noqa: E402

# column -> (node name pattern, pattern in the node's text)
CHECKS = {
    "shuffles": (r"Exchange$", r"hashpartitioning|rangepartitioning|RoundRobin"),
    "range": (r"Exchange$", r"rangepartitioning"),
    "broadcast": (r"BroadcastExchange", r""),
    "single_partition": (r"Exchange$", r"SinglePartition"),
    "nested_loop_or_cartesian": (r"BroadcastNestedLoopJoin|CartesianProduct", r""),
    "sort_aggregate": (r"SortAggregate", r""),
    "python": (r"Python|Pandas|Arrow", r""),
    "partial_group_limit": (r"WindowGroupLimit", r"Partial"),
    "scans": (r"^Scan |^FileScan ", r""),
    "writes": (r"InsertIntoHadoopFsRelationCommand|WriteFiles", r"InsertInto"),
}


def _nodes(plan: dict):
    yield plan["nodeName"], plan["simpleString"]
    for child in plan["children"]:
        yield from _nodes(child)


def audit(events: list[dict]) -> Counter:
    """Node counts over the final plan of every SQL execution in ``events``."""
    plans = {e["executionId"]: e["sparkPlanInfo"] for e in events if "sparkPlanInfo" in e}  # the last one wins
    found: Counter = Counter()
    for plan in plans.values():
        for name, text in _nodes(plan):
            for column, (kind, says) in CHECKS.items():
                found[column] += bool(re.search(kind, name) and re.search(says, text))
    return found


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    folder = tempfile.mkdtemp(prefix="run-plans-")
    SparkSession.builder.master("local[8]").config(map={
        "spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}).getOrCreate()
    spark = get_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    lines = [
        "# PLANS — physical plan audit",
        "",
        f"Generated by `python tools/plan_audit.py {sf_dir}`: every query of the main library is executed and the final",
        "adaptive plans of all its SQL executions are counted, also those that staged, published or counted",
        "something before the last one. `single_partition` nodes carry one-row aggregates or one row per",
        "partition; `nested_loop_or_cartesian` and `python` must stay 0.",
        "",
        "| query | " + " | ".join(CHECKS) + " |",
        "|---|" + "---|" * len(CHECKS),
    ]
    at = 0
    for name in sys.argv[2:] or bindings.queries():
        bindings.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        (log,) = os.listdir(folder)
        with open(os.path.join(folder, log), encoding="utf-8") as fh:
            fh.seek(at)
            text = fh.read()
        whole = text[:text.rfind("\n") + 1]
        at += len(whole.encode())
        found = audit([json.loads(line) for line in whole.splitlines()])
        lines.append(f"| {name} | " + " | ".join(str(found[c]) for c in CHECKS) + " |")
        print(lines[-1], flush=True)
    if not sys.argv[2:]:
        with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
            fh.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
