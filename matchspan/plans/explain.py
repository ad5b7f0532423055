"""Plan inspection: what a query will shuffle, scan and broadcast.

Reads the physical plan Spark prepared (before adaptive re-planning), so
checks run without executing the query.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class PlanReport:
    exchanges: Counter = field(default_factory=Counter)  # kind -> count
    scans: list[dict] = field(default_factory=list)  # one dict per file scan
    broadcasts: int = 0
    nested_loop_or_cartesian: bool = False
    text: str = ""


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def report(df: DataFrame) -> PlanReport:
    """Count exchanges by origin (``REPARTITION_BY_COL`` for explicit
    repartitions, ``ENSURE_REQUIREMENTS`` for ones Spark inserted), list file
    scans with their pushed filters and read schema, count broadcasts."""
    text = physical_plan(df)
    r = PlanReport(text=text)
    for m in re.finditer(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)"
                         r"[^\n]*?(REPARTITION_BY_COL|REPARTITION_BY_NUM|ENSURE_REQUIREMENTS)", text):
        r.exchanges[m.group(2)] += 1
    r.broadcasts = text.count("BroadcastExchange")
    r.nested_loop_or_cartesian = "CartesianProduct" in text or "NestedLoopJoin" in text
    jplan = df._jdf.queryExecution().executedPlan()
    for node in _collect_scans(jplan):
        meta = node.metadata()
        r.scans.append({k: meta.get(k).get() if meta.get(k).isDefined() else None
                        for k in ("PushedFilters", "ReadSchema", "Location")})
    return r


def _collect_scans(plan):
    out = []
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan") and node.getClass().getSimpleName() == "FileSourceScanExec":
            out.append(node)
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            stack.append(node.inputPlan())
    return out
