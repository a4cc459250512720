"""Physical-plan inspection: what a reviewer checks with ``explain``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# operators that must never appear in a salescope plan
FORBIDDEN = {
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "non-equi / cross join",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF",
}


def physical_plan(df: DataFrame) -> str:
    """Text of the physical plan (the initial adaptive plan, before run)."""
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df: DataFrame) -> list[str]:
    """One line per file scan, with its PushedFilters / PartitionFilters."""
    return [ln.strip() for ln in physical_plan(df).splitlines() if "FileScan" in ln or "Scan parquet" in ln]


def forbidden_operators(df: DataFrame) -> list[str]:
    plan = physical_plan(df)
    return [f"{op} ({why})" for op, why in FORBIDDEN.items() if op in plan]


def pushed_filters(df: DataFrame, table: str) -> list[str]:
    """PushedFilters of the scans of ``table``."""
    out = []
    for ln in scans(df):
        if table in ln:
            m = re.search(r"PushedFilters: \[(.*?)\](, ReadSchema|$)", ln)
            if m:
                out.append(m.group(1))
    return out


def final_plan(df: DataFrame):
    """The final adaptive physical plan (JVM object) of ``df``, after AQE's
    runtime re-planning.  Runs ``df`` once on the executors and brings nothing to
    the driver; meant for review runs."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    plan = execution.executedPlan()
    return plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan


def _nodes(plan):
    """Every physical node once: query stages, reused exchanges and subquery
    plans are followed; nodes are de-duplicated by plan id."""
    seen, stack, out = set(), [plan], []
    while stack:
        node = stack.pop()
        cls = node.getClass().getSimpleName()
        key = (cls, node.id())  # query stages reuse small ids of their own
        if key in seen:
            continue
        seen.add(key)
        out.append((cls, node))
        if cls == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if cls.endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if cls == "ReusedExchangeExec":
            continue
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
        subs = node.subqueries()
        for i in range(subs.size()):
            stack.append(subs.apply(i))
    return out


def plan_summary(plan) -> dict[str, int]:
    """Counts of the operators a reviewer looks for in a final physical plan."""
    nodes = _nodes(plan)
    classes = [c for c, _ in nodes]

    def exchanges(kind: str) -> int:
        return sum(1 for c, n in nodes if c == "ShuffleExchangeExec"
                   and n.outputPartitioning().getClass().getSimpleName().startswith(kind))

    def scans_with(pattern: str) -> int:
        return sum(1 for c, n in nodes if c == "FileSourceScanExec" and re.search(pattern, n.toString()))

    return {
        "hash_exchanges": exchanges("HashPartitioning"),
        "range_exchanges": exchanges("RangePartitioning"),
        "single_partition_exchanges": exchanges("SinglePartition"),
        "reused_exchanges": classes.count("ReusedExchangeExec"),
        "broadcast_hash_joins": classes.count("BroadcastHashJoinExec"),
        "sort_merge_joins": classes.count("SortMergeJoinExec"),
        "windows": classes.count("WindowExec"),
        "window_group_limits": classes.count("WindowGroupLimitExec"),
        "take_ordered": classes.count("TakeOrderedAndProjectExec"),
        "partition_filters_with_subquery": scans_with(r"PartitionFilters: \[[^\]]*(Subquery|scalar-subquery)"),
        "dynamic_pruning": scans_with(r"dynamicpruning"),
        "cartesian_or_nested_loop": classes.count("CartesianProductExec") + classes.count("BroadcastNestedLoopJoinExec"),
        "python_udf": classes.count("BatchEvalPythonExec") + classes.count("ArrowEvalPythonExec"),
    }
