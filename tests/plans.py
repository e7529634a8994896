"""Helpers that look at executed plans."""

from __future__ import annotations

import re


def executed(df) -> str:
    """Final physical plan after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_part(plan: str) -> str:
    """The plan without the 'Initial Plan' sections that adaptive execution prints."""
    keep, skip = [], None
    for line in plan.splitlines():
        depth = len(re.match(r"[\s:|]*", line).group(0))
        if skip is not None and depth >= skip and "== Initial Plan ==" not in line and "== Final Plan ==" not in line:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            keep.append(line)
    return "\n".join(keep)


def scans(plan: str, table: str) -> int:
    """How often a table's files are read; reused exchanges do not count."""
    return len(re.findall(rf"FileScan \w+ .*?/{table}\.parquet", final_part(plan)))


def rows_read(spark) -> int:
    """Input rows of all stages so far (files read; shuffles do not count)."""
    import time

    time.sleep(0.5)
    sc = spark.sparkContext
    empty = sc._jvm.java.util.ArrayList
    doubles = sc._gateway.new_array(sc._jvm.double, 0)
    stages = sc._jsc.sc().statusStore().stageList(empty(), False, False, doubles, empty())
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


def source_rows_read(spark, table: str, since: int = -1) -> tuple[int, int]:
    """Rows that scans of a source table's files gave to queries after the execution ``since``, and the last execution."""
    import time

    time.sleep(0.5)
    store = spark._jsparkSession.sharedState().statusStore()
    runs, total, last = store.executionsList(), 0, since
    for i in range(runs.size()):
        number = runs.apply(i).executionId()
        if number <= since:
            continue
        last, metrics, nodes = max(last, number), store.executionMetrics(number), store.planGraph(number).allNodes()
        for k in range(nodes.size()):
            node = nodes.apply(k)
            if not node.name().startswith("Scan parquet") or f"/{table}.parquet" not in node.desc():
                continue
            for m in range(node.metrics().size()):
                metric = node.metrics().apply(m)
                value = metrics.get(metric.accumulatorId())
                if metric.name() == "number of output rows" and value.isDefined():
                    total += int(value.get().replace(",", ""))
    return total, last
