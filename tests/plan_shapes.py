"""Walk executed (adaptive) physical plans and report shuffle exchanges."""

from __future__ import annotations


def _walk(node):
    cls = node.getClass().getSimpleName()
    if cls == "AdaptiveSparkPlanExec":
        yield from _walk(node.finalPhysicalPlan())
        return
    if cls in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ReusedExchangeExec"):
        yield from _walk(node.plan() if cls != "ReusedExchangeExec" else node.child())
        return
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _walk(children.apply(i))


def exchanges(df) -> list[tuple[str, int]]:
    """(partitioning, records written) of every shuffle exchange, after running ``df``."""
    df.write.format("noop").mode("overwrite").save()
    out = []
    for node in _walk(df._jdf.queryExecution().executedPlan()):
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            metrics = node.metrics()
            rows = metrics.get("shuffleRecordsWritten").get().value() \
                if metrics.contains("shuffleRecordsWritten") else -1
            out.append((node.outputPartitioning().toString(), int(rows)))
    return out


def single_partition_rows(df) -> int:
    """Largest number of rows any single-partition exchange carried (0 if none)."""
    return max([rows for part, rows in exchanges(df) if part.startswith("SinglePartition")],
               default=0)
