"""Counts what an executed plan really did: nodes of the final adaptive plans, an exchange that is reused counts once."""

from collections import Counter


def executed(df) -> Counter:
    """Runs ``df`` and counts its operators by class, with ``scan <columns>`` for every file scan."""
    df.collect()
    seen = Counter()
    _walk(df._jdf.queryExecution().executedPlan(), seen)
    return seen


def _walk(node, seen: Counter) -> None:
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _walk(node.executedPlan(), seen)
    if kind.endswith("QueryStageExec"):
        return _walk(node.plan(), seen)
    seen[kind] += 1
    if kind == "FileSourceScanExec":
        seen["scan " + ",".join(node.requiredSchema().fieldNames())] += 1
    if kind == "ReusedExchangeExec":
        return None
    for children in (node.children(), node.subqueries()):
        for i in range(children.size()):
            _walk(children.apply(i), seen)
